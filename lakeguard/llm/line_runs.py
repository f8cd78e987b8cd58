"""Repeated line runs from a suffix array over line-ID sequences.

The lines of all documents (in doc_id order) form one sequence of positions
with a gap behind every document; a line's ID is the first position of an equal
line, and lines that occur once take no part.  The suffix array is built by
distributed prefix doubling (``ordered``): each step sorts the positions whose
prefix is not yet unique by (rank, rank of the position one prefix further) over
range partitions, and a position's new rank is the place of the first suffix
with an equal prefix of twice the length.  Ranges are cut by position too, so
a line that fills a third of the corpus is sorted by many tasks; what runs over
the border of two partitions is put right from one row per partition.
Positions leave once their prefix is unique, with their final rank.

A run counts as repeated from MIN_WORDS words on.  Every maximal repeated run
of so many words is the union of minimal windows: from each line forward, and
from each line backward, the fewest lines that hold MIN_WORDS words, so at most
MIN_WORDS lines.  Doubling therefore stops once prefixes hold the longest
window.  One pass over the sorted array takes the longest common prefix of each
two neighbours and keeps, per length, the place where the current
longest-common-prefix interval began (``intervals``).  A window is repeated if
its interval holds an earlier position; its lines are deleted there, so only
the first copy of each run stays.

Defined cases: a line without a word belongs to no run and stays where the rest
of its text stays; lines are compared without blanks at their ends; null and
empty texts have no lines; null doc_ids come last, ordered by their text; rows
that share doc_id and text are one document and get the same result; an empty
table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeguard.llm.common import WORD, materialise, slices, small_batches
from lakeguard.session import local_table

MIN_WORDS = 50
_WORD = re.compile(WORD)
_BLANK = " \t\n\v\f\r"

_FIELDS = {"doc_id": pa.int64(), "digest": pa.string(), "p0": pa.int64(), "first": pa.bool_(), "idx": pa.list_(pa.int32()),
           "h1": pa.list_(pa.int64()), "h2": pa.list_(pa.int64()), "lens": pa.list_(pa.list_(pa.int32()))}


def windows(words: list[int], least: int) -> list[list[int]]:
    """Per line, the lengths of the minimal windows of ``least`` words that begin there."""
    n = len(words)
    found: list[set[int]] = [set() for _ in words]
    end = total = 0
    for start in range(n):           # fewest lines from here on
        while end < n and total < least:
            total += words[end]
            end += 1
        if total >= least:
            found[start].add(end - start)
        total -= words[start]
    start = total = 0
    for last in range(n):            # fewest lines up to here
        total += words[last]
        while total - words[start] >= least:
            total -= words[start]
            start += 1
        if total >= least:
            found[start].add(last + 1 - start)
    return [sorted(f) for f in found]


def lines_of(text: str | None, least: int):
    """Line numbers, two halves of each line's digest, and window lengths of a text's lines with words."""
    idx, h1, h2, words = [], [], [], []
    for i, line in enumerate(text.split("\n") if text else ()):
        count = len(_WORD.findall(line))
        if count:
            digest = hashlib.blake2b(line.strip(_BLANK).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            idx.append(i)
            h1.append(int.from_bytes(digest[:8], "little", signed=True))
            h2.append(int.from_bytes(digest[8:], "little", signed=True))
            words.append(count)
    return idx, h1, h2, windows(words, least)


def numbered(docs: DataFrame, least: int) -> DataFrame:
    """One row per document: the position p0 of its first line, and its lines.

    Documents are range-partitioned by (doc_id, digest); partition number and
    place within the partition make a position.
    """
    def cut(batches):
        for batch in batches:
            for piece in slices(batch):
                made = [lines_of(t, least) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("digest")]
                    + [pa.array([m[j] for m in made], t) for j, t in enumerate(list(_FIELDS.values())[4:])],
                    names=["doc_id", "digest", "idx", "h1", "h2", "lens"])

    def place(batches):
        at, before, p0 = TaskContext.get().partitionId() << 40, None, 0
        for batch in batches:
            p0s, firsts = [], []
            for key, idx in zip(zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist()),
                                batch.column("idx")):
                firsts.append(key != before)
                if key != before:
                    before, p0 = key, at
                    at += len(idx) + 1
                p0s.append(p0)
            columns = {c: batch.column(c) for c in batch.schema.names} | {
                "p0": pa.array(p0s, pa.int64()), "first": pa.array(firsts, pa.bool_())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in _FIELDS], names=list(_FIELDS))

    arrays = "idx array<int>, h1 array<long>, h2 array<long>, lens array<array<int>>"
    lines = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text").mapInArrow(
        cut, f"doc_id long, digest string, {arrays}")
    ranged = lines.repartitionByRange(_partitions(docs.sparkSession), F.asc_nulls_last("doc_id"), "digest").sortWithinPartitions(
        F.asc_nulls_last("doc_id"), "digest")
    return ranged.mapInArrow(place, f"doc_id long, digest string, p0 long, first boolean, {arrays}")


def ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose key occurs at several positions, with ``rank``: the first of them."""
    groups = (rows.groupBy(*[F.col(k).alias(f"__{k}") for k in key])
              .agg(F.min("p").alias("rank"), F.count("*").alias("n")).where("n > 1").drop("n"))
    on = [F.col(k) == F.col(f"__{k}") for k in key]
    return rows.join(groups, on).drop(*key, *[f"__{k}" for k in key])


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def _wide_batches(spark: SparkSession):
    """Rows of numbers alone may fill larger Arrow batches than texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    try:
        yield
    finally:
        small_batches(spark)


def ordered(rows: DataFrame, name: str) -> DataFrame:
    """(p, rank, alone) of ``rows`` (head, tail, p) in the order of (head, tail).

    ``head`` is the place where the suffixes with the prefix so far begin; ``rank``
    is the place where those with an equal tail begin, and ``alone`` tells that
    there is one only.
    """
    spark = rows.sparkSession

    def place(batches):
        part, at, hs, gs, last, held = TaskContext.get().partitionId(), 0, 0, 0, None, None

        def out(cols, follows):
            p, head, tail, index, h, g, new = cols
            arrays = [np.full(len(p), part, np.int32), index, h, g, new & follows, p, head, tail]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["part", "at", "hs", "gs", "alone", "p", "head", "tail"])

        for batch in batches:
            if not batch.num_rows:
                continue
            head, tail, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("head", "tail", "p"))
            new_head, new = np.ones(len(p), bool), np.ones(len(p), bool)
            new_head[1:] = head[1:] != head[:-1]
            new[1:] = new_head[1:] | (tail[1:] != tail[:-1])
            if last is not None:
                new_head[0] = head[0] != last[0]
                new[0] = new_head[0] or tail[0] != last[1]
            index = np.arange(at, at + len(p), dtype=np.int64)
            h = np.maximum.accumulate(np.where(new_head, index, hs))
            g = np.maximum.accumulate(np.where(new, index, gs))
            at, hs, gs, last = at + len(p), h[-1], g[-1], (head[-1], tail[-1])
            cols = [p, head, tail, index, h, g, new]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            held = [c[-1:] for c in cols]       # whether it is alone shows with the next row
            if len(cols[0]) > 1:
                yield out([c[:-1] for c in cols], cols[6][1:])
        if held is not None:
            yield out(held, np.ones(1, bool))

    ranged = rows.select("head", "tail", "p").repartitionByRange(_partitions(spark), "head", "tail", "p").sortWithinPartitions(
        "head", "tail", "p")
    with _wide_batches(spark):
        placed = materialise(ranged.mapInArrow(
            place, "part int, at long, hs long, gs long, alone boolean, p long, head long, tail long"), name)
    edges = placed.groupBy("part").agg(F.count("*").alias("n"), F.min_by(F.struct("head", "tail"), "at").alias("first"),
                                       F.max_by(F.struct("head", "tail", "hs", "gs"), "at").alias("last")).collect()
    bounds, base, before, h, g = [], 0, None, 0, 0
    for e in sorted(edges, key=lambda e: e["part"]):
        same_head = before is not None and before["head"] == e["first"]["head"]
        same = same_head and before["tail"] == e["first"]["tail"]
        h, g = h if same_head else base, g if same else base
        if same:
            bounds[-1][5] = True
        bounds.append([e["part"], base, h, g, same, False, e["n"]])
        before = e["last"]
        h, g = h if before["hs"] == 0 else base + before["hs"], g if before["gs"] == 0 else base + before["gs"]
        base += e["n"]
    # one row of numbers per partition
    sides = F.broadcast(local_table(spark, bounds, "part int, base long, h long, g long, same_before boolean, same_after boolean, n long"))
    first_head = F.when(F.col("hs") == 0, F.col("h")).otherwise(F.col("base") + F.col("hs"))
    first = F.when(F.col("gs") == 0, F.col("g")).otherwise(F.col("base") + F.col("gs"))
    alone = F.expr("alone and not (at = 0 and same_before) and not (at = n - 1 and same_after)")
    return placed.join(sides, "part").select("p", (F.col("head") + first - first_head).alias("rank"), alone.alias("alone"))


def suffix_array(ids: DataFrame, longest: int) -> DataFrame:
    """(p, rank, alone, depth) of the positions ``ids`` (p, rank: the line's ID), ordered by ``longest`` lines at least.

    ``rank`` is the place of the first suffix with the same lines, ``depth`` the prefix length at which it was found.
    """
    level, depth = ordered(ids.select(F.lit(0).cast("long").alias("head"), F.col("rank").alias("tail"), "p"), "order1"), 1
    finished = None
    while depth < longest:
        active = level.where("not alone")
        if active.isEmpty():
            break
        alone = level.where("alone").withColumn("depth", F.lit(depth))
        known = level.select("p", "rank") if finished is None else level.select("p", "rank").union(finished.select("p", "rank"))
        finished = alone if finished is None else finished.union(alone)
        tails = known.select((F.col("p") - depth).alias("p"), F.col("rank").alias("tail"))
        # what has no line behind it (a document's end or a line that occurs once) equals nothing else
        pairs = active.select("p", F.col("rank").alias("head")).join(tails, "p", "left").withColumn(
            "tail", F.coalesce("tail", -1 - F.col("p")))
        depth *= 2
        level = ordered(pairs, f"order{depth}")
    level = level.withColumn("depth", F.lit(depth))
    return level if finished is None else finished.union(level)


def common_prefix(a: tuple[list, list], b: tuple[list, list]) -> int:
    """Number of equal lines (two halves of their digests) two windows begin with."""
    n = 0
    for x in zip(*a, *b):
        if x[0] != x[2] or x[1] != x[3]:
            break
        n += 1
    return n


def intervals(suffixes: DataFrame, longest: int) -> DataFrame:
    """(p0, p, len, start) of each window of ``suffixes`` (rank, p, p0, lens, c1, c2: the lines of the longest window).

    ``start`` is the place in the sorted array where the interval begins whose
    suffixes share at least ``len`` lines with this one.
    """
    spark = suffixes.sparkSession
    names = ["part", "p0", "p", "len", "start", "edge"]
    edge_type = pa.struct([("n", pa.int64()), *[(k, pa.list_(pa.int64())) for k in ("f1", "f2", "l1", "l2", "ends")]])
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), edge_type]

    def walk(batches):
        part, at, starts, first, last = TaskContext.get().partitionId(), 0, [0] * (longest + 1), None, None
        for batch in batches:
            made = []
            for p0, p, lens, *window in zip(*(batch.column(c).to_pylist() for c in ("p0", "p", "lens", "c1", "c2"))):
                if last is None:
                    first = window
                else:
                    shared = common_prefix(last, window)
                    starts[shared + 1:] = [at] * (longest - shared)
                last, at = window, at + 1
                made += [(part, p0, p, n, starts[n], None) for n in lens]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)] if made
                                             else [pa.array([], t) for t in types], names=names)
        if first is not None:
            edge = {"n": at, "f1": first[0], "f2": first[1], "l1": last[0], "l2": last[1], "ends": starts}
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, None, None, None, None, edge), types)], names=names)

    ranged = suffixes.repartitionByRange(_partitions(spark), "rank", "p").sortWithinPartitions("rank", "p")
    arrays = ", ".join(f"{k}: array<bigint>" for k in ("f1", "f2", "l1", "l2", "ends"))
    made = materialise(ranged.mapInArrow(
        walk, f"part int, p0 long, p long, len int, start long, edge struct<n: bigint, {arrays}>"), "intervals")
    # one row per partition, of at most MIN_WORDS lines each
    edges = made.where("edge is not null").select("part", "edge.*").collect()
    bounds, base, before, open_at = [], 0, None, []
    for e in sorted(edges, key=lambda e: e["part"]):
        shared = -1 if before is None else common_prefix((before["l1"], before["l2"]), (e["f1"], e["f2"]))
        open_at = [open_at[n] if n <= shared else base for n in range(longest + 1)]
        bounds.append((e["part"], base, list(open_at)))
        open_at = [open_at[n] if e["ends"][n] == 0 else base + e["ends"][n] for n in range(longest + 1)]
        before, base = e, base + e["n"]
    sides = F.broadcast(local_table(spark, bounds, "part int, base long, open_at array<long>"))
    start = F.when(F.col("start") == 0, F.expr("open_at[len]")).otherwise(F.col("base") + F.col("start"))
    return made.where("edge is null").join(sides, "part").select("p0", "p", "len", start.alias("start"))


def repeated_windows(numbered_docs: DataFrame) -> DataFrame:
    """(p0, p, len) of every minimal window that occurs earlier."""
    docs = numbered_docs.where("first and size(idx) > 0")
    longest = docs.agg(F.max(F.array_max(F.flatten("lens")))).first()[0] or 0
    lines = (docs.select("p0", F.posexplode(F.arrays_zip("h1", "h2")).alias("i", "line"))
             .select((F.col("p0") + F.col("i")).alias("p"), "line.*"))
    order = suffix_array(ranked(lines, ["h1", "h2"]), longest)
    # the lines of each position's longest window, cut before the rows are: no row carries its whole document
    context = {c: F.expr(f"transform(lens, (l, i) -> slice({h}, i + 1, coalesce(array_max(l), 0)))")
               for c, h in (("c1", "h1"), ("c2", "h2"))}
    windows_at = (docs.select("p0", "lens", *[e.alias(c) for c, e in context.items()])
                  .select("p0", F.posexplode(F.arrays_zip("lens", "c1", "c2")).alias("i", "line"))
                  .select("p0", (F.col("p0") + F.col("i")).alias("p"), "line.*").where("size(lens) > 0"))
    # a suffix that was alone before its shortest window ended shares none
    shared = windows_at.join(order, "p").where("not alone or array_min(lens) < depth").drop("alone", "depth")
    found = intervals(shared, longest).withColumn("size", F.col("len"))
    return ranked(found, ["start", "size"]).where("rank < p").select("p0", "p", "len")


def removals(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest (md5 of the text), n_lines and the numbers of the lines to delete."""
    small_batches(docs.sparkSession)
    placed = materialise(numbered(docs, least), "lines")
    later = repeated_windows(placed).select("p0", F.explode(F.expr("sequence(p - p0, p - p0 + len - 1)")).alias("i"))
    gone = later.groupBy(F.col("p0").alias("__p0")).agg(F.collect_set("i").alias("gone"))
    return placed.join(gone, F.col("p0") == F.col("__p0"), "left").select(
        "doc_id", "digest", F.size("idx").alias("n_lines"),
        F.array_sort(F.coalesce(F.expr("transform(gone, i -> idx[int(i)])"), F.array().cast("array<int>"))).alias("removed"))


def deduplicate(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies of repeated runs; documents of which nothing is left are dropped.

    Columns stay; ``n_chars``, if there, follows the new text.
    """
    hits = materialise(removals(docs, least).where("size(removed) > 0").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "removed",
        (F.size("removed") == F.col("n_lines")).alias("__empty")).distinct(), "removals")
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__doc"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("__md5"))
    joined = rows.join(hits, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__md5") == F.col("__digest")), "left")
    left = joined.where("not coalesce(__empty, false)")
    kept = F.array_join(F.filter(F.split("__row.text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("__row.text")).otherwise(kept)
    out = left.select("__row", text.alias("__text"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("__text").alias("text"))
        elif name == "n_chars":
            columns.append(F.length("__text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"__row.`{name}`").alias(name))
    return out.select(*columns)
