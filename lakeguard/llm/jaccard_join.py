"""Similarity join of documents on word shingles by chosen paths.

A document is the set of hashes of its five-word shingles.  In each of several
independent runs a set follows a random tree of paths: at a node it chooses
each of its shingles with probability 1 / (similarity * size), decided by a
hash of node and shingle, so similar sets choose shared shingles and meet in
the same child.  Buckets (nodes) of few sets are compared by brute force,
larger ones split again; runs repeat until pairs at the threshold meet with the
target recall.

* Equal sets are one node of the join from the start; copies are counted, never
  paired.
* In a small bucket, sketches (64 one-byte minimum hashes) link the sets that may
  be similar; only a spanning star of each linked part leaves the task.
* In a large bucket every set is first compared with one pivot.  Sets like the
  pivot are settled among themselves; only buckets that hold an unsettled set
  split on.  Buckets that are still large at the last depth are compared in
  blocks.
* Connected parts gather in clusters, whose sets are sent once and compared
  exactly, block against block, inside tasks.  The tasks return link counts and
  spanning stars, so dense groups never become rows of pairs.

Result: per document its class (the smallest doc_id of its connected part) and
its number of links (other documents with a similarity of at least SIMILARITY).

Defined cases: a text of one to four words is one shingle; a null, empty or
blank text is similar to nothing and a class of its own; a null doc_id names no
class while another id can; rows with equal ids are documents like others; an
empty table gives an empty result; other columns are kept by ``one_per_class``.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeguard.llm.common import WORD, map_texts, materialise, small_batches
from lakeguard.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
FIRST_DEPTH = 2                # choices made before buckets are formed: a passage that many texts share fills no bucket alone
DEPTH = 3
SMALL = 256                    # sets a bucket may hold to be compared by brute force
SKETCH_BLOCK = 1024            # sets of a block where sketches (64 bytes each) are compared
BLOCK_SETS, BLOCK_TOKENS = 256, 400_000    # the same where whole sets are
SKETCH = 64
SKETCH_LOSS = 1e-5             # how likely a pair at the threshold may fail the sketches; the recall counts it
TOKEN_BLOCK = 1 << 16          # shingles of a set hashed at once, which bounds the memory for a very long text
SMALL_NODES = 500_000          # ids up to which they are broadcast; beyond, texts are shuffled to them

_WORD = re.compile(WORD)
_WORD_CACHE = 500_000


def sketch_least(similarity: float) -> int:
    """Equal bytes of two sketches from which a pair is checked exactly.

    Those of a pair at the threshold agree independently, each with the similarity or by chance of a byte; the largest
    number is taken that such a pair misses with probability SKETCH_LOSS at most (binomial tail).
    """
    p, tail = similarity + (1 - similarity) / 256, 0.0
    for k in range(SKETCH + 1):
        tail += math.comb(SKETCH, k) * p ** k * (1 - p) ** (SKETCH - k)
        if tail > SKETCH_LOSS:
            return k
    return SKETCH


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met, and passed the sketches, with the wanted probability.

    Such a pair shares at least one chosen shingle on average at every node.
    """
    recall = min(recall / (1 - SKETCH_LOSS), 1 - 1e-12)
    meets = 1.0
    for _ in range(depth):
        meets = 1 - math.exp(-meets)
    return math.ceil(math.log(1 - recall) / math.log(1 - meets))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (constants of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingle_set(text: str | None, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = _WORD.findall(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(cache) > _WORD_CACHE:
        cache.clear()
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    return np.unique(mix(total))


def choose(tokens: np.ndarray, nodes: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Children that a set goes on to from its nodes, and the place of each one's parent in ``nodes``.

    Tokens are spread hashes already, so a product with a node's odd number orders them anew.
    """
    share = 1 / (similarity * len(tokens))
    odd = mix(nodes) | np.uint64(1)
    if share >= 1:
        parent = np.repeat(np.arange(len(nodes)), len(tokens))
        return mix((odd[:, None] * tokens[None, :]).ravel() + odd[parent]), parent
    children, parents = [], []
    for begin in range(0, len(tokens), TOKEN_BLOCK):
        hashed = odd[:, None] * tokens[None, begin:begin + TOKEN_BLOCK]
        parent, place = np.nonzero(hashed < np.uint64(int(share * 2.0 ** 64)))
        children.append(mix(hashed[parent, place] + odd[parent]))
        parents.append(parent)
    return np.concatenate(children), np.concatenate(parents)


def sketch(tokens: np.ndarray) -> bytes:
    """One byte of each of SKETCH minimum hashes of a set that is not empty."""
    salts = mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    least = np.full(SKETCH, np.iinfo(np.uint64).max)
    for begin in range(0, len(tokens), TOKEN_BLOCK):
        least = np.minimum(least, (salts[:, None] * tokens[None, begin:begin + TOKEN_BLOCK]).min(axis=1))
    return mix(least).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, runs: int, similarity: float) -> DataFrame:
    """doc_id, r (hash of the row), the 128-bit key of the shingle set, its size, and its nodes at FIRST_DEPTH in all runs."""
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    cache = WordHashes()

    def fn(texts):
        out = {"s1": [], "s2": [], "n": [], "paths": []}
        for text in texts:
            tokens = shingle_set(text, cache)
            key = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), np.int64)
            out["s1"].append(int(key[0]))
            out["s2"].append(int(key[1]))
            out["n"].append(len(tokens))
            nodes = seeds
            for _ in range(FIRST_DEPTH if len(tokens) else 0):
                nodes = choose(tokens, nodes, similarity)[0]
            out["paths"].append((nodes if len(tokens) else tokens).view(np.int64))
        return out

    fields = {"s1": pa.int64(), "s2": pa.int64(), "n": pa.int64(), "paths": pa.list_(pa.int64())}
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("r"), "text")
    return map_texts(rows, ["doc_id", "r"], fn, fields, "s1 long, s2 long, n long, paths array<long>")


def candidate_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """nid, tokens and sketch of the listed rows (r, nid); repeated rows may give a node twice."""
    cache = WordHashes()

    def fn(texts):
        sets = [shingle_set(t, cache) for t in texts]
        return {"tokens": [s.view(np.int64) for s in sets], "sketch": [sketch(s) if len(s) else b"" for s in sets]}

    wanted = nodes.select(F.col("r").alias("__r"), "nid")
    if nodes.count() <= SMALL_NODES:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.xxhash64("doc_id", "text").alias("__key"), "text").join(wanted, F.col("__key") == F.col("__r"))
    return map_texts(rows.select("nid", "text"), ["nid"], fn, {"tokens": pa.list_(pa.int64()), "sketch": pa.binary()},
                     "tokens array<long>, sketch binary")


def groups(batches, keys: list[str], columns: list[str]):
    """Numpy arrays of ``columns`` for each run of rows with equal keys in sorted batches, behind its key."""
    held_key, held = None, []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key_of = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        changes = np.zeros(n - 1, bool)
        for c in key_of:
            changes |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
        for begin, end in zip(cuts, cuts[1:]):
            key = tuple(c[begin] for c in key_of)
            if key != held_key:
                if held:
                    yield held_key, [np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*held)]
                held_key, held = key, []
            held.append([v[begin:end] for v in values])
    if held:
        yield held_key, [np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*held)]


def stars(ids: np.ndarray, linked: np.ndarray):
    """Spanning stars (member, smallest id) of the parts that a symmetric matrix links."""
    label = ids.copy()
    while True:
        lowest = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, lowest)
        if (new == label).all():
            break
        label = new
    away = label != ids
    return ids[away], label[away]


def agreement(sketches: np.ndarray) -> np.ndarray:
    """Equal bytes of every two rows."""
    m = len(sketches)
    if m <= 48:
        return (sketches[:, None, :] == sketches[None, :, :]).sum(axis=2)
    equal = np.zeros((m, m), np.int16)
    for column in sketches.T:
        equal += column[:, None] == column[None, :]
    return equal


def sketch_links(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Edges (a, b) between sets of a bucket whose sketches agree; rows: keys, nid, block, sketch.

    Where two blocks of a bucket meet, the parts linked within either block are
    known from that block alone, so one edge for every two linked parts will do.
    """
    def run(batches):
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, (ids, blocks, sketches) in groups(batches, keys, ["nid", "block", "sketch"]):
            if len(ids) < 2:
                continue
            ids, first = np.unique(ids, return_index=True)
            if len(ids) < 2:
                continue
            table = np.frombuffer(b"".join(sketches[first].tolist()), np.uint8).reshape(-1, SKETCH)
            if len(ids) == 2:
                if (table[0] == table[1]).sum() >= least:
                    a.append(ids[1:])
                    b.append(ids[:1])
                continue
            linked = agreement(table) >= least
            if linked.sum() == len(ids):
                continue
            across = blocks[first][:, None] != blocks[first][None, :]
            if across.any():
                part = ids.copy()
                member, root = stars(ids, linked & ~across)
                part[np.searchsorted(ids, member)] = root
                x, y = np.nonzero(linked & across)
                x, y = np.unique(np.sort(np.stack([part[x], part[y]], axis=1), axis=1), axis=0).T
            else:
                x, y = stars(ids, linked)
            a.append(x)
            b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return (rows.select(*keys, "nid", "block", "sketch").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long"))


def split(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Children (path, nid, open) of the rows (path, nid, open).

    The paths of a set (a few per run) go to its tokens in one row, so no set is sent twice.
    """
    def run(batches):
        for batch in batches:
            path, nid, is_open = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
            for node, paths, opens, tokens in zip(*(batch.column(c).to_numpy(zero_copy_only=False)
                                                    for c in ("nid", "paths", "opens", "tokens"))):
                children, parent = choose(tokens.view(np.uint64), paths.view(np.uint64), similarity)
                path.append(children.view(np.int64))
                nid.append(np.full(len(children), node, np.int64))
                is_open.append(opens[parent])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (path, nid, is_open)], names=["path", "nid", "open"])

    mine = materialise(rows.groupBy("nid").agg(F.collect_list(F.struct("path", "open")).alias("p")), "to_split")
    if mine.count() <= SMALL_NODES:
        mine = F.broadcast(mine)        # a few paths per listed id: the sets stay where they are
    return (mine.join(sets.select("nid", "tokens"), "nid")
            .select("nid", "p.path", "p.open", "tokens").toDF("nid", "paths", "opens", "tokens")
            .mapInArrow(run, "path long, nid long, open boolean"))


def in_blocks(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Rows of groups dealt to pairs of blocks (b1 <= b2); sizes: key and number of blocks.

    Every two rows of a group meet in exactly one pair of blocks; ``block`` is
    the row's own.
    """
    dealt = rows.join(sizes, key).withColumn("block", F.expr("int(pmod(xxhash64(nid), blocks))"))
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    return dealt.withColumn("__o", other).withColumns(
        {"b1": F.least("block", "__o"), "b2": F.greatest("block", "__o")}).drop("__o", "blocks")


def candidate_edges(level: DataFrame, sets: DataFrame, similarity: float) -> list[DataFrame]:
    """Edges between sets that met in a bucket and have like sketches; level: path, nid."""
    sketches, least = sets.select("nid", "sketch"), sketch_least(similarity)
    level = level.withColumn("open", F.lit(True))
    edges = []
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count("*").alias("m"), F.min("nid").alias("pivot"), F.max("open").alias("any_open"))
        sizes = materialise(sizes.where("m > 1 and any_open"), f"sizes{depth}")
        small = level.join(sizes.where(F.col("m") <= SMALL), "path").join(sketches, "nid").withColumn("block", F.lit(0))
        edges.append(materialise(sketch_links(small, ["path"], least).distinct(), f"edges{depth}"))
        large = sizes.where(F.col("m") > SMALL)
        if large.isEmpty():
            break
        # Every set of a large bucket against its pivot: the like ones are settled among themselves.
        pivots = large.join(sketches.withColumnRenamed("sketch", "p_sketch"), F.col("pivot") == F.col("nid")).drop("nid")
        met = level.join(pivots.select("path", "pivot", "p_sketch"), "path").join(sketches, "nid")
        equal = F.expr(f"aggregate(sequence(1, {SKETCH}), 0, (s, j) -> s + int(substring(sketch, j, 1) = substring(p_sketch, j, 1)))")
        met = materialise(met.select("path", "nid", "open", "pivot", (equal >= least).alias("like")), f"met{depth}")
        edges.append(met.where("like and nid != pivot").select(F.col("nid").alias("a"), F.col("pivot").alias("b")).distinct())
        still = met.select("path", "nid", (F.col("open") & ~F.col("like")).alias("open"))
        unsettled = still.where("open").select("path").distinct()
        still = materialise(still.join(unsettled, "path", "left_semi").distinct(), f"still{depth}")
        if depth < DEPTH:
            level = materialise(split(still, sets, similarity)
                                .groupBy("path", "nid").agg(F.max("open").alias("open")), f"level{depth + 1}")
        elif not still.isEmpty():
            blocks = still.groupBy("path").agg(F.ceil(F.count("*") / SKETCH_BLOCK).cast("int").alias("blocks"))
            dealt = in_blocks(still.join(sketches, "nid"), blocks, "path")
            edges.append(materialise(sketch_links(dealt, ["path", "b1", "b2"], least).distinct(), "edges_blocks"))
    return edges


def overlaps(rows) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays."""
    m = len(rows)
    if m == 2:
        shared = len(np.intersect1d(rows[0], rows[1], assume_unique=True))
        return np.array([[len(rows[0]), shared], [shared, len(rows[1])]], np.int64)
    values, inverse, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), [len(r) for r in rows])
    used = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[used]]
    owner = owner[used]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total, width = np.zeros((m, m), np.float32), 4096
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [begin, begin + width])
        part = np.zeros((m, width), np.float32)
        part[owner[lo:hi], column[lo:hi] - begin] = 1
        total += part @ part.T
    return total.astype(np.int64)


def verify(rows: DataFrame, similarity: float) -> DataFrame:
    """Exact comparison within (cid, b1, b2); rows hold nid, block, copies, tokens.

    Returns (nid, links, root): copies linked to a set in this group, and one
    end of a spanning star where ``root`` is not null.
    """
    def run(batches):
        for key, (ids, block, copies, tokens) in groups(batches, ["cid", "b1", "b2"], ["nid", "block", "copies", "tokens"]):
            ids, first = np.unique(ids, return_index=True)
            if len(ids) < 2:
                continue
            block, copies, sets = block[first], copies[first], tokens[first]
            size = np.array([len(s) for s in sets])
            shared = overlaps(sets)
            linked = shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-9
            np.fill_diagonal(linked, False)
            if key[1] != key[2]:
                linked &= block[:, None] != block[None, :]
            links = linked @ copies
            x, y = stars(ids, linked)
            root = dict(zip(x.tolist(), y.tolist()))
            hit = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[hit]), pa.array(links[hit], pa.int64()), pa.array([root.get(i) for i in ids[hit].tolist()], pa.int64())],
                names=["nid", "links", "root"])

    keys = ["cid", "b1", "b2"]
    return (rows.select(*keys, "nid", "block", "copies", "tokens").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "nid long, links long, root long"))


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_shingles and r of every document."""
    small_batches(docs.sparkSession)
    sig = materialise(signatures(docs, runs_for(recall, DEPTH), similarity), "signatures")
    whole = materialise(sig.where("n > 0").groupBy("s1", "s2").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min("r").alias("r"), F.max("n").alias("n"),
        F.any_value("paths").alias("paths")), "sets")
    # From the distinct sets: a text that a third of all documents repeats puts one row on each of its paths.
    paths = whole.select("s1", "s2", F.explode(F.array_distinct("paths")).alias("path"))
    whole = whole.drop("paths")
    shared = paths.groupBy("path").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo != hi").select("path")
    met = materialise(paths.join(shared, "path"), "met")
    nodes = materialise(met.select("s1", "s2").distinct().join(whole, ["s1", "s2"])
                        .withColumn("nid", F.monotonically_increasing_id()), "nodes")
    sets = materialise(candidate_sets(docs, nodes), "candidate_sets")
    level = materialise(met.join(nodes.select("s1", "s2", "nid"), ["s1", "s2"]).select("path", "nid"), "level1")
    edges = candidate_edges(level, sets, similarity)
    every = edges[0]
    for more in edges[1:]:
        every = every.union(more)
    clusters = components(every).select(F.col("node").alias("nid"), F.col("label").alias("cid"))
    known = materialise(clusters.join(nodes.select("nid", "copies", "n"), "nid"), "clusters")
    blocks = known.groupBy("cid").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS))
                                      .cast("int").alias("blocks"), F.count("*").alias("m"))
    blocks = materialise(blocks, "blocks")
    dealt = in_blocks(known, blocks.select("cid", "blocks"), "cid")
    if (blocks.agg(F.sum(F.col("m") * F.col("blocks"))).first()[0] or 0) <= SMALL_NODES:
        dealt = F.broadcast(dealt)      # that many rows at most, so the sets stay where they are
    found = materialise(verify(dealt.join(sets.select("nid", "tokens"), "nid"), similarity), "links")
    links = found.groupBy("nid").agg(F.sum("links").alias("links"))
    classes = components(found.where("root is not null").select(F.col("nid").alias("a"), F.col("root").alias("b")))
    named = classes.join(nodes.select(F.col("nid").alias("node"), "first_id"), "node")
    ids = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    linked = named.join(ids, "label").join(links.withColumnRenamed("nid", "node"), "node", "left").join(
        nodes.select(F.col("nid").alias("node"), "s1", "s2"), "node").select("s1", "s2", "class_id", "links")
    info = materialise(whole.join(linked, ["s1", "s2"], "left").select(
        "s1", "s2", "copies", F.when(F.col("links").isNull(), F.col("first_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("links")), "classes")
    alone = sig.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                      F.col("n").alias("n_shingles"), "r")
    return sig.where("n > 0").select("doc_id", "s1", "s2", "n", "r").join(info, ["s1", "s2"]).select(
        "doc_id", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"),
        F.col("n").alias("n_shingles"), "r").unionByName(alone)


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each class: the one whose doc_id names it.

    Documents without shingles stay.  Of rows that repeat that id the one with
    the smallest row hash stays, and fully identical rows are one.
    """
    classes = materialise(join(docs.select("doc_id", "text"), similarity, recall), "documents_by_class")
    stays = classes.where((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("class_id")))
    first = stays.where("n_shingles > 0").groupBy("class_id").agg(F.min("r").alias("r")).select("r")
    empty = stays.where("n_shingles = 0").select("r").distinct()
    picked = materialise(first.unionByName(empty).distinct().join(stays.groupBy("r").agg(
        F.sum(F.signum("n_shingles")).alias("rows")), "r").select(F.col("r").alias("__r"), (F.col("rows") > 1).alias("__again")), "stays")
    rows = docs.select(F.struct("*").alias("__row"), F.xxhash64("doc_id", "text").alias("__key"))
    kept = rows.join(picked, F.col("__key") == F.col("__r"))
    out = kept.where("not __again")
    if not picked.where("__again").isEmpty():
        out = out.unionByName(kept.where("__again").dropDuplicates(["__key"]))
    return out.select("__row.*")
