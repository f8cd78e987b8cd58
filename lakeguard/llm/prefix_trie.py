"""Conversation prefix trie as a minimal-perfect-hash node table.

Each distinct sequence of first turns is a node.  Its digest is the XOR of two
64-bit hashes of (depth, turn) over its turns, so digests of all prefixes are
running XORs; the digest of a parent is that without the last turn.  One
aggregation by digest gives the nodes with their counts.  A node whose rows
disagree on the parent's digest or on the SHA-256 of the last turn would be a
collision; then all is done again with another salt.

A node whose subtree holds more than SHARD_ROWS rows is heavy.  The other nodes
lie in subtrees below heavy ones, and whole such subtrees are dealt to shards.
A shard is a few flat arrays: a minimal perfect hash gives every digest a slot
of its own (verified against the digest stored there), each node points to its
parent's slot, and sums go up along these pointers, the deepest level first.
What a subtree sums up to is added to the heavy node above it.  Heavy nodes are
few (each has SHARD_ROWS rows below it); they are summed by pointer doubling,
so neither one task nor the driver ever holds them all.

The ids of the conversations that end in a node are hashed as one text, which
is joined in pieces by many tasks and streamed through the hash by one.

Defined cases: turns are ordered by turn (null first), then role, then text;
a null role or text is empty; rows without conv_id belong to no conversation; a
conversation without turns is a member of the root only; repeated rows are
turns of their own; without any conversation there is no node; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeguard.llm.common import materialise, small_batches
from lakeguard.llm.running import running

# Fixed values of the query's contract: conversations in groups of so many share up to so many first turns.
FAMILY = 100
SHARED = 6

SHARD_ROWS = 50_000
PIECE_IDS = 4096


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn (SHA-256 of role and text) and chars of every turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), role.alias("role"), text.alias("text"),
        F.unhex(said).alias("turn"), F.length(text).cast("long").alias("chars"))
    numbered = running(rows, "conv_id", [F.col("at").asc_nulls_first(), F.col("role"), F.col("text")],
                       ["turn", "chars"], [], "turns")
    return numbered.withColumnRenamed("n", "pos")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as the contract rebuilds them: (conv_id, len) and (conv_id, depth, len, turn, chars).

    The first h turns of the first conversation of its family, then its own from turn h + 1 on.
    """
    turns = materialise(turns_of(conversations), "numbered")
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("h")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("first"), F.col("n").alias("head_n"))
    sizes = own.select("conv_id", "n", h, first.alias("first")).join(heads, "first", "left")
    taken = F.least("h", F.coalesce("head_n", F.lit(0)))
    sizes = materialise(sizes.select("conv_id", "first", "h", taken.alias("taken"),
                                     (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "sizes")
    lead = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv_id", "first")
    lead = (lead.join(sizes.where("taken > 0"), "first").where("pos <= taken")
            .select("conv_id", F.col("pos").alias("depth"), "len", "turn", "chars"))
    rest = (turns.join(sizes, "conv_id").where("pos > h")
            .select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "len", "turn", "chars"))
    return sizes.select("conv_id", "len"), lead.unionByName(rest)


def prefixes(ids: DataFrame, sequences: DataFrame, salt: int) -> DataFrame:
    """A row for every conversation and depth: digest (d1, d2), parent's digest (p1, p2) and the last turn."""
    hashed = sequences.withColumns({f"d{i}": F.xxhash64(F.lit(2 * salt + i), "depth", "turn") for i in (1, 2)})
    hashed = hashed.select("conv_id", "depth", "len", "turn", "chars", "d1", "d2", F.col("d1").alias("t1"), F.col("d2").alias("t2"))
    made = running(hashed, "conv_id", [F.col("depth")], ["depth", "len", "turn", "chars", "t1", "t2"], ["d1", "d2"], "digests")
    made = made.select("conv_id", "depth", "len", "turn", "chars", "d1", "d2",
                       F.col("d1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("t2")).alias("p2"))
    zero = F.lit(0).cast("long")
    roots = ids.select("conv_id", zero.alias("depth"), "len", F.unhex(F.lit("")).alias("turn"), zero.alias("chars"),
                       zero.alias("d1"), zero.alias("d2"), zero.alias("p1"), zero.alias("p2"))
    return made.unionByName(roots)


def distinct_nodes(rows: DataFrame) -> DataFrame:
    """Nodes by digest, with ``weight``: the rows of the subtree; and whether all rows agree."""
    last = F.struct("p1", "p2", "turn", "chars")
    found = rows.groupBy("depth", "d1", "d2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min(last).alias("last"), F.max(last).alias("other"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    return found.select("depth", "d1", "d2", "n_convs", "conv_id", "last.p1", "last.p2", "weight",
                        ((F.col("n_convs") - 1) * F.col("last.chars")).alias("saved"), (F.col("last") == F.col("other")).alias("agree"))


class SlotTable:
    """Minimal perfect hash of distinct (k1, k2) keys.

    Keys that are alone in their cell of a level's bit array get a slot by the cell's rank; the others go to the next level.
    """

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = np.arange(len(k1)), 0
        while len(left):
            if len(self.levels) == 256:
                raise ValueError("a key occurs twice")
            cells = self._cells(k1[left], k2[left], len(self.levels), max(64, 2 * len(left)))
            alone = np.bincount(cells, minlength=max(64, 2 * len(left))) == 1
            self.levels.append((alone, base + np.cumsum(alone) - alone))
            base += int(alone.sum())
            left = left[~alone[cells]]
        self.n = base
        self.k1, self.k2 = np.zeros(base, np.int64), np.zeros(base, np.int64)
        at = self._slots(k1, k2)
        self.k1[at], self.k2[at] = k1, k2

    @staticmethod
    def _cells(k1, k2, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = k1.astype(np.uint64) ^ (k2.astype(np.uint64) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
        return (x % np.uint64(size)).astype(np.int64)

    def _slots(self, k1, k2) -> np.ndarray:
        out = np.full(len(k1), -1, np.int64)
        open_ = np.arange(len(k1))
        for level, (alone, rank) in enumerate(self.levels):
            cells = self._cells(k1[open_], k2[open_], level, len(alone))
            hit = alone[cells]
            out[open_[hit]] = rank[cells[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for one that is not in the table (the digest stored there tells)."""
        at = self._slots(k1, k2)
        known = (at >= 0) & (self.k1[at] == k1) & (self.k2[at] == k2) if self.n else np.zeros(len(k1), bool)
        return np.where(known, at, -1)


_SHARD = ("conv_id long, depth long, d1 long, d2 long, p1 long, p2 long, n_convs long, parent_conv_id long, "
          "n_children long, n_leaves long, saved_tokens long")


def fold_shard(nodes: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and saved characters of a shard's nodes; a parent outside the shard leaves parent_conv_id null."""
    k1, k2, depth = (nodes[c].to_numpy(np.int64) for c in ("d1", "d2", "depth"))
    table = SlotTable(k1, k2)
    slot, n = table.slots(k1, k2), len(nodes)
    if (slot < 0).any() or len(np.unique(slot)) != n:
        raise ValueError("slots collide")
    conv, parent, saved = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    conv[slot], saved[slot] = nodes["conv_id"], nodes["saved"]
    over = table.slots(nodes["p1"].to_numpy(np.int64), nodes["p2"].to_numpy(np.int64))
    parent[slot] = np.where(depth > 0, over, -1)
    children = np.bincount(parent[parent >= 0], minlength=n)
    leaves = (children == 0).astype(np.int64)
    by_depth = np.argsort(depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)[::-1]:
        at = slot[level]
        at = at[parent[at] >= 0]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    up = parent[slot]
    return pd.DataFrame({
        **{c: nodes[c].to_numpy() for c in ("conv_id", "depth", "d1", "d2", "p1", "p2", "n_convs")},
        "parent_conv_id": pd.arrays.IntegerArray(np.where(up >= 0, conv[up], 0), up < 0),
        "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot]})


def ends_of(rows: DataFrame) -> DataFrame:
    """(depth, d1, d2, ends_sha256) of the nodes in which conversations end."""
    spark = rows.sparkSession
    node = ["depth", "d1", "d2"]
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = rows.where("depth = len").select(*node, "conv_id")
    last = last.repartitionByRange(n_parts, *node, "conv_id").sortWithinPartitions(*node, "conv_id")

    def runs(batches):
        """Consecutive rows of one node, cut to PIECE_IDS ids."""
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(c).to_numpy() for c in node]
                fresh = np.any([c[1:] != c[:-1] for c in columns], axis=0)
                cuts = [0, *(np.flatnonzero(fresh) + 1).tolist(), batch.num_rows]
                for a, b in zip(cuts, cuts[1:]):
                    for i in range(a, b, PIECE_IDS):
                        yield [int(c[a]) for c in columns], batch.column("conv_id")[i:min(b, i + PIECE_IDS)].to_pylist()

    def pieces(batches):
        held: list = []
        for key, ids in runs(batches):
            held.append((*key, ids[0], ",".join(map(str, ids))))
            if len(held) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=[*node, "low", "said"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=[*node, "low", "said"])

    def stream(batches):
        key, state = None, None
        for batch in batches:
            done = []
            for row in zip(*[batch.column(c).to_pylist() for c in [*node, "said"]]):
                if row[:3] != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = row[:3], hashlib.sha256(row[3].encode())
                else:
                    state.update(b"," + row[3].encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*node, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=[*node, "ends_sha256"])

    said = last.mapInArrow(pieces, "depth long, d1 long, d2 long, low long, said string")
    said = said.repartition(n_parts, *node).sortWithinPartitions(*node, "low")
    return said.mapInArrow(stream, "depth long, d1 long, d2 long, ends_sha256 string")


def heavy_sums(heavy: DataFrame, below: DataFrame) -> DataFrame:
    """Heavy nodes with the sums of their subtrees, by pointer doubling along their parents.

    ``below``: (depth, d1, d2, children, leaves, saved) that light subtrees add to the heavy node above them.
    """
    node = ["depth", "d1", "d2"]
    up = heavy.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
    under = below.unionByName(up.select(*node, F.lit(1).alias("children"), F.lit(0).alias("leaves"), F.lit(0).alias("below_saved")))
    under = under.groupBy(*node).agg(F.sum("children").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("below_saved").alias("below_saved"))
    zero = F.lit(0).cast("long")
    state = heavy.join(under, node, "left").select(
        *node, "p1", "p2", "n_convs", "conv_id", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.coalesce("n_children", zero) == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + F.coalesce("below_saved", zero)).alias("saved_tokens"),
        F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))).alias("up"))
    state = materialise(state, "heavy0")
    deepest = state.agg(F.max("depth")).first()[0] or 0
    for step in range(math.ceil(math.log2(deepest + 1)) if deepest else 0):
        gain = (state.where("up is not null").groupBy("up").agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("more_saved"))
                .select(*[F.col(f"up.{c}").alias(c) for c in node], "more", "more_saved"))
        jump = state.select(F.struct(*node).alias("up"), F.col("up").alias("far"))
        state = materialise(
            state.join(gain, node, "left").join(jump, "up", "left").select(
                *node, "p1", "p2", "n_convs", "conv_id", "n_children", (F.col("n_leaves") + F.coalesce("more", zero)).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", zero)).alias("saved_tokens"), F.col("far").alias("up")), f"heavy{step + 1}")
    return state.drop("up")


def trie(ids: DataFrame, sequences: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv_id, depth, len, turn, chars) of the conversations ``ids`` (conv_id, len).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    for salt in range(8):
        rows = materialise(prefixes(ids, sequences, salt), "prefixes")
        nodes = materialise(distinct_nodes(rows), "nodes")
        if nodes.where("not agree").isEmpty():
            break
    else:
        raise ValueError("digests collide under every salt")
    node = ["depth", "d1", "d2"]
    heavy = nodes.where(F.col("weight") > shard_rows)
    # A conversation's nodes are heavy down to some depth; the next one is the top of its light subtree.
    deep = rows.select(*node, F.col("conv_id").alias("member")).join(heavy.select(*node), node, "left_semi")
    tops = deep.groupBy("member").agg((F.max("depth") + 1).alias("top"))
    light = nodes.where(F.col("weight") <= shard_rows)
    owners = rows.select(F.col("conv_id").alias("member"), F.col("depth").alias("at"), F.col("d1").alias("s1"), F.col("d2").alias("s2"))
    owners = (owners.join(tops, "member", "left").where("at = coalesce(top, 0)")
              .select(F.col("member").alias("conv_id"), "s1", "s2"))
    total = nodes.agg(F.count("*")).first()[0]
    n_shards = max(1, math.ceil(total / shard_rows))
    dealt = light.join(owners, "conv_id").withColumn("shard", F.pmod(F.xxhash64("s1", "s2"), F.lit(n_shards)))
    folded = materialise(dealt.select("shard", "conv_id", *node, "p1", "p2", "n_convs", "saved")
                         .groupBy("shard").applyInPandas(fold_shard, _SHARD), "shards")
    # A light node whose parent is not in its shard stands below a heavy one (the root has no parent).
    tops_out = folded.where("parent_conv_id is null and depth > 0")
    below = (tops_out.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
             .agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below_saved")))
    summed = heavy_sums(heavy, below)
    parents = summed.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
                            F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", *node, "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"]
    open_ = tops_out.drop("parent_conv_id").unionByName(summed).join(parents, ["depth", "p1", "p2"], "left").select(*columns)
    inner = folded.where("parent_conv_id is not null or depth = 0").select(*columns)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return inner.unionByName(open_).join(ends_of(rows), node, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    small_batches(conversations.sparkSession)
    return trie(*rebuilt(conversations), shard_rows)
