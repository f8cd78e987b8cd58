"""Benchmark decontamination by SimHash of item-sized windows, with DataFrame functions only.

Texts become lower-case words (runs of letters and digits).  A SimHash of 60
bits is the majority vote of the hashes of a window's word pairs.  Windows are
sized to the item: an item of class g is covered by windows of 2g word pairs,
where g is 8, 4, 2 or 1 and the largest for which any text within the
similarity still holds an unbroken stretch of 3g words.  Documents are
fingerprinted at every g-th word, items at every word, so each such stretch
holds a document window equal to an item window, whatever the offset.

Votes are counted in packed lanes: a long holds twelve lanes of five bits, five
longs a window, and adding a constant moves each majority into its lane's top
bit.

Fingerprints within RADIUS bits share one of RADIUS + 1 blocks (multi-index);
windows join the item index on block values, and pairs beyond the radius go.
Every item-sized window that holds a surviving hit, wherever the hit stands in
it, is compared exactly: weighted Jaccard similarity of five-word shingles, the
weight of a shingle being its number of occurrences.  So blocks may stand in
another order than the item's.

Defined cases: null and empty texts hold no window; an item of fewer than five
words has no shingle and is found nowhere; null item ids are items like others;
equal item ids with different texts are compared apart and reported under their
id; rows that share doc_id and text give one row; an empty table on either side
gives an empty result; other columns are ignored, or kept where documents are
returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeguard.llm.common import materialise

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 3
LANES, VOTES = 12, 5                      # lanes of a long, and longs of a window
BITS = LANES * VOTES
BLOCK = BITS // (RADIUS + 1)
ONES = sum(1 << (5 * lane) for lane in range(LANES))
TOP = ONES << 4
# Rows of fixed width (numbers only) up to which a side is broadcast, 64 MB as Spark hashes them; beyond, the join shuffles.
ROW_BYTES, BROADCAST_BYTES = 64, 64 << 20


def words_of(text) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def pair_hashes(words: str) -> Column:
    """Hash of each word with the next one (the last pair is not used)."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.get(F.col(words), i + 1)))


def repeated(words: str, k: int) -> Column:
    """At least the number of places in a text of which the k words before them stand elsewhere in it, too."""
    grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0))),
                        lambda i: F.array_join(F.slice(words, i + 1, F.lit(k)), " "))
    return 2 * (F.size(grams) - F.size(F.array_distinct(grams)))


def class_of(words: str) -> Column:
    """Class of an item, from the longest unbroken stretch that a window within the similarity must share with it.

    A window of an item of N shingles holds at most N / 9 others, and 0.8 (N + others) of the item's.  It is a chain of
    stretches of the item, in any order.  Where two meet, four others stand, or one less for each word that they
    overlap in; such an overlap stands twice in the item.  The cheapest meetings are counted first.
    """
    n = F.size(words) - (SHINGLE - 1)
    left = others = F.floor(n / 9)
    overlaps = [repeated(words, k) for k in (4, 3, 2, 1)]
    breaks = overlaps[0]
    for cost, (fewer, more) in enumerate(zip(overlaps, overlaps[1:]), 1):
        here = F.least(more - fewer, F.floor(left / cost))
        breaks, left = breaks + here, left - cost * here
    last = F.floor(left / 4)
    breaks, left = breaks + last, left - 4 * last
    held = F.ceil(4 * (n + others - left) / 5)
    stretch = F.ceil(held / (breaks + 1)) + SHINGLE - 1
    return F.when(stretch >= 24, 8).when(stretch >= 12, 4).when(stretch >= 6, 2).otherwise(1)


def add_up(items: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, items)


def block_votes(hashes: str, first: Column, g: int, vote: int) -> Column:
    """Packed votes of g hashes from ``first`` on, for the bits of one long."""
    return add_up([F.shiftrightunsigned(F.get(F.col(hashes), first + t), vote).bitwiseAND(F.lit(ONES)) for t in range(g)])


def majority(votes: list[Column], g: int) -> Column:
    """Fingerprint from the packed votes of 2g pairs: bit set where more than g vote for it."""
    bias = F.lit((15 - g) * ONES)
    bits = [F.shiftrightunsigned((v + bias).bitwiseAND(F.lit(TOP)), VOTES - 1 - j) for j, v in enumerate(votes)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def whole_print(g: int):
    """Fingerprint of the window at an offset, straight from the pair hashes ``h``."""
    return lambda o: majority([block_votes("h", o, 2 * g, j) for j in range(VOTES)], g)


def block_at(g: int, vote: int):
    return lambda i: block_votes("h", i * g, g, vote)


def window_at(g: int):
    """Window of the blocks i and i + 1 of class g."""
    def at(i):
        votes = [F.get(F.col(f"v{g}_{j}"), i) + F.get(F.col(f"v{g}_{j}"), i + 1) for j in range(VOTES)]
        return F.struct(F.lit(g).alias("g"), i.alias("i"), majority(votes, g).alias("print"))
    return at


def blocks(fingerprint: Column, g: Column) -> Column:
    """The join keys of a fingerprint: class, block number and block value in one number."""
    mask = (1 << BLOCK) - 1
    return F.array(*[F.shiftrightunsigned(fingerprint, BLOCK * b).bitwiseAND(F.lit(mask)) + (g * (RADIUS + 1) + b) * (mask + 1)
                     for b in range(RADIUS + 1)])


def numbered_items(benchmark: DataFrame) -> DataFrame:
    """item_id, item_words, class g and a number of each distinct item."""
    items = (benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("item_words")).distinct()
             .where(F.size("item_words") >= SHINGLE).withColumn("g", class_of("item_words")))
    return materialise(items.withColumn("item_no", F.monotonically_increasing_id()), "items")


def item_index(items: DataFrame) -> DataFrame:
    """key, g, print, number and length of every window of every item; the words stay with the items."""
    hashed = items.withColumn("h", pair_hashes("item_words"))
    out = None
    for g in (8, 4, 2, 1):
        starts = F.sequence(F.lit(0), F.size("item_words") - 1 - 2 * g)
        # A separate column for the prints: the hashes are then computed once per item.
        prints = F.transform(starts, whole_print(g))
        one = (hashed.where((F.col("g") == g) & (F.size("item_words") > 2 * g))
               .select("item_no", F.size("item_words").alias("length"), "g", F.explode(prints).alias("print")).distinct())
        out = one if out is None else out.unionByName(one)
    return out.select("*", F.explode(blocks(F.col("print"), F.col("g"))).alias("key"))


def document_windows(docs: DataFrame, classes: list[int]) -> DataFrame:
    """doc_id, __h (hash of the text), and g, i, print of every window.

    The words stay behind: exploded rows would each copy them.
    """
    worded = docs.select("doc_id", F.xxhash64("text").alias("__h"), words_of(F.col("text")).alias("words"))
    hashed = worded.withColumn("h", pair_hashes("words"))
    arrays = []
    for g in classes:
        n = F.floor((F.size("words") - 1) / g).cast("int")      # full blocks of g pairs
        hashed = hashed.withColumns({f"v{g}_{j}": F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 1), block_at(g, j)))
                                     for j in range(VOTES)})
        arrays.append(F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), window_at(g))))
    every = F.concat(*[F.coalesce(a, F.array().cast("array<struct<g:int,i:int,print:bigint>>")) for a in arrays])
    return hashed.select("doc_id", "__h", F.explode(every).alias("w")).select("doc_id", "__h", "w.*")


def shingles(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE),
                       lambda i: F.array_join(F.slice(words, i + 1, F.lit(SHINGLE)), " "))


def weighted_jaccard(a: str, b: str) -> Column:
    """Shared over all occurrences of the shingles in two array columns."""
    def count(column, s):
        return F.size(F.filter(column, lambda x: x == s))

    def plain(column):
        return F.size(F.array_distinct(column)) == F.size(column)

    # Where one side repeats nothing, each common shingle is shared once.
    shared = F.when(plain(a) | plain(b), F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, s: acc + F.least(count(F.col(a), s), count(F.col(b), s))))
    return shared / (F.size(a) + F.size(b) - shared)


def may_reach(similarity: float):
    """Whether the window at a start of ``__p`` can be similar: ``__held`` tells which of its shingles the item has at all."""
    def at(start):
        held = F.slice("__held", start + 1, F.size("__b"))
        most = F.size(F.array_remove(held, False))
        return most * (1 + similarity) >= similarity * (F.size(held) + F.size("__b")) - 1e-9
    return at


def small(rows: DataFrame) -> DataFrame:
    """``rows`` of fixed width, to be broadcast if their bytes allow it."""
    return F.broadcast(rows) if rows.count() * ROW_BYTES <= BROADCAST_BYTES else rows


def find(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, __h, item_id, similarity and first word of the best window of every item found in a document."""
    items = numbered_items(benchmark)
    index = materialise(item_index(items), "item_index")
    classes = sorted((r["g"] for r in index.select("g").distinct().collect()), reverse=True) or [8]
    lookup = small(index.select("key", F.col("print").alias("__print"), "item_no", "length"))
    probes = document_windows(docs, classes).select(
        "*", F.explode(blocks(F.col("print"), F.col("g"))).alias("key"))
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("__print"))) <= RADIUS
    hits = probes.join(lookup, (probes["key"] == lookup["key"]) & near)
    # The windows that hold a hit start up to an item's length before it.  Starts are dealt in cells of that many.
    at, length = F.col("i") * F.col("g"), F.col("length")
    first = F.greatest(at + 2 * F.col("g") + 1 - length, F.lit(0))
    cells = F.sequence(F.floor(first / length).cast("int"), F.floor(at / length).cast("int"))
    # Written here, so that the exact comparison runs on these few rows and not inside the join.
    found = small(materialise(hits.select(F.col("doc_id").alias("__id"), F.col("__h").alias("__hash"), "item_no", "length",
                                          F.explode(cells).alias("cell")).distinct(), "candidates"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("__h"), "text")
    parts = texts.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash"))).select(
        "doc_id", "__h", "item_no", "length", (F.col("cell") * length).alias("first"), words_of(F.col("text")).alias("words"))
    placed = materialise(parts.select("doc_id", "__h", "item_no", "length", "first", F.slice(
        "words", F.col("first") + 1, 2 * length - 1).alias("part")).distinct(), "placed")
    shingled = (placed.where(F.size("part") >= SHINGLE).join(items.select("item_no", "item_id", "item_words"), "item_no")
                .select("doc_id", "__h", "item_id", "first", "length",
                        shingles(F.col("part")).alias("__p"), shingles(F.col("item_words")).alias("__b"))
                .withColumn("__held", F.transform("__p", lambda x: F.array_contains("__b", x))))
    starts = F.sequence(F.lit(0), F.least("length", F.size("__p")) - 1)
    compared = (shingled.select("*", F.explode(F.filter(starts, may_reach(similarity))).alias("at"))
                .select("doc_id", "__h", "item_id", (F.col("first") + F.col("at")).alias("start"),
                        F.slice("__p", F.col("at") + 1, F.size("__b")).alias("__a"), "__b")
                .select("doc_id", "__h", "item_id", "start", weighted_jaccard("__a", "__b").alias("similarity")))
    # The threshold stands behind the aggregate: a filter below it would compute the similarity twice.
    return compared.groupBy("doc_id", "__h", "item_id").agg(
        F.max("similarity").alias("similarity"),
        F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start")).where(F.col("similarity") >= similarity)


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` in which no item was found."""
    found = materialise(find(docs.select("doc_id", "text"), benchmark, similarity).select(
        F.col("doc_id").alias("__id"), F.col("__h").alias("__hash")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__text"))
    clean = rows.join(found, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_anti")
    return clean.select("__row.*")
