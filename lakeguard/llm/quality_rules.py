"""Quality rules with adaptive thresholds.

Each text is measured once; the measures of every (lang, source) feed a
quantile sketch, and the fences drawn from the sketches are joined back to the
measures to judge each document against its own group.

The sketch is a log-linear histogram of integers: a value below 64 is its own
bucket, a larger one keeps its six leading bits, so a quantile is off by less
than 1/32 of its value.  Two sketches merge by adding counts, in any order and
with the same result, which is what lets Spark pre-aggregate them per task and
what lets a thin group borrow the merged sketch of its language, or of the
whole corpus.

Defined cases: a null text has no words; null lang or source form a group like
any other; an empty table gives an empty result; repeated rows are judged each
on its own; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeguard.llm.common import WORD, map_texts, materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 100          # documents below which a group borrows the merged sketch
# A fence lies FENCE times the spread of the group's own sketch, from INNER to OUTER percent of its documents,
# beyond the outer quantile (and likewise below).
INNER, OUTER, FENCE = 50, 90, 10
# Spread taken for a measure that has none in the whole corpus, as most texts have not a single symbol
# (per mille; hundredths of a character for word_len).
MEASURES = {"symbol_rate": 6, "dup_rate": 45, "repeat_rate": 30, "word_len": 45}
TWO_SIDED = ("word_len",)

_WORD = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list[str]) -> int:
    """Positions that lie in a three-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, reach = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def count_text(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = _WORD.findall(text)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    return (len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), lines, dups, repeat_words(words))


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of every whole text, beside the columns ``keep``."""
    def fn(texts):
        return dict(zip(_COUNTS, map(list, zip(*map(count_text, texts)))))

    return map_texts(docs, keep, fn, {c: pa.int64() for c in _COUNTS}, ", ".join(f"{c} long" for c in _COUNTS))


def rates(counts: DataFrame) -> DataFrame:
    """The measures the adaptive rules judge, as integers."""
    return counts.withColumns({
        "symbol_rate": F.expr("1000 * n_symbols div greatest(word_chars, 1)"),
        "dup_rate": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
        "repeat_rate": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
        "word_len": F.expr("100 * word_chars div greatest(n_words, 1)")})


def bucket(value: F.Column) -> F.Column:
    """Lower bound of the sketch bucket that holds an integer >= 0."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group, measure and bucket with its count (a mergeable sketch)."""
    stacked = ", ".join(f"'{m}', {m}" for m in MEASURES)
    return (measured.selectExpr(*groups, f"stack({len(MEASURES)}, {stacked}) as (measure, value)")
            .groupBy(*groups, "measure", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n")))


def quantiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Outer and inner quantiles of each sketch on both sides (nearest rank, bucket's lower bound)."""
    whole = Window.partitionBy(*groups, "measure")
    upto = whole.orderBy("bucket")
    ranked = sketch.withColumns({"total": F.sum("n").over(whole), "upto": F.sum("n").over(upto)})
    shares = {"low": 100 - OUTER, "low_inner": 100 - INNER, "high_inner": INNER, "high": OUTER}
    return ranked.groupBy(*groups, "measure").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(100 * F.col("upto") >= share * F.col("total"), F.col("bucket"))).alias(q) for q, share in shares.items()])


def fences(sketch: DataFrame) -> DataFrame:
    """Per (lang, source): lower and upper fence of each measure, one row a group.

    A group of fewer than MIN_GROUP documents, or whose quantiles coincide so that they tell no spread, takes
    those of its language's merged sketch, and else those of the corpus; only where that has none either does the
    least spread of MEASURES decide.
    """
    by_lang = quantiles(sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n")), ["lang"])
    overall = quantiles(sketch.groupBy("measure", "bucket").agg(F.sum("n").alias("n")), [])
    own, lang, all_ = quantiles(sketch, ["lang", "source"]).alias("o"), by_lang.alias("l"), overall.alias("a")
    joined = (own.join(lang, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.measure") == F.col("l.measure")))
              .join(all_, F.col("o.measure") == F.col("a.measure")))

    least = F.create_map(*[F.lit(x) for kv in MEASURES.items() for x in kv])[F.col("o.measure")]

    def fence(outer, inner):
        def of(side):
            at, spread = F.col(f"{side}.{outer}"), F.col(f"{side}.{outer}") - F.col(f"{side}.{inner}")
            thin = (F.col(f"{side}.total") < MIN_GROUP) if side != "a" else F.lit(False)
            return F.when(~thin & (spread != 0), at + FENCE * spread)
        sign = 1 if outer == "high" else -1
        return F.coalesce(of("o"), of("l"), of("a"), F.col(f"a.{outer}") + sign * FENCE * least)

    fenced = joined.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), F.col("o.measure").alias("measure"),
                           fence("high", "high_inner").alias("most"), fence("low", "low_inner").alias("least"))
    picks = []
    for m in MEASURES:
        picks.append(F.max(F.when(F.col("measure") == m, F.col("most"))).alias(f"{m}_max"))
        if m in TWO_SIDED:
            picks.append(F.max(F.when(F.col("measure") == m, F.col("least"))).alias(f"{m}_min"))
    return fenced.groupBy("lang", "source").agg(*picks)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, ``base_failed`` (fixed rules) and ``kept`` (fixed and adaptive rules).

    The counts are written once: the sketches and the join back both read them.
    """
    counts = materialise(rates(measure(docs, ["doc_id", "lang", "source"])), "counts")
    limits = fences(sketches(counts, ["lang", "source"]))
    c, f = counts.alias("c"), limits.alias("f")
    joined = c.join(f, F.col("c.lang").eqNullSafe(F.col("f.lang")) & F.col("c.source").eqNullSafe(F.col("f.source")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fits = F.lit(True)
    for m in MEASURES:
        fits = fits & (F.col(m) <= F.col(f"{m}_max"))
        if m in TWO_SIDED:
            fits = fits & (F.col(m) >= F.col(f"{m}_min"))
    return joined.select("c.doc_id", *[c for c in _COUNTS if c != "n_lines"], failed.alias("base_failed"),
                         (~failed & fits).alias("kept"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    Rows are matched by doc_id and a hash of the text, so equal ids with
    different texts are judged apart.
    """
    keyed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__key"))
    probe = docs.select(F.struct("doc_id", F.xxhash64("text").alias("k")).alias("doc_id"), "text", "lang", "source")
    good = judge(probe).where("kept").select(F.col("doc_id.doc_id").alias("__gid"), F.col("doc_id.k").alias("__gkey")).distinct()
    hit = keyed.join(good, F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__key") == F.col("__gkey")), "left_semi")
    return hit.select("__row.*")
