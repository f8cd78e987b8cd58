"""Mixing sources to target weights as a min-cost flow.

Documents are aggregated by membership pattern (the set of sources that claim
them).  Each pattern supplies its words once at no cost and every further copy
at a rising cost (convex repetition); each source demands its target.  Sources
that share documents may want more than those hold: then the targets of the
sources that compete are lowered by one common factor, as little as it takes
(max-min fair), and what no rival can use is left to the others.  The flow from
patterns to sources is solved per component of sources that overlap, directly
for a source on its own, and each pattern's flow then becomes documents, taken
in a seeded order.

Only one row per pattern reaches the driver; their number is that of the
distinct source combinations, not of documents.  Rows that are alike in id, size
and order are one row with a count until they are placed, and the seeded order
is cut by running sums inside ORDER_BUCKETS hash ranges per pattern, so no task
sees a whole pattern.

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own, sorted last; an empty membership belongs to no source and
is never taken; an empty table gives an empty result; fully identical rows are
interchangeable; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeguard.llm.common import materialise, n_words
from lakeguard.session import local_table

# Fixed values of the query's contract.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2

ORDER_BUCKETS = 4096
SEED = 20240229


def weighted_targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> dict:
    """Targets by weight that stop at ``cap`` times a source's size, the excess reshared."""
    order = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[k] for k in order if k in open_)
        full = [k for k in order if k in open_ and weight[k] * unit > cap * sizes[k]]
        if not full:
            target |= {k: weight[k] * unit for k in order if k in open_}
            break
        for k in full:
            target[k] = float(cap * sizes[k])
            left -= target[k]
            open_.discard(k)
    return target


def min_cost_flow(supply: dict, demand: dict, max_copies: int) -> dict:
    """Words each (pattern, source) carries: successive cheapest augmenting paths.

    ``supply``: words by pattern (a tuple of sources).  The n-th copy of a
    pattern's words costs n - 1 a word, so repetition is spread before it deepens.
    """
    start, end = ("start",), ("end",)
    cap: dict = defaultdict(dict)
    cost: dict = defaultdict(dict)

    def edge(a, b, capacity, price):
        cap[a][b], cost[a][b] = capacity, price
        cap[b].setdefault(a, 0)
        cost[b][a] = -price

    for p, words in supply.items():
        for copy in range(max_copies):
            edge(start, ("copy", p, copy), words, copy)
            edge(("copy", p, copy), ("pattern", p), words, 0)
        for s in p:
            edge(("pattern", p), ("source", s), words * max_copies, 0)
    for s, words in demand.items():
        edge(("source", s), end, words, 0)
    height: dict = defaultdict(int)
    while True:
        dist, before, heap, tie = {start: 0}, {}, [(0, 0, start)], 0
        while heap:
            d, _, node = heapq.heappop(heap)
            if d > dist[node]:
                continue
            for to, left in cap[node].items():
                if left > 0:
                    new = d + cost[node][to] + height[node] - height[to]
                    if new < dist.get(to, float("inf")):
                        tie += 1
                        dist[to], before[to] = new, node
                        heapq.heappush(heap, (new, tie, to))
        if end not in dist:
            break
        for node in list(cap):
            height[node] += dist.get(node, dist[end])
        path, node = [], end
        while node != start:
            path.append((before[node], node))
            node = before[node]
        push = min(cap[a][b] for a, b in path)
        for a, b in path:
            cap[a][b] -= push
            cap[b][a] += push
    return {(p, s): cap[("source", s)].get(("pattern", p), 0) for p in supply for s in p}


def components(patterns) -> list[list[tuple]]:
    """Patterns grouped so that two groups have no source in common."""
    root: dict = {}

    def find(s):
        while root.setdefault(s, s) != s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for p in patterns:
        for s in p[1:]:
            root[find(s)] = find(p[0])
    groups: dict = defaultdict(list)
    for p in patterns:
        groups[find(p[0])].append(p)
    return list(groups.values())


def starved(capacity: dict, demand: dict) -> set:
    """Sources that compete for too few words: the source side of a minimum cut, empty if all demands can be met."""
    left, got = dict(capacity), {p: defaultdict(int) for p in capacity}
    of: dict = defaultdict(list)
    for p in capacity:
        for s in p:
            of[s].append(p)
    hungry: set = set()
    for start, need in demand.items():
        while need > 0:
            # From the source over its patterns; a pattern that is used up leads on to the sources it feeds.
            before, queue, end = {("s", start): None}, [start], None
            for s in queue:
                for p in of[s]:
                    if ("p", p) in before:
                        continue
                    before["p", p] = s
                    if left[p] > 0:
                        end = p
                        break
                    for other, words in got[p].items():
                        if words > 0 and ("s", other) not in before:
                            before["s", other] = p
                            queue.append(other)
                if end is not None:
                    break
            if end is None:
                hungry |= set(queue)
                break
            path, p = [], end
            while True:
                s = before["p", p]
                path.append((p, s))
                if (p := before["s", s]) is None:
                    break
            push = min([need, left[end], *[got[before["s", s]][s] for _, s in path if before["s", s] is not None]])
            left[end] -= push
            need -= push
            for p, s in path:
                got[p][s] += push
                if (taken := before["s", s]) is not None:
                    got[taken][s] -= push
    return hungry


def reachable(supply: dict, demand: dict, max_copies: int) -> dict:
    """The largest demands that can all be met, each at most as wanted, lowered max-min fairly.

    Where a set of sources wants more than its patterns hold, the factor that fits is what they hold over what they
    want; smaller sets are tried until none is left hungry, then the set is settled and the rest goes on without it.
    """
    capacity = {p: w * max_copies for p, w in supply.items()}
    settled: dict = {}
    open_ = {s: t for s, t in demand.items() if t > 0}
    while open_:
        factor, tight = Fraction(1), None
        while hungry := starved(capacity, settled | {s: int(t * factor) for s, t in open_.items()}):
            tight = hungry & open_.keys() or tight
            held = sum(w for p, w in capacity.items() if hungry & set(p))
            want = sum(open_[s] for s in hungry if s in open_)
            new = Fraction(max(0, held - sum(settled.get(s, 0) for s in hungry)), want) if want else Fraction(0)
            if new >= factor:
                break
            factor = new
        if tight is None:
            return settled | open_ | {s: 0 for s in demand if s not in settled and s not in open_}
        settled |= {s: int(open_.pop(s) * factor) for s in list(tight) if s in open_}
    return settled | {s: 0 for s in demand if s not in settled}


def route(supply: dict, demand: dict, max_copies: int) -> tuple[dict, dict]:
    """(words each (pattern, source) carries, the demand that is met of each source)."""
    flow, met = {}, {}
    for group in components([p for p in supply if p]):
        sources = {s for p in group for s in p}
        if len(sources) == 1:
            (p,), (s,) = group, sources
            met[s] = flow[p, s] = min(demand.get(s, 0), supply[p] * max_copies)
            continue
        part = {p: supply[p] for p in group}
        fair = reachable(part, {s: demand.get(s, 0) for s in sources}, max_copies)
        met |= fair
        flow |= min_cost_flow(part, fair, max_copies)
    return flow, met


def select(sized: DataFrame, flow: dict, supply: dict, max_copies: int, seed: int = SEED) -> DataFrame:
    """``sized`` (doc_id, size, members, __order) with ``taken`` and the sources its copies go to.

    A pattern's copies lie end to end on an axis in seeded order; its sources
    hold consecutive stretches of that axis.  A document's n-th copy is taken
    if its middle lies within a stretch.
    """
    spark = sized.sparkSession
    rows = []
    for p in supply:
        at, cuts = 0, []
        for s in p:
            if flow.get((p, s)):
                at += flow[(p, s)]
                cuts.append((at, s))
        rows.append((list(p), supply[p], cuts))
    schema = T.StructType([
        T.StructField("p", T.ArrayType(T.StringType())), T.StructField("p_words", T.LongType()),
        T.StructField("cuts", T.ArrayType(T.StructType([
            T.StructField("until", T.LongType()), T.StructField("source", T.StringType())])))])
    plan = local_table(spark, rows, schema)
    in_bucket = Window.partitionBy("members", "__b")
    ordered = in_bucket.orderBy("__order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    # Rows that are alike stand side by side in any order, so they are placed as one.
    alike = sized.groupBy("doc_id", "size", "members", "__order").agg(F.count("*").alias("__times"))
    rows = alike.withColumns({"__b": F.pmod("__order", F.lit(ORDER_BUCKETS)), "__all": F.col("size") * F.col("__times")})
    starts = rows.groupBy("members", "__b").agg(F.sum("__all").alias("w")).withColumn(
        "start", F.coalesce(F.sum("w").over(Window.partitionBy("members").orderBy("__b")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = rows.withColumn("inner", F.coalesce(F.sum("__all").over(ordered), F.lit(0)))
    s = starts.select(F.col("members").alias("s_members"), F.col("__b").alias("s_b"), "start")
    placed = placed.join(s, F.col("members").eqNullSafe(F.col("s_members")) & (F.col("__b") == F.col("s_b")))
    placed = placed.withColumn("__nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1)))
    placed = placed.withColumn("inner", F.col("inner") + F.col("__nth") * F.col("size"))
    placed = placed.join(plan, F.col("members").eqNullSafe(F.col("p")), "left")
    middle = F.expr(f"transform(sequence(0, {max_copies - 1}), c -> c * p_words + start + inner + size div 2)")
    routes = F.transform(
        middle, lambda m: F.try_element_at(F.filter("cuts", lambda c: m < c["until"]), F.lit(1)))
    taken = F.when(F.col("size") > 0, F.filter(routes, lambda r: r.isNotNull()))
    taken = F.coalesce(taken, F.array().cast("array<struct<until:bigint,source:string>>"))
    return placed.select("doc_id", "size", "members", (F.size(taken) * F.col("size")).cast("long").alias("taken"),
                         F.transform(taken, lambda r: r["source"]).alias("routes"))


def mix(docs: DataFrame, targets_of=weighted_targets, members: F.Column | None = None,
        max_copies: int = MAX_COPIES, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken and routes of every document.

    ``members``: array of the sources that claim a document (default: its one
    source); ``targets_of`` maps source sizes to target words.  source_size and
    target are those of the document's first source, 0 without one.
    """
    members = F.array("source") if members is None else members
    order = F.xxhash64(F.lit(seed), "doc_id", "text")
    sized = docs.select("doc_id", n_words(F.col("text")).alias("size"), members.alias("members"),
                        order.alias("__order"), *keep)
    sized = materialise(sized.withColumn("members", F.array_sort(F.array_distinct("members"))), "sizes")
    supply = {tuple(r["members"]): r["w"] for r in
              sized.where(F.size("members") > 0).groupBy("members").agg(F.sum("size").alias("w")).collect()}
    sizes: dict = defaultdict(int)
    for p, words in supply.items():
        for s in p:
            sizes[s] += words
    targets = targets_of(dict(sizes)) if sizes else {}
    flow, met = route(supply, {s: round(t) for s, t in targets.items()}, max_copies)
    # A target that the flow cannot reach is lowered to what it can.
    targets = {s: float(met[s]) if met.get(s, 0) < round(t) else t for s, t in targets.items()}
    chosen = select(sized, flow, supply, max_copies, seed)
    schema = "t_source string, source_size long, target double"
    plan = local_table(docs.sparkSession, [(s, sizes[s], float(targets[s])) for s in sizes], schema)
    first = F.when(F.size("members") > 0, F.col("members")[0])
    known = chosen.withColumn("__first", first).join(
        plan, F.col("__first").eqNullSafe(F.col("t_source")) & (F.size("members") > 0), "left")
    return known.select("doc_id", "size", F.coalesce("source_size", F.lit(0)).alias("source_size"),
                        F.coalesce("target", F.lit(0.0)).alias("target"), "taken", "routes")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies``: how often (in place of a column of that name).

    Rows that share doc_id and text are taken alike, as often as the one taken most.
    """
    key = F.struct("doc_id", F.xxhash64("text").alias("h"))
    probe = docs.select(key.alias("doc_id"), "text", "source")
    picked = materialise(
        mix(probe, **options).where("taken > 0")
        .select(F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.h").alias("__h"), F.expr("int(taken div size)").alias("__n"))
        .groupBy("__id", "__h").agg(F.max("__n").alias("__copies")), "picked")
    rows = docs.drop("copies").select(F.struct("*").alias("__row"), F.col("doc_id").alias("__doc"),
                                      F.xxhash64("text").alias("__hash"))
    hit = rows.join(picked, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")))
    return hit.select("__row.*", F.col("__copies").alias("copies"))
