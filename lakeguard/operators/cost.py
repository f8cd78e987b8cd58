"""Cost attribution and projection (operators C1-C5, W2).

Everything is a column expression over a run-log DataFrame
``(pipeline_name, run_type, runtime_seconds, rows_processed, ...)`` so that
roll-ups over any number of logged runs stay distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the cost model: proxy DBU price and serverless consumption,
# and the projection horizon (runs per day, days).
DBU_RATE_USD = 0.22
DBU_PER_HOUR = 2.0
RUNS_PER_DAY = 4
DAYS = 30
RUN_TYPES = ("full_refresh", "incremental")


def methodology(rate: float = DBU_RATE_USD) -> str:
    return (f"DBU proxy ${rate:.2f}/DBU at {DBU_PER_HOUR:g} DBU/h (serverless estimate); "
            "replace with billed usage where available")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dbu(runtime_seconds: Column | str, dbu_per_hour: float = DBU_PER_HOUR) -> Column:
    return _c(runtime_seconds) / F.lit(3600.0) * F.lit(float(dbu_per_hour))


def runtime_to_cost_usd(runtime_seconds: Column | str, dbu_per_hour: float = DBU_PER_HOUR,
                        rate: float = DBU_RATE_USD) -> Column:
    """Unrounded USD of one run."""
    return dbu(runtime_seconds, dbu_per_hour) * F.lit(float(rate))


def with_cost(runs: DataFrame, dbu_per_hour: float = DBU_PER_HOUR,
              rate: float = DBU_RATE_USD) -> DataFrame:
    """Add ``estimated_dbu`` and ``estimated_cost_usd`` rounded to six
    decimals (half-even), the cost computed from the unrounded DBU."""
    raw = dbu("runtime_seconds", dbu_per_hour)
    return runs.withColumns({
        "estimated_dbu": F.bround(raw, 6),
        "estimated_cost_usd": F.bround(raw * F.lit(float(rate)), 6),
        "methodology": F.lit(methodology(rate)),
    })


def mean_runtimes(log: DataFrame) -> DataFrame:
    """Measured seconds of a run of each type: the mean over the logged runs, by exact sums."""
    seconds = F.sum(F.col("runtime_seconds").cast("decimal(24,6)")).cast("double")
    return log.groupBy("run_type").agg((seconds / F.count("runtime_seconds")).alias("runtime_seconds"))


def project_costs(runs: DataFrame, runs_per_day: int = RUNS_PER_DAY, days: int = DAYS,
                  dbu_per_hour: float = DBU_PER_HOUR, rate: float = DBU_RATE_USD) -> DataFrame:
    """Cumulative cost on day 1..days of running each run type
    ``runs_per_day`` times a day: ``daily_cost * day``.  ``runs``: one measured
    runtime per run type, as :func:`mean_runtimes` takes from the cost log."""
    daily = runtime_to_cost_usd("runtime_seconds", dbu_per_hour, rate) * F.lit(runs_per_day)
    return (runs.select("run_type", daily.alias("daily_cost_usd"))
            .withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(days))))
            .select("run_type", "day", "daily_cost_usd",
                    (F.col("daily_cost_usd") * F.col("day")).alias("cumulative_cost_usd")))


def spent_by_day(log: DataFrame) -> DataFrame:
    """W2 over logged runs: what each run type has cost per day and up to and including it.

    Days are summed first, so the window holds one row per day and run type.
    """
    day = F.to_date("logged_at").alias("day")
    daily = log.groupBy("run_type", day).agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.col("estimated_cost_usd").cast("decimal(24,6)")).alias("cost"))
    upto = Window.partitionBy("run_type").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("run_type", "day", "runs", F.col("cost").cast("double").alias("cost_usd"),
                        F.sum("cost").over(upto).cast("double").alias("cumulative_cost_usd"))


def savings(projection: DataFrame, days: int = DAYS) -> DataFrame:
    """Full-refresh minus incremental cumulative cost on the last day."""
    last = projection.filter(F.col("day") == days)
    return last.groupBy("day").agg(
        F.sum(F.when(F.col("run_type") == "full_refresh", F.col("cumulative_cost_usd")))
        .alias("full_refresh_usd"),
        F.sum(F.when(F.col("run_type") == "incremental", F.col("cumulative_cost_usd")))
        .alias("incremental_usd"),
    ).withColumn("savings_usd", F.col("full_refresh_usd") - F.col("incremental_usd"))


def cost_by_pipeline(log: DataFrame) -> DataFrame:
    """C4: per (pipeline, run type) totals.  Sums go through decimals so the
    totals do not depend on the order logged runs are read in."""
    def dsum(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(24,6)")).cast("double")
    return log.groupBy("pipeline_name", "run_type").agg(
        F.count(F.lit(1)).alias("runs"),
        dsum("runtime_seconds").alias("runtime_seconds"),
        F.sum("rows_processed").alias("rows_processed"),
        dsum("estimated_dbu").alias("estimated_dbu"),
        dsum("estimated_cost_usd").alias("estimated_cost_usd"))


def full_vs_incremental(log: DataFrame) -> DataFrame:
    """Mean runtime of each run type and their ratio."""
    mean = {t: F.max(F.when(F.col("run_type") == t, F.col("runtime_seconds"))) for t in RUN_TYPES}
    g = mean_runtimes(log).agg(mean["full_refresh"].alias("full_s"), mean["incremental"].alias("incr_s"))
    return g.withColumn("ratio", F.col("full_s") / F.col("incr_s"))
