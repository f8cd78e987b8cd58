"""Silver model ``orders_cleaned`` (operator M1): current state per order_id.

Pure DataFrame transformations; writing them to storage is
``lakeguard.plans.lake``'s job.

* full refresh: latest version per ``order_id`` over all of Bronze (W1), then
  the fixed 12-column projection with ``line_total``;
* incremental, ``mode="event_time"`` (the reference rule): Bronze rows with
  ``updated_at`` strictly above the target's high-water mark, reduced to one
  row per key, replace the target rows of those keys;
* incremental, ``mode="arrival"``: Bronze rows that arrived since the last run
  (the caller passes the batches no run has taken, or an arrival watermark),
  competing with the target's current row of the same key, so a late-arriving
  older version cannot overwrite a newer one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeguard.operators.latest import latest_per_key
from lakeguard.operators.merge import upsert
from lakeguard.operators.watermark import high_watermark_filter

KEY = "order_id"
_KEYED = "__key"
SYSTEM_COLUMNS = ["_ingested_at", "_schema_version", "_source"]
SILVER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price",
                  "line_total", "status", "created_at", "updated_at", *SYSTEM_COLUMNS]
# Version order for Bronze in production: newest event time, then latest arrival,
# then the remaining columns so that the order is total.
DEFAULT_VERSION_ORDER = ["updated_at", "_ingested_at", "status", "product_id",
                         "quantity", "unit_price", "customer_id", "created_at"]
# Between an incoming row and the current Silver row of its key: newer event
# time wins, on equal event time the later arrival, and on equal arrival the
# version order's other columns, as in a full refresh.
ARRIVAL_ORDER = ["updated_at", "_ingested_at"]


def arrival_order(version_order: Sequence[str]) -> list[str]:
    return ARRIVAL_ORDER + [c for c in version_order if c in SILVER_COLUMNS and c not in ARRIVAL_ORDER]


def line_total() -> Column:
    return (F.col("quantity") * F.col("unit_price")).alias("line_total")


def project(df: DataFrame) -> DataFrame:
    """The fixed Silver projection (unlisted columns such as delivery_partner drop)."""
    cols = [line_total() if c == "line_total" else F.col(c) for c in SILVER_COLUMNS]
    return df.select(*cols)


def silver_full(bronze: DataFrame, version_order: Sequence[str] = DEFAULT_VERSION_ORDER) -> DataFrame:
    return project(latest_per_key(bronze, KEY, version_order))


def silver_delta(bronze: DataFrame, watermark: Column | None) -> DataFrame:
    """Strict high-water filter; a NULL or missing watermark (empty target)
    selects everything instead of nothing."""
    return high_watermark_filter(bronze, "updated_at", watermark, strict=True)


def _ahead(a: Column, b: Column) -> Column:
    """``a`` sorts before ``b`` in a descending, nulls-last order."""
    return F.coalesce(a > b, F.lit(False)) | (a.isNotNull() & b.isNull())


def staged_change_set(bronze: DataFrame, target: DataFrame, partition: Column, *,
                      mode: str = "arrival", watermark: Column | None = None,
                      version_order: Sequence[str] = DEFAULT_VERSION_ORDER) -> DataFrame:
    """What a merge run stages, from one join: for every key whose row
    changes, its new Silver row (``_side = 'new'``, ``_part`` from
    ``partition``) and, if the key is already in the target, what Gold counts
    of its current row, with its partition (``_side = 'old'``; other columns null).

    Only the columns that decide are read from the target to find the current
    rows of the delta's keys.  In arrival mode an incoming row replaces the
    current one unless the current row is ahead in :func:`arrival_order`; a
    key whose current row stays is not staged (rewriting it would be a
    no-op).  In event-time mode every incoming row replaces its key.
    """
    if mode == "event_time":
        delta = silver_delta(bronze, watermark)
    elif mode == "arrival":
        delta = high_watermark_filter(bronze, "_ingested_at", watermark, strict=True)
    else:
        raise ValueError(f"unknown incremental mode {mode!r}")
    # a struct is never null and equals one whose field is null too, so one plain column deals out the
    # versions, the delta's keys and the current rows, each of them once
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn(_KEYED, F.struct(KEY)).drop(KEY)

    latest = latest_per_key(keyed(delta), _KEYED, [c for c in version_order if c != KEY])
    order = arrival_order(version_order)
    kept = ["created_at", "updated_at", "_ingested_at", "status", "line_total", "_part"]
    narrow = kept + [c for c in order if c not in kept] if mode == "arrival" else kept
    current = (keyed(target.select(KEY, *narrow)).join(keyed(delta.select(KEY)).distinct(), _KEYED, "left_semi")
               .select(_KEYED, *[F.col(c).alias(f"__cur_{c}") for c in narrow],
                       F.lit(True).alias("__cur")))
    j = latest.join(current, _KEYED, "left_outer").withColumns(
        {KEY: F.col(f"{_KEYED}.{KEY}"), "line_total": line_total()})
    cur = lambda c: F.col(f"__cur_{c}")
    if mode == "arrival":
        current_stays = F.lit(False)
        for c in reversed(order):
            current_stays = _ahead(cur(c), F.col(c)) | (cur(c).eqNullSafe(F.col(c)) & current_stays)
        j = j.filter(F.col("__cur").isNull() | ~current_stays)
    types = dict((f.name, f.dataType) for f in project(delta).schema.fields)
    new = F.struct(*[F.col(c) for c in SILVER_COLUMNS], partition.cast("int").alias("_part"),
                   F.lit("new").alias("_side"))
    old_fields = [F.col(KEY) if c == KEY else cur(c).alias(c) if c in kept
                  else F.lit(None).cast(types[c]).alias(c) for c in SILVER_COLUMNS]
    old = F.when(F.col("__cur").isNotNull(), F.struct(
        *old_fields, cur("_part").cast("int").alias("_part"), F.lit("old").alias("_side")))
    return j.select(F.inline(F.filter(F.array(new, old), lambda x: x.isNotNull())))


def merge_changes(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Update-all / insert-all merge of one-row-per-key changes into target."""
    return upsert(target.select(*SILVER_COLUMNS), changes.select(*SILVER_COLUMNS), KEY)
