"""Spark session settings the library relies on.

Everything time-related is kept in ``timestamp_ntz`` and the session zone is
pinned to UTC, so results never depend on the machine's clock or zone.
"""

from __future__ import annotations

import os
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings every session used by the library should carry.  They are hints for
# Catalyst/AQE, not hand scheduling: AQE coalesces small shuffle partitions,
# splits skewed join partitions and switches joins to broadcast at run time
# when a side turns out to be small.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lakeguard", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.  On a cluster, use the
    cluster's session and call :func:`configure` on it instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LAKEGUARD_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.ui."):
            continue
        spark.conf.set(key, value)
    return spark


def local_table(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A DataFrame of a few driver-made rows (tuples or lists), in one partition.

    They are handed over as one Arrow table; a plain list would be split into
    as many Python tasks as the session has cores.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a scratch folder created,
    and it is then registered on the session so every later caller agrees.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not value:
        value = tempfile.mkdtemp(prefix="lakeguard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", value)
    spark.sparkContext.setCheckpointDir(value)
    return value
