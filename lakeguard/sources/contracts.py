"""Schema contracts as DataFrames (operators S4, S5, S6, N1, N6).

A contract is a DataFrame ``(contract_key, ordinal, column, raw_type, type,
nullable)`` — one row per column, ``type`` the canonical name (F1).  Many
contracts (seed versions, live tables, every file of every pending batch)
live in one DataFrame and are compared with joins, never one by one in
driver loops.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.functions.types import normalize_type, normalize_type_name
from lakeguard.session import local_table

CONTRACT_DIR = Path(__file__).resolve().parents[1] / "contracts"
SEED_VERSIONS = ("v1", "v2", "v3")
# Columns the pipeline adds at write time (the last two are Bronze's partition
# columns); never part of an upstream contract.
SYSTEM_COLUMNS = ("_ingested_at", "_schema_version", "_source", "_ingest_date", "_batch_id")

CONTRACT_SCHEMA = T.StructType([
    T.StructField("contract_key", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("raw_type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), True),
])


class UnknownContractVersion(ValueError):
    pass


def seed_path(version: str) -> str:
    """File of a packaged version (``v1``/``v2``/``v3`` already carry the ``v``), or the
    path of a contract file as the caller gives it."""
    if version.endswith(".json"):
        return version
    packaged = CONTRACT_DIR / f"schema_{version}.json"
    if not packaged.exists():
        raise UnknownContractVersion(f"no seed contract for schema_version={version!r}")
    return str(packaged)


def with_canonical(contract: DataFrame) -> DataFrame:
    return contract.withColumn("type", normalize_type("raw_type"))


def load_contracts(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Contract JSON files -> contract rows keyed by each file's ``version``."""
    raw = spark.read.option("multiLine", True).json(paths)
    rows = raw.select(F.col("version").alias("contract_key"),
                      F.posexplode("columns").alias("pos", "c"))
    return with_canonical(rows.select(
        "contract_key",
        (F.col("pos") + 1).cast("int").alias("ordinal"),
        F.col("c.name").alias("column_name"),
        F.col("c.type").alias("raw_type"),
        F.col("c.nullable").cast("boolean").alias("nullable")))


def seed_contracts(spark: SparkSession, versions=SEED_VERSIONS) -> DataFrame:
    """All requested seed versions in one read (S6: select by contract_key)."""
    return load_contracts(spark, [seed_path(v) for v in versions])


def contract_rows(schema: T.StructType, key: str, drop_system: bool = True) -> list[tuple]:
    fields = [f for f in schema.fields if not (drop_system and f.name in SYSTEM_COLUMNS)]
    return [(key, i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(fields, start=1)]


def contract_of(spark: SparkSession, schemas: dict[str, T.StructType],
                drop_system: bool = True) -> DataFrame:
    """Contracts of DataFrame schemas (N1).  Schemas are metadata already on
    the driver; no data is read."""
    rows = [r for key, s in schemas.items() for r in contract_rows(s, key, drop_system)]
    return with_canonical(local_table(spark, rows, CONTRACT_SCHEMA))


def same_contract(a: T.StructType, b: T.StructType, drop_system: bool = True) -> bool:
    """Equal names and canonical types: then there is no drift and nothing to compare by column."""
    def said(schema):
        return {name: normalize_type_name(raw) for _, _, name, raw, _ in contract_rows(schema, "", drop_system)}
    return said(a) == said(b)


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path`` on the cluster's Hadoop filesystem.  The
    JVM class and configuration handles are looked up once per session."""
    sc = spark.sparkContext
    handles = getattr(sc, "_lakeguard_hadoop", None)
    if handles is None:
        handles = (sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration())
        sc._lakeguard_hadoop = handles
    path_cls, conf = handles
    jpath = path_cls(path)
    return jpath.getFileSystem(conf), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


SCHEMA_FILE = "_schema.json"  # hidden from Spark's Parquet reader


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_table_schema(spark: SparkSession, table_path: str, schema: T.StructType) -> None:
    """Record a table's accepted schema next to its data.

    It is written under a new name and put in place whole; should the writer die
    between the two steps, readers take the new file, which is complete by then.
    """
    fs, p = hadoop_path(spark, f"{table_path.rstrip('/')}/{SCHEMA_FILE}")
    _, new = hadoop_path(spark, f"{table_path.rstrip('/')}/{SCHEMA_FILE}.new")
    out = fs.create(new, True)
    try:
        out.write(bytearray(schema.json().encode("utf-8")))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(new, p):
        raise OSError(f"could not record the schema of {table_path}")


def live_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a live Parquet table (S5); ``None`` only when the table does
    not exist.  The recorded schema is used when present (no footer is read);
    otherwise the footers are merged, since the table evolves by appends.
    A folder without any data file, as a failed first write leaves it, is no
    table.  Any other failure propagates instead of silently falling back."""
    if not path_exists(spark, path):
        return None
    name = f"{path.rstrip('/')}/{SCHEMA_FILE}"
    recorded = _read_text(spark, name) or _read_text(spark, f"{name}.new")
    if recorded:
        return T.StructType.fromJson(json.loads(recorded))
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def baseline_contract(spark: SparkSession, table_path: str, key: str = "live",
                      seed_version: str = "v1") -> tuple[DataFrame, str]:
    """Live table contract, else the seed (N6).  Returns (contract, source)."""
    schema = live_schema(spark, table_path)
    if schema is not None:
        return contract_of(spark, {key: schema}), f"live table: {table_path}"
    seed = seed_contracts(spark, [seed_version]).withColumn("contract_key", F.lit(key))
    return seed, Path(seed_path(seed_version)).name


# Canonical contract type -> the Spark type a typed read uses.  Timestamps are
# read zone-free, the convention throughout the library.
_SPARK_TYPES = {"string": T.StringType(), "integer": T.IntegerType(), "double": T.DoubleType(),
                "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(),
                "date": T.DateType()}


def contract_struct(contract: DataFrame) -> T.StructType:
    """StructType of one contract (collected: a contract is column-count sized)."""
    rows = contract.orderBy("ordinal").select("column_name", "type", "nullable").collect()
    return T.StructType([T.StructField(r[0], _SPARK_TYPES.get(r[1]) or T._parse_datatype_string(r[1]),
                                       bool(r[2]) if r[2] is not None else True) for r in rows])
