"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.session import checkpoint_dir

# Words as every contract of this package reads them: runs of anything but
# space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch and bytes of text handled at once in a task; both
# bound a worker's memory and change no result.
BATCH_ROWS = 512
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts may be long, so Arrow batches hold few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


_MADE: list[str] = []   # folders of the intermediates this process has written


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, removed when the session's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    _MADE.append(path)
    return path


def discard(spark: SparkSession, since: int, keep: str | None = None) -> None:
    """Delete the intermediates written since there were ``since`` of them, once nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in _MADE[since:] if p != keep]:
        folder = jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
        folder.getFileSystem(conf).delete(folder, True)
        _MADE.remove(path)


def finished(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` written to the shared folder; the intermediates it wrote on the way are deleted."""
    already = made()
    out = materialise(make(), name)
    discard(spark, already, keep=_MADE[-1])
    return out


def made() -> int:
    """How many intermediates there are."""
    return len(_MADE)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back.

    Later stages then neither recompute it nor depend on executors that may be lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about SLICE_BYTES of text (one row at least)."""
    sizes = batch.column(column).to_pylist()
    start = total = 0
    for i, value in enumerate(sizes):
        total += len(value) if value is not None else 0
        if total >= SLICE_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def quoted(name: str) -> str:
    """A column name as it must stand in an expression, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def map_texts(df: DataFrame, keep: list[str], fn: Callable[[list], dict[str, list]],
              fields: dict[str, pa.DataType], ddl: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row plus what ``fn`` makes of the whole texts.

    ``fn`` gets a list of texts (None for null) and returns one list per field.
    """
    made = map_rows(df, keep, fn, fields, ddl, text)
    return made.select(*[F.col(f"row.{quoted(k)}").alias(k) for k in keep], *fields)


def map_rows(df: DataFrame, keep: list[str], fn: Callable[[list], dict[str, list]],
             fields: dict[str, pa.DataType], ddl: str, text: str = "text") -> DataFrame:
    """As ``map_texts``, with the kept columns inside one struct ``row``, so that no name clashes."""
    # A struct without a field can't be sent, hence the constant.
    row = F.struct(*[F.col(quoted(k)) for k in keep]) if keep else F.struct(F.lit(True).alias("none"))
    sent = df.select(row.alias("row"), F.col(quoted(text)).alias("text"))
    schema = T.StructType([sent.schema["row"], *T.StructType.fromDDL(ddl).fields])

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                made = fn(piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row")] + [pa.array(made[k], t) for k, t in fields.items()], names=["row", *fields])

    return sent.mapInArrow(run, schema)


def shared(spark: SparkSession, value) -> Callable:
    """A function that gives ``value`` in a task, for values of a stated bound only.

    It is broadcast as bytes that hold the classes it is made of, so an executor needs no copy of this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get():
        if not held:
            held.append(cloudpickle.loads(sent.value))
        return held[0]

    return get


def n_words(text) -> F.Column:
    """Number of words of a text column (0 for null), JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
