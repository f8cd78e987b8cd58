"""Running numbers and running XORs within a key, without a task that holds a whole key.

Rows are range-partitioned by key and order, so a key with very many rows lies
in several partitions.  Each partition numbers its own rows; what the
partitions before it hold of its first key is one row per partition and is
added afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.llm.common import materialise


def running(df: DataFrame, key: str, order: list[Column], keep: list[str], xors: list[str], name: str) -> DataFrame:
    """Columns ``key`` (long, not null) and ``keep`` of every row, with ``n``, its number within the key, and the XOR
    of each column of ``xors`` (long, not null) over all rows of the key up to and including this one."""
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_parts, F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    kept = [f for f in df.schema.fields if f.name in keep and f.name not in xors]
    fields = [df.schema[key], *kept, *[T.StructField(x, T.LongType()) for x in xors],
              T.StructField("n", T.LongType()), T.StructField("__part", T.IntegerType()), T.StructField("__at", T.LongType())]
    schema = T.StructType(fields)

    def number(batches):
        part, at, last = TaskContext.get().partitionId(), 0, None
        count, totals = 0, [0] * len(xors)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]])
            starts = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
            carried = starts < 0                      # rows that go on with the key of the batch before
            n = np.arange(len(keys)) - np.maximum(starts, 0) + 1 + np.where(carried, count, 0)
            made = []
            for j, x in enumerate(xors):
                total = np.bitwise_xor.accumulate(batch.column(x).to_numpy(zero_copy_only=False))
                before = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0)
                total = total ^ np.where(carried, totals[j], before)
                totals[j] = total[-1]
                made.append(pa.array(total, pa.int64()))
            last, count = keys[-1], int(n[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *[batch.column(f.name) for f in kept], *made, pa.array(n, pa.int64()),
                 pa.array(np.full(len(keys), part, np.int32)), pa.array(np.arange(at, at + len(keys)))], names=schema.names)
            at += len(keys)

    columns = list(dict.fromkeys([key, *[f.name for f in kept], *xors]))
    local = materialise(ranged.select(*columns).mapInArrow(number, schema), name)
    state = F.struct("__at", F.col(key).alias("key"), "n", *xors)
    # One row per partition, from which the rows that a partition's first key has before it follow.
    ends = local.groupBy("__part").agg(F.min(state)["key"].alias("first"), F.max(state).alias("last")).orderBy("__part").collect()
    carry, held = [], None
    for r in ends:
        last = [r["last"]["n"], *[r["last"][x] for x in xors]]
        if held is not None and held[0] == r["first"]:
            carry.append((r["__part"], r["first"], *held[1]))
            if r["last"]["key"] == r["first"]:
                last = [last[0] + held[1][0], *[a ^ b for a, b in zip(last[1:], held[1][1:])]]
        held = (r["last"]["key"], last)
    names = ["n", *xors]
    ddl = "c_part int, c_key long, " + ", ".join(f"c_{x} long" for x in names)
    before = F.broadcast(df.sparkSession.createDataFrame(carry, ddl))      # at most one row per partition
    joined = local.join(before, (F.col("__part") == F.col("c_part")) & (F.col(key) == F.col("c_key")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(key, *[f.name for f in kept],
                         *[F.col(x).bitwiseXOR(F.coalesce(f"c_{x}", zero)).alias(x) for x in xors],
                         (F.col("n") + F.coalesce("c_n", zero)).alias("n"))
