"""Order-dependent quantities (running sums, dense positions) computed without
a single-partition window.

The rows are range-partitioned by (group, order) - Spark samples the splitters -
and sorted; a partition adds up its own rows from its first one on, group by
group, and is written down.  The order ends in a unique key, so a value shared
by a third of all rows still spreads over many partitions.  Only a partition's
first group can go on from the partitions before, so what is carried into a
partition is one number per summed column: the last sums of the partitions
before it that end in the same group.  These are as many as there are
partitions, and come back to the rows by partition number.  Rows move once.
The plan is the same at every size; only the number of partitions follows the
row count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rarelab.session import cut_lineage, expose_package


def _local_sums(groups: list[str], sums: list[str], schema: pa.Schema):
    """Append the partition's number, the row's place in it, whether its group is the first, and sums from the
    group's first row here to this one."""
    def starts(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, tuple]:
        """Rows that start a group, and the last row's group."""
        new = np.zeros(batch.num_rows, bool)
        first, end = [], []
        for g in groups:
            coded = batch.column(g).dictionary_encode(null_encoding="encode")
            number = coded.indices.to_numpy(zero_copy_only=False)
            new[1:] |= number[1:] != number[:-1]
            first.append(batch.column(g)[0].as_py())
            end.append(batch.column(g)[-1].as_py())
        new[0] = last is None or tuple(first) != last
        return new, tuple(end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, runs, last = TaskContext.get().partitionId(), 0, 0, None
        carried = [0] * len(sums)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            new, last = starts(batch, last)
            run_no = runs + np.cumsum(new)
            runs = int(run_no[-1])
            begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the group began before this batch
            local = []
            for k, c in enumerate(sums):
                x = batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)
                total = np.cumsum(x)
                before = np.where(begin > 0, total[np.maximum(begin, 1) - 1], 0)
                value = total - before + np.where(begin < 0, carried[k], 0).astype(x.dtype)
                carried[k] = value[-1]
                local.append(pa.array(value))
            cols = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(at + np.arange(n)), pa.array(run_no == 1), *local]
            at += n
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
    return run


def running_sum(df: DataFrame, group_cols: list[str], order_cols: list, sum_cols: list[str],
                prefix: str = "cum_", rows_per_bucket: int = 2_000_000, materialize: bool = True,
                n: int | None = None) -> DataFrame:
    """Add ``<prefix><c>``: the sum of ``c`` (integers as bigint, others as double, null as 0) over rows of the same group at or
    before the current row in ``order_cols`` order.  ``order_cols`` (column
    names or expressions, ascending) must be unique within a
    group.  ``materialize`` writes the input down first (its plan would
    otherwise run once for the splitters and once for the rows); ``n`` (the
    row count, when the caller knows it) saves a pass."""
    spark = df.sparkSession
    group_cols = list(group_cols)
    names = df.columns
    ocols = []
    for i, c in enumerate(order_cols):
        df = df.withColumn(f"__o{i}", F.col(c) if isinstance(c, str) else c)
        ocols.append(f"__o{i}")
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    kinds = [T.LongType() if isinstance(df.schema[c].dataType, whole) else T.DoubleType() for c in sum_cols]
    terms = [f"__t{i}" for i in range(len(sum_cols))]
    df = df.withColumns({t: F.col(c).cast(k) for t, c, k in zip(terms, sum_cols, kinds, strict=True)})
    if materialize:
        df = cut_lineage(df)
    if n is None:
        n = df.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / rows_per_bucket))
    local = [f"__l{i}" for i in range(len(sum_cols))]
    schema = T.StructType([*df.schema.fields, T.StructField("__b", T.IntegerType()), T.StructField("__at", T.LongType()),
                           T.StructField("__head", T.BooleanType()), *[T.StructField(c, k) for c, k in zip(local, kinds, strict=True)]])
    expose_package(spark)
    keys = [*group_cols, *ocols]
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys) if keys else df.repartition(1)
    rows = cut_lineage(ranged.mapInArrow(_local_sums(group_cols, terms, to_arrow_schema(schema)), schema).drop(*ocols, *terms))

    # one row per partition: the group that it starts with, and the one that it ends with and its sums there
    group = F.struct(F.lit(0).alias("any"), *group_cols)
    ends = rows.groupBy("__b").agg(F.min_by(group, "__at").alias("first"), F.max_by(group, "__at").alias("last"),
                                   *[F.max_by(c, "__at").alias(f"e_{c}") for c in local])
    so_far = Window.partitionBy("last").orderBy("__b")
    ends = ends.withColumns({f"e_{c}": F.sum(f"e_{c}").over(so_far) for c in local})
    by_number = Window.partitionBy().orderBy("__b")
    goes_on = F.lag("last").over(by_number).eqNullSafe(F.col("first"))
    carry = ends.select("__b", *[F.when(goes_on, F.lag(f"e_{c}").over(by_number)).otherwise(F.lit(0)).cast(k).alias(f"c_{c}")
                                 for c, k in zip(local, kinds, strict=True)])
    out = rows.join(carry.withColumnRenamed("__b", "__cb"), F.col("__b") == F.col("__cb"))
    total = {f"{prefix}{c}": F.col(x) + F.when(F.col("__head"), F.col(f"c_{x}")).otherwise(F.lit(0).cast(k))
             for c, x, k in zip(sum_cols, local, kinds, strict=True)}
    return out.withColumns(total).select(*names, *[f"{prefix}{c}" for c in sum_cols])


def dense_position(df: DataFrame, order_cols: list, name: str = "pos",
                   rows_per_bucket: int = 2_000_000, materialize: bool = True) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order_cols`` order
    (unique per row - end with the key)."""
    one = df.withColumn("__one", F.lit(1).cast("bigint"))
    r = running_sum(one, [], order_cols, ["__one"], rows_per_bucket=rows_per_bucket, materialize=materialize)
    return r.withColumn(name, F.col("cum___one") - 1).drop("__one", "cum___one")
