"""CSV sources and sinks (inventory A1, A2, A4).

Schemas are declared, never inferred (inference is an extra pass over the
data).  Spark writes a directory of part files; the key is a real column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelab.session import cut_lineage


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1: header CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_csv_apart(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A1 for files of others: ``(rows, rejected)``.

    A line with fields that are missing, too many or not of their type is no row: it comes back
    as ``(file, line)``, the line as it stands in the file.  Every line is read once and is in one of the two;
    ``rejected.count()`` is the number that were left out."""
    bad, name = "__rejected", "__file"
    whole = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    read = (spark.read.schema(whole).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", bad).csv(path))
    # written down whole: a parser that is asked for some columns only does not see what is wrong in others
    parsed = cut_lineage(read.withColumn(name, F.input_file_name()))
    return (parsed.where(F.col(bad).isNull()).drop(bad, name),
            parsed.where(F.col(bad).isNotNull()).select(F.col(name).alias("file"), F.col(bad).alias("line")))


def read_csv_saved_index(spark: SparkSession, path: str, schema: T.StructType,
                         index_name: str | None = None) -> DataFrame:
    """A2: CSV whose first column is a saved (unnamed) row index.  The schema's
    first field reads it; it is renamed to ``index_name`` or dropped."""
    df = read_csv(spark, path, schema)
    first = schema.fields[0].name
    return df.withColumnRenamed(first, index_name) if index_name else df.drop(first)


def write_csv(df: DataFrame, path: str) -> None:
    """A4: header CSV directory, overwritten."""
    df.write.mode("overwrite").option("header", True).csv(path)
