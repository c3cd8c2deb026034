"""CSV sinks/sources and dense keys on a hand-made table."""
import tempfile

from pyspark.sql import types as T

from rarelab.sources.csv import read_csv, read_csv_apart, read_csv_saved_index, write_csv
from rarelab.sources.keys import dense_key


def test_csv_roundtrip_and_saved_index(spark):
    df = spark.createDataFrame([(10, "a", True), (11, None, False)], "idx long, s string, b boolean")
    path = tempfile.mkdtemp(prefix="rarelab-csv-") + "/out"
    write_csv(df, path)
    schema = T.StructType([T.StructField("idx", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("b", T.BooleanType())])
    assert sorted(tuple(r) for r in read_csv(spark, path, schema).collect()) == [(10, "a", True), (11, None, False)]
    dropped = read_csv_saved_index(spark, path, schema)
    assert dropped.columns == ["s", "b"]
    renamed = read_csv_saved_index(spark, path, schema, index_name="row")
    assert renamed.columns == ["row", "s", "b"]


def test_dense_key_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(k, k % 3) for k in (50, 7, 31, 8, 99, 2)], "k long, g long")
    out = {r["k"]: r["row_key"] for r in dense_key(df, ["g", "k"], start=1).collect()}
    order = sorted(out, key=lambda k: (k % 3, k))
    assert [out[k] for k in order] == list(range(1, 7))


def test_bad_lines_are_kept_apart(spark):
    path = tempfile.mkdtemp(prefix="rarelab-csv-") + "/bad"
    lines = ["1,a,true", "2,b", "x,c,false", "4,d,true,more", "5,,", "6,\"q,r\",maybe", "7,\"q,r\",false"]
    spark.createDataFrame([("\n".join(["k,s,b", *lines]),)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("b", T.BooleanType())])
    rows, rejected = read_csv_apart(spark, path, schema)
    assert rows.columns == ["k", "s", "b"]
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "a", True), (5, None, None), (7, "q,r", False)]
    assert sorted(r["line"] for r in rejected.collect()) == sorted([lines[1], lines[2], lines[3], lines[5]])
    assert rejected.count() == 4 and all("/bad/" in r["file"] for r in rejected.collect()) and rows.select("k").count() == 3
