"""Exact dedup by sorting whole texts.

Texts are normalised (white space deleted), range-partitioned by sampled
splitters and sorted inside each partition, so equal texts lie side by side;
each text is compared in full with its neighbour.  The splitters hold the first
bytes of the text, a hash, and the row's rank within its group, so the sample
stays small whatever the texts' lengths, texts with a common opening spread,
and a group with a third of all rows is cut over many partitions.  Groups that
reach over a partition's edge are joined by comparing the edge texts in full."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarelab.llm.common import SPACE_CLASS, column, map_arrow, pieces
from rarelab.session import cut_lineage

PREFIX = 32  # characters of the normalised text in a splitter

_RUNS = ("doc_id bigint, text_chars bigint, text_sha256 string, part int, pos bigint, run bigint, edge string")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts in one sorted partition.

    ``edge`` carries the text of a run that another partition may continue,
    on the run's first row: runs whose (prefix, hash) equals that of the
    partition's first or last row."""
    last_text, run, pos, key, first_key = None, -1, 0, None, None
    waiting: list[tuple[dict, tuple]] = []  # first rows of the runs that share the latest key

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_RUNS_ARROW)

    for piece in pieces(batches):
        texts = column(piece, "norm")
        n = len(texts)
        head = pa.array([last_text], pa.string())
        before = pa.concat_arrays([head, texts.slice(0, n - 1)])
        same = pc.fill_null(pc.equal(texts, before), False).to_pylist()
        ids, chars, shas, parts = (column(piece, c).to_pylist() for c in ("doc_id", "text_chars", "sha", "part"))
        keys = list(zip(column(piece, "prefix").to_pylist(), column(piece, "h").to_pylist(), strict=True))
        rows = []
        for i in range(n):
            row = {"doc_id": ids[i], "text_chars": chars[i], "text_sha256": shas[i], "part": parts[i], "pos": pos,
                   "run": run, "edge": None}
            pos += 1
            if same[i]:
                row["run"] = run
                rows.append(row)
                continue
            run += 1
            row["run"] = run
            first_key = keys[i] if first_key is None else first_key
            if keys[i] != key:
                rows += [w for w, _ in waiting]
                waiting, key = [], keys[i]
            text = texts[i].as_py()
            if keys[i] == first_key:
                row["edge"] = text
                rows.append(row)
            else:
                waiting.append((row, text))
        last_text = texts[n - 1].as_py()
        yield table(rows)
    if waiting:  # the last key's runs may go on in the next partition
        yield table([w | {"edge": text} for w, text in waiting])


_RUNS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_chars", pa.int64()), ("text_sha256", pa.string()),
                         ("part", pa.int32()), ("pos", pa.int64()), ("run", pa.int64()), ("edge", pa.string())])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, text_chars``.

    Texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``.
    Of equal texts the row with the most code points in the original text
    stays, then the smallest id (rows without an id come last); of rows that
    repeat both, exactly one.  A null text counts as empty, and all empty
    texts form one group.  An empty table gives an empty result.  Other
    columns are not read."""
    norm = F.regexp_replace(F.col("t"), SPACE_CLASS + "+", "")
    rows = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .select("doc_id", F.char_length("t").cast("bigint").alias("text_chars"), norm.alias("norm"))
            .withColumns({"prefix": F.substring("norm", 1, PREFIX), "h": F.xxhash64("norm")}))
    order = [F.col("text_chars").desc(), F.col("doc_id").asc_nulls_last()]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (rows.repartitionByRange(parts, "prefix", "h", *order)
              .sortWithinPartitions("prefix", "h", "norm", *order)
              .withColumns({"sha": F.sha2("norm", 256), "part": F.spark_partition_id()}))
    runs = cut_lineage(map_arrow(placed, _runs, _RUNS))

    # a run never leaves its partition, so these groups hold one partition's rows at most
    first = F.struct((-F.col("text_chars")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"),
                     F.col("part").alias("p"), F.col("pos").alias("i"))
    local = runs.groupBy("part", "run").agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("size"),
                                            F.max("edge").alias("edge"))
    inner = local.where("edge IS NULL").drop("edge")
    over = Window.partitionBy("edge")  # a few runs per partition, whatever the rows
    outer = local.where("edge IS NOT NULL").select(
        "part", "run", F.min("best").over(over).alias("best"), F.sum("size").over(over).alias("size"))
    groups = inner.select("part", "run", "best", "size").unionAll(outer)
    return runs.drop("edge").join(groups, ["part", "run"]).select(
        "doc_id", F.col("best.d").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("best.p").eqNullSafe(F.col("part")) & F.col("best.i").eqNullSafe(F.col("pos"))).alias("kept"),
        "text_sha256", "text_chars")


def keep_unique(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    A row is found again by its id and normalised text; rows that repeat both
    are one document and the longest, then the first by its text, is returned.
    Rows without an id are told apart by their text alone."""
    stay = exact_dedup(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the input's columns travel as one, so their names clash with none of these
    tagged = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"),
                         F.sha2(F.regexp_replace(text, SPACE_CLASS + "+", ""), 256).alias("sha"), text.alias("text"))
    kept = tagged.join(stay, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    one = Window.partitionBy(F.coalesce("id", F.lit(0)), F.col("id").isNull(), "sha").orderBy(
        F.char_length("text").desc(), "text")
    return kept.withColumn("n", F.row_number().over(one)).where("n = 1").select("row.*")
