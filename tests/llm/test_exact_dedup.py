import hashlib
import random
import re

from pyspark.sql import functions as F

from rarelab.llm.exact_dedup import exact_dedup, keep_unique
from tests.llm.messy import messy, messy_rows, nothing

GAPS = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    """doc_id, keep_id, group_size, text_sha256 of every row."""
    groups = {}
    for i, t in rows:
        groups.setdefault(GAPS.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[2], members[0][2], len(members), sha) for m in members]
    return sorted(out, key=repr), len(groups)


def check(df, rows):
    got = exact_dedup(df).collect()
    expected, groups = brute(rows)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=repr) == expected
    assert sum(r["kept"] for r in got) == groups
    assert all(r["keep_id"] == r["doc_id"] for r in got if r["kept"])


def test_messy_rows(spark):
    check(messy(spark), [(r[0], r[1]) for r in messy_rows()])


def test_empty_table(spark):
    assert exact_dedup(nothing(spark)).collect() == []
    assert keep_unique(nothing(spark)).collect() == []


def test_group_over_many_partitions(spark):
    rng = random.Random(1)
    rows = [(i, " " * rng.randrange(3) + "the same text") for i in range(900)]
    rows += [(1000 + i, rng.choice(["the same text", "the same texts", "the sam", "a b", "a  b", f"own {i}"])) for i in range(900)]
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), rows)


def test_equal_hash_and_prefix_are_told_apart(spark, monkeypatch):
    """With one hash for all texts, neighbours alone decide, over the edges of partitions too."""
    import rarelab.llm.exact_dedup as m

    monkeypatch.setattr(m.F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    monkeypatch.setattr(m, "PREFIX", 2)
    rows = [(i, f"aa{i % 5}") for i in range(500)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), rows)


def test_keep_unique_returns_one_whole_row_per_text(spark):
    df = messy(spark)
    got = keep_unique(df)
    assert got.columns == df.columns
    norms = [GAPS.sub("", r["text"] or "") for r in got.collect()]
    assert len(norms) == len(set(norms)) == brute([(r[0], r[1]) for r in messy_rows()])[1]
    assert {r["doc_id"] for r in got.collect()} >= {4, 7, 8, 10, 11, 13}
