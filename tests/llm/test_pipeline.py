import public_tokenizers
import sentencepiece

import corpus_pipeline
from rarelab.llm import toxicity
from tests.conftest import SF_SMALL
from tests.llm.messy import messy
from tests.llm.test_exact_dedup import brute as brute_exact
from tests.llm.test_minhash_dedup import brute as brute_near
from tests.llm.test_mixing import brute_targets, size

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    clean = STAGES["toxicity"](spark, docs, SF_SMALL).checkpoint()
    good = {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    assert clean.columns == columns and {r[0] for r in rows_of(clean)} == good

    single = STAGES["exact dedup"](spark, clean, SF_SMALL).checkpoint()
    expected, _ = brute_exact([r[:2] for r in rows_of(clean)])
    assert single.columns == columns
    assert sorted(r[0] for r in rows_of(single)) == sorted(i for i, keep, _, _ in expected if i == keep)

    apart = STAGES["minhash near-dedup"](spark, single, SF_SMALL).checkpoint()
    assert apart.columns == columns
    assert sorted(r[0] for r in rows_of(apart)) == sorted(r[0] for r in brute_near([r[:2] for r in rows_of(single)], 5) if r[3])

    mixed = STAGES["source mix"](spark, apart, SF_SMALL).checkpoint()
    assert mixed.columns == columns and set(rows_of(mixed)) <= set(rows_of(apart))
    sizes, taken, largest = {}, {}, {}
    for _, t, s in rows_of(apart):
        sizes[s], largest[s] = sizes.get(s, 0) + size(t), max(largest.get(s, 0), size(t))
    for _, t, s in rows_of(mixed):
        taken[s] = taken.get(s, 0) + size(t)
    for s, goal in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - goal) <= largest[s] / 2 + 1

    encoded = STAGES["sentencepiece"](spark, mixed, SF_SMALL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r[0]: r[1] for r in rows_of(mixed)}
    assert len(encoded) == mixed.count()
    assert all(list(r["ids"]) == library.encode(texts[r["doc_id"]]) and r["parity"] for r in encoded)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == sorted(r["doc_id"] for r in encoded)


def test_messy_rows_pass_every_stage(spark):
    docs = messy(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).checkpoint()
        assert docs.count() > 0, name
    empty = messy(spark).where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_SMALL).checkpoint()
        assert empty.count() == 0
