"""The study fixture reproduces FIXTURES.md; the driver contract holds."""
from tests.conftest import SF_SMALL


def test_entity_profile_matches_fixtures(spark):
    import __spark_entry__ as e
    got = {r["cohort"]: r for r in e.queries()["entity_profile"](spark, SF_SMALL).collect()}
    assert (got["train"]["n_rows"], got["train"]["positives"], got["train"]["zero_wins"],
            got["train"]["total_wins"]) == (126, 10, 78, 58)
    assert got["train"]["corr_label_n_orders"] == 0.500245
    assert (got["7"]["n_rows"], got["8"]["n_rows"]) == (13, 11)


def test_entry_and_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0 and df.columns == ["entity_id", "name", "wins"]
    assert set(e.oracle_sql()) <= set(e.queries())
