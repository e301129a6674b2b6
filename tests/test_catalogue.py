import pytest

from strandline.plans import catalogue

from .oracle import both

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_oracle(spark, name):
    ours, theirs = both(catalogue.QUERIES[name](spark, SF), catalogue.ORACLES[name], SF)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 6
    assert set(e.oracle_sql()) <= set(e.queries())


def test_rules_keep_and_reject(spark):
    rows = catalogue.QUERIES["dual_threshold_pools"](spark, SF).collect()
    assert all(0 < r.n_passed < r.n_seen for r in rows)


def test_length_bound_reaches_the_scan(spark, tmp_path):
    from strandline.operators.pools import dual_threshold

    spark.createDataFrame([("r", "c", 4500, 5000)], "qname string, tname string, n_match long, aln_len long").write.parquet(str(tmp_path / "a"))
    plan = dual_threshold(spark.read.parquet(str(tmp_path / "a")))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(aln_len,3000)" in plan
