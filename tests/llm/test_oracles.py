import pytest

from strandline.llm import queries

from ..oracle import both

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    ours, theirs = both(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)
    assert ours == theirs and ours


def test_all_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
