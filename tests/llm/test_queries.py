import pytest

from gaugeworks.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs(spark, name):
    queries.queries()[name](spark, DATA).collect()
