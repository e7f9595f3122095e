"""Every registered query against its SQL."""

import pytest

from quern import registry
from tests.compare import SMALL, of_spark, oracle


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, name):
    assert of_spark(registry.QUERIES[name](spark, SMALL)) == oracle(registry.ORACLE_SQL[name])


def test_every_sql_has_a_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)


def test_flagship_has_rows(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and all(r.prompt and r.response.startswith("<think>") and "<|" not in r.response for r in rows)


def test_approximate_count_is_near(spark):
    for r in registry.QUERIES["agg_approx_distinct"](spark, SMALL).collect():
        assert abs(r.approx_parts - r.parts) <= 0.1 * r.parts
