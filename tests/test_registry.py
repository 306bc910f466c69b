import __spark_entry__ as registry
from tokenlake.plans.oracles import ORACLES
from tokenlake.plans.queries import QUERIES


def test_every_oracle_has_a_query_and_the_flagship_runs(spark):
    queries, oracles = registry.queries(), registry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(QUERIES) - set(ORACLES) == {"throughput_report", "generate_text"}
    rows = registry.entry(spark).collect()
    assert {r["lang"] for r in rows} == {"de", "en", "es", "fr"}
    assert all(r["ratio"] > 1 for r in rows)
