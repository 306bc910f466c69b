import __spark_entry__ as registry
from tokenlake.llm.queries import ORACLES, QUERIES


def test_only_listed_queries_have_no_sql():
    text = {"op3_byte_bpe", "op4_toxicity", "op5_secret_scan", "op6_suffix_dedup", "op7_near_dedup", "op8_lm_score", "op9_license_scan"}
    assert set(QUERIES) - set(ORACLES) == text
    allowed = {"throughput_report", "generate_text", "pipeline", *text}
    assert set(registry.queries()) - set(registry.oracle_sql()) == allowed


def test_there_is_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
