"""Registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from tokenlake.llm import decontaminate, line_dedup, merkle_manifest, phrase_mining, quality_rules, url_filter
from tokenlake.llm.byte_bpe import op3_byte_bpe
from tokenlake.llm.decontaminate import op10_decontaminate
from tokenlake.llm.license_scan import op9_license_scan
from tokenlake.llm.line_dedup import op1_line_dedup
from tokenlake.llm.lm_score import op8_lm_score
from tokenlake.llm.merkle_manifest import op12_merkle_manifest
from tokenlake.llm.near_dedup import op7_near_dedup
from tokenlake.llm.phrase_mining import op11_phrase_mining
from tokenlake.llm.quality_rules import op2_quality_rules
from tokenlake.llm.secret_scan import op5_secret_scan
from tokenlake.llm.suffix_dedup import op6_suffix_dedup
from tokenlake.llm.toxicity import op4_toxicity
from tokenlake.llm.url_filter import op13_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_quality_rules,
        op3_byte_bpe,
        op4_toxicity,
        op5_secret_scan,
        op6_suffix_dedup,
        op7_near_dedup,
        op8_lm_score,
        op9_license_scan,
        op10_decontaminate,
        op11_phrase_mining,
        op12_merkle_manifest,
        op13_url_filter,
    )
}
ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_phrase_mining": phrase_mining.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
    "op13_url_filter": url_filter.ORACLE,
}
