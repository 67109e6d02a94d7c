"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from millrace.llm import (
    exact_dedup,
    fingerprints,
    licenses,
    lm_scores,
    mixing,
    near_dedup,
    periodic,
    rollups,
    sentencepiece,
    spelling,
    toxicity,
    url_filter,
    warc,
)

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_lm_scores": lm_scores.op2_lm_scores,
    "op3_sentencepiece": sentencepiece.op3_sentencepiece,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_rollups": rollups.op9_rollups,
    "op10_warc": warc.op10_warc,
    "op11_spelling": spelling.op11_spelling,
    "op12_periodic": periodic.op12_periodic,
    "op13_url_filter": url_filter.op13_url_filter,
}
ORACLES = {
    "op1_licenses": licenses.ORACLE_SQL,
    "op2_lm_scores": lm_scores.ORACLE_SQL,
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_rollups": rollups.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op11_spelling": spelling.ORACLE_SQL,
    "op13_url_filter": url_filter.ORACLE_SQL,
}
