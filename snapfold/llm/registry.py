"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import (
    byte_cnn,
    collocations,
    html_blocks,
    line_dedup,
    periodic_runs,
    quality_rules,
    secret_scan,
    sentencepiece_fst,
    simhash_covering,
    spaced_seeds,
    suffix_tree,
    toxicity_ordinal,
    warc,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_html_blocks": html_blocks.op3_html_blocks,
    "op4_simhash_covering": simhash_covering.op4_simhash_covering,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_byte_cnn": byte_cnn.op6_byte_cnn,
    "op7_warc": warc.op7_warc,
    "op8_toxicity_ordinal": toxicity_ordinal.op8_toxicity_ordinal,
    "op9_sentencepiece_fst": sentencepiece_fst.op9_sentencepiece_fst,
    "op10_spaced_seeds": spaced_seeds.op10_spaced_seeds,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_suffix_tree": suffix_tree.op12_suffix_tree,
    "op13_collocations": collocations.op13_collocations,
}
ORACLE = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op3_html_blocks": html_blocks.OP3_SQL,
    "op5_secret_scan": secret_scan.OP5_SQL,
    "op7_warc": warc.OP7_SQL,
    "op11_periodic_runs": periodic_runs.OP11_SQL,
    "op13_collocations": collocations.OP13_SQL,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
