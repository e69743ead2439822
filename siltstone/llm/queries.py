"""The registered queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from siltstone.llm import audit, chat, decontamination, fingerprints, html_text, language, merkle, mixing, neardup, neighbours, pii, sharding, urls

QUERIES = {
    "op1_hilbert_shards": sharding.op1_hilbert_shards,
    "op2_boosted_spans": pii.op2_boosted_spans,
    "op3_language_mixture": language.op3_language_mixture,
    "op4_source_schedule": mixing.op4_source_schedule,
    "op5_piecewise_hashes": fingerprints.op5_piecewise_hashes,
    "op6_order_minhash": neardup.op6_order_minhash,
    "op7_url_language_models": urls.op7_url_language_models,
    "op8_template_compiler": chat.op8_template_compiler,
    "op9_host_suffixes": html_text.op9_host_suffixes,
    "op10_benchmark_windows": decontamination.op10_benchmark_windows,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_block_neighbours": neighbours.op13_block_neighbours,
}
ORACLE = {
    "op4_source_schedule": mixing.OP4_SQL,
    "op8_template_compiler": chat.OP8_SQL,
    "op10_benchmark_windows": decontamination.OP10_SQL,
    "op12_filter_audit": audit.OP12_SQL,
    "op13_block_neighbours": neighbours.OP13_SQL,
}
