"""The registered queries of this subpackage, and the SQL they are checked against where SQL can express them."""

from __future__ import annotations

from heliograph.llm import (
    collocations,
    decontamination,
    license_scans,
    packing,
    quality_rules,
    secret_scans,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    url_filters,
    warc,
    whitening,
)

QUERIES = {
    f.__name__: f
    for f in (
        url_filters.op1_url_filters,
        packing.op2_best_fit_packing,
        secret_scans.op3_secret_scans,
        quality_rules.op4_quality_rules,
        license_scans.op5_license_scans,
        simhash.op6_simhash_near_dedup,
        decontamination.op7_benchmark_decontamination,
        sharding.op8_sharding,
        token_counts.op9_token_counts,
        warc.op10_warc,
        whitening.op11_embedding_whitening,
        collocations.op12_phrase_collocations,
        suffix_dedup.op13_suffix_array_dedup,
    )
}

SQL: dict[str, str] = {
    "op4_quality_rules": quality_rules.SQL,
    "op7_benchmark_decontamination": decontamination.SQL,
    "op8_sharding": sharding.SQL,
    "op10_warc": warc.SQL,
    "op12_phrase_collocations": collocations.SQL,
    "op13_suffix_array_dedup": suffix_dedup.SQL,
}
