"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from . import decontaminate, fingerprints, line_dedup, ngram_join, packing, pii, quality, sharding, url_filter, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op5_ngram_jaccard_join": ngram_join.op5_ngram_jaccard_join,
    "op2_fingerprints": fingerprints.op2_fingerprints,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op6_packing": packing.op6_packing,
    "op7_url_filters": url_filter.op7_url_filters,
    "op8_sharding": sharding.op8_sharding,
    "op9_pii": pii.op9_pii,
    "op10_warc": warc.op10_warc,
}

SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op5_ngram_jaccard_join": ngram_join.OP5_SQL,
    "op4_decontamination": decontaminate.OP4_SQL,
    "op10_warc": warc.OP10_SQL,
    "op7_url_filters": url_filter.OP7_SQL,
}
