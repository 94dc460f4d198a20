"""The registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from . import (embedding_dedup, language_id, license_scan, line_dedup, merkle_manifest, mixing, quality_classifier, quality_rules, sentencepiece_codec, simhash_dedup, source_divergence,
               suffix_dedup, token_counts)
from .common import read

_DOCS = {
    "op1_sentencepiece_codec": sentencepiece_codec.query,
    "op2_license_scan": license_scan.query,
    "op3_token_counts": token_counts.query,
    "op5_mixing": mixing.query,
    "op6_quality_rules": quality_rules.query,
    "op7_suffix_dedup": suffix_dedup.query,
    "op8_language_id": language_id.query,
    "op9_simhash_dedup": simhash_dedup.query,
    "op10_line_dedup": line_dedup.query,
    "op12_merkle_manifest": merkle_manifest.query,
    "op13_source_divergence": source_divergence.query,
}


def queries():
    found = {name: (lambda spark, sf_dir, f=f: f(read(spark, sf_dir, "documents"))) for name, f in _DOCS.items()}
    return found | {
        "op4_embedding_dedup": lambda spark, sf_dir: embedding_dedup.query(read(spark, sf_dir, "embeddings")),
        "op11_quality_classifier": lambda spark, sf_dir: quality_classifier.query(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": license_scan.sql(), "op4_embedding_dedup": embedding_dedup.SQL, "op5_mixing": mixing.SQL,
            "op6_quality_rules": quality_rules.SQL, "op10_line_dedup": line_dedup.SQL,
            "op12_merkle_manifest": merkle_manifest.SQL, "op13_source_divergence": source_divergence.SQL}
