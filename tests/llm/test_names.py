"""Names of other columns never matter: dots, other cases, names of the operators' own columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from starloom.llm import language_id, license_scan, line_dedup, mixing, quality_rules, sentencepiece_codec, simhash_dedup, suffix_dedup, token_counts

from .helpers import SF, awkward, rows_of

OPERATORS = {
    "encode": lambda d: sentencepiece_codec.encode(d, decoded="decoded"),
    "license_scan": license_scan.license_scan,
    "token_counts": token_counts.token_counts,
    "mix": mixing.mix,
    "quality_rules": quality_rules.quality_rules,
    "suffix_dedup": suffix_dedup.suffix_dedup,
    "language_id": lambda d: language_id.label(d, language_id.learn(d)),
    "simhash_groups": simhash_dedup.simhash_groups,
    "line_dedup": line_dedup.line_dedup,
}
PACKED = {"license_scan", "mix", "quality_rules", "line_dedup"}  # plain column work: tested through the stages


def odd(docs):
    return docs.withColumns({"a.b": F.lit(1), "IDS": F.lit("x"), "N_Bytes": F.lit("y"), "__rest": F.lit(2), "`q`": F.lit(3), "block": F.lit(4)})


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - PACKED))
def test_operators_take_any_names(spark, name):
    docs = awkward(spark)
    want, got = OPERATORS[name](docs), OPERATORS[name](odd(docs))
    assert {"a.b", "__rest", "`q`", "block"} <= set(got.columns)
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    common = [c for c in want.columns if c in got.columns]
    assert {c.lower() for c in want.columns} <= {c.lower() for c in got.columns}
    assert rows_of(got.select(*common)) == rows_of(want.select(*common))


def test_decode_takes_any_names(spark):
    rows = sentencepiece_codec.encode(awkward(spark).select("doc_id", "text"))
    got = sentencepiece_codec.decode(rows.withColumns({"a.b": F.lit(1), "DECODED": F.lit("old")}))
    assert [c for c in got.columns if c.lower() == "decoded"] == ["decoded"] and "a.b" in got.columns
    assert rows_of(got.select("doc_id", "decoded")) == rows_of(sentencepiece_codec.decode(rows).select("doc_id", "decoded"))


def test_stages_take_any_names(spark):
    docs = awkward(spark).withColumns({"a.b": F.lit(1), "block": F.lit(4), "__th": F.lit(5)})
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() >= 0
    assert "a.b" in pipeline.STAGES[-1][1](spark, docs, SF).columns
