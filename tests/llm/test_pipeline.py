"""Every stage of the pipeline on its own input, and the whole of it."""

import corpus_pipeline as pipeline
from starloom.llm import line_dedup, mixing, quality_rules, queries, simhash_dedup
from starloom.llm.token_counts import default_model, load

from .helpers import SCHEMA, SF, awkward, by_sql, rows_of
from .test_groups import brute_simhash


def test_stages_in_order():
    assert [f.__name__ for _, f in pipeline.STAGES] == ["quality", "dedup_lines", "near_dedup", "mixture", "tokens"]


def test_stages_keep_the_columns(spark):
    docs = awkward(spark)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString()
        out.count()
        assert stage(spark, spark.createDataFrame([], SCHEMA), SF).collect() == []
    last = pipeline.STAGES[-1][1]
    assert all(r["round_trip"] for r in last(spark, docs, SF).collect())
    assert last(spark, spark.createDataFrame([], SCHEMA), SF).collect() == []


def test_quality_stage_follows_the_verdict(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = by_sql(docs, "documents", f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept", str(tmp_path / "d"))
    assert rows_of(pipeline.quality(spark, docs, SF).select("doc_id")) == want


def test_line_stage_follows_the_sql(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = by_sql(docs, "documents", f"SELECT doc_id, clean_text text FROM ({line_dedup.SQL}) WHERE n_removed = 0 OR n_words_left > 0", str(tmp_path / "d"))
    assert rows_of(pipeline.dedup_lines(spark, docs, SF).select("doc_id", "text")) == want


def test_near_dedup_stage_keeps_one_of_each(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted({c for _, _, c in brute_simhash(rows)})
    assert sorted(r["doc_id"] for r in pipeline.near_dedup(spark, docs, SF).collect()) == want


def test_mixture_stage_follows_the_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r["doc_id"]: (r["taken"], r["size"], r["text"]) for r in mixing.mix(docs).collect()}
    copies = {}
    for r in pipeline.mixture(spark, docs, SF).collect():
        copies.setdefault(r["doc_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"]) or r["text"] == taken[r["doc_id"]][2]
    for k, (n, size, text) in taken.items():
        mine = sorted(copies.get(k, []), key=len, reverse=True)
        assert sum(len(t.split()) for t in mine) == n
        assert all(text.startswith(t) for t in mine) and sum(t == text for t in mine) >= (n // size if size else 0)


def test_whole_pipeline(spark):
    rows = pipeline.run(spark, SF).collect()
    sp = load(default_model())
    given = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows and {r["doc_id"] for r in rows} <= given
    for r in rows:
        assert r["round_trip"] and r["n_tokens"] == len(r["ids"])
        assert sp.decode(r["ids"]) == r["text"]


def test_registered():
    import __spark_entry__ as entry

    found, sql = entry.queries(), entry.oracle_sql()
    for n, name in enumerate(["op1_sentencepiece_codec", "op2_license_scan", "op3_token_counts", "op4_embedding_dedup", "op5_mixing",
                              "op6_quality_rules", "op7_suffix_dedup", "op8_language_id", "op9_simhash_dedup", "op10_line_dedup",
                              "op11_quality_classifier", "op12_merkle_manifest", "op13_source_divergence"], 1):
        assert name in found and name.startswith(f"op{n}_")
    assert "pipeline" in found and set(sql) <= set(found)
    assert set(queries.oracle_sql()) == {"op2_license_scan", "op4_embedding_dedup", "op5_mixing", "op6_quality_rules", "op10_line_dedup",
                                         "op12_merkle_manifest", "op13_source_divergence"}
    assert simhash_dedup.BLOCK > 0
