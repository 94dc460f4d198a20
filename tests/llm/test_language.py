"""Language identification: held-out accuracy, exact paths, defined cases."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import language_id as lid

from .helpers import SCHEMA, awkward


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lid.query(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98
    assert out.filter("score < 0 or score > 1").count() == 0


def test_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame([(i, "wort " * 9, "de") for i in range(40)], "doc_id long, text string, lang string")
    split = docs.select("doc_id", lid.held_out(F.col("doc_id")).alias("h")).collect()
    import zlib
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in split)
    changed = docs.withColumn("lang", F.when(lid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert {r["lang_pred"] for r in lid.query(changed).collect()} == {"de"}


def test_best_path_is_exact():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n, k = int(rng.integers(1, 7)), int(rng.integers(1, 4))
        s = rng.normal(size=(n, k)) * 5
        price = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 4.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731,B023
        best = max(price(p) for p in itertools.product(range(k), repeat=n))
        assert abs(price(lid.viterbi(s, 4.0).tolist()) - best) < 1e-9


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_paths_of_many_texts_are_exact(monkeypatch, chunk):
    """Chunks of any length give paths of the price that the plain recursion finds."""
    monkeypatch.setattr(lid, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    for k in (1, 2, 4, 17):
        size = rng.integers(1, 200, 30)
        s = rng.normal(size=(int(size.sum()), k)) * rng.choice([0.5, 5, 20])
        found, at = lid.paths(s, size, 6.0), 0
        price = lambda x, p: x[np.arange(len(x)), p].sum() - 6.0 * (p[1:] != p[:-1]).sum()
        for n in size.tolist():
            x, p = s[at:at + n], found[at:at + n]
            best = x[0].copy()
            for row in x[1:]:
                best = np.maximum(best, best.max() - 6.0) + row
            assert abs(price(x, p) - best.max()) < 1e-8 and abs(price(x, lid.viterbi(x, 6.0)) - best.max()) < 1e-8
            at += n
    assert len(lid.paths(np.zeros((0, 3)), np.zeros(0, np.int64), 6.0)) == 0


def test_words_keep_their_combining_marks():
    assert lid.text_words("हिन्दी भाषा में लिखा") == ["हिन्दी", "भाषा", "में", "लिखा"]
    assert lid.text_words("ที่นี่ e\u0301te\u0301 x1y_z ½") == ["ที่นี่", "e\u0301te\u0301", "x", "y", "z", "½"]
    assert lid.text_words("\u0301 \u0301a") == ["a"]


def test_indian_scripts_narrow_candidates(spark):
    given = {"hi": "हिन्दी भाषा में लिखा हुआ", "gu": "ગુજરાતી ભાષામાં લખેલું", "te": "తెలుగు భాషలో వ్రాసిన", "kn": "ಕನ್ನಡ ಭಾಷೆಯಲ್ಲಿ", "ml": "മലയാള ഭാഷയിൽ", "th": "ภาษาไทย ที่นี่", "km": "ភាសាខ្មែរ"}
    docs = spark.createDataFrame([(i, t, x) for i in range(4) for x, t in given.items()], "doc_id long, text string, lang string")
    out = lid.label(spark.createDataFrame([(x, t.split()[0]) for x, t in given.items()], "doc_id string, text string"), lid.learn(docs))
    assert {r["doc_id"]: r["lang_pred"] for r in out.collect()} == {x: x for x in given}
    points = [start for start, _ in lid.RANGES]
    assert points == sorted(set(points))


def test_names_of_other_columns_do_not_matter(spark):
    docs = awkward(spark)
    odd = docs.withColumns({"a.b": F.lit(1), "LANG_PRED": F.lit("x"), "__rest": F.lit(2)})
    out = lid.label(odd, lid.learn(docs))
    assert out.columns == [c for c in odd.columns if c not in ("text", "LANG_PRED")] + ["lang_pred", "score", "spans"]
    assert out.count() == docs.count()


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(lid, "LANGUAGES", 3)
    with pytest.raises(ValueError):
        lid.learn(spark.createDataFrame([(i, "some words", f"l{i}") for i in range(5)], "doc_id long, text string, lang string"))


def test_best_path_without_the_best_single_language():
    s = np.array([[0, -20, -9.9], [-20, 0, -9.9]])
    assert lid.viterbi(s, 12.0).tolist() == [0, 1]


def test_rare_languages_are_learned_from_large_tables(spark):
    rows = [(i, "hello world and house", "en") for i in range(3000)] + [(5000 + i, "γεια σου κόσμε", "el") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lid.learn(docs, sample_docs=60)
    out = lid.label(spark.createDataFrame([(1, "house"), (2, "κόσμε σου")], "doc_id long, text string"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in out.collect()} == {1: "en", 2: "el"}


def test_mixed_text_is_labelled_by_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lid.learn(docs)
    take = {r["lang"]: r["text"] for r in docs.filter("n_chars between 800 and 3000 and lang in ('de', 'es')").collect()}
    de, es = (" ".join(take[x].split()[:60]) for x in ("de", "es"))
    mixed = spark.createDataFrame([(1, f"{de}\n{es}")], "doc_id long, text string")
    spans = lid.label(mixed, model).first()["spans"]
    assert {spans[0]["lang"], spans[-1]["lang"]} == {"de", "es"}
    assert sum(s["n_words"] for s in spans) == len(lid.text_words(f"{de}\n{es}"))


def test_scripts_narrow_candidates(spark):
    docs = spark.createDataFrame([(i, t, x) for i in range(6) for t, x in
                                  [("привет мир", "ru"), ("hello world", "en"), ("γεια σου κόσμε", "el")]], "doc_id long, text string, lang string")
    model = lid.learn(docs)
    out = lid.label(spark.createDataFrame([(1, "дом"), (2, "house"), (3, "σπίτι"), (4, "家"), (5, "hello привет мир привет")], "doc_id long, text string"), model)
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["ru", "en", "el"] and got[4]["lang_pred"] in ("ru", "en", "el")
    assert got[5]["lang_pred"] == "ru"


def test_defined_cases(spark):
    docs = awkward(spark)
    got = lid.query(docs)
    assert got.count() == docs.count()
    blank = docs.filter("text is null or trim(text) = '' or text rlike '^[^a-zA-Z]*$'").select("doc_id").na.drop()
    assert {r["lang_pred"] for r in got.join(blank, "doc_id", "left_semi").filter("doc_id < 5").collect()} == {"und"}
    assert lid.query(spark.createDataFrame([], SCHEMA)).collect() == []
    nobody = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in lid.query(nobody).collect()} == {("und", 0.0)}
    assert "k" in lid.label(docs, lid.learn(docs)).columns
