"""License scan, quality rules, line dedup and mixing against their SQL."""

import pytest

from starloom.llm import license_scan, line_dedup, mixing, quality_rules

from .helpers import SF, SCHEMA, awkward, awkward_rows, by_sql, rows_of

CASES = [(license_scan.query, license_scan.sql()), (quality_rules.query, quality_rules.SQL),
         (line_dedup.query, line_dedup.SQL), (mixing.query, mixing.SQL)]
NAMES = ["license", "quality", "lines", "mixing"]
#: Rows whose id and text both repeat share what the SQL, row by row, gives to one of them.
ONCE = {"lines"}


@pytest.mark.parametrize("case", range(4), ids=NAMES)
def test_given_table(spark, tmp_path, case):
    query, sql = CASES[case]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(query(docs)) == by_sql(docs, "documents", sql, str(tmp_path / "d"))


@pytest.mark.parametrize("case", range(4), ids=NAMES)
def test_awkward_rows(spark, tmp_path, case):
    query, sql = CASES[case]
    rows = awkward_rows()
    if NAMES[case] in ONCE:
        rows = list(dict.fromkeys(rows))
    docs = awkward(spark, rows)
    assert rows_of(query(docs)) == by_sql(docs, "documents", sql, str(tmp_path / "d"))


@pytest.mark.parametrize("case", range(4), ids=NAMES)
def test_empty_table(spark, case):
    empty = spark.createDataFrame([], SCHEMA)
    assert CASES[case][0](empty).collect() == []


@pytest.mark.parametrize("operator", [license_scan.license_scan, quality_rules.quality_rules, line_dedup.line_dedup, mixing.mix],
                         ids=NAMES)
def test_other_columns_pass(spark, operator):
    docs = awkward(spark)
    out = operator(docs)
    assert out.count() == docs.count()
    assert {"doc_id", "text", "lang", "k", "ids"} <= set(out.columns)
    assert len({c.lower() for c in out.columns}) == len(out.columns)


def test_line_dedup_keeps_the_first(spark):
    rows = [(i, f"alone {i}\nsame line everywhere\nend {i}", f"s{i}") for i in range(12)]
    out = {r["doc_id"]: r["clean_text"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0] == rows[0][1]
    assert all(out[i] == f"alone {i}\nend {i}" for i in range(1, 12))


def test_line_dedup_limit_is_exact(spark):
    rows = [(1000 * n + i, f"line on {n} sites", f"s{i}") for n in range(5, 16) for i in range(n)]
    out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r["doc_id"] // 1000 for r in out.filter("n_removed > 0").collect()} == set(range(10, 16))


def test_license_filters_lose_nothing(spark):
    """Blocks at, above and below the threshold of a template."""
    words = license_scan._template_words(license_scan.TEMPLATES[2][1])
    rows = [(n, " ".join(words[:n])) for n in range(len(words) + 1)]
    out = license_scan.block_matches(spark.createDataFrame(rows, "doc_id long, text string")).filter("label = 'bsd-3-clause'").collect()
    need = -(-8 * len(words) // 10)
    assert sorted(int(r["__id"]) for r in out) == list(range(need, len(words) + 1))


WRAPPED = {
    "mit": """Some project (c) 2020

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction""",
    "bsd-3-clause": """All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "apache-2.0": """ * Licensed to someone; you may not use this file
 * except in compliance with the License. You may
 * obtain a copy of the License
 * at""",
    "mpl-2.0": "This Source Code Form is subject\nto the terms of\nthe Mozilla\nPublic License, v.\n2.0. If a copy",
}


def test_wrapped_notices_are_found(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(WRAPPED.values())]
    rows += [(100 + i, t.replace("\n", "\n\n")) for i, t in enumerate(WRAPPED.values())]  # no run crosses an empty line
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.query(docs).collect()}
    for i, label in enumerate(WRAPPED):
        assert out[i][0] == label and out[i][1] >= 0.8 and out[100 + i] == ("", 0.0)
    assert rows_of(license_scan.query(docs)) == by_sql(docs, "documents", license_scan.sql(), str(tmp_path / "d"))


def test_a_notice_over_many_short_lines_is_found(spark, tmp_path):
    """However narrow the column: a notice of one or two words a line."""
    rows = []
    for i, (label, notice, _) in enumerate(license_scan.TEMPLATES):
        ws = notice.split()
        rows += [(10 * i, "\n".join(ws), label), (10 * i + 1, "\n".join(" ".join(ws[k:k + 2]) for k in range(0, len(ws), 2)), label)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    found = license_scan.block_matches(docs).select("__id", "label").distinct().collect()
    assert {(str(i), label) for i, _, label in rows} <= {tuple(r) for r in found}
    assert rows_of(license_scan.query(docs)) == by_sql(docs, "documents", license_scan.sql(), str(tmp_path / "d"))


def test_wrapped_notices_of_given_templates_are_found(spark):
    """Runs are as wide as the words of a notice are by the rule for texts, not by its
    blanks, and its letters are those of a text that holds it."""
    notices = (("hyphens", "non-exclusive/royalty-free/world-wide sub-license/re-use/re-distribution of the so-called data-base-rights", "royalty free"),
               ("accents", "Œuvre placée sous la licence de l'État, Établie par l'Équipe", "État Œuvre"),
               ("any", "all rights of copying are waived by its author", ""))
    rows = []
    for i, (label, notice, _) in enumerate(notices):
        apart = notice.replace("-", "\n").replace("/", "\n").replace(" ", "\n")
        rows += [(10 * i, notice, label), (10 * i + 1, notice.replace(" ", "\n"), label), (10 * i + 2, f"before\n{apart}\nafter", label)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    found = license_scan.block_matches(docs, templates=notices).filter("containment = 1").select("__id", "label").distinct().collect()
    assert {tuple(r) for r in found} >= {(str(i), label) for i, _, label in rows}


def test_a_notice_needs_its_own_words(spark):
    rows = [(0, "Released under the Apache License"), (1, "Licensed under CC BY 4.0"), (2, "This work is licensed under the GNU General Public License, version 2"),
            (3, "Released under the MIT License")]
    out = {r["doc_id"]: r["labels"] for r in license_scan.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {0: "apache", 1: "cc-by", 2: "gpl", 3: "mit"}


def test_quality_depleted_and_host_limits(spark):
    common = " ".join(f"c{j}" for j in range(30))
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(i, f"{own(i)}\n{common}", "a") for i in range(30)] + [(100, common, "a"), (101, f"{common}\nshort {own(7)[:20]}", "a")]
    rows += [(200 + i, f"{own(i)} {i}\n{common}", "b") for i in range(5)]  # too few documents for a limit
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[0]["n_removed_lines"] == 0 and out[0]["kept"]  # the first holder
    assert all(out[i]["clean_text"] == own(i) and out[i]["kept"] for i in range(1, 30))
    assert not out[100]["kept"] and not out[101]["kept"]
    assert all(out[200 + i]["n_removed_lines"] == 0 and out[200 + i]["kept"] for i in range(5))


def _boilerplate_of_a_large_host(spark, n_lines):
    """400 documents of a host; each of its lines stands in 20 of them, 5 %, and one line in 9."""
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(40 + 4 * n_lines // 20))
    rows = []
    for i in range(400):
        shared = [f"Shared  line {k}" for k in range(n_lines) if k % 20 == i % 20]
        rows.append((i, "\n".join([own(i), *shared, *(["line of nine"] if i < 9 else [])]), "big" if i % 400 else None))
    rows += [(None, rows[30][1], "big"), rows[41], rows[41]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("n_lines", [40, 400], ids=["short lists", "long lists"])
def test_quality_count_does_not_grow_with_the_host(spark, n_lines):
    rows, docs = _boilerplate_of_a_large_host(spark, n_lines)
    out = quality_rules.quality_rules(docs).collect()
    assert len(out) == len(rows)
    first = {}  # the smallest id, as text
    for i, text, source in rows:
        for x in text.split("\n")[1:]:
            first[source, x] = min(first.get((source, x), "~"), "~" if i is None else str(i))
    for r in out:
        me = str(r["doc_id"])
        kept = [x for k, x in enumerate(r["text"].split("\n"))
                if not k or x == "line of nine" or r["source"] is None or first[r["source"], x] == me]
        assert r["clean_text"] == "\n".join(kept)
        assert r["n_removed_lines"] == len(r["text"].split("\n")) - len(kept)
    assert sum(r["n_removed_lines"] for r in out) > 300


def test_pipeline_strips_large_hosts(spark):
    import corpus_pipeline

    rows, docs = _boilerplate_of_a_large_host(spark, 40)
    docs = docs.selectExpr("*", "cast(length(text) as long) n_chars", "'en' lang")
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    assert sum("Shared  line" in x for x in out.values()) <= 41


def test_mix_meets_budgets(spark):
    rows = [(i, "w " * (1 + i % 50), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    by = {r["source"]: r for r in mixed.groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"}).collect()}
    total = sum(1 + i % 50 for i in range(3000))
    assert abs(sum(r["max(target)"] for r in by.values()) - min(total, 3 * total)) < 1e-6 * total
    for r in by.values():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 0.5
        assert r["max(target)"] <= 3 * r["max(source_size)"]
    assert mixed.filter("taken > 3 * size").count() == 0
    # the copies hold exactly the words taken
    made = mixing.copies(mixed)
    words = made.selectExpr("size(regexp_extract_all(text, '([^ ]+)', 1)) n").agg({"n": "sum"}).first()[0]
    assert words == sum(r["sum(taken)"] for r in by.values())
    assert rows_of(mixing.query(docs)) == rows_of(mixing.query(docs.repartition(7)))


def test_mix_shares_a_cut_among_copies(spark):
    rows = [(1, "a b c d", "x")] * 10 + [(2, "e " * 100, "y")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = [r["taken"] for r in out if r["source"] == "x"]
    assert len(set(taken)) == 1 and abs(sum(taken) - out[0]["target"] if out[0]["source"] == "x" else 0) <= 10 * 4
