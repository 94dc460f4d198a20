"""Awkward documents, DuckDB over a frame, and row comparison."""

import math
import random

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, n_words string, kept string, ids int, size string"
NOTICE = "Licensed under the Apache License, Version 2.0."
SHARED = "subscribe to our news letter and never miss a thing again"


def awkward_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing columns."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [None, "", " \t\r\n\x0b\x0c ", "\n\n", "one", "a b c", "#*$%&|<> x", "é́ﬁ ñandú 日本語 🙂🏽\x00 end",
             "  x\u0085y", "MIT License mit license MIT", "CC-BY cc by", NOTICE, "  lead\n\ntail  ",
             prose(3) + " " + prose(12) + "\n" + NOTICE, prose(40) * 2, "x" * 50_000, prose(20_000)]
    base = prose(60)
    texts += [base, base, base + " extra", "z " + base]
    lines = [prose(9) for _ in range(5)]
    for i in range(60):
        texts.append("\n".join([prose(14), SHARED if i % 2 else prose(6), *rng.sample(lines, 2), prose(11), lines[i % 5] if i % 7 == 0 else "."]))
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, rng.choice(["en", "fr", None]), None if i % 17 == 3 else f"s{i % 13}", None if i % 11 == 0 else len(t or ""), 7, "w", None, i, "x"))
    rows += [rows[17], rows[17], rows[30], (None, prose(30), "en", "s1", 1, 1, "w", "y", 1, "x"), (None, None, None, None, None, None, None, None, None, None)]
    return rows


def awkward(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA).repartition(3)


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=str)


def rows_of(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def by_sql(df, name, sql, path):
    """The rows of a DuckDB statement over the frame as table ``name``."""
    df.write.mode("overwrite").parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = con.execute(sql)
    return table([d[0] for d in found.description], found.fetchall())
