"""Documents with inferred, drifting schema: kinds, the lattice, and what is rescued."""

import pytest

from starloom.sources import drift_report, scan_documents

TEXTS = ['{"id":1,"a":"x","s":2}', '{"id":2,"s":"7","b":[1,2]}', '{"id":3.5,"s":null,"o":{"p":1}}', "[1]", '{"id":', None,
         '{"id":99999999999999999999,"s":1.5,"a":true}', "null", "{}", '{"a":1e300}', '{"n":null,"x.y":5}']


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(t,) for t in texts], "body string").repartition(3)


def test_drift_report(spark):
    out = {(r["field"], r["kind"]): (r["documents"], r["merged"]) for r in drift_report(docs(spark), "body").collect()}
    assert out[None, "MALFORMED"] == (4, "MALFORMED")
    assert out["id", "BIGINT"] == (2, "DECIMAL") and out["id", "DECIMAL"] == (2, "DECIMAL")
    assert {out["s", k] for k in ("BIGINT", "DECIMAL", "STRING", "VOID")} == {(1, "STRING")}
    assert out["a", "DOUBLE"] == (1, "STRING") and out["b", "ARRAY"] == (1, "ARRAY") and out["o", "OBJECT"] == (1, "OBJECT")
    assert out["n", "VOID"] == (1, "VOID") and out["x.y", "BIGINT"] == (1, "BIGINT")
    assert drift_report(docs(spark, []), "body").count() == 0


def test_scan_rescues_what_does_not_fit(spark):
    rows = scan_documents(docs(spark), "body", "id long, a string, s double").collect()
    out = {(r["id"], r["a"], r["s"], tuple(sorted((r["_rescued"] or {}).items())), r["_malformed"]) for r in rows}
    assert len(rows) == len(TEXTS) and out == {
        (1, "x", 2.0, (), None), (2, None, None, (("b", "[1,2]"), ("s", '"7"')), None), (None, None, None, (("id", "3.5"), ("o", '{"p":1}')), None),
        (None, None, None, (), "[1]"), (None, None, None, (), '{"id":'), (None, None, None, (), None), (None, None, None, (), "null"),
        (None, None, 1.5, (("a", "true"), ("id", "99999999999999999999")), None), (None, None, None, (("a", "1.0E300"),), None),
        (None, None, None, (("n", "null"), ("x.y", "5")), None)}
    small = scan_documents(docs(spark, ['{"s":5}', '{"s":3000000000}']), "body", "s int").collect()
    assert {(r["s"], (r["_rescued"] or {}).get("s")) for r in small} == {(5, None), (None, "3000000000")}
    with pytest.raises(ValueError):
        scan_documents(docs(spark), "body", "a array<int>")


def test_scan_is_one_projection(spark):
    plan = scan_documents(docs(spark), "body", "id long, s double")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the test's own repartition
