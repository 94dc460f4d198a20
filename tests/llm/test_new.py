"""Quality classifier, Merkle manifest and source divergence: SQL, brute force, planted and awkward cases."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import merkle_manifest as mm
from starloom.llm import quality_classifier as qc
from starloom.llm import source_divergence as sd
from starloom.llm.common import read

from .helpers import SCHEMA, SF, awkward, awkward_rows, by_sql, rows_of, table

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


# Merkle manifest

def own_leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grown(nodes, fan=16):
    """(root, siblings before and after per level of every leaf) of a plain tree."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for leaf, k in enumerate(at):
            run, j = runs[k // fan], k % fan
            proofs[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            at[leaf] = k // fan
        nodes = [H(*run) for run in runs]
    return nodes[0], proofs


def plain_manifest(rows):
    by = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        by[source].append((doc_id is not None, doc_id or 0, own_leaf(doc_id, source, lang, n_chars, text), doc_id, (source, lang, n_chars, text)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grown([leaf[2] for leaf in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    root, above = grown([trees[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above):
        for leaf, proof in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1]):
            doc_id, (source, lang, n_chars, text), path = leaf[3], leaf[4], proof + up
            now = leaf[2]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                now = own_leaf(doc_id, source, lang, n_chars, text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
            for a, b in path:
                now = H(a, now, b)
            out.append((doc_id, leaf[2], trees[s][0], root, H(*[a + b for a, b in path]), now, now == root))
    return out


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_is_the_plain_tree(spark, monkeypatch, levels):
    """Blocks of one level are cut and joined over several rounds; the tree is the same."""
    monkeypatch.setattr(mm, "LEVELS", levels)
    docs = awkward(spark)
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in awkward_rows()]
    rows += [(1000 + i, f"Text {i}", "en", "hot", i) for i in range(700)] + [(5000 + i, "Same", None, f"one{i}", None) for i in range(40)]
    more = spark.createDataFrame([(*r, 7, "w", None, 1, "x") for r in rows[len(awkward_rows()):]], SCHEMA)
    found = mm.query(docs.unionByName(more))
    assert rows_of(found) == table(MANIFEST, plain_manifest(rows))


def test_manifest_equals_sql(spark, tmp_path):
    docs = awkward(spark).unionByName(awkward(spark).withColumn("doc_id", F.col("doc_id") + 200))
    assert rows_of(mm.query(docs)) == by_sql(docs, "documents", mm.SQL, str(tmp_path / "d"))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 700, 4096])
def test_appended_witnesses_fold_to_the_root(n):
    tree, nodes = mm.Appender(), [H(str(i)) for i in range(n)]
    for node in nodes:
        tree.append(node)
    root = tree.close()
    assert root == grown(nodes)[0]
    for i in (0, n // 2, n - 1):
        at = nodes[i]
        for step in tree.witness(i):
            at = H(step["left"], at, step["right"])
        assert at == root


def test_manifest_of_nothing_and_of_one(spark):
    assert mm.query(awkward(spark, [])).collect() == []
    one = mm.query(awkward(spark, awkward_rows()[4:5])).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == H()


def test_manifest_does_not_read_other_columns(spark):
    docs = awkward(spark)
    odd = docs.withColumns({"a.b": F.lit(1), "NODE": F.lit("x"), "payload": F.lit(2), "key": F.lit(3), "tree": F.lit(4)})
    assert rows_of(mm.query(odd)) == rows_of(mm.query(docs))


# Source divergence

def plain_divergence(rows, min_docs, top=50):
    import re

    word = re.compile(rb"[A-Za-z\x80-\xff]+")
    cut = [(r[2] or "", r[3] or "", [w.lower() for w in word.findall((r[1] or "").encode())]) for r in rows]
    out = []
    for lang in {c[0] for c in cut}:
        mine = [c for c in cut if c[0] == lang]
        held = Counter(w for c in mine for w in set(c[2]))
        kept = {w for w, n in held.items() if n >= min_docs}
        counts = {s: Counter(w for c in mine if c[1] == s for w in c[2] if w in kept) for s in {c[1] for c in mine}}
        whole = sum(counts.values(), Counter())
        p = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        of, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pair = sorted([(-sum(abs(of[s][w] - of[o][w]) for w in kept), o.encode()) for o in counts if o != s])
            term = sorted([(q[w] - of[s][w], w) for w in kept if counts[s][w] and of[s][w] > q[w]])[:top]
            for part, items in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(items, 1)]
    return out


ORDER = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("segment, block", [(1 << 16, 64), (7, 3)])
def test_divergence_is_that_of_whole_columns(spark, monkeypatch, segment, block):
    """Small segments and blocks cut every column and every set of sources."""
    monkeypatch.setattr(sd, "SEGMENT", segment)
    monkeypatch.setattr(sd, "BLOCK", block)
    monkeypatch.setattr(sd, "HELD", 50)
    rows = awkward_rows()
    found = sd.divergence(awkward(spark, rows), min_docs=3, top=5)
    assert rows_of(found) == table(ORDER, plain_divergence(rows, 3, 5))


def test_divergence_equals_sql(spark, tmp_path):
    docs = read(spark, SF, "documents")
    want = by_sql(docs, "documents", sd.SQL, str(tmp_path / "d"))
    assert any(r[2] == "term" for r in want) and rows_of(sd.query(docs)) == want


def test_divergence_of_awkward_tables(spark):
    docs = awkward(spark)
    odd = docs.withColumns({"a.b": F.lit(1), "g": F.lit("x"), "term": F.lit(2), "n": F.lit(3)})
    assert rows_of(sd.divergence(odd, min_docs=2)) == rows_of(sd.divergence(docs, min_docs=2))
    assert sd.query(awkward(spark, [])).collect() == []
    # no term is kept: pairs of value 0, ranked by name
    few = rows_of(sd.query(awkward(spark, awkward_rows()[:4])).filter("part = 'pair'"))
    assert few and all(r[5] == 0 for r in few)


def test_long_division_is_exact():
    n = np.array([0, 1, 7, 10**6, 8 * 10**15 - 5])
    total, v = 8 * 10**15, 11
    assert sd.probability(n, total, v).tolist() == [1 + 10**9 * (int(x) + 5) // (total + 5 * v) for x in n]


# Quality classifier

def test_held_out_accuracy_and_prior(spark):
    docs, labels = read(spark, SF.replace("0.001", "0.01"), "documents"), read(spark, SF.replace("0.001", "0.01"), "labels")
    rows = qc.query(docs, labels).join(labels, "doc_id").toPandas()
    assert rows["score"].between(0, 1).all()
    held = rows[rows["held_out"]]
    assert len(held) > 50 and set(held["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5)) == {0}
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert (held[held["quality"] == 1]["predicted"] == 1).mean() > 0.97
    assert ((held["score"] >= 0.3) == (held["predicted"] == 1)).all()


def test_labels_of_held_out_documents_change_nothing(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    assert rows_of(qc.query(docs, labels)) == rows_of(qc.query(other, turned))


def two_samples(rng, prior, n=3000):
    """Positives high in one statistic, negatives low; two others are noise."""
    def draw(k, shift):
        stats = rng.normal(size=(k, len(qc.STATISTICS)))
        stats[:, 0] += shift
        stats[:, 3:] = 0
        return stats

    none = lambda s: qc.Samples(s, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    bad = int(n * (1 - prior))
    return none(draw(n, 4)), none(np.concatenate([draw(n - bad, 4), draw(bad, -4)])), none(draw(n, -4))


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_is_found_and_negatives_are_told(prior):
    positive, unlabelled, negative = two_samples(np.random.default_rng(1), prior)
    model = qc.train(positive, unlabelled)
    assert abs(model.prior - prior) < 0.07
    good, bad = model.score(model.raw(positive)), model.score(model.raw(negative))
    assert (good[:, None] > bad[None]).mean() > 0.95 and (bad < 0.3).mean() > 0.75 and (good >= 0.3).mean() > 0.75


def test_risk_gradient():
    rng = np.random.default_rng(2)
    z_p, z_u, prior, e = rng.normal(size=9), rng.normal(size=8), 0.4, 1e-6
    g_p, g_u = qc.risk_weights(z_p, z_u, prior)
    assert np.logaddexp(0, z_u).mean() > prior * np.logaddexp(0, z_p).mean()
    for k in range(8):
        up = np.eye(8)[k] * e
        assert abs((qc.risk(z_p, z_u + up, prior) - qc.risk(z_p, z_u - up, prior)) / (2 * e) - g_u[k]) < 1e-6
        up = np.eye(9)[k] * e
        assert abs((qc.risk(z_p + up, z_u, prior) - qc.risk(z_p - up, z_u, prior)) / (2 * e) - g_p[k]) < 1e-6


def test_classifier_on_awkward_tables(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 70, 2)] + [(4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = qc.query(docs, labels)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"] and rows.count() == docs.count()
    assert rows.filter("score is null or isnan(score) or score < 0 or score > 1").count() == 0
    assert qc.query(awkward(spark, []), labels).collect() == []
    assert {r["score"] for r in qc.query(docs, labels.limit(0)).collect()} == {0.5}
    model = qc.learn(docs, labels)
    odd = docs.withColumns({"a.b": F.lit(1), "SCORE": F.lit("old"), "__rest": F.lit(2)})
    found = qc.score(odd, model)
    assert found.columns == [c for c in odd.columns if c not in ("text", "SCORE")] + ["score"]
    assert table(["score"], [(r["score"],) for r in found.collect()]) == table(["score"], [(r["score"],) for r in qc.score(docs, model).collect()])
