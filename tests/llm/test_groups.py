"""SimHash groups, embedding groups and repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import embedding_dedup as emb
from starloom.llm import links
from starloom.llm import simhash_dedup as sim
from starloom.llm import suffix_dedup as suf

from .helpers import awkward, rows_of, SCHEMA


def closure(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(999, 500 + i) for i in range(50)]
    want = closure(1000, pairs)
    got = {r["node"]: r["root"] for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert set(got) == {x for p in pairs if p[0] != p[1] for x in p}
    assert all(want[k] == v for k, v in got.items())
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_spans():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    x, y = links.forest(a, b)
    want = closure(200, list(zip(a.tolist(), b.tolist())))
    assert closure(200, list(zip(x.tolist(), y.tolist()))) == want
    assert len(x) == len(set(x.tolist()))


def brute_simhash(rows, distance=4):
    import re

    import xxhash

    def fp(t):
        t = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        ones = [0] * 64
        for x in sh:
            h = xxhash.xxh64_intdigest(x.encode(), 42)
            for b in range(64):
                ones[b] += h >> b & 1
        return sum(1 << b for b in range(64) if 2 * ones[b] > len(sh))

    f = [fp(t) for _, t in rows]
    root = closure(len(f), [(i, j) for i in range(len(f)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= distance])
    low = {}
    for (k, _), r in zip(rows, root):
        if k is not None:
            low[r] = min(low.get(r, k), k)
    return sorted(((k, f"{x:016x}", low.get(r)) for (k, _), x, r in zip(rows, f, root)), key=str)


def test_simhash_against_brute_force(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 60_000]
    words = [f"w{i}" for i in range(400)]
    rng = random.Random(9)
    for g in range(6):  # near copies: a few words changed
        base = [rng.choice(words) for _ in range(300)]
        for i in range(12):
            w = list(base)
            w[rng.randrange(300)] = f"x{i}"
            rows.append((1000 * (g + 1) + i, " ".join(w).upper() if i % 2 else "  ".join(w)))
    got = sorted(map(tuple, sim.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_simhash(rows)


@pytest.mark.parametrize("parts,distance", [(4, 4), (4, 2), (5, 6), (6, 4), (3, 4)])
def test_probing_finds_every_link(spark, monkeypatch, parts, distance):
    monkeypatch.setattr(sim, "BLOCK", 16)  # hot values in blocks
    rng = np.random.default_rng(parts)
    seeds = rng.integers(0, 2**63, 30, dtype=np.uint64)
    f = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(20):  # chains around a seed, half of them beyond the distance
            x = s
            for b in rng.integers(0, 64, rng.integers(1, 2 * distance)).tolist():
                x ^= 1 << b
            f.add(x)
    f |= {0xFFFF000000000000 + i for i in range(120)}  # all share three partitions
    f = np.array(sorted(f), np.uint64)
    want = closure(len(f), [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= distance)])
    signed = f.view(np.int64).tolist()
    place = {x: i for i, x in enumerate(signed)}
    found = sim.similar_links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), distance, parts).collect()
    assert closure(len(f), [(place[r["a"]], place[r["b"]]) for r in found]) == want


def test_thresholds_sum_to_the_budget():
    rng = np.random.default_rng(0)
    values = [rng.integers(0, 16, 50) for _ in range(4)]
    expected = [[rng.integers(0, 100, 16).astype(float) * (t + 1) for t in range(4)] for _ in range(4)]
    sizes = [[1, 5, 11, 15]] * 4
    chosen = np.stack(sim.allocate(values, expected, sizes, 1))
    assert (chosen.sum(0) == 1).all() and chosen.min() >= -1
    price = lambda i, t, v: 0 if t < 0 else expected[i][t][v] + sizes[i][t]
    from itertools import product
    for k in range(50):
        best = min(sum(price(i, t, values[i][k]) for i, t in enumerate(ts)) for ts in product(range(-1, 4), repeat=4) if sum(ts) == 1)
        assert sum(price(i, int(chosen[i, k]), values[i][k]) for i in range(4)) == best


def test_keep_one(spark):
    docs = awkward(spark)
    kept = sim.keep_one(docs)
    assert kept.columns == docs.columns
    groups = sim.simhash_groups(docs.select("doc_id", "text"))
    assert kept.count() == groups.select("__root").distinct().count()
    odd = docs.withColumns({"a.b": F.lit(1), "__row": F.lit("x"), "FINGERPRINT": F.lit(2), "node": F.lit(3)})
    assert rows_of(sim.keep_one(odd).select(*docs.columns)) == rows_of(kept) and sim.keep_one(odd).columns == odd.columns


def test_documents_move_once(spark):
    """keep_one: one shuffle of the texts, combined before it; the kept keys come to it."""
    plan = sim.keep_one(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("__row") and sum("Exchange hashpartitioning(__id" in line for line in plan.splitlines()) == 2
    assert "partial_first(__row" in plan


def test_a_hot_component_is_cut(spark, monkeypatch):
    """Many fingerprints of one component: its root is dealt out, names stay the same."""
    rows = [(i, " ".join(["same words again and again"] * 12 + [f"tail {i}"])) for i in range(300)] + [(900, "quite another text " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = rows_of(sim.query(docs))
    monkeypatch.setattr(sim, "ROOT_ROWS", 1)
    assert rows_of(sim.query(docs)) == want
    assert sim.query(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_vectors(rows, t=0.98):
    rows = [(*r, n) for n, r in enumerate(rows)]  # repeated rows are rows of their own
    ok = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    n = {r[3]: 0 for r in ok}
    pairs = []
    for i, a in enumerate(ok):
        for j in range(i):
            b = ok[j]
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float32(a[1]).astype(float), np.float32(b[1]).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= t:
                    pairs.append((i, j))
                    n[a[3]] += 1
                    n[b[3]] += 1
    root = closure(len(ok), pairs)
    low = {}
    for r, c in zip(ok, root):
        if r[0] is not None:
            low[c] = min(low.get(c, r[0]), r[0])
    comp = {r[3]: low.get(c) for r, c in zip(ok, root)}
    return sorted(((r[0], n.get(r[3], 0), comp.get(r[3], r[0])) for r in rows), key=str)


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for lab in (1, 2, None):
        for _ in range(12):
            c = rng.normal(size=16)
            for _ in range(rng.integers(1, 12)):
                rows.append((k, [float(np.float32(x)) for x in c + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.12])], lab))
                k += 1
    nan, inf = float("nan"), float("inf")
    rows += [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [nan] + [1.0] * 15, 1), (9003, [inf] + [1.0] * 15, 1),
             (9004, [None] + [1.0] * 15, 1), (9005, [1.0, 0.0], 1), (9006, [2.0, 0.0], 1), (9007, [], 1), (None, [1.0, 0.001], 1)]
    return rows + [rows[0], rows[0]]


@pytest.mark.parametrize("sizes", [{}, {"block": 8, "pivots": 5}, {"block": 3, "pivots": 2}])
def test_embeddings_against_brute_force(spark, sizes):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, node string, w int").repartition(4)
    out = emb.embedding_dedup(df, **sizes)
    assert {"node", "w"} <= set(out.columns)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()), key=str) == brute_vectors(rows)
    assert out.filter("kept <> (vec_id <=> component_id)").count() == 0


def _reps(spark, x, labels):
    rows = [(i, f"g{g}", [float(v) for v in row], 1) for i, (row, g) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "node long, grp string, emb array<float>, w long").repartition(4)


@pytest.mark.parametrize("kind", ["uniform", "clustered"])
def test_copies_of_a_vector_do_not_grow(spark, kind):
    """Cells of halving radius: four times the vectors make four times the cells, not four times the copies."""
    rng, reach, copies = np.random.default_rng(8), 0.2, []
    for n in (600, 2400):
        if kind == "uniform":
            x = rng.normal(size=(n, 3))
        else:
            x = rng.normal(size=(n // 30, 16))[rng.integers(0, n // 30, n)] + rng.normal(size=(n, 16)) * 0.03
        x /= np.linalg.norm(x, axis=1)[:, None]
        rows = emb.cells_of(_reps(spark, x, [0] * n), reach, block=40, pivots=8, sample=128).select("cell", "node", "home").collect()
        copies.append(len(rows) / n)
        home = {r["node"]: r["cell"] for r in rows if r["home"]}
        assert sorted(home) == list(range(n)) and len(rows) - len(home) == sum(not r["home"] for r in rows)
        if n == 600:  # every near pair stands in one cell, once
            at = {}
            for r in rows:
                at.setdefault(r["cell"], []).append((r["node"], r["home"]))
            met = [(min(a, b), max(a, b)) for c in at.values() for i, (a, h) in enumerate(c) for b, g in c[:i] if h or g]
            assert len(met) == len(set(met))
            d = np.linalg.norm(x[:, None] - x[None], axis=2)
            assert {(int(a), int(b)) for a, b in np.argwhere(d <= reach) if a < b} <= set(met)
    assert copies[1] < (1.5 if kind == "clustered" else 2.2) * copies[0]


def test_labels_of_mixed_lengths_have_cells_of_their_own(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in rng.normal(size=d)], 1) for i, d in enumerate([3] * 60 + [5] * 60)]
    rows += [(1000 + i, r[1], 1) for i, r in enumerate(rows[::7])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = emb.embedding_dedup(df, block=10, pivots=4, sample=50)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()), key=str) == brute_vectors(rows)


def test_cover_tree_invariants():
    rng = np.random.default_rng(5)
    x = np.concatenate([c + rng.normal(size=(30, 8)) * 0.05 for c in rng.normal(size=(10, 8))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = emb.CoverTree(x)
    for node, kids in enumerate(tree.children):
        d = np.linalg.norm(x[tree.members[node]] - x[tree.center[node]], axis=1)
        assert d.max() <= tree.radius[node] + 1e-7
        if kids is not None:
            assert tree.center[node] in tree.center[kids]  # nested
            assert sorted(np.concatenate([tree.members[k] for k in kids])) == sorted(tree.members[node])
    seen = [p for i, j in emb.dual_pairs(tree, tree, 0.2) for p in zip(i.tolist(), j.tolist())]
    assert len(seen) == len(set(seen)) and all(a < b for a, b in seen)
    near = {(a, b) for a in range(300) for b in range(a + 1, 300) if np.linalg.norm(x[a] - x[b]) <= 0.2}
    assert near <= set(seen)


def test_embeddings_empty(spark):
    assert emb.query(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
    only = spark.createDataFrame([(1, None, None)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in emb.query(only).collect()] == [(1, 0, 1, True)]


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(400):
        s = [rng.randint(1, rng.choice([1, 2, 3, 10])) for _ in range(rng.randint(0, 60))]
        assert suf.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def brute_repeats(rows, length=200):
    raw = [(t or "").encode() for _, t in rows]
    count = {}
    for x in raw:
        for i in range(len(x) - length + 1):
            w = x[i:i + length]
            count[w] = count.get(w, 0) + 1
    out = []
    for (k, _), x in zip(rows, raw):
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if count[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(1 for i in range(len(x)) if gone[i] and not (i and gone[i - 1]))
        out.append((k, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [1000, 4])
def test_repeats_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suf, "CLASS", most)  # 4: large classes are cut down
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh \n") for _ in range(900))
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).select("doc_id", "text").collect()
            if len(r["text"] or "") < 3000]
    rows += [(1000 + i, t) for i, t in enumerate([
        base, base, base[100:700] + "x" * 10, "y" + base[50:249], "z" + base[50:250], "w" + base[50:251], "a" * 1000,
        "ab" * 300, "q" * 199, "r" * 200, "r" * 201, "é" * 250, base[:450] + "#" + base[451:]])]
    rows += [(2000 + i, f"{i:06d}" * rng.randint(1, 9) + base[200:200 + rng.randint(150, 420)] + f"{i * 7919}" * rng.randint(1, 40)) for i in range(150)]
    df = spark.createDataFrame([(k, t, "u", 1) for k, t in rows], "doc_id long, text string, k string, gone int").repartition(3)
    got = suf.suffix_dedup(df)
    assert {"k", "gone"} <= set(got.columns)
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)


def test_repeats_empty(spark):
    assert suf.query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeats_in_very_long_texts(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop \n") for _ in range(n))
    a, b = text(400_000), text(90_000)
    rows = [(1, a + b[:700] + a[5_000:5_200]), (2, b), (3, a[250_000:250_199]), (None, b[40_000:40_260])]
    got = {r["doc_id"]: r for r in suf.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_removed"], got[1]["n_spans"]) == (700 + 200 + 200, 2)
    assert (got[2]["n_removed"], got[2]["n_spans"]) == (700 + 260, 2)
    assert (got[3]["n_removed"], got[None]["n_removed"]) == (0, 260)
    assert bytes(got[2]["kept"]) == (b[700:40_000] + b[40_260:]).encode()


def test_simhash_thresholds_reach_a_large_distance(spark):
    rng = random.Random(3)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(20)]
    pairs = [(x, x ^ sum(1 << b for b in rng.sample(range(64), 16))) for x in base]
    fps = {signed(x) for p in pairs for x in p}
    found = sim.similar_links(spark.createDataFrame([(x,) for x in fps], "fp long"), distance=16).collect()
    got = {frozenset((r["a"], r["b"])) for r in found}
    assert {frozenset((signed(x), signed(y))) for x, y in pairs} <= got
