"""Embedding near-dedup by dual traversal of cover trees.

Unit vectors u, v have cosine >= t exactly if |u - v| <= sqrt(2 - 2t).  The upper
levels of the tree are distributed.  A cell, at first a label, that holds more than a
block is split by a net of its own: pivots in farthest-point order over a bounded
sample, until their covering radius is half the cell's.  Each resident moves to the
cell of its nearest pivot and visits later siblings whose covering radius allows a
link; a visitor of the cell goes on to all children it may link with.  So every pair
that may link meets in one cell, once, and the copies of a vector depend on how many
cells lie within the link distance, not on how many there are.  Cells already as
narrow as the link distance are not split further but cut into blocks by hash.

Below, residents and visitors of a cell meet in tasks of two blocks, which build a
cover tree per block (nested levels, halving radii) and walk both at once, dropping
node pairs farther apart than their covering radii plus the link distance.  What
is left is verified by cosine in double precision.  A task returns counts and a
spanning forest: rows as vectors, not as links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_pairs, salted_join
from .common import broadcast_if_small, nullable_key, stored, written
from .links import components, forest

#: Vectors of a block, about; pivots of a cell's net, at most; vectors of the sample it is chosen from, about.
BLOCK, PIVOTS, SAMPLE = 1024, 32, 2048
#: Levels of cells, at most: what is then still larger than a block is cut by hash.
LEVELS = 40
#: Rows of one component that one task names, about.
ROOT_ROWS = 1_000_000
LEAF = 8
_SLACK = 1e-9


class CoverTree:
    """A cover tree over unit vectors: every node's children are a net of its
    members at half its scale that contains its own centre."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.center, self.members, self.radius, self.children = [], [], [], []
        dist = self._dist(0, np.arange(len(x)))
        self._add(0, np.arange(len(x)), dist)
        todo = [(0, 2.0)]
        while todo:
            node, scale = todo.pop()
            mine = self.members[node]
            if len(mine) <= LEAF or self.radius[node] <= 1e-12:
                continue
            while self.radius[node] <= scale / 2:  # levels that would hold one child only
                scale /= 2
            left, kids, center = mine, [], self.center[node]
            while len(left):
                d = self._dist(center, left)
                near = d <= scale / 2
                near[left == center] = True
                kids.append(self._add(center, left[near], d[near]))
                left = left[~near]
                center = left[0] if len(left) else -1
            self.children[node] = np.array(kids)
            todo += [(k, scale / 2) for k in kids]
        self.center, self.radius = np.array(self.center), np.array(self.radius)

    def _dist(self, center: int, others: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * (self.x[others] @ self.x[center])))

    def _add(self, center, members, dist) -> int:
        self.center.append(center)
        self.members.append(members)
        self.radius.append(float(dist.max()))
        self.children.append(None)
        return len(self.center) - 1


def dual_pairs(a: CoverTree, b: CoverTree, reach: float):
    """Arrays (i, j) of member pairs the traversal cannot rule out; for a tree
    against itself each unordered pair once, i < j."""
    same = a is b
    todo = [(0, 0)]
    while todo:
        p, q = todo.pop()
        ka, kb = a.children[p], b.children[q]
        if ka is None and kb is None:
            i, j = np.repeat(a.members[p], len(b.members[q])), np.tile(b.members[q], len(a.members[p]))
            if same and p == q:
                i, j = i[i < j], j[i < j]
            elif same:
                i, j = np.minimum(i, j), np.maximum(i, j)
            yield i, j
            continue
        ka = np.array([p]) if ka is None else ka
        kb = np.array([q]) if kb is None else kb
        for at in range(0, len(ka), 512):
            part = ka[at:at + 512]
            d = np.sqrt(np.maximum(0.0, 2 - 2 * (a.x[a.center[part]] @ b.x[b.center[kb]].T)))
            live = d <= a.radius[part][:, None] + b.radius[kb][None, :] + reach + 1e-7
            if same and p == q:
                live &= part[:, None] <= kb[None, :]
            r, c = np.nonzero(live)
            pa_, qb = part[r], kb[c]
            alone = np.array([len(a.members[k]) == 1 for k in part])[r] & np.array([len(b.members[k]) == 1 for k in kb])[c]
            i, j = a.center[pa_[alone]], b.center[qb[alone]]
            if same:
                i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
            yield i, j
            todo += list(zip(pa_[~alone].tolist(), qb[~alone].tolist()))


def links_between(va: np.ndarray, vb: np.ndarray | None, threshold: float):
    """Index pairs with cosine >= threshold (double precision); ``vb`` None: within ``va``."""
    na = np.linalg.norm(va, axis=1)
    nb = na if vb is None else np.linalg.norm(vb, axis=1)
    ta = CoverTree(va / na[:, None])
    tb = ta if vb is None else CoverTree(vb / nb[:, None])
    wb = va if vb is None else vb
    found, held, n = [], [], 0

    def verify():
        i, j = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        for at in range(0, len(i), 65536):
            x, y = i[at:at + 65536], j[at:at + 65536]
            ok = np.einsum("ij,ij->i", va[x], wb[y]) / (na[x] * nb[y]) >= threshold
            found.append((x[ok], y[ok]))

    for pair in dual_pairs(ta, tb, math.sqrt(max(0.0, 2 - 2 * threshold)) + _SLACK):
        if len(pair[0]):
            held.append(pair)
            n += len(pair[0])
            if n >= 500_000:
                verify()
                held, n = [], 0
    if held:
        verify()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def pivot_net(sample: np.ndarray, k: int) -> np.ndarray:
    """Up to k vectors of the sample in farthest-point order, fewer if half the radius
    around the first is covered before."""
    if not len(sample):
        return sample
    chosen, far = [0], 2 - 2 * sample @ sample[0]
    enough = far.max() / 4  # squared distances
    while len(chosen) < min(k, len(sample)) and (len(chosen) < 2 or far.max() > enough):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, 2 - 2 * sample @ sample[chosen[-1]])
    return sample[chosen]


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.zeros((0, 0))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(column) -> np.ndarray:
    x = _matrix(column)
    return x / np.linalg.norm(x, axis=1)[:, None] if len(x) else x


def _split(cells: DataFrame, large: DataFrame, reach: float, block: int, pivots: int, sample: int, level: int) -> DataFrame:
    """The rows of the children of the cells ``large`` (c2, n, salts), and whether a child
    is ``narrow``: within the link distance as a whole."""
    rows = cells.join(broadcast_if_small(large, 64), F.col("cell") == F.col("c2"))
    steps = 1_000_000
    drawn = rows.filter("home").filter(F.pmod(F.xxhash64(F.lit(level), "node"), F.lit(steps)) < F.ceil(steps * F.lit(sample) / F.col("n")))

    def net(key, table):
        """A cell's pivots, one copy for each of its salts."""
        order = np.argsort(table.column("node").to_numpy())
        # no more children than blocks: where covering radii tell little apart, each child is a copy more
        found = pivot_net(_unit(table.column("emb"))[order], min(pivots, max(2, -(-table.column("n")[0].as_py() // block))))
        salts = table.column("salts")[0].as_py()
        flat = pa.array([found.ravel().tolist()] * salts, pa.list_(pa.float64()))
        return pa.table({"cell": [key[0].as_py()] * salts, "salt": pa.array(range(salts), pa.int64()), "net": flat})

    nets = drawn.select("cell", "node", "emb", "salts", "n").groupBy("cell").applyInArrow(net, "cell string, salt long, net array<double>")
    dealt_rows = rows.select("cell", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), "node", "w", "emb", "home")

    def place(key, table, nets):
        """Distances to the cell's pivots; the nearest is a resident's child.  A cell of which
        nothing was drawn has one child, itself."""
        x = _unit(table.column("emb"))
        if nets.num_rows and len(x):
            p = np.array(nets.column("net")[0].as_py()).reshape(-1, x.shape[1])
            d = np.sqrt(np.maximum(0.0, 2 - 2 * x @ p.T))
        else:
            d = np.full((len(x), 1), 2.0)
        child = np.where(table.column("home").to_numpy(zero_copy_only=False), d.argmin(1) if len(x) else 0, -1)
        return table.drop_columns(["salt"]).append_column("child", pa.array(child, pa.int32())).append_column(
            "far", pa.array(list(d), pa.list_(pa.float64())))

    placed = stored(dealt_rows.groupBy("cell", "salt").cogroup(nets.groupBy("cell", "salt")).applyInArrow(
        place, f"cell string, node long, w long, emb {cells.schema['emb'].dataType.simpleString()}, home boolean, child int, far array<double>"))
    radii = placed.filter("home").groupBy("cell", "child").agg(F.max(F.get("far", F.col("child"))).alias("r")).groupBy(F.col("cell").alias("c2")).agg(
        F.collect_list(F.struct("child", "r")).alias("kids"))  # at most ``pivots`` of a cell
    met = placed.join(broadcast_if_small(stored(radii), 32 + 16 * pivots), F.col("cell") == F.col("c2"))
    # residents visit later siblings only, so that a pair meets once; visitors go on to all
    open_to = F.filter("kids", lambda c: (c["child"] == F.col("child")) | ((~F.col("home") | (c["child"] > F.col("child")))
                                                                            & (F.get("far", c["child"]) <= c["r"] + F.lit(reach))))
    met = met.withColumn("to", F.explode(open_to))
    return met.select(F.concat("cell", F.lit("."), F.col("to.child").cast("string")).alias("cell"), "node", "w", "emb",
                      (F.col("home") & (F.col("to.child") == F.col("child"))).alias("home"), (F.col("to.r") <= reach / 2).alias("narrow"))


def cells_of(reps: DataFrame, reach: float, block: int, pivots: int, sample: int) -> DataFrame:
    """(cell, node, w, emb, home): the rows of all cells that are not split further.  Every
    two vectors of a grp within ``reach`` stand in one cell, once, at least one at home."""
    at = stored(reps.select(F.col("grp").alias("cell"), "node", "w", "emb", F.lit(True).alias("home")))
    leaves = []
    for level in range(LEVELS):
        sizes = at.groupBy(F.col("cell").alias("c2")).agg(F.count_if("home").alias("n"), F.count(F.lit(1)).alias("all"))
        large = stored(sizes.filter(F.col("n") > block).select("c2", "n", F.ceil(F.col("all") / (8 * block)).alias("salts")))
        if not large.head(1):
            break
        leaves.append(at.join(broadcast_if_small(large.select("c2"), 64), F.col("cell") == F.col("c2"), "left_anti"))
        below = stored(_split(at, large, reach, block, pivots, sample, level))
        leaves.append(below.filter("narrow").drop("narrow"))
        at = below.filter("NOT narrow").drop("narrow")
    for leaf in leaves:
        at = at.unionByName(leaf)
    return at


def near_links(reps: DataFrame, threshold: float = 0.98, block: int = BLOCK, pivots: int = PIVOTS,
               sample: int = SAMPLE) -> DataFrame:
    """(node, links, up): per vector and task the weight of what it links to, and
    its place in the task's spanning forest (null: none).  ``reps``: node, grp,
    emb, w; the vectors of a grp have one length and no zero vector."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    reach = math.sqrt(2 - 2 * threshold) + 1e-4
    rows = written(cells_of(reps, reach, block, pivots, sample))
    # residents in blocks 0 to m - 1, visitors in blocks m to m + k - 1
    sizes = rows.groupBy(F.col("cell").alias("c2")).agg(F.ceil(F.count_if("home") / block).alias("m"), F.ceil(F.count_if(~F.col("home")) / (4 * block)).alias("k"))
    met = rows.join(broadcast_if_small(stored(sizes), 64), F.col("cell") == F.col("c2")).filter(F.col("m") > 0)
    own = F.when(F.col("home"), F.pmod(F.xxhash64("node"), F.col("m"))).otherwise(F.col("m") + F.pmod(F.xxhash64("node"), F.greatest("k", F.lit(1))))
    upto = F.when(F.col("home"), F.col("m") + F.col("k")).otherwise(F.col("m")) - 1
    met = met.withColumn("mine", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), upto)))
    met = met.select(F.col("cell").alias("grp"), F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
                     F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "w", "emb")

    def join(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        alone = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        node, w, x = table.column("node").to_numpy(), table.column("w").to_numpy(), _matrix(table.column("emb"))
        left = np.arange(len(node)) if alone else np.flatnonzero(side == 0)
        right = left if alone else np.flatnonzero(side == 1)
        links, up = np.zeros(len(node), np.int64), {}
        if len(left) and len(right):
            i, j = links_between(x[left], None if alone else x[right], threshold)
            i, j = left[i], right[j]
            np.add.at(links, i, w[j])
            np.add.at(links, j, w[i])
            up = dict(zip(*(v.tolist() for v in forest(node[i], node[j]))))
        out = links > 0
        return pa.table({"node": node[out], "links": links[out], "up": pa.array([up.get(v) for v in node[out].tolist()], pa.int64())})

    return met.groupBy("grp", "a", "b").applyInArrow(join, "node long, links long, up long")


def embedding_dedup(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = 0.98, **sizes) -> DataFrame:
    """Every row of ``vectors`` with n_links, component_id and kept.

    Equal vectors of a label are one node with a weight, so a vector held by a
    third of all rows is compared once.  Defined cases: a null label, or a
    vector that is null, empty, zero or holds null or non-finite components,
    links with nothing; vectors of different length do not link; repeated rows
    are vectors of their own that link with each other; a null id never names a
    component unless all its ids are null; an empty table gives an empty result;
    input columns named like an added one are replaced.  Nodes are named by a
    64-bit hash of label and vector.
    """
    e = F.col(embedding)
    whole = F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    length = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    ok = F.col(label).isNotNull() & whole & (F.coalesce(length, F.lit(0.0)) > 0)
    grp = F.concat_ws("|", F.size(e).cast("string"), nullable_key(F.col(label)))
    slim = vectors.withColumn("__node", F.when(ok, F.xxhash64(grp, e)))
    reps = written(slim.filter("__node is not null").groupBy(F.col("__node").alias("node")).agg(
        F.first(grp).alias("grp"), F.first(e).alias("emb"), F.count(F.lit(1)).alias("w"), F.min(vec_id).alias("low")))
    found = written(near_links(reps.select("node", "grp", "emb", "w"), threshold, **sizes))
    sums = found.groupBy(F.col("node").alias("n2")).agg(F.sum("links").alias("links"))
    roots = components(found.filter("up is not null"), "node", "up").withColumnsRenamed({"node": "n3"})
    each = reps.select("node", "w", "low").join(sums, F.col("node") == F.col("n2"), "left").join(roots, F.col("node") == F.col("n3"), "left")
    each = each.select("node", "low", F.coalesce("root", "node").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("__links"))
    each = written(each)
    lows = each.groupBy("root").agg(F.min("low").alias("__low"))
    # a component may hold a third of all vectors: a hot root is cut
    each = salted_join(each, lows, "root", hot=hot_pairs(each, lows, "root", ROOT_ROWS)).select(F.col("node").alias("__n4"), "__links", "__low")
    rows = slim.join(each, F.col("__node") == F.col("__n4"), "left")
    component = F.when(F.col("__n4").isNull(), F.col(vec_id)).otherwise(F.col("__low"))
    return rows.withColumns({"n_links": F.coalesce("__links", F.lit(0)).cast("long"), "component_id": component}).withColumn(
        "kept", F.col(vec_id).eqNullSafe(F.col("component_id"))).drop("__node", "__n4", "__links", "__low")


def query(vectors: DataFrame) -> DataFrame:
    return embedding_dedup(vectors).select("vec_id", "n_links", "component_id", "kept")


SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id a, b.vec_id b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a vec_id, min(b) component_id FROM reach GROUP BY 1),
n AS (SELECT a vec_id, count(*) n_links FROM link GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::BIGINT n_links, component_id, vec_id = component_id kept
FROM v JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
