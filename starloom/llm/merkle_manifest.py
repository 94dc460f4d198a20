"""Merkle dataset manifest: a digest tree over the documents, with a witness per document.

The leaves of a source are appended in order to a stream.  Every level of the
tree keeps one open run of up to ``FAN`` subtrees; a subtree that joins a run
takes the siblings before it as a partial witness, and each sibling completed
later extends the witnesses of those before it.  A full run closes into its
parent, which is appended one level up.

The stream is cut at multiples of ``FAN ** LEVELS`` leaves.  Blocks so aligned
are whole subtrees, so tasks build them independently and their roots are
further appends, of a stream that is ``FAN ** LEVELS`` times shorter.  The roots of the
sources are the leaves of the last tree.  On the way down each block gets the
witness of its root as one row of the block's own stream; a document's witness
is its own within the block and then the block's.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, dealt, nullable_key, stored
from ..operators.keys import assign_dense_key

FAN = 16
LEVELS = 3
#: Rows of a block's answer that are handed on at once.
ROWS = 256
_STEP = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the value's length in bytes, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def fold(node: Column, witness: Column) -> Column:
    """The root that a leaf's digest and its witness give."""
    return F.aggregate(witness, node, lambda at, step: digest(step["left"], at, step["right"]))


def witness_digest(witness: Column) -> Column:
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


class Appender:
    """A tree that grows by appended subtrees, with the witnesses of all it holds.

    ``levels`` fixes the height (an aligned block of a larger tree); without it
    the height is what the number of leaves needs."""

    def __init__(self, levels: int | None = None):
        self.levels = levels
        self.open: list[list[list]] = []  # per level the subtrees of the open run: [digest, left, right, parent]
        self.leaves: list[list] = []

    def append(self, node: str, level: int = 0, under: list | None = None) -> None:
        if len(self.open) == level:
            self.open.append([])
        run = self.open[level]
        subtree = [node, "".join(s[0] for s in run), [], None]
        for s in run:  # the sibling that is now complete extends the witnesses before it
            s[2].append(node)
        for s in under or ():
            s[3] = subtree
        run.append(subtree)
        if not level:
            self.leaves.append(subtree)
        if len(run) == FAN and level != self.levels:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.append(sha256("".join(s[0] for s in run).encode()).hexdigest(), level + 1, run)

    def close(self) -> str:
        """Close the open runs up to the root and return it."""
        level = 0
        while True:
            run, above = self.open[level], self.open[level + 1:]
            last = level == self.levels if self.levels is not None else len(run) == 1 and not any(above)
            if last:
                return run[0][0]
            if run:
                self._close(level)
            level += 1

    def witness(self, i: int) -> list[dict]:
        """Of a leaf, once the tree is closed: its siblings to the left and right, level by level."""
        out, at = [], self.leaves[i]
        while at[3] is not None:
            out.append({"left": at[1], "right": "".join(at[2])})
            at = at[3]
        return out


def _blocks(rows: DataFrame, witnesses: bool) -> DataFrame:
    """Rows (tree, n, pos, node, above, payload) dealt out by block and streamed through an :class:`Appender`.

    A row with pos null carries in ``above`` the witness of its block's root.
    Gives (tree, n, pos, node), a row per block with its root as a leaf of the next tree, or with
    ``witnesses`` (tree, pos, node, witness, payload), a row per leaf."""
    by, given = FAN ** LEVELS, rows.schema["payload"].dataType.simpleString()

    def stream(batches):
        key, held, above, n, kind = None, [], [], 0, None

        def close():
            # a tree of more than one block has whole blocks of equal height
            grown = Appender(LEVELS if n > by else None)
            for _, node, _ in held:
                grown.append(node)
            root = grown.close()
            if not witnesses:
                yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([-(-n // by)], pa.int64()),
                                                  pa.array([key[1]], pa.int64()), pa.array([root])], ["tree", "n", "pos", "node"])
                return
            for i in range(0, len(held), ROWS):
                pos, node, load = zip(*held[i:i + ROWS])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * len(pos), pa.string()), pa.array(pos, pa.int64()), pa.array(node, pa.string()),
                     pa.array([grown.witness(i + k) + above for k in range(len(pos))], pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
                     pa.array(load, kind)], ["tree", "pos", "node", "witness", "payload"])

        for batch in batches:
            kind = batch.schema.field("payload").type
            for tree, block, size, pos, node, up, load in zip(*[c.to_pylist() for c in batch.columns]):
                if (tree, block) != key:
                    if held:
                        yield from close()
                    key, held, above = (tree, block), [], []
                if pos is None:
                    above = up
                else:
                    held.append((pos, node, load))
                    n = size
        if held:
            yield from close()

    at = F.coalesce("pos", "of") if "of" in rows.columns else F.col("pos")
    rows = rows.select("tree", F.floor(at / by).cast("long").alias("block"), "n", "pos", "node", "above", "payload")
    ordered = dealt(rows, "tree", "block").sortWithinPartitions("tree", "block", F.col("pos").asc_nulls_first())
    return ordered.mapInArrow(stream, f"tree string, pos long, node string, witness array<{_STEP}>, payload {given}" if witnesses
                              else "tree string, n long, pos long, node string")


def climb(leaves: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """From written (tree, n, pos, node), n leaves a tree at places from 0: the roots (tree, node) and the
    aligned nodes that :func:`witnesses` goes down again, the leaves first."""
    levels, roots = [leaves], None
    while True:
        up = stored(_blocks(levels[-1].withColumns({"above": F.lit(None).cast(f"array<{_STEP}>"), "payload": F.lit(None).cast("int")}), False))
        done = up.filter(F.col("n") == 1).select("tree", "node")
        roots = done if roots is None else roots.unionByName(done)
        levels.append(up.filter(F.col("n") > 1))
        if not levels[-1].head(1):
            return roots, levels[:-1]


def witnesses(levels: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """(tree, pos, node, witness, payload) of the leaves of :func:`climb`, whose first level may have a
    payload; ``above`` (tree, above) gives the witnesses of the trees' roots."""
    by, found = FAN ** LEVELS, None
    for i in reversed(range(len(levels))):
        rows = levels[i] if "payload" in levels[i].columns else levels[i].withColumn("payload", F.lit(None).cast("int"))
        rows = rows.withColumns({"above": F.lit(None).cast(f"array<{_STEP}>"), "of": F.col("pos")})
        # a block's first row: the witness of its root, its own tree's or that from above the tree
        if found is not None:
            rows = rows.unionByName(found.select("tree", (F.col("pos") * by).alias("of"), F.col("witness").alias("above")), allowMissingColumns=True)
        if above is not None:
            ends = levels[i].filter((F.col("pos") == 0) & (F.col("n") <= by)).select("tree")
            rows = rows.unionByName(above.join(ends, "tree").select("tree", F.lit(0).cast("long").alias("of"), "above"), allowMissingColumns=True)
        found = _blocks(rows, True)
        if i:
            found = stored(found.select("tree", "pos", "witness"))
    return found


def manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", lang: str = "lang", n_chars: str = "n_chars",
             text: str = "text", carry: Column | None = None) -> DataFrame:
    """Rows (doc_id, source, leaf, subroot, root, witness[, carry]), one per document.

    ``witness``: per level from the leaf to the root the digests of the run's
    other members, those before and those after, joined; ``fold(leaf, witness)``
    is the root.  ``carry`` is a value per document that comes with it.

    Defined cases: a null field is ``-`` in the leaf; null sources are one source,
    the first; a null doc_id comes first in its source; documents of one source
    and id follow their leaves, so repeated rows are neighbours, each a leaf of its
    own; a lone document is its source's root, and a lone source's root is the
    root; very long texts are hashed whole; an empty table gives no row; other
    columns are not read, whatever their names.
    """
    c = lambda name: F.col(f"`{name}`")
    own = [c(doc_id).alias("doc_id"), c(source).alias("source"), nullable_key(c(source)).alias("tree"),
           leaf(c(doc_id), c(source), c(lang), c(n_chars), c(text)).alias("node")]
    # rows tied on source, id and leaf are alike in all that is hashed
    ordered = assign_dense_key(docs.select(*own, *([] if carry is None else [carry.alias("carry")])), ["tree", "doc_id", "node"], "key").df
    trees = assign_dense_key(ordered.groupBy("tree").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")), ["tree"], "place", ties="none")
    leaves = stored(ordered.join(broadcast_if_small(trees.df.drop("place"), 96), "tree").withColumn("pos", F.col("key") - F.col("first")).drop("key", "first"))
    roots, levels = climb(leaves.select("tree", "n", "pos", "node"))
    # the sources' roots are the leaves of one more tree
    places = trees.df.select(F.col("tree").alias("payload"), F.col("place").alias("pos"), F.lit(trees.rows).cast("long").alias("n"))
    subroots = stored(places.join(roots.withColumnRenamed("tree", "payload"), "payload").withColumn("tree", F.lit("")))
    top, upper = climb(subroots.drop("payload"))
    last = top.first()  # one row
    root = F.lit(last["node"] if last else None).cast("string")
    led = stored(witnesses([subroots, *upper[1:]]).select(F.col("payload").alias("tree"), F.col("node").alias("subroot"), F.col("witness").alias("above")))
    load = [x for x in leaves.columns if x not in ("tree", "n", "pos", "node")]
    laden = leaves.join(broadcast_if_small(led.select("tree", "subroot"), 160), "tree").select(
        "tree", "n", "pos", "node", F.struct(*load, "subroot").alias("payload"))
    found = witnesses([laden, *levels[1:]], led.select("tree", "above"))
    return found.select("payload.doc_id", "payload.source", F.col("node").alias("leaf"), "payload.subroot", root.alias("root"), "witness",
                        *([] if carry is None else ["payload.carry"]))


def tampered(text: Column) -> Column:
    """The text with A-Z lower-cased."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def query(docs: DataFrame) -> DataFrame:
    c = [F.col(x) for x in ("doc_id", "source", "lang", "n_chars")]
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    now = F.when(changed, leaf(*c, tampered(F.col("text"))))
    rows = manifest(docs, carry=now)
    rows = rows.withColumn("folded_root", fold(F.coalesce("carry", "leaf"), F.col("witness")))
    return rows.select("doc_id", "leaf", "subroot", "root", witness_digest(F.col("witness")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


SQL = r"""
WITH RECURSIVE e AS (SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') head, text,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 5 = 0 changed FROM documents),
h AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) leaf,
  CASE WHEN changed THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END now FROM e),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 place, count(*) n FROM h GROUP BY 1),
l AS (SELECT doc_id, leaf, coalesce(now, leaf) now, place, n, row_number() OVER (PARTITION BY place ORDER BY doc_id NULLS FIRST, leaf) - 1 pos,
  row_number() OVER () r FROM h JOIN s ON h.source IS NOT DISTINCT FROM s.source),
t AS (SELECT 0 lvl, place tree, pos, n, leaf node FROM l UNION ALL
  SELECT lvl + 1, tree, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lvl, tree, pos // 16, n),
u AS (SELECT 0 lvl, tree pos, (SELECT count(*) FROM s) n, node FROM t WHERE n = 1 UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 16, n),
a AS (SELECT * FROM t UNION ALL SELECT lvl, -1, pos, n, node FROM u),
w AS (SELECT x.lvl, x.tree, x.pos, coalesce(string_agg(y.node, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') l,
  coalesce(string_agg(y.node, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') r
  FROM a x JOIN a y ON x.lvl = y.lvl AND x.tree = y.tree AND x.pos // 16 = y.pos // 16 WHERE x.n > 1 GROUP BY 1, 2, 3),
f AS (SELECT r, place, n, 0 lvl, pos, now node, '' proof FROM l UNION ALL
  SELECT f.r, place, (n + 15) // 16, f.lvl + 1, f.pos // 16, sha256(w.l || node || w.r), proof || w.l || w.r
  FROM f JOIN w ON w.tree = place AND w.lvl = f.lvl AND w.pos = f.pos),
g AS (SELECT r, (SELECT count(*) FROM s) n, 0 lvl, place pos, node, proof FROM f WHERE n = 1 UNION ALL
  SELECT g.r, (n + 15) // 16, g.lvl + 1, g.pos // 16, sha256(w.l || node || w.r), proof || w.l || w.r
  FROM g JOIN w ON w.tree = -1 AND w.lvl = g.lvl AND w.pos = g.pos)
SELECT doc_id, leaf, t.node subroot, u.node root, sha256(proof) proof_sha256, g.node folded_root, g.node = u.node verified
FROM l JOIN g ON l.r = g.r AND g.n = 1 JOIN t ON t.tree = l.place AND t.n = 1 JOIN u ON u.n = 1
"""
