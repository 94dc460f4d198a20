"""Source divergence audit: how far the word use of sources of one language lies apart.

Terms are counted per (language, source) in tasks that combine as they go.  The
kept vocabulary of a language is reordered so that equal counts stand together:
by the counts in its largest sources, then by the total.  In that order a
source's column of counts is a few long runs.  Each column is run-length encoded
in segments of places; a pair of columns meets segment by segment, where the
boundaries of both are intersected and every |p - q| is multiplied by the length
of its run.  Sources meet in blocks, so a task holds two blocks of runs whatever
the number of sources.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import maybe_broadcast
from ..operators.keys import assign_dense_key
from .common import broadcast_if_small, dealt, stored

MIN_DOCS = 30
SMOOTH = 5
SCALE = 10**9
TOP = 50
#: Sources whose counts the vocabulary is ordered by, places in a segment, and sources in a block.
LEADERS = 8
SEGMENT = 1 << 16
BLOCK = 64
#: Entries and bytes of terms that a task holds before it hands its counts on.
HELD, HELD_BYTES = 400_000, 64 << 20
#: Every byte outside of terms becomes a blank; only A-Z are lower-cased.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of A-Z, a-z and all that is not ASCII."""
    return text.translate(_BYTES).split()


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of rows (lang, source, text), one row per term and group."""

    def tally(batches):
        number, present, held, fresh = defaultdict(Counter), defaultdict(Counter), 0, 0

        def flush():
            for (lang, source), found in number.items():
                keys = list(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()),
                     pa.array(keys, pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64()),
                     pa.array(list(map(present[lang, source].__getitem__, keys)), pa.int64())], ["lang", "source", "term", "n", "docs"])
            number.clear()
            present.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                key, cut = (lang.as_py(), source.as_py()), terms(text.as_py())
                if not cut:
                    continue
                own, once, known = number[key], set(cut), len(number[key])
                own.update(cut)
                present[key].update(once)
                held += len(own) - known
                fresh += sum(map(len, once)) if len(own) > known else 0
                if held > HELD or fresh > HELD_BYTES:
                    yield from flush()
                    held = fresh = 0
        yield from flush()

    rows = docs.select("lang", "source", F.encode("text", "utf-8").alias("text")).filter(F.octet_length("text") > 0)
    return rows.mapInArrow(tally, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n, total, v) -> np.ndarray:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * v)) by long division, three digits at
    a time: exact in 64 bits up to 9 * 10^15 terms of a group."""
    rest, by = np.asarray(n, np.int64) + SMOOTH, np.int64(total + SMOOTH * v)
    out = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // by
        rest = rest % by
    return out + 1


def probability_column(n: Column, total: Column, v: Column) -> Column:
    """The same as a column, in decimals."""
    wide = lambda c: c.cast("decimal(19,0)")
    a, b = wide(F.lit(SCALE).cast("decimal(10,0)")) * wide(n + SMOOTH), wide(total + SMOOTH * v)
    return F.call_function("div", a, b) + 1


def runs(columns: DataFrame) -> DataFrame:
    """Rows (g, seg, place, n, total, v) of one source's counts each, places within the
    segment: (g, seg, starts, p), a row per source and segment that holds a term of it.
    ``starts`` and ``p`` are the first places and probabilities of its runs, those of count 0 included."""

    def encode(batches):
        held, key = [], None

        def close():
            place, n = (np.concatenate(x) for x in zip(*[(h[0], h[1]) for h in held]))
            total, v = held[0][2], held[0][3]
            size = min(SEGMENT, v - key[1] * SEGMENT)
            full = np.zeros(size, np.int64)
            full[place] = n
            starts = np.flatnonzero(np.r_[True, full[1:] != full[:-1]])
            p = probability(full[starts], total, v)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                 pa.array([starts.astype(np.int32)], pa.list_(pa.int32())), pa.array([p.astype(np.int32)], pa.list_(pa.int32()))],
                ["g", "seg", "starts", "p"])

        for batch in batches:
            if not batch.num_rows:
                continue
            g, seg, place, n, total, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (seg[1:] != seg[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(g)]):
                at = (int(g[a]), int(seg[a]))
                if key is not None and at != key:
                    yield close()
                    held = []
                key = at
                held.append((place[a:b].copy(), n[a:b].copy(), int(total[a]), int(v[a])))
        if held:
            yield close()

    rows = columns.select("g", "seg", "place", "n", "total", "v")
    return dealt(rows, "g", "seg").sortWithinPartitions("g", "seg").mapInArrow(encode, "g long, seg long, starts array<int>, p array<int>")


def distance(starts_a: np.ndarray, p: np.ndarray, starts_b: np.ndarray, q: np.ndarray, size: int) -> int:
    """The sum of |p - q| over ``size`` places of two run-length encoded columns."""
    at = np.union1d(starts_a, starts_b)
    gap = np.abs(p[np.searchsorted(starts_a, at, "right") - 1] - q[np.searchsorted(starts_b, at, "right") - 1])
    return int((gap * np.diff(np.r_[at, size])).sum())


def _block_pairs(key, table):
    """All pairs between the sources of two blocks (of one, if both are the same), in one segment."""
    i, j, size = key[2].as_py(), key[3].as_py(), table.column("size")[0].as_py()
    member = sorted(zip(table.column("block").to_pylist(), table.column("source").to_pylist(),
                        [np.asarray(x.values, np.int64) for x in table.column("starts")], [np.asarray(x.values, np.int64) for x in table.column("p")]),
                    key=lambda m: (m[0], m[1].encode()))
    first = [m for m in member if m[0] == i]
    second = [m for m in member if m[0] == j]
    out = [(a[1], b[1], distance(a[2], a[3], b[2], b[3], size) if size else 0)
           for x, a in enumerate(first) for b in (first[x + 1:] if i == j else second)]
    return pa.table([pa.array([key[0].as_py()] * len(out), pa.string()), pa.array([o[0] for o in out], pa.string()),
                     pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.int64())], ["lang", "a", "b", "value"])


def _tables(docs: DataFrame, lang: str, source: str, text: str, min_docs: int):
    """The written tables all parts read: ``columns`` (lang, source, term, place, n, n_lang) of
    kept terms and ``groups`` (lang, source, g, g_lang, groups, total, v, total_lang)."""
    none = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = docs.select(none(lang).alias("lang"), none(source).alias("source"), none(text).alias("text"))
    found = stored(counted(docs))
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    largest = Window.partitionBy("lang").orderBy(F.desc("size"), "source")
    leaders = stored(sizes.withColumn("lead", F.row_number().over(largest)).filter(F.col("lead") <= LEADERS).drop("size"))
    led = found.join(broadcast_if_small(leaders, 256), ["lang", "source"], "left")
    signature = [F.coalesce(F.max(F.when(F.col("lead") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(1, LEADERS + 1)]
    vocabulary = led.groupBy("lang", "term").agg(*signature, F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    ordered = assign_dense_key(vocabulary, ["lang", *[f"c{k}" for k in range(1, LEADERS + 1)], "n_lang", "term"], "key", ties="none")
    words = ordered.df.select("lang", "term", "key", "n_lang")
    languages = stored(words.groupBy("lang").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang")))
    languages_ = broadcast_if_small(languages, 128)
    columns = stored(found.drop("docs").join(maybe_broadcast(words, ordered.data_bytes), ["lang", "term"]).join(languages_, "lang").select(
        "lang", "source", "term", (F.col("key") - F.col("first")).alias("place"), "n", "n_lang"), found)
    totals = columns.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = assign_dense_key(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left"), ["lang", "source"], "g", ties="none").df
    own = groups.groupBy("lang").agg(F.min("g").alias("first_g"), F.count(F.lit(1)).alias("groups"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = groups.join(broadcast_if_small(stored(own), 128), "lang").join(languages_, "lang", "left").select(
        "lang", "source", "g", (F.col("g") - F.col("first_g")).alias("g_lang"), "groups", zero("total"), zero("v"), zero("total_lang"))
    return columns, stored(groups)


def pair_values(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, a before b."""
    here = broadcast_if_small(groups.select("lang", "source", "g", "total", "v"), 256)
    encoded = runs(columns.join(here, ["lang", "source"]).select(
        "g", F.floor(F.col("place") / SEGMENT).alias("seg"), F.pmod("place", F.lit(SEGMENT)).alias("place"), "n", "total", "v"))
    last = F.greatest(F.ceil(F.col("v") / SEGMENT), F.lit(1)) - 1
    every = groups.withColumn("seg", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # a source without a term in a segment is one run of count 0
    by = F.greatest(F.col("total") + SMOOTH * F.col("v"), F.lit(SMOOTH))  # without a kept term, any
    nothing = F.array(probability_column(F.lit(0), by, F.lit(0)).cast("int"))
    block, blocks = F.floor(F.col("g_lang") / BLOCK), F.ceil(F.col("groups") / BLOCK)
    rows = every.join(encoded, ["g", "seg"], "left").select(
        "lang", "source", "seg", F.least(F.lit(SEGMENT), F.col("v") - F.col("seg") * SEGMENT).alias("size"), block.alias("block"),
        F.coalesce("starts", F.array(F.lit(0))).alias("starts"), F.coalesce("p", nothing).alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    sums = rows.groupBy("lang", "seg", "i", "j").applyInArrow(_block_pairs, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of two parts.

    ``pair``: for every other source of the language the sum of |p - q| over its
    kept terms, all ranks.  ``term``: the ``top`` terms a source uses more than
    its language does, by p - q.

    Defined cases: null text, lang or source is ''; a group without a term has
    p = that of count 0 throughout and takes part in all pairs; a language
    without a kept term has pairs of value 0 and no terms; equal values rank by
    item in UTF-8 order; repeated rows count as often as they stand; very long
    texts are counted whole; an empty table gives no row; other columns are not
    read, whatever their names.
    """
    columns, groups = _tables(docs, lang, source, text, min_docs)
    pairs = pair_values(columns, groups)
    both = pairs.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("s"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = both.select("lang", "s.source", "s.item", "value").withColumn("rank", F.row_number().over(by_value)).withColumn("part", F.lit("pair"))
    here = broadcast_if_small(groups.select("lang", "source", "total", "v", "total_lang"), 256)
    p = probability_column(F.col("n"), F.col("total"), F.col("v"))
    q = probability_column(F.col("n_lang"), F.col("total_lang"), F.col("v"))
    more = columns.join(here, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).filter(F.col("value") > 0)
    term = more.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    order = ["lang", "source", "part", "item", "value", "rank"]
    return pair.select(*order).unionByName(term.select(*order))


def query(docs: DataFrame) -> DataFrame:
    return divergence(docs)


SQL = r"""
WITH d AS (SELECT coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') text, row_number() OVER () r FROM documents),
w AS (SELECT lang, source, r, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') term FROM d),
v AS (SELECT lang, term, count(*) n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) n FROM w SEMI JOIN v USING (lang, term) GROUP BY 1, 2, 3),
l AS (SELECT lang, count(*) v, sum(n) total FROM v GROUP BY 1),
t AS (SELECT lang, source, sum(n) total FROM c GROUP BY 1, 2),
a AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) n,
  1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(t.total, 0) + 5 * l.v) p, 1 + 1000000000::HUGEINT * (v.n + 5) // (l.total + 5 * l.v) q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
pair AS (SELECT x.lang, x.source, 'pair' part, y.source item, coalesce(s.value, 0)::BIGINT AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source != y.source
  LEFT JOIN (SELECT m.lang, m.source, o.source other, sum(abs(m.p - o.p)) AS value FROM a m JOIN a o ON m.lang = o.lang AND m.term = o.term
    GROUP BY 1, 2, 3) s ON s.lang = x.lang AND s.source = x.source AND s.other = y.source),
f AS (SELECT * FROM pair UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM a WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM f)
SELECT * FROM o WHERE part = 'pair' OR rank <= 50
"""
