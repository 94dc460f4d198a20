"""Cross-site line dedup in built-in functions only.

One HyperLogLog sketch of sites per line hash is merged by aggregation.  Lines
well above the limit are boilerplate by their estimate; those within the
sketch's error of the limit are counted exactly.  Only line hashes and sites
travel; the documents move once, to meet the positions of their removed lines.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, has_word, lines, normal_line, nullable_key, words, written


def _occurrences(docs: DataFrame, site: str, text: str, doc_id: str) -> DataFrame:
    """One row per line that has a word: its 128-bit key, site, document and place."""
    base = docs.select(nullable_key(F.col(site)).alias("__site"), F.col(doc_id).cast("string").alias("__id"),
                       F.xxhash64(F.col(text)).alias("__th"), F.col(text).alias("__text"))
    each = base.select("__site", "__id", "__th", F.posexplode(lines(F.col("__text"))).alias("__pos", "__line"))
    norm = normal_line(F.col("__line"))
    return each.filter(has_word(F.col("__line"))).withColumn("__norm", norm).select(
        F.xxhash64("__norm").alias("__k1"), F.xxhash64(F.lit("line"), F.col("__norm")).alias("__k2"),
        "__site", "__id", "__th", "__pos")


def boilerplate_occurrences(docs: DataFrame, site: str = "source", text: str = "text", doc_id: str = "doc_id",
                            min_sites: int = 10, lg_k: int = 12) -> DataFrame:
    """Occurrences (``__id``, ``__th``, ``__pos``) of the lines on ``min_sites``
    distinct sites or more, all but the first (by id, text hash, place).

    The sketch error is 1.04 / sqrt(2^lg_k); lines whose estimate is within four
    of it (and within one site) of the limit are decided by an exact count over
    their occurrences."""
    occ = _occurrences(docs, site, text, doc_id)
    sketch = occ.groupBy("__k1", "__k2").agg(
        F.hll_sketch_agg("__site", F.lit(lg_k)).alias("__sk"), F.count(F.lit(1)).alias("__n"),
        F.min(F.struct("__id", "__th", "__pos")).alias("__first"))
    slack = max(1.0, 4 * 1.04 / math.sqrt(2 ** lg_k) * min_sites)
    seen = written(sketch.filter(F.col("__n") >= min_sites)
                   .withColumn("__est", F.hll_sketch_estimate("__sk"))
                   .filter(F.col("__est") >= min_sites - slack)
                   .select("__k1", "__k2", "__first", (F.col("__est") <= min_sites + slack).alias("__near")))
    hits = written(occ.join(broadcast_if_small(seen, 104), ["__k1", "__k2"]))
    near = hits.filter("__near")
    exact = (near.groupBy("__k1", "__k2").agg(F.count_distinct("__site").alias("__sites"))
             .filter(F.col("__sites") >= min_sites).select("__k1", "__k2"))
    found = hits.filter("not __near").unionByName(near.join(exact, ["__k1", "__k2"], "left_semi"))
    return found.filter(F.struct("__id", "__th", "__pos") != F.col("__first")).select("__id", "__th", "__pos")


def line_dedup(docs: DataFrame, site: str = "source", text: str = "text", doc_id: str = "doc_id",
               min_sites: int = 10, lg_k: int = 12) -> DataFrame:
    """Every row of ``docs`` with n_lines, n_removed, n_words_left and clean_text.

    Lines are compared in lower case with blank runs as one space.  A line found
    on ``min_sites`` sites or more is removed wherever it stands but at its first
    occurrence (smallest id, text hash, place), so a text that was copied across
    sites keeps one whole copy.

    Defined cases: null or blank text has no lines and stays as it is; a null
    site is one site; blank lines are never removed; repeated rows (same id and
    text) are one occurrence and are treated alike; an empty table gives an
    empty result; input columns named like an added one are replaced; a very
    long text is one row's array of lines.
    """
    out = (boilerplate_occurrences(docs, site, text, doc_id, min_sites, lg_k)
           .groupBy("__id", "__th").agg(F.collect_set("__pos").alias("__gone"))
           .withColumnsRenamed({"__id": "__id2", "__th": "__th2"}))
    mine = docs.withColumn("__th", F.xxhash64(F.col(text))).withColumn("__id", F.col(doc_id).cast("string"))
    rows = mine.join(out, mine["__id"].eqNullSafe(out["__id2"]) & (mine["__th"] == out["__th2"]), "left")
    t, gone = F.col(text), F.col("__gone")
    left = F.when(gone.isNull(), t).otherwise(
        F.array_join(F.filter(lines(t), lambda x, i: ~F.array_contains(gone, i)), "\n"))
    n_lines = F.size(F.filter(lines(t), has_word)).cast("long")
    return rows.withColumns({
        "n_lines": n_lines, "n_removed": F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long"), "clean_text": left,
    }).withColumn("n_words_left", F.size(words(F.col("clean_text"))).cast("long")).drop(
        "__th", "__id", "__th2", "__id2", "__gone")


def query(docs: DataFrame) -> DataFrame:
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed", "n_words_left", "clean_text")


SQL = r"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, text, coalesce(text, '') t, CASE WHEN source IS NULL THEN '' ELSE '=' || source END site FROM documents),
l AS (SELECT rid, doc_id, site, line, pos, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) bare
  FROM (SELECT rid, doc_id, site, unnest(string_split(t, chr(10))) line, generate_subscripts(string_split(t, chr(10)), 1) pos FROM d)),
n AS (SELECT *, lower(regexp_replace(bare, '[\x20\x09-\x0D]+', ' ', 'g')) nl FROM l WHERE bare <> ''),
b AS (SELECT nl, min((doc_id::VARCHAR, pos)) first_at FROM n GROUP BY 1 HAVING count(DISTINCT site) >= 10),
g AS (SELECT rid, list(pos) gone, count(*) n_removed FROM n JOIN b USING (nl) WHERE (doc_id::VARCHAR, pos) <> first_at GROUP BY 1),
c AS (SELECT rid, count(*) n_lines FROM n GROUP BY 1),
k AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) kept FROM l JOIN g USING (rid) WHERE NOT list_contains(gone, pos) GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT n_lines, coalesce(n_removed, 0)::BIGINT n_removed,
  len(regexp_extract_all(CASE WHEN n_removed IS NULL THEN t ELSE coalesce(kept, '') END, '[^\x20\x09-\x0D]+'))::BIGINT n_words_left,
  CASE WHEN n_removed IS NULL THEN text ELSE coalesce(kept, '') END clean_text
FROM d LEFT JOIN c USING (rid) LEFT JOIN g USING (rid) LEFT JOIN k USING (rid)
"""
