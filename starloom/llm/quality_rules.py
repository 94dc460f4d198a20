"""Quality rules with cross-document line frequency, in built-in functions only.

The normalised lines of every document are hashed and the distinct documents
counted per host and line (distinct texts: exact copies count once).  The
occurrences then meet the lines over the limit by host and line, each document
gets the hashes of the lines it loses, and one projection over the documents works
out the rules, the text without those lines and the verdict.  The limit is a count
that does not grow with the host, so the lines of a host are no short list, and
there is one way at every size: all joins are by equal keys, on hashes but for the
last, which brings the documents their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import maybe_broadcast
from .common import BLANK_RUN, has_word, let, lines, normal_line, nullable_key, words, written

WINDOW = 8


def _repeat_positions(hashes: Column) -> Column:
    """Ascending starts of the windows whose hash occurs twice or more."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        n = F.size(s)
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        again = F.filter(F.sequence(F.lit(0), n - 1),
                         lambda j: ((j > 0) & same(j, j - 1)) | ((j < n - 1) & same(j, j + 1)))
        return F.array_sort(F.transform(again, lambda j: F.get(s, j)["i"]))

    return let(ordered, twice)


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word windows that occur twice or more in the list."""

    def covered(p: Column) -> Column:
        n = F.size(p)
        steps = F.zip_with(F.slice(p, 2, n - 1), F.slice(p, 1, n - 1), lambda b, a: F.least(b - a, F.lit(window)))
        return F.aggregate(steps, F.lit(window), lambda acc, x: acc + x).cast("long")

    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
        found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                    .otherwise(let(_repeat_positions(h), covered)))
        return F.when(n <= window, F.lit(0).cast("long")).otherwise(found)

    return let(word_list, of)


def document_signals(text: Column) -> dict[str, Column]:
    """The per-document counts of the base rules, as columns of one projection."""
    body = F.coalesce(text, F.lit(""))
    worded = let(F.filter(lines(text), has_word), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    both = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    return {
        "_words": both,
        "word_chars": F.char_length(F.regexp_replace(body, BLANK_RUN, "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": worded,
    }


def _line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def _line_hashes(docs: DataFrame, host: str, text: str, doc_id: str) -> DataFrame:
    """One row per document and distinct line that has a word."""
    base = docs.select(nullable_key(F.col(host)).alias("__host"), F.xxhash64(F.col(text)).alias("__th"),
                       F.col(doc_id).cast("string").alias("__id"), F.col(text).alias("__text"))
    return base.select("__host", "__th", "__id", F.explode(F.array_distinct(
        F.transform(F.filter(lines(F.col("__text")), has_word), _line_hash))).alias("__h"))


def frequent_lines(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id",
                   max_share: float = 0.0, min_docs: int = 10) -> DataFrame:
    """Per host (``__host``) its lines (``__h``) held by at least ``min_docs``
    distinct documents and, if asked, over ``max_share`` of them; ``__first`` is the smallest
    (doc_id, text hash) that has the line."""
    first = F.min(F.struct("__id", "__th"))
    # once per distinct text, then per line: both steps combine before they shuffle
    once = _line_hashes(docs, host, text, doc_id).groupBy("__host", "__h", "__th").agg(F.min("__id").alias("__id"))
    counts = once.groupBy("__host", "__h").agg(F.count(F.lit(1)).alias("__n"), first.alias("__first"))
    counts = counts.filter(F.col("__n") >= min_docs)
    if max_share > 0:
        hosts = (docs.select(nullable_key(F.col(host)).alias("__host2"), F.xxhash64(F.col(text)).alias("__th")).distinct()
                 .groupBy("__host2").agg(F.count(F.lit(1)).alias("__all")))
        counts = counts.join(hosts, counts["__host"] == hosts["__host2"]).filter(F.col("__n") > max_share * F.col("__all"))
    return counts.select("__host", "__h", "__first")


def _with_own_lines(docs: DataFrame, over: DataFrame, n: int, host: str, text: str, doc_id: str) -> DataFrame:
    """``docs`` with the array ``__over`` of the line hashes that they lose."""
    over = maybe_broadcast(over.withColumnsRenamed({"__host": "__host2", "__h": "__h2"}), n * 120)
    each = _line_hashes(docs, host, text, doc_id)
    hits = each.join(over, (each["__host"] == over["__host2"]) & (each["__h"] == over["__h2"])).filter(
        ~F.col("__first").eqNullSafe(F.struct("__id", "__th")))
    hits = hits.groupBy("__host", "__id", "__th").agg(F.collect_set("__h").alias("__over")).withColumnsRenamed(
        {"__host": "__key2", "__id": "__id2", "__th": "__th2"})
    mine = docs.withColumns({"__key": nullable_key(F.col(host)), "__id": F.col(doc_id).cast("string"), "__th": F.xxhash64(F.col(text))})
    return mine.join(hits, (mine["__key"] == hits["__key2"]) & mine["__id"].eqNullSafe(hits["__id2"]) & (mine["__th"] == hits["__th2"]),
                     "left").drop("__key", "__id", "__th", "__key2", "__id2", "__th2")


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id",
                  max_share: float = 0.0, min_docs: int = 10, max_removed: float = 0.5,
                  min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Every row of ``docs`` with the rule signals, the cleaned text and a verdict.

    Added columns (an input column of the same name is replaced): n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_lines, n_removed_words, clean_text, kept.

    A line over its host's limits (see :func:`frequent_lines`) is removed from
    every document of the host but the first that holds it.  The limit is
    ``min_docs`` alone and does not grow with the host, unless ``max_share`` asks
    for a share besides, under which large hosts keep boilerplate.  A document is
    depleted if over ``max_removed`` of its words went that way; ``kept`` is
    false for it and for a base failure.

    Defined cases: a null or blank text has no words and fails the base rule;
    its ``clean_text`` is the text as given.  A null host is a host of its own.
    Repeated rows are judged alike (one text counts as one document per host).
    Ties for the first holder fall to the smallest text hash.  An empty table
    gives an empty result.  One very long text is one row's arrays.
    """
    over = written(frequent_lines(docs, host, text, doc_id, max_share, min_docs))
    rows = _with_own_lines(docs, over, over.count(), host, text, doc_id)
    t = F.col(text)

    def strip(over_me: Column) -> Column:
        gone = lambda l: has_word(l) & F.array_contains(over_me, _line_hash(l))  # noqa: E731,E741
        return let(lines(t), lambda all_lines: let(
            F.filter(all_lines, gone), lambda out: F.struct(
                F.size(out).cast("long").alias("lines"),
                F.aggregate(out, F.lit(0).cast("long"), lambda acc, l: acc + F.size(words(l))).alias("words"),  # noqa: E741
                F.when(F.size(out) == 0, t).otherwise(
                    F.array_join(F.filter(all_lines, lambda l: ~gone(l)), "\n")).alias("text"))))  # noqa: E741

    kept_all = F.struct(F.lit(0).cast("long").alias("lines"), F.lit(0).cast("long").alias("words"), t.alias("text"))
    sig = document_signals(t)
    rows = rows.withColumns({"__w": sig.pop("_words"), "__s": F.when(F.col("__over").isNull(), kept_all)
                             .otherwise(strip(F.col("__over"))), **sig})
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = rows.withColumns({
        "n_words": F.col("__w.n"), "n_repeat_words": F.col("__w.r"), "n_removed_lines": F.col("__s.lines"),
        "n_removed_words": F.col("__s.words"), "clean_text": F.col("__s.text")})
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_removed_words") <= max_removed * F.col("n_words"))
    ).drop("__w", "__s", "__over")


def query(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_lines", "n_removed_words")


SQL = r"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, coalesce(text, '') t, CASE WHEN source IS NULL THEN '' ELSE '=' || source END host FROM documents),
w AS (SELECT rid, doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls FROM d),
win AS (SELECT rid, i, list_aggregate(list_slice(ws, i, i + 7), 'string_agg', ' ') g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) n_repeat FROM (SELECT rid, unnest(range(i, i + 8)) p FROM dup) GROUP BY 1),
l AS (SELECT rid, doc_id, host, t, x line, lower(regexp_replace(trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) nl FROM (SELECT rid, doc_id, host, t, unnest(ls) x FROM w)),
f AS (SELECT host, nl, count(DISTINCT t) n, min(doc_id::VARCHAR) first_id FROM l GROUP BY 1, 2),
o AS (SELECT host, nl, first_id FROM f WHERE n >= 10),
r AS (SELECT rid, count(*) n_removed_lines, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) n_removed_words FROM l JOIN o USING (host, nl) WHERE l.doc_id::VARCHAR IS DISTINCT FROM o.first_id GROUP BY 1),
s AS (SELECT doc_id, len(ws)::BIGINT n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT word_chars,
 length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT n_dup_lines,
 coalesce(n_repeat, 0)::BIGINT n_repeat_words, coalesce(n_removed_lines, 0)::BIGINT n_removed_lines, coalesce(n_removed_words, 0)::BIGINT n_removed_words
 FROM w LEFT JOIN rep USING (rid) LEFT JOIN r USING (rid))
SELECT *, base_failed = false AND n_removed_words <= 0.5 * n_words kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words base_failed FROM s)
"""
