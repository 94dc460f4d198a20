"""Mixing sources to target weights by hash-random order and prefix sums.

Every document gets a random key (a hash of a seed, its id and its text).
Within a source the documents are taken in key order up to the source's budget.
The order is never built as one sorted run: prefix sums over key ranges find,
range by range, the one that holds a source's cut; only that range, a few
thousand documents, is sorted document by document.  The final pass compares
each document's key with its source's cut, so no document row is shuffled and a
source that holds a third of all rows costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import assign_dense_key
from .common import broadcast_if_small, nullable_key, words, written

WEIGHTS = (5, 2, 1)
_KEY_DIGITS = 16


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    """16 hex digits that order documents at random, alike in every run."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                                         F.md5(F.coalesce(text, F.lit(""))))), 1, _KEY_DIGITS)


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """From rows (source, __source, source_size) the column target.

    Sources in code-point order, null last, take the weights in turn; their
    places are dense keys, made by a distributed sort.  A share stops at
    ``max_epochs`` times its source's size and the rest is shared again by
    weight: the level (share of weight 1) rises until no further source stops.
    One row comes back per round, whatever the number of sources."""
    named = sources.withColumn("__none", F.col("source").isNull().cast("int"))
    ranked = assign_dense_key(named, ["__none", "source"], "__rank", ties="none").df
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.pmod(F.col("__rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("__w", w).withColumn("__cap", max_epochs * F.col("source_size"))
    level, stopped = 0.0, -1
    while True:
        full = F.lit(level) * F.col("__w") > F.col("__cap")
        now = ranked.agg(F.sum("source_size").alias("size"), F.coalesce(F.sum(F.when(full, F.col("__cap"))), F.lit(0)).alias("capped"),
                         F.sum(F.when(~full, F.col("__w"))).alias("weight"), F.count_if(full).alias("stopped")).first()
        if not now["weight"] or now["stopped"] == stopped:
            break
        level, stopped = (now["size"] - now["capped"]) / now["weight"], now["stopped"]
    return ranked.withColumn("target", F.least(F.col("__cap").cast("double"), F.lit(level) * F.col("__w"))).drop(
        "__rank", "__w", "__cap", "__none")


def cuts(keyed: DataFrame, weights=WEIGHTS, max_epochs: int = 3, leaf_rows: int = 5000) -> DataFrame:
    """One row per source: source_size, target, whole epochs, and the cut of the
    last epoch: documents below ``__cut`` are taken whole, those at it share
    ``__rest`` of their ``__at`` words.  ``keyed``: (__source, source, __size, __rand)."""
    sources = keyed.groupBy("__source").agg(F.first("source").alias("source"), F.sum("__size").alias("source_size"))
    plan = targets(sources, weights, max_epochs)
    words_due = F.floor(F.col("target") + 0.5).cast("long")
    due = F.when(F.col("source_size") > 0, words_due).otherwise(F.lit(0).cast("long"))
    size = F.greatest(F.col("source_size"), F.lit(1))
    plan = written(plan.withColumn("__epochs", F.floor(due / size).cast("long"))
                   .withColumn("__left", due - F.col("__epochs") * F.col("source_size")).drop("source"))
    # narrow down, two hex digits at a time, the range that holds each cut
    at = plan.filter(F.col("__left") > 0).select(
        F.col("__source").alias("__s"), F.lit("").alias("__range"), F.col("__left").alias("__need"))
    running = Window.partitionBy("__s").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)

    def inside(n: int) -> DataFrame:
        held = broadcast_if_small(at, 128)
        return keyed.join(held, (keyed["__source"] == held["__s"]) & (F.substring(keyed["__rand"], 1, n) == held["__range"]))

    at = written(at)
    for n in range(0, _KEY_DIGITS, 2):
        parts = inside(n).groupBy("__s", F.substring("__rand", 1, n + 2).alias("__part")).agg(
            F.sum("__size").alias("__sum"), F.count(F.lit(1)).alias("__rows"), F.first("__need").alias("__need"))
        sums = parts.withColumn("__upto", F.sum("__sum").over(running))
        holds = sums.filter((F.col("__upto") >= F.col("__need")) & (F.col("__upto") - F.col("__sum") < F.col("__need")))
        at = written(holds.select("__s", F.col("__part").alias("__range"),
                                  (F.col("__need") - F.col("__upto") + F.col("__sum")).alias("__need"), "__rows"))
        largest = at.agg(F.max("__rows")).first()[0]
        at = at.drop("__rows")
        if largest is None or largest <= leaf_rows:
            break
    alike = inside(n + 2).groupBy("__s", F.col("__rand").alias("__part")).agg(
        F.sum("__size").alias("__sum"), F.first("__need").alias("__need"))
    sums = alike.withColumn("__upto", F.sum("__sum").over(running))
    cut = sums.filter((F.col("__upto") >= F.col("__need")) & (F.col("__upto") - F.col("__sum") < F.col("__need"))).select(
        "__s", F.col("__part").alias("__cut"), (F.col("__need") - F.col("__upto") + F.col("__sum")).alias("__rest"),
        F.col("__sum").alias("__at"))
    return written(plan.join(cut, plan["__source"] == cut["__s"], "left").drop("__s"))


def _keyed(docs: DataFrame, source: str, text: str, doc_id: str, seed: int) -> DataFrame:
    return docs.withColumns({
        "__source": nullable_key(F.col(source)), "__size": F.size(words(F.col(text))).cast("long"),
        "__rand": random_key(F.col(doc_id), F.col(text), seed)})


def _taken(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    plan = broadcast_if_small(plan.drop("__left").withColumnRenamed("__source", "__s"), 192)
    rows = keyed.drop("source_size", "target").join(plan, keyed["__source"] == plan["__s"])
    size, rand, cut = F.col("__size"), F.col("__rand"), F.col("__cut")
    last = F.when(rand < cut, size).when(rand == cut, F.floor(F.col("__rest") * size / F.greatest(F.col("__at"), F.lit(1))))
    taken = F.col("__epochs") * size + F.coalesce(last, F.lit(0))
    return rows.withColumns({"size": size, "taken": taken.cast("long")}).drop(
        "__s", "__source", "__size", "__rand", "__epochs", "__cut", "__rest", "__at")


def mix(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id",
        weights=WEIGHTS, max_epochs: int = 3, seed: int = 5) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and taken.

    ``taken`` counts the words the mix takes of the document, all epochs
    together: whole epochs of its source, plus the whole document if its random
    key lies below the source's cut, plus the words up to the exact budget for
    the document at the cut.

    Defined cases: a null text has size 0 and is never taken; a null source is a
    source of its own, last in order; repeated rows (same id and text) at the
    cut share the words left in equal parts, rounded down; an empty table gives
    an empty result; input columns named like an added one are replaced.
    """
    keyed = _keyed(docs, source, text, doc_id, seed)
    slim = written(keyed.select("__source", F.col(source).alias("source"), "__size", "__rand"))
    return _taken(keyed, cuts(slim, weights, max_epochs))


def copies(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: a row per epoch in which a document is taken (``epoch``
    from 0); the document at a cut keeps its words up to the budget."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))).otherwise(0).cast("int")
    part = F.col("taken") - whole * F.col("size")
    n = whole + F.when(part > 0, 1).otherwise(0)
    rows = mixed.withColumns({"__part": part, "__whole": whole}).withColumn(
        "epoch", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))))
    # a place after a word and before blanks ends a piece: pieces join back to the text
    pieces = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut_text = F.array_join(F.slice(pieces, F.lit(1), F.col("__part").cast("int")), "")
    return rows.withColumn(text, F.when(F.col("epoch") == F.col("__whole"), cut_text).otherwise(F.col(text))).drop(
        "__part", "__whole")


def query(docs: DataFrame) -> DataFrame:
    # the texts are read once: what follows needs only sizes and keys
    slim = written(_keyed(docs.select("doc_id", "source", "text"), "source", "text", "doc_id", 5).drop("text"))
    return _taken(slim, cuts(slim)).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END sk,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT size,
  substr(md5('5:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 16) k FROM documents),
s AS (SELECT sk, any_value(source) source, sum(size)::BIGINT source_size FROM d GROUP BY 1),
r AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] w, 3 * source_size cap,
  row_number() OVER (ORDER BY source IS NULL, source) rank FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) level FROM r),
t AS (SELECT sk, source_size, least(cap::DOUBLE, (SELECT level FROM l WHERE level * w <= cap ORDER BY cap / w, rank LIMIT 1) * w) target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT ELSE 0 END due FROM t),
k AS (SELECT sk, k, sum(size) here, sum(sum(size)) OVER (PARTITION BY sk ORDER BY k) upto FROM d GROUP BY 1, 2)
SELECT doc_id, size, source_size, target,
 (CASE WHEN source_size = 0 THEN 0 ELSE due // source_size * size + greatest(0, least(size,
   floor((due % source_size - (upto - here)) * size / greatest(here, 1)))) END)::BIGINT taken
FROM d JOIN b USING (sk) JOIN k USING (sk, k)
"""
