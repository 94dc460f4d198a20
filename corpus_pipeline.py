"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last
return the columns of ``documents``.  ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import read
from starloom.llm.line_dedup import line_dedup
from starloom.llm.mixing import copies, mix
from starloom.llm.quality_rules import quality_rules
from starloom.llm.sentencepiece_codec import encode
from starloom.llm.simhash_dedup import keep_one
from starloom.session import remove_path, scratch_path


_OWN = ("doc_id", "text", "source", "n_chars")


def _packed(docs: DataFrame) -> DataFrame:
    """The columns the stages use, and all others as one, out of the operators' way."""
    rest = [c for c in docs.columns if c not in _OWN]
    return docs.select(*_OWN, F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("__none")).alias("__others"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in _OWN else F.col("__others").getField(c).alias(c) for c in docs.columns])


def _with_text(rows: DataFrame, clean: str) -> DataFrame:
    """The text replaced by ``clean``; the length follows a changed text."""
    changed = ~F.col(clean).eqNullSafe(F.col("text"))
    return rows.withColumn("n_chars", F.when(changed, F.char_length(clean).cast("long")).otherwise(F.col("n_chars"))).withColumn(
        "text", F.col(clean))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that ten documents of their host hold."""
    # the row number keeps the filter above the rules: below, Spark would work them out twice
    rows = quality_rules(_packed(docs)).withColumn("__row", F.monotonically_increasing_id())
    rows = rows.filter(F.col("kept") & (F.col("__row") >= 0))
    return _unpacked(_with_text(rows, "clean_text"), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate; a text that loses its last word goes."""
    rows = line_dedup(_packed(docs)).filter((F.col("n_removed") == 0) | (F.col("n_words_left") > 0))
    return _unpacked(_with_text(rows, "clean_text"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: a row per epoch of a taken document; the one at
    a source's cut keeps its words up to the budget."""
    rows = copies(mix(_packed(docs)))
    cut = F.col("taken") < (F.col("epoch") + 1) * F.col("size")
    return _unpacked(rows.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text again."""
    rows = encode(docs, decoded="decoded")
    # a marker in the text itself stands for a blank
    same = F.coalesce(F.col("decoded") == F.replace(F.col("text"), F.lit("▁"), F.lit(" ")), F.col("n_tokens") == 0)
    return rows.withColumn("round_trip", same).drop("decoded")


STAGES = [("quality rules", quality), ("line dedup", dedup_lines), ("SimHash near-dedup", near_dedup),
          ("mixing to target weights", mixture), ("SentencePiece codec", tokens)]

#: SimHash grouping and the codec have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next reads them."""
    docs, before = read(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                remove_path(spark, before)  # the next one stands
            before = path
    return docs
