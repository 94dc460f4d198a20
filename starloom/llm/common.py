"""Small helpers that the operators share (column expressions, sizes, scratch)."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import maybe_broadcast
from ..session import checkpoint_dir, remove_path, scratch_path

#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table, by a path only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable holds the value, so lambdas inside ``body`` can use it
    for every element without evaluating it again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The blank-separated words of a text; null or blank text has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return let(bare, lambda b: F.when(b == "", F.array().cast("array<string>")).otherwise(F.split(b, BLANK_RUN)))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) != ""


def normal_line(line: Column) -> Column:
    """A line as it is compared: lower case, outer blanks gone, blank runs one space."""
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), BLANK_RUN, " "))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def nullable_key(c: Column) -> Column:
    """A text key that tells null from every value and is never null itself."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


def written(df: DataFrame) -> DataFrame:
    """The frame cut from its lineage by a copy in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, *done: DataFrame) -> DataFrame:
    """The frame as a parquet table in the shared checkpoint folder; tables that
    are ``done`` once it is written are deleted.

    For loops: a checkpoint keeps the size Spark once estimated for the plan it
    cuts, and joins multiply the sizes of their sides, round by round without
    end; a table is as large as its files."""
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    for old in done:
        remove_path(spark, old.table_path)
    return out


def shared(df: DataFrame, value):
    """A function that gives tasks ``value``, broadcast once; classes of this
    folder travel with it, so executors need not have them."""
    held = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def quoted(name: str) -> Column:
    """A column by its own name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def set_aside(docs: DataFrame, used: dict[str, str], added: tuple[str, ...]):
    """For operators that hand rows to Python: the columns an operator uses, under
    its own names (``used``: own name -> column), and all others as one, ``__rest``,
    so that no name of theirs is ever resolved there.  The second result puts the rows
    together again, in order and with their names: the other columns, but for those
    named like an ``added`` one (as Spark compares names), the used ones unless they are
    left out, and the added ones."""
    gone = {a.lower() for a in added}
    own = {c: name for name, c in used.items()}
    given = [c for c in docs.columns if c in own or c.lower() not in gone]
    place = {c: f"_{i}" for i, c in enumerate(given) if c not in own}
    slim = docs.select(*[quoted(c).alias(name) for name, c in used.items()],
                       F.struct(F.lit(0).alias("_"), *[quoted(c).alias(p) for c, p in place.items()]).alias("__rest"))

    def back(rows: DataFrame, *without: str) -> DataFrame:
        return rows.select(*[F.col("__rest").getField(place[c]).alias(c) if c in place else F.col(own[c]).alias(c) for c in given if c not in without], *added)

    return slim, back


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key to as many tasks as the session shuffles to.  For
    work that costs much time per byte: without the number, Spark would join
    partitions of few bytes into few long tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written frame, marked for broadcast if rows x ``row_bytes`` fit the
    session's broadcast budget; else Spark joins it by a shuffle."""
    return maybe_broadcast(df, df.count() * row_bytes)
