"""Raw catalogue records derived from the ``part`` table.

The reference reads crawled book documents (``_id, Rank, Title, Author,
Rating, Number of Ratings, Date, Pages, Cover Type, Description, Reviews,
Score, Genres``, all text).  This adapter derives records of that shape from
``part`` with Spark expressions only, so its size grows with the table: every
part row becomes a record, with shared titles, comma-grouped numbers, three
date layouts, unparseable values, numbers only a lenient cast reads and every
free-text edge class; one document in fifty is delivered twice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates

RAW_COLUMNS = [
    "_id", "Rank", "Title", "Author", "Rating", "Number of Ratings", "Reviews",
    "Score", "Pages", "Cover Type", "Date", "Description", "Genres",
]


def _case(value: Column, branches: list[tuple[int, Column]]) -> Column:
    out = None
    for k, v in branches:
        out = F.when(value == k, v) if out is None else out.when(value == k, v)
    return out


def raw_records_from_part(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    name, brand, ptype, size = F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size")

    def comma(x: Column) -> Column:
        return F.format_number(x, 0)

    day = F.date_add(F.lit(_dt.date(1900, 1, 1)), (k % 36000).cast("int"))
    d1 = F.date_format(day, "MMMM d, yyyy")
    d2 = F.date_format(day, "yyyy")
    d3 = F.date_format(day, "MMMM yyyy")
    first = F.lit(dates.PUBLISHED_PREFIX)

    copies = F.array_repeat(F.lit(0), F.when(k % 50 == 0, 2).otherwise(1))
    return part.withColumn("__copy", F.explode(copies)).select(
        F.concat(F.lit("id"), k.cast("string")).alias("_id"),
        k.cast("string").alias("Rank"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(name, F.lit(" "), brand, F.lit(" "), ptype)).alias("Title"),
        F.when(k % 89 == 0, F.lit(None).cast("string")).otherwise(brand).alias("Author"),
        F.concat(F.floor(size / 10).cast("int").cast("string"), F.lit("."),
                 (size % 10).cast("string")).alias("Rating"),
        F.when(k % 83 == 0, F.lit(None).cast("string"))
        .when(k % 79 == 0, F.lit("n/a"))
        .otherwise(comma(k * 997)).alias("Number of Ratings"),
        comma(k * 31).alias("Reviews"),
        comma(k * 1009).alias("Score"),
        F.when(k % 71 == 0, F.lit("unknown"))
        .when(k % 73 == 0, F.concat(size.cast("string"), F.lit(".7")))
        .when(k % 59 == 0, F.lit(".5"))
        .when(k % 61 == 0, F.concat(F.lit("\x01"), size.cast("string"), F.lit(" ")))
        .when(k % 53 == 0, F.concat(size.cast("string"), F.lit("\x85")))
        .otherwise(size.cast("string")).alias("Pages"),
        _case(k % 4, [(0, F.lit("Hardcover")), (1, F.lit("Paperback")),
                      (2, F.lit("Kindle Edition"))]).alias("Cover Type"),
        _case(k % 6, [(0, F.concat(first, d1)), (1, F.concat(first, d2)),
                      (2, F.concat(first, d3)), (3, F.concat(F.lit(dates.PLACEHOLDER_DATE_PREFIX), d1)),
                      (4, d1)]).alias("Date"),
        _case(k % 10, [
            (1, F.lit("   ")), (2, F.lit("12345")), (3, F.lit("1st place")),
            (4, F.lit("great book9")), (5, F.lit('Café "noir" été')), (6, F.lit("плохо")),
            (7, F.lit("19-th century")), (8, F.lit("plain text")),
            (9, F.concat(name, F.lit(', a "fine" story.'))),
        ]).alias("Description"),
        F.when(k % 67 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 0, F.concat(ptype, F.lit(","), ptype))
        .when(k % 2 == 0, F.concat(ptype, F.lit(", "), F.replace(name, F.lit(" "), F.lit(","))))
        .otherwise(F.concat(F.replace(name, F.lit(" "), F.lit(", ")), F.lit(", "), ptype))
        .alias("Genres"),
    )


def json_documents_from_part(part: DataFrame) -> DataFrame:
    """(part_id, body): a JSON document per part row, as a store whose writers changed over
    time holds them: sizes as numbers, as text, with a fraction or null, fields that only
    some documents have, and one document in 41 cut off."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    sized = (F.when(k % 5 == 0, F.concat(F.lit('"'), size, F.lit('"'))).when(k % 7 == 0, F.concat(size, F.lit(".5")))
             .when(k % 11 == 0, F.lit("null")).otherwise(size))
    brand = F.when(k % 4 == 0, F.concat(F.lit(',"brand":{"code":"'), F.col("p_brand"), F.lit('"}'))).otherwise("")
    tags = F.when(k % 3 == 0, F.concat(F.lit(',"tags":["'), F.col("p_type"), F.lit('"]'))).otherwise("")
    whole = F.concat(F.lit('{"id":'), k.cast("string"), F.lit(',"name":"'), F.col("p_name"), F.lit('","size":'), sized, brand, tags, F.lit("}"))
    return part.select(k.alias("part_id"), F.when(k % 41 == 0, F.substring(whole, 1, 10)).otherwise(whole).alias("body"))
