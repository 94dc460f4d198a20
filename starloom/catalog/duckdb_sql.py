"""DuckDB statements that compute what each registered Spark query computes.

They follow the reference's literal plan (e.g. reports count through the
final books table and look names up by id), while the Spark side may take a
cheaper but equivalent plan; agreement of the two is the correctness check.

Dialect notes: Java's ``$`` also matches before one final line terminator, so
the oracle spells that out; Java's ``\\s`` includes \\x0B, RE2's does not, so
the class is spelled out; ``regexp_replace`` needs the 'g' flag; sums are cast
to BIGINT; dense keys order NULLS FIRST as Spark's ascending sort does.
"""

from __future__ import annotations

from .params import AS_OF

# Character classes, placeholder and default texts that must equal the reference for equal results.
WS = r"[ \t\n\x0B\f\r]"
EOL = r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"
PLACEHOLDER = "No description available"
NO_TITLE, NO_AUTHOR, NO_COVER, NO_GENRES = "No title", "no author", "No cover type", "No genres"


def _unusable(c: str) -> str:
    pats = [
        rf"^[0-9]+{EOL}",
        rf"^{WS}+{EOL}",
        rf"^[0-9]+[a-zA-Z]+|[a-zA-Z]+[0-9]+{EOL}",
    ]
    conds = " OR ".join(f"regexp_matches({c}, '{p}')" for p in pats)
    return f"({c} IS NULL OR trim({c}) = '' OR {conds})"


def _classify(c: str) -> str:
    return f"(CASE WHEN {_unusable(c)} THEN '{PLACEHOLDER}' ELSE {c} END)"


def _strip(c: str) -> str:
    return (
        f"regexp_replace(regexp_replace({c}, '\"', '', 'g'), "
        rf"'[^a-zA-Z0-9 \t\n\x0B\f\r]', '', 'g')"
    )


def _first_pass(c: str) -> str:
    return _strip(_classify(c))


def _second_pass(c: str) -> str:
    return _classify(_strip(c))


# what a lenient cast trims: characters up to the blank, and DEL
_TRIMMED = "concat(" + ", ".join(f"chr({i})" for i in [*range(1, 33), 127]) + ")"


def _to_int(c: str) -> str:
    """The lenient cast by its steps: trim, sign, digits, optional fraction."""
    s = f"trim({c}, {_TRIMMED})"
    bare = f"(CASE WHEN left({s}, 1) IN ('+', '-') THEN substr({s}, 2) ELSE {s} END)"
    whole, rest = f"split_part({bare}, '.', 1)", f"substr({bare}, strpos({bare} || '.', '.') + 1)"
    digits = lambda x: f"translate({x}, '0123456789', '') = ''"
    return (f"(CASE WHEN {bare} = '' OR NOT ({digits(whole)}) OR NOT ({digits(rest)}) THEN NULL WHEN {whole} = '' THEN 0 "
            f"ELSE TRY_CAST((CASE WHEN left({s}, 1) = '-' THEN '-' ELSE '' END) || {whole} AS INTEGER) END)")


# fixed values: the months of the legacy date parser, by their short names
_MONTHS = "['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec']"
_LONG_MONTHS = ("['january', 'february', 'march', 'april', 'may', 'june', 'july', 'august', 'september', 'october', "
                "'november', 'december']")


def _legacy_date(t: str) -> str:
    """The first of 'month d, yyyy', 'yyyy', 'month yyyy' that a text starts
    with: short or long month names in any case, blanks before a number
    skipped, any width of numbers, what follows ignored, real days only."""
    name = rf"lower(regexp_extract({t}, '^([A-Za-z]+) ', 1))"
    month = f"(CASE WHEN list_contains({_MONTHS}, {name}) OR list_contains({_LONG_MONTHS}, {name}) THEN list_position({_MONTHS}, {name}[1:3]) END)"
    number = lambda rx, g: rf"TRY_CAST(regexp_extract({t}, '{rx}', {g}) AS INTEGER)"
    full = "^[A-Za-z]+ [ ]*([0-9]+), [ ]*([0-9]+)"
    made = lambda y, m, d: f"TRY_CAST(printf('%04d-%02d-%02d', NULLIF({y}, 0), {m}, {d}) AS DATE)"
    return (f"COALESCE({made(number(full, 2), month, number(full, 1))}, {made(number('^[ ]*([0-9]+)', 1), 1, 1)}, "
            f"{made(number('^[A-Za-z]+ [ ]*([0-9]+)', 1), month, 1)}, DATE '1900-01-01')")


def _comma(x: str) -> str:
    return f"format('{{:,}}', {x})"


_DAY = "(DATE '1900-01-01' + CAST(p_partkey % 36000 AS INTEGER))"
_D1 = f"strftime({_DAY}, '%B %-d, %Y')"
_D2 = f"strftime({_DAY}, '%Y')"
_D3 = f"strftime({_DAY}, '%B %Y')"
AS_OF_SQL = f"DATE '{AS_OF.isoformat()}'"

RAW = f"""raw0 AS (
  SELECT 'id' || CAST(p_partkey AS VARCHAR) AS "_id",
    CAST(p_partkey AS VARCHAR) AS "Rank",
    CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_name || ' ' || p_brand || ' ' || p_type END AS "Title",
    CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_brand END AS "Author",
    CAST(CAST(floor(p_size / 10) AS INTEGER) AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) AS "Rating",
    CASE WHEN p_partkey % 83 = 0 THEN NULL WHEN p_partkey % 79 = 0 THEN 'n/a'
         ELSE {_comma('p_partkey * 997')} END AS "Number of Ratings",
    {_comma('p_partkey * 31')} AS "Reviews",
    {_comma('p_partkey * 1009')} AS "Score",
    CASE WHEN p_partkey % 71 = 0 THEN 'unknown' WHEN p_partkey % 73 = 0 THEN CAST(p_size AS VARCHAR) || '.7'
         WHEN p_partkey % 59 = 0 THEN '.5' WHEN p_partkey % 61 = 0 THEN chr(1) || CAST(p_size AS VARCHAR) || ' '
         WHEN p_partkey % 53 = 0 THEN CAST(p_size AS VARCHAR) || chr(133)
         ELSE CAST(p_size AS VARCHAR) END AS "Pages",
    CASE p_partkey % 4 WHEN 0 THEN 'Hardcover' WHEN 1 THEN 'Paperback' WHEN 2 THEN 'Kindle Edition' END AS "Cover Type",
    CASE p_partkey % 6 WHEN 0 THEN 'First published ' || {_D1} WHEN 1 THEN 'First published ' || {_D2}
         WHEN 2 THEN 'First published ' || {_D3} WHEN 3 THEN 'Published ' || {_D1} WHEN 4 THEN {_D1} END AS "Date",
    CASE p_partkey % 10 WHEN 1 THEN '   ' WHEN 2 THEN '12345' WHEN 3 THEN '1st place' WHEN 4 THEN 'great book9'
         WHEN 5 THEN 'Café "noir" été' WHEN 6 THEN 'плохо' WHEN 7 THEN '19-th century' WHEN 8 THEN 'plain text'
         WHEN 9 THEN p_name || ', a "fine" story.' END AS "Description",
    CASE WHEN p_partkey % 67 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN p_type || ',' || p_type
         WHEN p_partkey % 2 = 0 THEN p_type || ', ' || replace(p_name, ' ', ',')
         ELSE replace(p_name, ' ', ', ') || ', ' || p_type END AS "Genres"
  FROM part),
raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE CAST("Rank" AS BIGINT) % 50 = 0)"""

_CLEANED_DATE = "replace(\"Date\", 'First published ', '')"

PARSED = f"""parsed AS (
  SELECT "_id" AS record_id,
    "Rank" AS rank, "Title" AS title, "Author" AS author,
    TRY_CAST("Rating" AS FLOAT) AS rating,
    {_to_int('replace("Number of Ratings", \',\', \'\')')} AS num_ratings,
    {_to_int('replace("Reviews", \',\', \'\')')} AS reviews,
    {_to_int('replace("Score", \',\', \'\')')} AS score,
    {_to_int('"Pages"')} AS pages,
    "Cover Type" AS cover_type,
    "Date" AS date_text,
    {_first_pass('"Description"')} AS description,
    "Genres" AS genres,
    {_CLEANED_DATE} AS cleaned_date,
    {_legacy_date(_CLEANED_DATE)} AS publish_date
  FROM raw)"""

CLEAN0 = "clean0 AS (SELECT DISTINCT * FROM parsed)"

CLEANED = f"""cleaned AS (
  SELECT record_id, COALESCE(rank, '0') AS rank,
    COALESCE(title, '{NO_TITLE}') AS title,
    COALESCE(author, '{NO_AUTHOR}') AS author,
    CASE WHEN rating IS NULL OR isnan(rating) THEN CAST(0.0 AS FLOAT) ELSE rating END AS rating,
    COALESCE(num_ratings, 0) AS num_ratings,
    COALESCE(reviews, 0) AS reviews,
    COALESCE(score, 0) AS score,
    COALESCE(pages, 0) AS pages,
    COALESCE(cover_type, '{NO_COVER}') AS cover_type,
    COALESCE(date_text, strftime({AS_OF_SQL}, '%Y-%m-%d')) AS date_text,
    COALESCE(description, '{PLACEHOLDER}') AS description,
    COALESCE(genres, '{NO_GENRES}') AS genres,
    COALESCE(cleaned_date, 'Published ' || strftime({AS_OF_SQL}, '%B %d, %Y')) AS cleaned_date,
    publish_date
  FROM clean0)"""

BOOKS = f"""books0 AS (
  SELECT record_id, title AS book_title, pages AS num_pages, cover_type, publish_date, genres, rating, author,
    {_second_pass('description')} AS description
  FROM cleaned),
books AS (
  SELECT row_number() OVER (ORDER BY book_title NULLS FIRST, author NULLS FIRST, num_pages NULLS FIRST,
      cover_type NULLS FIRST, publish_date NULLS FIRST, genres NULLS FIRST, rating NULLS FIRST,
      description NULLS FIRST) - 1 AS book_id, *
  FROM books0)"""

AUTHORS = """authors AS (
  SELECT row_number() OVER (ORDER BY author_name NULLS FIRST) - 1 AS author_id, author_name
  FROM (SELECT DISTINCT author AS author_name FROM cleaned))"""

GENRES = """genres AS (
  SELECT row_number() OVER (ORDER BY genre_name NULLS FIRST) - 1 AS genre_id, genre_name
  FROM (SELECT DISTINCT unnest(string_split(genres, ',')) AS genre_name FROM cleaned))"""

RATINGS = """ratings AS (
  SELECT row_number() OVER (ORDER BY book_title NULLS FIRST, rating NULLS FIRST, num_ratings NULLS FIRST,
      num_reviews NULLS FIRST, score NULLS FIRST) - 1 AS rating_id, *
  FROM (SELECT title AS book_title, rating, num_ratings, reviews AS num_reviews, score FROM cleaned))"""

REVIEWS = """reviews AS (
  SELECT row_number() OVER (ORDER BY book_id NULLS FIRST, reviews NULLS FIRST, score NULLS FIRST) - 1 AS review_id,
    book_id, reviews, score
  FROM (SELECT b.book_id, c.reviews, c.score FROM cleaned c JOIN books b ON c.title = b.book_title))"""

BOOK_GENRES = """book_genres AS (
  SELECT DISTINCT x.book_id, g.genre_id
  FROM (SELECT book_id, unnest(string_split(genres, ',')) AS genre_name FROM books) x
  JOIN genres g ON x.genre_name = g.genre_name)"""

BOOK_RATINGS = """book_ratings AS (
  SELECT b.book_id, r.rating_id
  FROM books b JOIN ratings r ON b.book_title = r.book_title
  WHERE b.book_id IN (SELECT book_id FROM books) AND r.rating_id IN (SELECT rating_id FROM ratings))"""

BOOKS_FINAL = """bf_ids AS (
  SELECT x.book_id, list_sort(list(g.genre_id)) AS genre_list,
    COALESCE(string_agg(CAST(g.genre_id AS VARCHAR), ',' ORDER BY g.genre_id), '') AS genre_ids
  FROM (SELECT book_id, unnest(string_split(genres, ',')) AS genre_name FROM books) x
  LEFT JOIN genres g ON x.genre_name = g.genre_name
  GROUP BY x.book_id),
books_final AS (
  SELECT b.book_id, b.book_title, a.author_id, b.num_pages, b.cover_type,
    CAST(try_strptime(strftime(b.publish_date, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS publish_date,
    b.description, i.genre_ids, i.genre_list
  FROM books b LEFT JOIN authors a ON b.author = a.author_name
  LEFT JOIN bf_ids i ON b.book_id = i.book_id)"""

DEPS = {
    "raw": (RAW, []),
    "parsed": (PARSED, ["raw"]),
    "clean0": (CLEAN0, ["parsed"]),
    "cleaned": (CLEANED, ["clean0"]),
    "books": (BOOKS, ["cleaned"]),
    "authors": (AUTHORS, ["cleaned"]),
    "genres": (GENRES, ["cleaned"]),
    "ratings": (RATINGS, ["cleaned"]),
    "reviews": (REVIEWS, ["books"]),
    "book_genres": (BOOK_GENRES, ["books", "genres"]),
    "book_ratings": (BOOK_RATINGS, ["books", "ratings"]),
    "books_final": (BOOKS_FINAL, ["books", "genres", "authors"]),
}


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first, then ``extra``."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in DEPS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = [DEPS[n][0] for n in order] + list(extra or [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


RATING_VALUES = ["rating", "num_ratings", "num_reviews", "score"]
BOOK_COLS = ["book_id", "book_title", "num_pages", "cover_type", "publish_date", "genres", "rating",
             "author", "description"]
BOOK_ORDER = ["book_title", "author", "num_pages", "cover_type", "publish_date", "genres", "rating", "description"]
RATING_COLS = ["rating_id", "book_title", "rating", "num_ratings", "num_reviews", "score"]

_R_PREFIXED = ", ".join(f"r.{c} AS r_{c}" for c in RATING_VALUES)
_ORDER_DATE_TEXT = """CASE o_orderkey % 13
      WHEN 0 THEN 'First published ' || strftime(o_orderdate, '%B %-d, %Y')
      WHEN 1 THEN 'First published ' || strftime(o_orderdate, '%Y')
      WHEN 2 THEN 'First published ' || strftime(o_orderdate, '%B %Y')
      WHEN 3 THEN 'Published ' || strftime(o_orderdate, '%B %-d, %Y')
      WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y') || ' extra'
      WHEN 5 THEN strftime(o_orderdate, '%b %-d, %Y')
      WHEN 6 THEN strftime(o_orderdate, '%b %Y')
      WHEN 7 THEN strftime(o_orderdate, '%B  %-d, %Y')
      WHEN 8 THEN strftime(o_orderdate, '%B %-d, %Y') || ' (ebook)'
      WHEN 9 THEN strftime(o_orderdate, '%Y') || ' reissue'
      WHEN 10 THEN ' ' || upper(strftime(o_orderdate, '%B')) || strftime(o_orderdate, ' %-d, %Y')
      WHEN 11 THEN strftime(o_orderdate, '%B %-d %Y')
      ELSE 'February 30, ' || strftime(o_orderdate, '%Y') END"""

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _nf(cols):
    return ", ".join(f"{c} NULLS FIRST" for c in cols)


SCHEMA_COLUMNS = [
    ("rank", "string"), ("title", "string"), ("author", "string"), ("rating", "float"),
    ("num_ratings", "int"), ("reviews", "int"), ("score", "int"), ("pages", "int"),
    ("cover_type", "string"), ("date_text", "string"), ("description", "string"),
    ("genres", "string"), ("cleaned_date", "string"), ("publish_date", "date"),
]


def _schema_report_sql() -> str:
    parts = []
    for i, (c, t) in enumerate(SCHEMA_COLUMNS):
        parts.append(
            f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, '{t}' AS expected_type, "
            f"TRUE AS type_ok, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM cleaned"
        )
    return with_ctes(["cleaned"], "\nUNION ALL\n".join(parts))


_RAW_NAMES = ["_id", "Rank", "Title", "Author", "Rating", "Number of Ratings", "Reviews", "Score", "Pages",
              "Cover Type", "Date", "Description", "Genres"]
_CLEAN_NAMES = [c for c, _ in SCHEMA_COLUMNS]


def _census(names, table):
    cols = ", ".join(f'CAST(count(*) FILTER (WHERE "{c}" IS NULL) AS BIGINT) AS "{c}"' for c in names)
    return f"SELECT {cols} FROM {table}"


def _author_counts_literal() -> str:
    return """rep1 AS (
  SELECT a.author_name, x.book_count
  FROM (SELECT author_id, count(*) AS book_count FROM books_final GROUP BY author_id) x
  JOIN authors a ON x.author_id = a.author_id)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_records"] = with_ctes(["raw"], "SELECT * FROM raw")
    q["scan_project_rename"] = (
        "SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand, p_type AS part_type, "
        "p_size AS size, 'part' AS source_table FROM part"
    )
    q["strip_thousands_cast"] = with_ctes(
        ["parsed"], "SELECT record_id, rating, num_ratings, reviews, score, pages FROM parsed")
    q["date_cascade"] = f"""SELECT o_orderkey, date_text, {_legacy_date('t')} AS publish_date
FROM (SELECT o_orderkey, date_text, replace(date_text, 'First published ', '') AS t
      FROM (SELECT o_orderkey, {_ORDER_DATE_TEXT} AS date_text FROM orders))"""
    q["date_cascade_legacy"] = f"""SELECT o_orderkey, date_text, {_legacy_date('t')} AS publish_date
FROM (SELECT o_orderkey, date_text, replace(replace(date_text, 'First published ', ''), 'Published ', '') AS t
      FROM (SELECT o_orderkey, {_ORDER_DATE_TEXT} AS date_text FROM orders))"""
    q["date_roundtrip"] = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  strftime(o_orderdate, '%d-%m-%Y') AS dmy_text,
  CAST(try_strptime(strftime(o_orderdate, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS dmy_date,
  CAST(TRY_CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS DATE) AS lenient_date
FROM orders"""
    q["date_defaults"] = with_ctes(["parsed"], f"""SELECT record_id,
  COALESCE(date_text, strftime({AS_OF_SQL}, '%Y-%m-%d')) AS date_text,
  COALESCE(cleaned_date, 'Published ' || strftime({AS_OF_SQL}, '%B %d, %Y')) AS cleaned_date
FROM parsed""")
    q["text_classify"] = f"""SELECT doc_id,
  {_unusable('text')} AS unusable,
  {_classify('text')} AS classified
FROM documents"""
    q["text_clean"] = with_ctes(["raw"], f"""SELECT "_id" AS record_id, "Description" AS raw_text,
  {_first_pass('"Description"')} AS first_pass,
  {_second_pass(_first_pass('"Description"'))} AS second_pass
FROM raw""")
    q["text_clean_documents"] = f"""SELECT doc_id, lang,
  {_second_pass(_first_pass('text'))} AS cleaned_text
FROM documents"""
    q["clean_records"] = with_ctes(["cleaned"], "SELECT * EXCLUDE (record_id) FROM cleaned")
    fill_cols = ["rank", "title", "author", "rating", "num_ratings", "description", "reviews", "pages",
                 "cover_type", "score", "genres", "date_text", "cleaned_date"]
    fills = ", ".join(
        f"CAST(count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'rating' else ''}) AS BIGINT) "
        f"AS {c}_filled" for c in fill_cols)
    q["fill_defaults"] = with_ctes(["clean0"], f"SELECT {fills} FROM clean0")
    q["null_census_raw"] = with_ctes(["raw"], _census(_RAW_NAMES, "raw"))
    q["null_census_clean"] = with_ctes(["cleaned"], _census(_CLEAN_NAMES, "cleaned"))
    q["schema_report"] = _schema_report_sql()
    q["dedupe_rows"] = "SELECT DISTINCT text, lang, source, n_chars FROM documents"
    rest = [c for c in _LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]
    q["dedupe_key"] = f"""SELECT {', '.join(_LINEITEM_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_nf(['l_linenumber'] + rest)}) AS rn
  FROM lineitem) WHERE rn = 1"""
    q["dense_ids"] = f"""SELECT row_number() OVER (ORDER BY {_nf(_LINEITEM_COLS)}) - 1 AS row_id,
  {', '.join(_LINEITEM_COLS)} FROM lineitem"""
    q["semi_filter"] = """SELECT * FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')"""
    q["anti_filter"] = """SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""
    q["semi_filter_bitmap"], q["anti_filter_bitmap"] = q["semi_filter"], q["anti_filter"]
    q["dedupe_by_id"] = """SELECT DISTINCT * FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 7 = 0
UNION ALL SELECT * REPLACE (p_name || ' 2' AS p_name) FROM part WHERE p_partkey % 11 = 0)"""
    first = "CAST(substr(record_id, 3) AS BIGINT) % 3 <> 0"
    q["keys_two_deliveries"] = with_ctes(["cleaned"], f"""SELECT kind, natural_key, row_number() OVER (PARTITION BY kind ORDER BY delivery, natural_key) - 1 AS id, delivery
FROM (SELECT kind, natural_key, CASE WHEN bool_or({first}) THEN 'first' ELSE 'second' END AS delivery
  FROM (SELECT 'genre' AS kind, unnest(string_split(genres, ',')) AS natural_key, record_id FROM cleaned
        UNION ALL SELECT 'book', record_id, record_id FROM cleaned) k GROUP BY 1, 2) d""")
    q["load_books_incremental"] = with_ctes(["books"], f"""SELECT row_number() OVER (ORDER BY delivery, record_id) - 1 AS book_id, * FROM (
  SELECT record_id, book_title, num_pages, cover_type, publish_date, genres, rating, author, description,
    CASE WHEN {first} THEN 'first' ELSE 'second' END AS delivery FROM books0) b""")
    q["reviews_two_deliveries"] = with_ctes(["books"], f"""SELECT row_number() OVER (ORDER BY b.old AND c.old DESC, b.book_id, c.record_id) - 1 AS review_id,
  b.book_id, c.reviews, c.score, c.record_id
FROM (SELECT *, {first} AS old, row_number() OVER (ORDER BY {first} DESC, record_id) - 1 AS book_id FROM books0) b
JOIN (SELECT *, {first} AS old FROM cleaned) c ON c.title = b.book_title""")
    q["title_pair_report"] = with_ctes(["books", "ratings"], """SELECT b.book_title, count(*) AS pairs, CAST(sum(b.num_pages) AS BIGINT) AS sum_pages,
  CAST(sum(r.num_ratings) AS BIGINT) AS sum_num_ratings, CAST(sum(r.score) AS BIGINT) AS sum_score
FROM books b JOIN ratings r ON b.book_title = r.book_title GROUP BY 1""")
    q["bridge_expanded"] = with_ctes(["book_ratings"], "SELECT * FROM book_ratings")
    whole = """'{"id":' || p_partkey || ',"name":"' || p_name || '","size":' || CASE WHEN p_partkey % 5 = 0 THEN '"' || p_size || '"'
  WHEN p_partkey % 7 = 0 THEN p_size || '.5' WHEN p_partkey % 11 = 0 THEN 'null' ELSE p_size::VARCHAR END"""
    q["scan_variant_documents"] = f"""SELECT CASE WHEN ok THEN p_partkey END AS id, CASE WHEN ok THEN p_name END AS name,
  CASE WHEN ok AND p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN p_size END AS size,
  CASE WHEN ok THEN NULLIF(concat_ws(';', CASE WHEN p_partkey % 4 = 0 THEN 'brand={{"code":"' || p_brand || '"}}' END,
    CASE WHEN p_partkey % 5 = 0 THEN 'size="' || p_size || '"' WHEN p_partkey % 7 = 0 THEN 'size=' || p_size || '.5' END,
    CASE WHEN p_partkey % 3 = 0 THEN 'tags=["' || p_type || '"]' END), '') END AS rescued,
  CASE WHEN NOT ok THEN substr({whole}, 1, 10) END AS malformed
FROM (SELECT *, p_partkey % 41 <> 0 AS ok FROM part)"""
    q["schema_drift_report"] = """SELECT field, kind, count(*) AS documents,
  CASE field WHEN 'id' THEN 'BIGINT' WHEN 'name' THEN 'STRING' WHEN 'size' THEN 'STRING' WHEN 'brand' THEN 'OBJECT' WHEN 'tags' THEN 'ARRAY' ELSE 'MALFORMED' END AS merged
FROM (SELECT unnest(CASE WHEN p_partkey % 41 = 0 THEN [NULL] ELSE ['id', 'name', 'size', CASE WHEN p_partkey % 4 = 0 THEN 'brand' ELSE '-' END,
    CASE WHEN p_partkey % 3 = 0 THEN 'tags' ELSE '-' END] END) AS field,
  unnest(CASE WHEN p_partkey % 41 = 0 THEN ['MALFORMED'] ELSE ['BIGINT', 'STRING', CASE WHEN p_partkey % 5 = 0 THEN 'STRING' WHEN p_partkey % 7 = 0 THEN 'DECIMAL'
    WHEN p_partkey % 11 = 0 THEN 'VOID' ELSE 'BIGINT' END, 'OBJECT', 'ARRAY'] END) AS kind FROM part) x
WHERE field IS NULL OR field <> '-' GROUP BY 1, 2"""
    q["clean_books"] = with_ctes(["books"], f"SELECT {', '.join(BOOK_COLS)} FROM books")
    q["dim_authors"] = with_ctes(["authors"], "SELECT * FROM authors")
    q["dim_genres"] = with_ctes(["genres"], "SELECT * FROM genres")
    q["bridge_book_genres"] = with_ctes(["book_genres"], "SELECT * FROM book_genres")
    q["fact_ratings"] = with_ctes(["ratings"], f"SELECT {', '.join(RATING_COLS)} FROM ratings")
    q["fact_reviews"] = with_ctes(["reviews"], "SELECT * FROM reviews")
    q["bridge_book_ratings"] = with_ctes(["book_ratings"], "SELECT * FROM book_ratings")
    q["bridge_valid_count"] = with_ctes(["books", "ratings"], """SELECT
  count(*) FILTER (WHERE ok) AS valid_rows, count(*) FILTER (WHERE NOT ok) AS rejected_rows
FROM (SELECT (b.book_id IN (SELECT book_id FROM books) AND r.rating_id IN (SELECT rating_id FROM ratings)) AS ok
      FROM books b JOIN ratings r ON b.book_title = r.book_title)""")
    q["referential_orphans"] = """SELECT count(*) FILTER (WHERE ok) AS valid_rows, count(*) FILTER (WHERE NOT ok) AS rejected_rows
FROM (SELECT l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)
         AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0) AS ok FROM lineitem)"""
    q["rejected_orphans"] = """SELECT * FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)"""
    by_record = {
        "reviews_by_record": """SELECT row_number() OVER (ORDER BY book_id, reviews NULLS FIRST, score NULLS FIRST) - 1 AS review_id,
  book_id, reviews, score FROM (SELECT b.book_id, c.reviews, c.score FROM cleaned c JOIN rbooks b USING (record_id))""",
        "bridge_book_ratings_by_record": "SELECT b.book_id, r.rating_id FROM rbooks b JOIN rratings r USING (record_id)",
        "books_left_ratings_by_record": f"""SELECT b.*, r.rating_id, {_R_PREFIXED}
FROM rbooks b LEFT JOIN rratings r ON b.record_id = r.record_id""",
    }
    record_tables = [
        f"rbooks AS (SELECT row_number() OVER (ORDER BY {_nf([*BOOK_ORDER, 'record_id'])}) - 1 AS book_id, * FROM books0)",
        f"""rratings AS (SELECT row_number() OVER (ORDER BY {_nf([*RATING_COLS[1:], 'record_id'])}) - 1 AS rating_id, *
  FROM (SELECT record_id, title AS book_title, rating, num_ratings, reviews AS num_reviews, score FROM cleaned))""",
    ]
    for name, body in by_record.items():
        q[name] = with_ctes(["books"], body, record_tables)
    q["books_left_ratings"] = with_ctes(["books", "ratings"], f"""SELECT b.* EXCLUDE (record_id), r.rating_id, {_R_PREFIXED}
FROM books b LEFT JOIN ratings r ON b.book_title = r.book_title""")
    q["ratings_left_books"] = with_ctes(["books", "ratings"], f"""SELECT r.rating_id, {_R_PREFIXED}, b.* EXCLUDE (record_id)
FROM ratings r LEFT JOIN books b ON r.book_title = b.book_title""")
    b_cols = ", ".join(f"b.{c} AS b_{c}" for c in BOOK_COLS)
    r_cols = ", ".join(f"r.{c} AS r_{c}" for c in RATING_COLS)
    q["books_ratings_wide"] = with_ctes(["books", "ratings"], f"""SELECT {b_cols}, {r_cols}
FROM books b LEFT JOIN ratings r ON b.book_title = r.book_title""")
    q["book_rating_details"] = with_ctes(["book_ratings"], """SELECT br.book_id, b.book_title, b.num_pages,
  b.cover_type, b.publish_date, b.genres, b.rating, b.author, b.description, br.rating_id
FROM book_ratings br JOIN books b ON br.book_id = b.book_id""")
    q["books_genre_names"] = with_ctes(["book_genres"], """SELECT b.book_id, b.book_title, b.num_pages,
  b.cover_type, b.publish_date, b.rating, b.author, b.description, g.genre_name
FROM books b JOIN book_genres bg ON b.book_id = bg.book_id JOIN genres g ON bg.genre_id = g.genre_id""")
    q["books_reviews"] = with_ctes(["reviews"], """SELECT b.* EXCLUDE (record_id), r.review_id, r.reviews, r.score
FROM books b JOIN reviews r ON b.book_id = r.book_id""")
    q["books_final"] = with_ctes(["books_final"], """SELECT book_id, book_title, author_id, num_pages, cover_type,
  publish_date, description, genre_ids FROM books_final""")
    q["report_author_counts"] = with_ctes(["books_final"], "SELECT author_name, book_count FROM rep1",
                                          [_author_counts_literal()])
    q["report_genre_counts"] = with_ctes(["books_final"], """SELECT g.genre_name, x.book_count
FROM (SELECT gid AS genre_id, count(*) AS book_count
      FROM (SELECT unnest(genre_list) AS gid FROM books_final) GROUP BY gid) x
JOIN genres g ON x.genre_id = g.genre_id""")
    q["report_title_ratings"] = with_ctes(["ratings"], """SELECT book_title,
  round(avg(CAST(rating AS DOUBLE)), 6) AS average_rating,
  CAST(sum(num_ratings) AS BIGINT) AS total_ratings,
  CAST(sum(num_reviews) AS BIGINT) AS total_reviews
FROM ratings GROUP BY book_title""")
    q["report_top20"] = with_ctes(
        ["books_final"],
        "SELECT author_name, book_count FROM rep1 ORDER BY book_count DESC, author_name ASC LIMIT 20",
        [_author_counts_literal()])
    str_cols = {"book_title", "cover_type", "description", "genre_ids"}
    bf_cols = ["book_id", "book_title", "author_id", "num_pages", "cover_type", "publish_date",
               "description", "genre_ids"]
    sel = ", ".join(f"NULLIF({c}, '') AS {c}" if c in str_cols else c for c in bf_cols)
    q["csv_split_roundtrip"] = q["csv_roundtrip"] = with_ctes(["books_final"], f"SELECT {sel} FROM books_final")
    q["csv_skip_bad"] = with_ctes(["raw"], """SELECT NULLIF(COALESCE("_id", ''), '') AS record_id,
  NULLIF(COALESCE("Title", ''), '') AS title, NULLIF(COALESCE("Genres", ''), '') AS genres
FROM raw
WHERE strpos(COALESCE("_id", '') || COALESCE("Title", '') || COALESCE("Genres", ''), ',') = 0""")
    counted = {"authors": "authors", "book_genres": "book_genres", "book_ratings": "book_ratings", "books": "books_final",
               "genres": "genres", "ratings": "ratings", "reviews": "reviews"}
    q["export_star"] = with_ctes(list(counted.values()), "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, 1::BIGINT AS files FROM {t}" for name, t in counted.items()))
    columns = {"authors": ["author_id", "author_name"], "book_genres": ["book_id", "genre_id"], "book_ratings": ["book_id", "rating_id"], "books": bf_cols,
               "genres": ["genre_id", "genre_name"], "ratings": RATING_COLS, "reviews": ["review_id", "book_id", "reviews", "score"]}
    q["export_census"] = with_ctes(list(counted.values()), "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM {t}"
        for name, t in counted.items() for c in columns[name]))
    q["load_authors"] = with_ctes(["authors"], "SELECT author_id, author_name FROM authors")
    sel2 = ", ".join(f"NULLIF({c}, '') AS {c}" if c in str_cols else c for c in bf_cols if c != "book_id")
    spoiled = ("CASE WHEN book_id % 13 = 0 THEN TRY_CAST('2024-02-3' || substr(CAST(publish_date AS VARCHAR), 10, 1) AS DATE) "
               "WHEN book_id % 17 = 0 THEN NULL ELSE publish_date END AS publish_date")
    sel2 = sel2.replace(", publish_date,", f", {spoiled},")
    q["load_books"] = with_ctes(["books_final"], f"SELECT {sel2} FROM books_final")
    q["load_ratings"] = with_ctes(["ratings"], f"""SELECT {', '.join(RATING_COLS)} FROM ratings
WHERE rating_id NOT IN (SELECT rating_id FROM ratings WHERE num_ratings = 0)""")
    q["load_reviews"] = with_ctes(["reviews"], """SELECT book_id, reviews, score FROM reviews
WHERE book_id IN (SELECT book_id FROM books)""")
    q["load_reviews_orphans"] = with_ctes(["reviews"], """SELECT book_id, reviews, score FROM reviews
WHERE book_id IN (SELECT book_id FROM books WHERE cover_type <> 'Hardcover')""")
    q["load_book_genres_orphans"] = with_ctes(["book_genres"], """SELECT book_id, genre_id FROM book_genres
WHERE genre_id IN (SELECT genre_id FROM genres WHERE genre_name NOT LIKE ' %')""")
    q["load_book_genres"] = with_ctes(["book_genres"], """SELECT book_id, genre_id FROM book_genres
WHERE genre_id IN (SELECT genre_id FROM genres)""")
    q["load_book_ratings"] = with_ctes(["book_ratings"], """SELECT book_id, rating_id FROM (
  SELECT book_id, row_number() OVER (ORDER BY book_id NULLS FIRST, rating_id NULLS FIRST) AS rating_id
  FROM book_ratings) x
WHERE rating_id IN (SELECT rating_id FROM ratings) AND book_id IN (SELECT book_id FROM books)""")
    q["stream_clean"] = q["stream_clean_twice"] = with_ctes(["cleaned"], "SELECT * EXCLUDE (record_id) FROM cleaned")
    q["append_twice"] = "SELECT *, 'batch-' || (l_orderkey % 3) AS batch FROM lineitem WHERE l_orderkey % 3 < 2"
    none = "CAST(NULL AS DOUBLE) AS average_rating, CAST(NULL AS BIGINT) AS total_ratings, CAST(NULL AS BIGINT) AS total_reviews"
    q["report_two_deliveries"] = with_ctes(["cleaned"], f"""SELECT 'author' AS report, author AS name, count(*) AS book_count, {none} FROM cleaned GROUP BY author
UNION ALL SELECT 'genre', genre_name, count(*), {none} FROM (SELECT unnest(string_split(genres, ',')) AS genre_name FROM cleaned) GROUP BY 2
UNION ALL SELECT 'title', title, NULL, round(avg(CAST(rating AS DOUBLE)), 6), CAST(sum(num_ratings) AS BIGINT), CAST(sum(reviews) AS BIGINT)
FROM cleaned GROUP BY title""")
    return q
