"""Summarise the physical plan of every registered query (PLANS.md).

For each query: shuffles (hash / range / single-partition exchanges),
broadcasts, join strategies, aggregates and what each parquet scan reads
(ReadSchema) and pushes down (PushedFilters).  Keyed tables that a query
reads were written before the query runs; their build is one range exchange
(the sort), the parquet write and a per-partition count.
"""

from __future__ import annotations

import contextlib
import os
import io
import re
import sys


def summarise(plan: str) -> dict:
    ops = re.findall(r"^\(\d+\) (.+?)\s*$", plan, flags=re.M)
    exchanges = re.findall(r"^Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
                           plan, flags=re.M)
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        if block.startswith("(") and "Scan parquet" in block.splitlines()[0]:
            rs = re.search(r"ReadSchema: struct<(.*)>", block)
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", rs.group(1))] if rs else []
            scans.append((cols, pf.group(1) if pf else ""))
    return {
        "exchanges": exchanges,
        "broadcasts": sum(1 for o in ops if o.startswith("BroadcastExchange")),
        "joins": [o for o in ops if "Join" in o],
        "aggregates": sum(1 for o in ops if "Aggregate" in o),
        "scans": scans,
    }


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from starloom import build_session
    from starloom.catalog import queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `python tools_plans.py` on `{sf}` (AQE initial plans; sizes do not change",
           "the operators chosen here because static broadcasts are off and only measured sides are",
           "broadcast). Shuffles: `H` hash, `R` range, `1` single partition, `RR` round robin.", "",
           "| query | shuffles | broadcasts | joins | aggregates | parquet scans: columns read [pushed filters] |",
           "|---|---|---|---|---|---|"]
    short = {"hashpartitioning": "H", "rangepartitioning": "R", "SinglePartition": "1",
             "RoundRobinPartitioning": "RR"}
    for name, fn in sorted(queries().items()):
        df = fn(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        s = summarise(buf.getvalue())
        shuffles = " ".join(short[e] for e in s["exchanges"]) or "none"
        joins = ", ".join(sorted(set(j.replace(" BuildRight", "").replace(" BuildLeft", "") for j in s["joins"]))) or "-"
        scans = "; ".join(f"{','.join(c)}" + (f" [{f}]" if f else "") for c, f in s["scans"]) or "-"
        out.append(f"| `{name}` | {shuffles} | {s['broadcasts']} | {joins} | {s['aggregates']} | {scans} |")
    out += ["", "## Notes", "",
            "* Keyed tables are parquet written by `assign_dense_key` with their key in it; a query
  reads only the columns it needs from them.
* `bridge_book_genres`: no shuffle: genre lists are de-duplicated inside each book row and",
            "  the measured genre dictionary is broadcast.",
            "* Reports: one hash shuffle after a partial aggregate, then a range shuffle for the order",
            "  (a `TakeOrderedAndProject` for the top 20).",
            "* `books_genre_names`: no join; `book_rating_details`: one join that makes the pairs and
  carries the book columns; `books_final`: the wide rows meet the regrouped genre ids once
  (no shuffle at all on a star built with `book_buckets`; see `tests/test_plans.py`).
* JOB1's de-duplication is the hash shuffle of `clean_records` and of the reports.
* `semi_filter` / `anti_filter`: sort-merge semi/anti joins here because static broadcasts",
            "  are off; AQE turns them into broadcast joins at run time when the measured side is small.",
            "* `text_classify` / `text_clean_documents`: the round-robin shuffle spreads a single-split",
            "  source over the task slots; with as many splits as slots it is not added."]
    print("\n".join(out))


if __name__ == "__main__":
    main()
