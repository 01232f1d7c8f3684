"""Time the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries import load_all, standins  # noqa: E402
from queries.registry import QUERIES, Inputs  # noqa: E402
from shelfmark.session import local_session  # noqa: E402

HEADLINE = [
    "c1_normalize_text", "c18_clean_documents", "c10_normalize_genres", "c11_normalize_publishers",
    "c14_normalize_publish_date", "d1_first_document_per_text", "k1_part_identifier", "k3_assign_ids",
    "j1_inner_join", "j4_either_key_join", "j5_membership_join", "w1_g10_ranked_pivot", "g2_group_totals",
    "g3_grouped_distinct", "g11_average_rating", "run_cleaning", "n6_n7_book_isbn", "n8_author_isbn",
    "n11_book_isbn_genre", "v4_check_unique", "v5_check_foreign_key", "a2_book_log", "h1_clean_sales",
    "h7_fill_avg_rating", "h13_monthly_fact", "r11_sales_by_first_author", "r13_top_books", "r14_monthly_trend",
    "r15_top_authors", "r18_wide_fact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "shelfmark-bench")
    load_all()
    from queries import normalised, star
    # Not timed: start-up, the stand-in files the jobs read, and the star, lookups and link that several queries share.
    inputs = Inputs(spark, sf_dir)
    for make in (standins.raw_books, standins.staging, standins.books, standins.raw_sales, star.star, normalised.lookups, normalised.linked):
        make(inputs)
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
