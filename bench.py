"""Time the headline queries; prints one JSON line.

Every query runs whole (into Spark's noop sink): once to warm up, then three times, of which the
median counts. ``build_star`` is the whole job from raw tables to stored star.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import partial

from starloom.catalogue import queries as catalogue
from starloom.plans.stored import new_folder
from starloom.session import local_session
from starloom.sources.files import write_star

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
HEADLINE = [
    "merge_union_all",
    "merge_keep_first",
    "merge_keep_first_composite",
    "line_total",
    "order_detail_summary",
    "dim_time",
    "dim_customer",
    "dim_product",
    "fact_sales",
    "fact_sales_s",
    "star_join",
    "star_join_fanout",
    "filter_date_range",
    "filter_country_subset",
    "filter_domain_country",
    "kpi_unfiltered",
    "kpi_filtered",
    "revenue_by_month",
    "top_countries",
    "top_customers",
    "top_customers_filtered",
    "top_employees",
    "freight_by_shipper",
    "detail_table",
    "dq_contract",
    "dq_order_gap",
]


def main() -> None:
    spark = local_session(CPUS, memory="16g")
    queries = catalogue.all_queries()

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return time.perf_counter() - start

    def build() -> None:
        write_star(catalogue.build_star(spark, SF_DIR), new_folder(spark, "bench"))

    def query(name: str) -> None:
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    actions = {"build_star": build} | {name: partial(query, name) for name in HEADLINE}
    seconds = {}
    for name, action in actions.items():
        action()
        seconds[name] = statistics.median(timed(action) for _ in range(RUNS))
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
        "runs": RUNS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
