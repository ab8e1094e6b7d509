"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs once to warm up and then
``BENCH_RUNS`` times; its figure is the best run, every row of the result being computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "superdomain_links", "extract_links", "link_edges", "canonicalize_urls", "resolve_links",
    "robots_filter", "attach_counts", "frontier_order", "bfs_depths", "log_source", "log_totals",
    "status_distribution", "top_domains", "phase_p95", "run_summary", "running_domain_counts",
    "stream_totals", "crawl_order", "page_link_counts", "stream_links",
)
FULL_PAGE = 262144


def full_pages(spark, sf):
    """Pages repeated to the byte cap, spread over all cores and kept: ``page_id, url, html``."""
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    cores = spark.sparkContext.defaultParallelism
    times = F.ceil(F.lit(FULL_PAGE) / F.octet_length("html")).cast("int")
    grown = pages.repartition(cores * 4).withColumn("html", F.repeat("html", times))
    return grown.select("page_id", "url", F.substring("html", 1, FULL_PAGE).alias("html"))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from linkloom.operators.links import extract_links
    from linkloom.session import tune
    from linkloom.workload.queries import all_queries

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)

    def best(make) -> float:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return round(min(times[1:]), 3)

    queries = all_queries()
    seconds = {name: best(lambda name=name: queries[name](spark, sf)) for name in HEADLINE}

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    n, size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    big = full_pages(spark, sf)
    grow = best(lambda: big)
    parse = {}
    for mode in ("robust",):
        seconds[f"full_pages_{mode}"] = best(lambda: extract_links(big, mode=mode))
        parse[mode] = max(seconds[f"full_pages_{mode}"] - grow, 0.001)
    big_size = big.agg(F.sum(F.octet_length("html"))).first()[0]
    rates = {
        "pages_per_sec": round(n / seconds["extract_links"], 1),
        "bytes_per_sec": round(size / seconds["extract_links"]),
        "full_page_ms_per_core": {m: round(1000 * t * int(cpus) / n, 2) for m, t in parse.items()},
        "full_page_bytes_per_sec": {m: round(big_size / t) for m, t in parse.items()},
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": int(cpus),
                "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
