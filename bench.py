"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores. Every query is defined and run to a sink that discards its rows; the better of
two runs counts. The language model is fitted once before that, and its time reported on its own. Besides
the headline queries, which make up the total, it times a build whose anchors belong to one page by a third, and the steady state
over many copies of the crawl (BENCH_COPIES, default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from webloom.plans import catalog, index_build as B  # noqa: E402
from webloom.plans.catalog import QUERIES  # noqa: E402
from webloom.session import local_session  # noqa: E402

HEADLINES = [
    "lang_profile",
    "record_ids",
    "full_text",
    "main_content",
    "doc_title",
    "anchors_by_lang",
    "job_counters",
    "merge_duplicates",
    "index_documents",
    "index_json",
]
RUNS = 2


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def hot_anchors(spark, sf_dir: str):
    """The build with a third of all anchor lines on one page, as flat tables."""
    given = catalog.inputs(spark, sf_dir)
    hot = F.concat(F.lit("clueweb12-en0000-00-00001 "), F.expr("uuid()"), F.lit(" link"))
    lines = given.anchors.select(F.explode(F.array("value", "value", hot)).alias("value"))
    inputs = B.Inputs(given.records, given.spam, given.page_ranks, lines)
    return B.index_tables(inputs, catalog.model(spark, sf_dir), catalog.PREFIX)[1]


def steady(spark, sf_dir: str, copies: int):
    """The pages of ``copies`` crawls, extracted: planning and start-up weigh little here."""
    records = catalog.inputs(spark, sf_dir).records
    many = records.select("key", "value", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("c")).drop("c")
    return B.extract_pages(many, catalog.model(spark, sf_dir), catalog.PREFIX)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    catalog.model(spark, sf_dir)
    fit = round(time.perf_counter() - start, 3)
    best = lambda run: round(min(timed(run) for _ in range(RUNS)), 3)
    seconds = {n: best(lambda n=n: QUERIES[n](spark, sf_dir)) for n in HEADLINES}
    copies = int(os.environ.get("BENCH_COPIES", "8"))
    hot = best(lambda: hot_anchors(spark, sf_dir))
    long = round(timed(lambda: steady(spark, sf_dir, copies)), 3)
    n_pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "pages_per_second": round(n_pages / seconds["index_documents"], 1),
                "fit_seconds": fit,
                "hot_anchors_seconds": hot,
                "steady_pages_per_second": round(copies * n_pages / long, 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
