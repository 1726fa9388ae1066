"""Time alternative plans for the same result, at $BENCH_SF_DIR.

Prints one JSON line: both report strategies, page parsing, upserts of three sizes, and the
checks of one table in one pass against one pass each.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from listlake.functions.calendar import dim_date
from listlake.functions.html import Selector
from listlake.operators import pages as P
from listlake.operators import quality as Q
from listlake.plans import warehouse as W
from listlake.session import build_session, tune, work_dir
from listlake.sources.lake import LakeTable, publish_table
from workload.standins import detail_pages, listing_lake, table


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tune(
        build_session(
            "bench-variants",
            **{
                "spark.master": f"local[{cpus}]",
                "spark.sql.shuffle.partitions": cpus,
                "spark.ui.enabled": "false",
                "spark.driver.memory": "16g",
            },
        )
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}

    def best(name: str, run, repeat: int = 3) -> None:
        seconds = []
        for _ in range(repeat):
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        times[name] = round(min(seconds), 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Inputs are stored first, in as many files as cores, so that only the variants are timed.
    root = work_dir(spark, "variants")
    parts = int(cpus)
    stg = publish_table(W.staging(listing_lake(spark, sf_dir)).repartition(parts), f"{root}/stg")
    pages = publish_table(table(spark, sf_dir, "pages").repartition(parts), f"{root}/pages")
    details = publish_table(detail_pages(spark, sf_dir).repartition(parts), f"{root}/details")
    calendar = dim_date(spark)

    for strategy in ("fused", "star"):
        best(f"report_detail_{strategy}", lambda: drain(W.bi_job_analysis_detail(stg, calendar, strategy)))
    best("report_fused", lambda: drain(W.bi_job_analysis_fused(stg, calendar)))
    best(
        "report_star",
        lambda: drain(W.bi_job_analysis(W.fct_jobs(stg), W.dim_job_details(stg), calendar)),
    )
    best("links", lambda: drain(P.extract_links(pages, Selector(tag="li"))))
    best("detail_page", lambda: drain(P.parse_detail_page(details)))

    source = listing_lake(spark, sf_dir).persist()
    base = LakeTable(spark, f"{root}/lake").create_if_absent()
    base.merge(source)
    for percent in (1, 10, 100):
        # A share of the keys, picked by hash: the variable of this measurement.
        share = F.pmod(F.xxhash64("detail_link"), F.lit(100)) < percent
        changed = source.where(share).withColumn("monthly_salary", F.col("monthly_salary") + 1)
        best(f"upsert_{percent}_percent", lambda: base.merge(changed), 2)

    columns = stg.columns
    best("not_null_one_pass", lambda: drain(Q.dq_not_null(stg, columns)))
    best("not_null_pass_each", lambda: [drain(Q.dq_not_null(stg, [c])) for c in columns])
    spark.stop()
    print(json.dumps({"sf": os.path.basename(sf_dir.rstrip("/")), "seconds": times}))


if __name__ == "__main__":
    main()
