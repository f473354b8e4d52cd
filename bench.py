"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from martloom.session import build_session
from workload import QUERIES

#: Queries that write on their own are timed as they are; the others go to the no-op sink.
HEADLINE = [
    "contacts_mart", "contacts_by_flag", "contacts_by_deal_role", "contacts_by_company_role", "contacts_by_role_dedup",
    "role_multi_explode", "deals_mart", "deals_by_category", "leads_mart", "leads_enriched", "leads_enriched_all",
    "companies_mart", "clean_entity_rows", "clean_connector_rows", "bom_strip", "envelope_rows", "matrix_rows",
    "dedupe_pages", "owner_rows", "product_rows_of_deals", "key_violations", "infer_types", "sync_reconcile",
    "new_rows", "mart_write", "stream_new_rows", "marts_written",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("contacts_mart")  # start-up and class loading are not part of any query
    times = {name: round(run(name), 3) for name in sys.argv[1:] or HEADLINE}
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
