"""Times the headline queries and prints one JSON line.

Every query is written to the no-op sink in full.  One small query warms the
session first; ``cold`` and ``warm`` are the first and the second run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallygraph.plans import QUERIES  # noqa: E402
from tallygraph.session import local_session  # noqa: E402

HEADLINE = [
    "ledger_balance", "order_line_postings", "register_postings", "account_baseline", "document_rollup",
    "resolve_links", "actor_shells", "actor_fill", "cap_per_form", "chart_of_accounts", "op_totals",
    "bounded_batches", "page_report", "page_links", "contacts", "two_source", "jsonld_entities",
    "link_reasons", "sections", "social_profiles", "company_profiles", "apps", "registry_facts",
    "file_passport", "csv_profile", "json_profile", "xml_links", "money_numbers", "dates_mixed", "stream_load",
]


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    timed(spark, "parent_links", sf_dir)
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(spark, name, sf_dir), 3)
        warm[name] = round(timed(spark, name, sf_dir), 3)
    print(json.dumps({"metric": "total warm time of the headline queries", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "cold": cold, "cpus": cpus,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
