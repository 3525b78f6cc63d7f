"""Time the whole life of generated tables: ``python benchmarks/generated.py FOLDER [SCALE]``.

Generates the six tables at SCALE of full size (45.5 million rows at 1.0), loads them, copies them as
a snapshot, validates the copy and runs the year and month reports. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trueledger.plans import analytics, jobs, suite  # noqa: E402
from trueledger.session import get_session  # noqa: E402
from trueledger.sources import snapshots, tables  # noqa: E402


def main() -> None:
    root, scale = sys.argv[1], float(sys.argv[2]) if len(sys.argv) > 2 else 0.1
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "generated",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name, run):
        start = time.perf_counter()
        result = run()
        seconds[name] = round(time.perf_counter() - start, 2)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    total = timed("generate_load_verify", lambda: jobs.generate_and_load(spark, f"{root}/source", scale=scale).summary.first())
    source = tables.read_tables(spark, f"{root}/source")
    timed("snapshot", lambda: snapshots.snapshot(spark, source, f"{root}/copy"))
    copy = {name: snapshots.read_version(spark, f"{root}/copy", name) for name in source}
    failed = timed("suite", lambda: suite.run_suite(spark, source, copy).where("status <> 'PASS'").count())
    timed("ledger_by_year", lambda: drain(analytics.ledger_by_year(source["gl_transactions"])))
    timed("monthly_pnl", lambda: drain(analytics.monthly_pnl(source["gl_transactions"], source["chart_of_accounts"], 2023)))
    timed("vendor_payments", lambda: drain(analytics.vendor_payments(source["invoices"], source["vendors"])))
    spark.stop()
    print(json.dumps({"rows": total.total_rows, "gigabytes": float(total.total_gb), "failed_checks": failed, "seconds": seconds}))


if __name__ == "__main__":
    main()
