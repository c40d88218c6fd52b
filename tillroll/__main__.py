"""Command line: run the job, or one of its tasks, as a Spark application.

    python -m tillroll run    --landing L --lake K --as-of 2024-01-01
    python -m tillroll bronze --landing L --lake K
    python -m tillroll realtime --lake K --events E | --servers S --topic T [--every "1 minute"]
    python -m tillroll silver --lake K --as-of 2024-01-01 [--realtime-bronze P]
    python -m tillroll gate   --lake K --as-of 2024-01-01 [--suite-as-of D]
    python -m tillroll gold   --lake K [--export-csv]

Exit code 1 when a data-quality gate fails (landing counts, pass rate or the
Silver suite), so a scheduler stops the downstream tasks.
"""

from __future__ import annotations

import argparse
import json
import sys

from tillroll.operators.dq import DQGateError
from tillroll.plans import pipeline
from tillroll.session import build_session
from tillroll.streaming import realtime


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillroll")
    ap.add_argument("task", choices=["run", "bronze", "realtime", "silver", "gate", "gold"])
    ap.add_argument("--landing")
    ap.add_argument("--lake", required=True)
    ap.add_argument("--as-of")
    ap.add_argument("--suite-as-of")
    ap.add_argument("--realtime-bronze")
    ap.add_argument("--events", help="folder of JSON event files")
    ap.add_argument("--servers", help="broker to read events from")
    ap.add_argument("--topic")
    ap.add_argument("--every", help="keep running on this trigger instead of draining once")
    ap.add_argument("--keep-versions", type=int, default=0)
    ap.add_argument("--pass-rate", type=float, default=0.95)
    ap.add_argument("--freshness-days", type=int, default=3650)
    ap.add_argument("--export-csv", action="store_true")
    ap.add_argument("--null-safe-scd", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session("tillroll-" + a.task)
    try:
        if a.task == "run":
            out = vars(pipeline.run_pipeline(
                spark, a.landing, a.lake, a.as_of, suite_as_of=a.suite_as_of,
                realtime_bronze=a.realtime_bronze, freshness_days=a.freshness_days,
                pass_rate=a.pass_rate, export_csv=a.export_csv, null_safe_scd=a.null_safe_scd,
                keep_versions=a.keep_versions))
        elif a.task == "bronze":
            out = pipeline.run_bronze(spark, a.landing, a.lake)
        elif a.task == "silver":
            out = pipeline.run_silver(spark, a.lake, a.as_of, realtime_bronze=a.realtime_bronze,
                                      pass_rate=a.pass_rate, null_safe_scd=a.null_safe_scd,
                                      keep_versions=a.keep_versions)
        elif a.task == "realtime":
            events = (realtime.kafka_source(spark, a.servers, a.topic) if a.servers
                      else realtime.json_source(spark, a.events))
            query = pipeline.run_realtime(spark, events, a.lake, a.every)
            if a.every:
                query.awaitTermination()
            out = {"realtime_bronze": f"{a.lake.rstrip('/')}/bronze/loyalty_realtime"}
        elif a.task == "gate":
            res = pipeline.run_quality_gate(spark, a.lake, a.as_of, suite_as_of=a.suite_as_of,
                                            freshness_days=a.freshness_days)
            out = {"checks": res.count()}
        else:
            out = pipeline.run_gold(spark, a.lake, export_csv=a.export_csv)
        print(json.dumps(out, default=str))
        return 0
    except DQGateError as e:
        print(f"data-quality gate failed: {e}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
