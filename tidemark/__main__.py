"""Command line: ``spark-submit``-able steps of the pipeline.

    python -m tidemark ingest --servers host:9092 --bronze B --checkpoints C [--once]
    python -m tidemark silver --bronze B --silver S [--reparse]
    python -m tidemark follow --bronze B --silver S --checkpoints C [--once]
    python -m tidemark gold   --silver S --gold G
    python -m tidemark history --bronze B --gold G [--slices 256]
    python -m tidemark show   --silver S --select fct_orders --limit 5
    python -m tidemark audit  --bronze B
    python -m tidemark check  --silver S [--bronze B]
    python -m tidemark quarantine --bronze B
    python -m tidemark compact --bronze B [--before 2024-05-01]
"""

from __future__ import annotations

import argparse

from tidemark.operators import quality
from tidemark.operators.skew import SLICES
from tidemark.plans import pipeline
from tidemark.schemas import TABLES
from tidemark.session import get_session
from tidemark.streaming import jobs
from tidemark.streaming.messages import kafka_messages


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidemark")
    steps = parser.add_subparsers(dest="step", required=True)
    needs = {
        "ingest": ("servers", "bronze", "checkpoints"),
        "silver": ("bronze", "silver"),
        "follow": ("bronze", "silver", "checkpoints"),
        "gold": ("silver", "gold"),
        "history": ("bronze", "gold"),
        "show": ("silver", "select"),
        "audit": ("bronze",),
        "check": ("silver",),
        "quarantine": ("bronze",),
        "compact": ("bronze",),
    }
    for step, options in needs.items():
        sub = steps.add_parser(step)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        if step in ("ingest", "follow"):
            sub.add_argument("--once", action="store_true", help="take what is there, then stop")
            sub.add_argument("--every", default="5 seconds", help="time between micro-batches")
        if step == "ingest":
            sub.add_argument(
                "--max-offsets", type=int, default=5_000_000, help="most messages in a micro-batch"
            )
        if step == "silver":
            sub.add_argument("--reparse", action="store_true", help="read all messages again")
        if step == "history":
            sub.add_argument("--slices", type=int, default=SLICES, help="shares of events per task")
        if step == "check":
            sub.add_argument("--bronze", help="check the status chain of this log too")
        if step == "compact":
            sub.add_argument("--before", help="days before this one; by default all but today")
        if step == "show":
            sub.add_argument("--limit", type=int, default=5)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = get_session()
    if args.step in ("ingest", "follow"):
        trigger = jobs.ALL_THERE_IS if args.once else {"processingTime": args.every}
        if args.step == "ingest":
            # One reader per table: each topic advances on its own.
            queries = [
                query
                for name in TABLES
                for query in pipeline.start_ingest(
                    kafka_messages(spark, args.servers, [name], max_offsets=args.max_offsets),
                    args.bronze, args.checkpoints, [name], trigger,
                )
            ]
        else:
            queries = pipeline.start_silver(
                spark, args.bronze, args.silver, args.checkpoints, trigger=trigger
            )
        for query in queries:
            query.awaitTermination()
    elif args.step == "silver":
        print(pipeline.build_silver(spark, args.bronze, args.silver, reparse=args.reparse))
    elif args.step == "gold":
        print(pipeline.build_gold(spark, args.silver, args.gold))
    elif args.step == "history":
        print(pipeline.build_history(spark, args.bronze, args.gold, args.slices))
    elif args.step == "show":
        pipeline.show_model(spark, args.silver, args.select, args.limit).show(args.limit, False)
    elif args.step == "audit":
        pipeline.audit_bronze(spark, args.bronze).show(truncate=False)
    elif args.step == "check":
        report = quality.collected(pipeline.check_silver(spark, args.silver, args.bronze))
        report.show(1000, False)
        quality.enforce(report)
    elif args.step == "quarantine":
        pipeline.quarantined(spark, args.bronze).show(1000, False)
    elif args.step == "compact":
        print(pipeline.compact_bronze(spark, args.bronze, args.before))


if __name__ == "__main__":
    main()
