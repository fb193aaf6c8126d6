"""Command line: `python -m wattloom.plans.cli --raw DIR --out DIR [options]`.

Phases: 1 quality report, 2 message ingest, 3 features and split, 4 models,
5 explanation, 6 validation. Phase 1 reports on the features, so it runs after 3
when both are asked for.
"""

from __future__ import annotations

import argparse
import logging

from wattloom.fixed_values import PERMUTATION_REPEATS, STEP
from wattloom.plans import phases
from wattloom.session import get_session
from wattloom.sources import store

PHASES = [1, 2, 3, 4, 5, 6]


def chosen_phases(only: int | None, start_from: int | None, skip_stream: bool) -> list[int]:
    if only:
        return [only]
    picked = [p for p in PHASES if p >= (start_from or 1)]
    return [p for p in picked if not (skip_stream and p == 2)]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Household sensor analytics on Spark")
    p.add_argument("--raw", help="folder of raw CSV readings")
    p.add_argument("--messages", help="folder of JSON message files (phase 2)")
    p.add_argument("--out", required=True, help="folder for all tables")
    p.add_argument("--only", type=int, choices=PHASES)
    p.add_argument("--start-from", type=int, choices=PHASES)
    p.add_argument("--skip-stream", action="store_true")
    p.add_argument("--step", default=STEP)
    p.add_argument("--repeats", type=int, default=PERMUTATION_REPEATS)
    p.add_argument("--appliances", help="external appliance data (CSV)")
    p.add_argument("--smart-home", help="external smart-home data (CSV)")
    return p


def run(spark, args, grids=None, folds=None) -> list[int]:
    """Run the chosen phases; returns those that ran."""
    picked = chosen_phases(args.only, args.start_from, args.skip_stream or not args.messages)
    order = sorted(picked, key=lambda p: {1: 3.5}.get(p, p))
    for phase in order:
        logging.info("phase %d", phase)
        if phase == 1:
            features = spark.read.parquet(f"{args.out}/features").drop("date")
            store.write_result(phases.quality_report(features), f"{args.out}/results/quality")
        elif phase == 2:
            phases.run_ingest(spark, args.messages, args.out)
        elif phase == 3:
            phases.run_preprocessing(spark, args.raw, args.out, args.step)
            phases.run_split(spark, args.out)
        elif phase == 4:
            phases.run_models(spark, args.out, grids, folds)
        elif phase == 5:
            phases.run_explain(spark, args.out, args.repeats)
        elif phase == 6:
            phases.run_validation(spark, args.out, args.appliances, args.smart_home)
    return order


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parser().parse_args()
    spark = get_session()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
