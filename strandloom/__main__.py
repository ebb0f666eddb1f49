"""``python -m strandloom COMMAND SETTINGS``: runs, single steps, quick tests, checks of settings."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace
from pathlib import Path

from strandloom.plans.config import ConfigError
from strandloom.sources import settings

STEPS = ("extract", "correct", "dedup", "matrix", "pair-map", "downsample", "report")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strandloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", *STEPS, "summary", "quick-test", "validate-config", "init-config"):
        one = commands.add_parser(name)
        one.add_argument("settings", help="the settings' file")
        if name not in ("validate-config", "init-config"):
            one.add_argument("--sample", action="append", default=[], help="only this sample, into an output folder of its own name")
        if name in ("run", *STEPS):
            one.add_argument("--overwrite", action="store_true", help="do steps again that were done before")
        if name == "run":
            one.add_argument("--skip-quick-test", action="store_true")
        if name == "quick-test":
            one.add_argument("--reads", type=int)
    return parser


def chosen(run: settings.Run, names: list[str]) -> settings.Run:
    """The run over some of its samples."""
    if not names:
        return run
    if unknown := set(names) - set(run.samples):
        raise ConfigError(f"no sample {', '.join(sorted(unknown))}")
    kept = {k: v for k, v in run.samples.items() if k in names}
    return replace(run, samples=kept, output=f"{run.output}/{'+'.join(kept)}")


def work(args: argparse.Namespace) -> None:
    if args.command == "init-config":
        with Path(args.settings).open("x") as new:  # never over a file
            new.write(settings.EXAMPLE)
        return
    run = settings.load(args.settings)
    if args.command == "validate-config":
        print(f"{len(run.samples)} samples, {len(run.plan.segments)} segments: good")
        return
    from pyspark.sql import SparkSession

    from strandloom.plans.steps import Job, quick_test
    from strandloom.plans.tables import scope

    run = chosen(run, args.sample)
    spark = SparkSession.builder.appName("strandloom").getOrCreate()
    job = Job(spark, run)
    again = run.overwrite or getattr(args, "overwrite", False)
    if args.command == "quick-test" or (args.command == "run" and run.quick_reads and not args.skip_quick_test):
        with scope(spark):
            job.shown_whole(quick_test(spark, run, getattr(args, "reads", None)), "quick_test")
    if args.command == "run":
        job.run = replace(run, overwrite=again)
        job.run_all()
    elif args.command == "summary":
        job.run_step("report", again=True)
    elif args.command in STEPS:
        job.run_step(args.command, again)


def main(given: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s\t%(levelname)s\t%(message)s")
    try:
        work(arguments().parse_args(given))
    except (ConfigError, FileExistsError) as error:
        print(f"strandloom: {error}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
