"""``python -m alembiq JOB --option value ...``: run one job; ``--verbose`` prints its reports."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from . import jobs

JOBS = {f.__name__: f for f in (jobs.phase0, jobs.phase1, jobs.phase2, jobs.phase3, jobs.phase4, jobs.report)}


def parser() -> argparse.ArgumentParser:
    """Options are the parameters of the jobs: a switch for each flag, required where there is no default."""
    out = argparse.ArgumentParser(prog="alembiq")
    some = out.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        one = some.add_parser(name, help=inspect.getdoc(job))
        one.add_argument("--verbose", action="store_true", help="print the reports")
        for p in list(inspect.signature(job).parameters.values())[1:]:
            option = f"--{p.name.replace('_', '-')}"
            if p.default is False:
                one.add_argument(option, action="store_true")
            elif p.default is p.empty:
                one.add_argument(option, required=True)
            else:
                one.add_argument(option, default=p.default, type=str if p.default is None else type(p.default))
    return out


def main(args: list[str] | None = None) -> None:
    given = vars(parser().parse_args(args))
    job, verbose = JOBS[given.pop("job")], given.pop("verbose")
    reports = job(SparkSession.builder.appName(f"alembiq-{job.__name__}").getOrCreate(), **given)
    if verbose:
        for name, df in reports.items():
            print(name)
            df.show(truncate=False)


if __name__ == "__main__":
    main()
