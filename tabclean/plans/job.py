"""Batch job: `spark-submit tabclean/plans/job.py IN OUT [--strategy mode]`."""

from __future__ import annotations

import argparse

from tabclean.plans import state
from tabclean.plans.sales import CleanConfig, audit, clean_sales, drop_marks
from tabclean.operators.impute import drop_snapshot
from tabclean.session import build_session
from tabclean.sources.files import read_table, write_auto
from tabclean.sources.staging import stage, staged_until_end


def run(
    spark, source: str, target: str, strategy: str = "mode", audit_to: str | None = None,
    state_from: str | None = None, state_to: str | None = None,
) -> None:
    """Clean the table at `source` and write it to `target` (CSV or Parquet, by suffix).

    With an audit, the marked table is written once and both results are read from it. With
    `state_to`, what the table tells is added to the state at `state_from`, if there is one,
    and saved; with `state_from` alone, the table is cleaned by that state as it is. Nothing
    staged on the way is left behind.
    """
    with staged_until_end(spark):
        table, config = read_table(spark, source), CleanConfig(strategy=strategy, keep_marks=True)
        known = [state.load(spark, state_from, config)] if state_from else []
        if state_to:
            known = [state.merge(*known, state.fit(table, config))]
            state.save(known[0], state_to)
        marked = state.apply(table, known[0]) if known else clean_sales(table, config)
        if audit_to:
            marked = stage(marked, "marked")
            write_auto(audit(marked), audit_to)
        write_auto(drop_marks(drop_snapshot(marked)), target)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--strategy", default="mode")
    parser.add_argument("--audit", dest="audit_to")
    parser.add_argument("--state-from")
    parser.add_argument("--state-to")
    args = parser.parse_args(argv)
    spark = build_session("tabclean-job")
    run(spark, args.source, args.target, args.strategy, args.audit_to, args.state_from, args.state_to)


if __name__ == "__main__":
    main()
