"""Command line over the library: ``python -m quillspan.cli run INPUTS OUT [--until N] [--no-resume]`` and more.

    run        all stages over a folder of input tables (Parquet, one folder per table)
    status     what each stage of a run folder holds
    pending    entities to run at a step, by a table of run events
    clean      files of a listing that a clean-up would remove (a dry run)
    compare    rows in which two result tables differ
    summary    complete and failed entities of each step, by a table of run events
    retry      run events without the failures
    migrate    where the files of a flat listing go in the layout of a folder per step (a dry run)
    script     a submission script of a run

Results are tables: ``--to PATH`` writes the whole result as Parquet, else all rows are printed as they come.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from .plans import stages, state, validate
from .sources.shared import exists

TABLES = ["proteins", "seq_search", "struct_search", "struct_hits", "codes", "errors", "atoms", "chain_map", "templates", "weights", "history", "residue_map", "tgroups"]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quillspan", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    out.add_argument("--to")
    sub = out.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("inputs")
    run.add_argument("out")
    run.add_argument("--until", type=int, default=24)
    run.add_argument("--no-resume", action="store_true")
    run.add_argument("--events")
    status = sub.add_parser("status")
    status.add_argument("out")
    pending = sub.add_parser("pending")
    pending.add_argument("events")
    pending.add_argument("proteins")
    pending.add_argument("--step", type=int, required=True)
    clean = sub.add_parser("clean")
    clean.add_argument("listing")
    clean.add_argument("--remove", action="append", default=[])
    clean.add_argument("--keep", action="append", default=[])
    compare = sub.add_parser("compare")
    compare.add_argument("left")
    compare.add_argument("right")
    compare.add_argument("--keys", default="")
    compare.add_argument("--values", default="")
    compare.add_argument("--tolerance", type=float, default=1e-6)
    for name in ("summary", "retry"):
        sub.add_parser(name).add_argument("events")
    migrate = sub.add_parser("migrate")
    migrate.add_argument("listing")
    migrate.add_argument("suffixes")
    migrate.add_argument("proteins")
    migrate.add_argument("--shared", action="append", default=[])
    script = sub.add_parser("script")
    script.add_argument("name")
    script.add_argument("inputs")
    script.add_argument("out")
    script.add_argument("--executors", type=int, default=10)
    script.add_argument("--memory", default="16g")
    script.add_argument("--until", type=int, default=24)
    return out


def execute(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The command's result table."""
    read = spark.read.parquet
    if args.command == "run":
        tables = {t: read(f"{args.inputs}/{t}") for t in TABLES}
        events = read(args.events) if args.events else None
        made = stages.run(spark, tables, args.out, resume=not args.no_resume, until=args.until, events=events)
        until = stages.ALIASES.get(args.until, args.until)
        return made[[name for step, name, _ in stages.PLAN if step <= until][-1]]
    if args.command == "status":
        rows = [(step, name, exists(spark, f"{args.out}/step{step:02d}_{name}/_SUCCESS")) for step, name, _ in stages.PLAN]
        return spark.createDataFrame(rows, "step int, name string, complete boolean")
    if args.command == "pending":
        return state.pending(read(args.proteins), state.steps(spark), read(args.events), args.step)
    if args.command == "clean":
        return state.clean_plan(spark.read.text(args.listing).withColumnRenamed("value", "file"), args.remove, args.keep)
    if args.command == "summary":
        return state.summary(read(args.events))
    if args.command == "retry":
        return state.retry(read(args.events))
    listed = lambda path: spark.read.text(path).withColumnRenamed("value", "file")
    if args.command == "migrate":
        return state.migration_plan(listed(args.listing), read(args.suffixes), read(args.proteins), tuple(args.shared))
    if args.command == "script":
        return spark.createDataFrame([(state.job_script(args.name, args.inputs, args.out, args.executors, memory=args.memory, until=args.until),)], "value string")
    a, b = read(args.left), read(args.right)
    if args.keys:
        return validate.tolerant_differences(a, b, args.keys.split(","), args.values.split(","), args.tolerance)
    return validate.exact_differences(a, b)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    got = execute(SparkSession.builder.appName("quillspan").getOrCreate(), args)
    if args.to:
        got.write.mode("overwrite").parquet(args.to)
        return
    for row in got.toLocalIterator():
        print(row["value"] if args.command == "script" else json.dumps(row.asDict(True), default=str))


if __name__ == "__main__":
    main()
