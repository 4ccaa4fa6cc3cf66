"""Run state as a table: what is complete, what failed, what is pending; run logs; layout migration."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stage numbers and names, and the stages whose failure halts a protein.
STEPS = [(1, "prepare"), (2, "sequence_search"), (3, "structure_search"), (4, "coverage_cap"), (5, "map_hits"), (6, "candidates"), (7, "iterative_alignment"), (8, "analyse"), (9, "support"), (10, "filter"), (11, "secondary_structure"), (12, "disorder"), (13, "parse_domains"), (15, "features"), (16, "infer"), (17, "confident"), (18, "mapping"), (19, "merge_candidates"), (20, "extract"), (21, "compare"), (22, "merge"), (23, "predictions"), (24, "integrate")]
CRITICAL = (2, 3, 7)


def steps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, name, n in CRITICAL) for n, name in STEPS], "step int, name string, critical boolean")


def latest(events: DataFrame) -> DataFrame:
    """The last status of each (protein, step): ``events`` is append-only (protein, step, status, error, at); of one time a failure counts as the later."""
    return events.groupBy("protein", "step").agg(F.max_by(F.struct("status", "error"), F.struct("at", "status", F.coalesce("error", F.lit("")))).alias("s")).select("protein", "step", "s.*")


def pending(proteins: DataFrame, all_steps: DataFrame, events: DataFrame, step: int) -> DataFrame:
    """Proteins to run at a step: not complete there, and without a failed critical step before."""
    now = latest(events)
    done = now.filter((F.col("step") == step) & (F.col("status") == "complete"))
    halted = now.filter((F.col("step") < step) & (F.col("status") == "failed")).join(all_steps.filter("critical").select("step"), "step", "left_semi")
    return proteins.select("protein").distinct().join(done.select("protein"), "protein", "left_anti").join(halted.select("protein"), "protein", "left_anti")


def summary(events: DataFrame) -> DataFrame:
    """(step, complete, failed) counts."""
    return latest(events).groupBy("step").agg(F.count_if(F.col("status") == "complete").alias("complete"), F.count_if(F.col("status") == "failed").alias("failed"))


def batch_summary(events: DataFrame, proteins: DataFrame) -> DataFrame:
    """(total, success, failed): a protein fails when any step does."""
    bad = latest(events).groupBy("protein").agg(F.max((F.col("status") == "failed").cast("int")).alias("bad"))
    return proteins.select("protein").distinct().join(bad, "protein", "left").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("bad") == 0).alias("success"), F.count_if(F.col("bad") == 1).alias("failed"))


def incomplete(proteins: DataFrame, events: DataFrame, last_step: int) -> DataFrame:
    done = latest(events).filter((F.col("step") == last_step) & (F.col("status") == "complete"))
    return proteins.join(done, "protein", "left_anti")


def retry(events: DataFrame) -> DataFrame:
    """``events`` without the failures: what failed last is pending again, and so is all that it halted."""
    failed = latest(events).filter(F.col("status") == "failed").select("protein", "step")
    return events.join(failed, ["protein", "step"], "left_anti")


def label_counts(rows: DataFrame, label: str) -> DataFrame:
    """(label, n): rows by label."""
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def from_documents(states: DataFrame) -> DataFrame:
    """Events of per-protein JSON states: completed_steps, and failed_steps as a map or (legacy) a list."""
    plain = F.from_json("value", "protein string, completed_steps array<int>, failed_steps map<string,string>")
    listed = F.from_json("value", "failed_steps array<int>")
    rows = states.select("file", plain.alias("j"), listed.alias("k"))
    done = rows.select(F.coalesce("j.protein", "file").alias("protein"), F.explode("j.completed_steps").alias("step"), F.lit("complete").alias("status"), F.lit(None).cast("string").alias("error"))
    failed = rows.select(F.coalesce("j.protein", "file").alias("protein"), F.explode("j.failed_steps").alias("step", "error")).select("protein", F.col("step").cast("int"), F.lit("failed").alias("status"), "error")
    legacy = rows.filter("j.failed_steps is null").select(F.coalesce("j.protein", "file").alias("protein"), F.explode("k.failed_steps").alias("step")).select("protein", "step", F.lit("failed").alias("status"), F.lit(None).cast("string").alias("error"))
    return done.unionByName(failed).unionByName(legacy)


def to_document(events: DataFrame) -> DataFrame:
    """One JSON state per protein."""
    now = latest(events)
    done = F.array_sort(F.collect_list(F.when(F.col("status") == "complete", F.col("step"))))
    failed = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("status") == "failed", F.struct(F.col("step").cast("string"), F.coalesce("error", F.lit("")))))))
    return now.groupBy("protein").agg(done.alias("completed_steps"), failed.alias("failed_steps")).select("protein", F.to_json(F.struct("protein", "completed_steps", "failed_steps")).alias("value"))


def log_line(protein: str, step: int, message: str, seconds: float | None = None) -> str:
    """A structured log line; lines are read back with ``logs``."""
    return json.dumps({"protein": protein, "step": step, "message": message, "duration": seconds})


def logs(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", "protein string, step int, message string, duration double").alias("j")).select("j.*")


def durations(run_log: DataFrame) -> DataFrame:
    """(step, runs, mean, longest) of logged durations."""
    return run_log.filter("duration is not null").groupBy("step").agg(F.count(F.lit(1)).alias("runs"), F.avg("duration").alias("mean"), F.max("duration").alias("longest"))


def classify_files(files: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(file, protein, step): the longest matching suffix decides; unknown files go. ``suffixes``: suffix, step (a fixed table of formats)."""
    both = files.join(suffixes, F.expr("endswith(file, suffix)"))
    best = F.row_number().over(Window.partitionBy("file").orderBy(F.length("suffix").desc()))
    rows = both.withColumn("place", best).filter("place = 1")
    return rows.select("file", F.expr("substring(file, 1, length(file) - length(suffix))").alias("protein"), "step")


def step_folder(root: str, step: int, sharded: bool = True) -> str:
    """Where a step's files are: a folder of its own, or the root in the flat layout and for unknown steps."""
    names = dict(STEPS)
    return f"{root}/step{step:02d}_{names[step]}" if sharded and step in names else root


def is_sharded(files: DataFrame) -> bool:
    """Whether a listing (file: path below the root) has the folder of the first step."""
    return files.filter(F.col("file").startswith(f"step{STEPS[0][0]:02d}_{STEPS[0][1]}/")).limit(1).count() > 0


def migration_plan(files: DataFrame, suffixes: DataFrame, proteins: DataFrame, shared: tuple[str, ...] = (), dual: tuple[int, ...] = (24,)) -> DataFrame:
    """(file, protein, step, action, target) that takes a flat listing to a folder per step: a dry run.

    Known files of wanted proteins move to their step's folder; results of ``dual`` steps are copied to
    ``results`` as well; names of ``shared`` folders move below ``_batch``; all else stays (skip).
    """
    known = classify_files(files, suffixes).join(proteins.select("protein").distinct(), "protein", "left_semi")
    folders = F.create_map(*[F.lit(x) for n, name in STEPS for x in (n, f"step{n:02d}_{name}")])
    move = known.withColumn("action", F.lit("move")).withColumn("target", F.concat(F.try_element_at(folders, F.col("step")), F.lit("/"), "file")).filter("target is not null")
    copy = known.filter(F.col("step").isin(*dual)).withColumn("action", F.lit("copy")).withColumn("target", F.concat(F.lit("results/"), "file"))
    rest = files.join(move.select("file"), "file", "left_anti").withColumns({"protein": F.lit(None).cast("string"), "step": F.lit(None).cast("int")})
    is_shared = F.split("file", "/")[0].isin(*shared) if shared else F.lit(False)
    rest = rest.withColumn("action", F.when(is_shared, "move").otherwise("skip")).withColumn("target", F.when(is_shared, F.concat(F.lit("_batch/"), "file")).otherwise(F.col("file")))
    cols = ["file", "protein", "step", "action", "target"]
    return move.select(*cols).unionByName(copy.select(*cols)).unionByName(rest.select(*cols))


def job_script(name: str, inputs: str, out: str, executors: int = 10, cores: int = 4, memory: str = "16g", until: int = 24, shared: str = "", extra: dict[str, str] | None = None) -> str:
    """A submission script of one run over all proteins; ``shared`` is the cluster's checkpoint folder."""
    conf = {"spark.sql.adaptive.enabled": "true", "spark.checkpoint.dir": shared or f"{out}/_shared"} | (extra or {})
    flags = [f"--name {name}", "--deploy-mode cluster", f"--num-executors {executors}", f"--executor-cores {cores}", f"--executor-memory {memory}", *[f"--conf {k}={v}" for k, v in sorted(conf.items())]]
    return "#!/bin/sh\nset -eu\nexec spark-submit \\\n  " + " \\\n  ".join(flags) + f" \\\n  -m quillspan.cli run {inputs} {out} --until {until}\n"


def clean_plan(files: DataFrame, remove: list[str], preserve: list[str]) -> DataFrame:
    """Files that match a removal pattern and no preserved one (regular expressions): a dry run."""
    gone = F.lit(False)
    for p in remove:
        gone = gone | F.col("file").rlike(p)
    for p in preserve:
        gone = gone & ~F.col("file").rlike(p)
    return files.filter(gone)
