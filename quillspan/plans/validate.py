"""Comparison of two result tables: exact, tolerant, and the domain-agreement rubric."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as lk


def exact_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with their side; repeats count."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def tolerant_differences(a: DataFrame, b: DataFrame, keys: list[str], values: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Rows by key that are on one side only or differ beyond the tolerance."""
    x = a.select(*keys, *[F.col(v).alias(f"{v}_a") for v in values], F.lit(1).alias("in_a"))
    y = b.select(*keys, *[F.col(v).alias(f"{v}_b") for v in values], F.lit(1).alias("in_b"))
    both = x.join(y, keys, "full_outer")
    off = F.col("in_a").isNull() | F.col("in_b").isNull()
    for v in values:
        off = off | (F.abs(F.col(f"{v}_a") - F.col(f"{v}_b")) > tolerance) | (F.col(f"{v}_a").isNull() != F.col(f"{v}_b").isNull())
    return both.filter(off).drop("in_a", "in_b")


def collapse_space(rows: DataFrame, column: str = "value") -> DataFrame:
    """Lines with runs of white space as one space, for comparison."""
    return rows.withColumn(column, F.trim(F.regexp_replace(column, r"\s+", " ")))


def backend_differences(a: DataFrame, b: DataFrame, z: float = 0.5, n: float = 5, q: float = 0.05) -> DataFrame:
    """One row of counts over templates of either backend: shared, on one side, and beyond each tolerance."""
    x, y = (d.select("template", *[F.col(c).alias(f"{c}{s}") for c in ("z", "n", "q")]) for d, s in ((a, 1), (b, 2)))
    both = x.join(y, "template", "full_outer")
    far = lambda c, t: F.count_if(F.abs(F.col(f"{c}1") - F.col(f"{c}2")) > t)
    return both.agg(F.count_if(F.col("z1").isNotNull() & F.col("z2").isNotNull()).alias("shared"), F.count_if(F.col("z2").isNull()).alias("left_only"), F.count_if(F.col("z1").isNull()).alias("right_only"), far("z", z).alias("z_far"), far("n", n).alias("n_far"), far("q", q).alias("q_far"))


def rubric(matches: DataFrame, counts: DataFrame) -> DataFrame:
    """Eight rates: ``matches`` has one row per left domain (jaccard, same_t, same_judge; null without a match), ``counts`` one per protein (n_a, n_b)."""
    m = matches.agg(
        F.avg((F.coalesce("jaccard", F.lit(0.0)) >= 0.8).cast("double")).alias("jaccard_80"), F.avg(F.coalesce("jaccard", F.lit(0.0))).alias("mean_jaccard"),
        F.avg(F.when(F.col("jaccard") >= 0.2, F.col("same_t").cast("double"))).alias("t_agreement"), F.avg(F.when(F.col("jaccard") >= 0.2, F.col("same_judge").cast("double"))).alias("judge_agreement"),
        F.avg((F.coalesce("jaccard", F.lit(0.0)) < 0.2).cast("double")).alias("missed"),
    )
    c = counts.agg((F.sum("n_b") / F.sum("n_a")).alias("count_ratio"), F.avg((F.col("n_a") == F.col("n_b")).cast("double")).alias("same_count"), F.avg((F.abs(F.col("n_a") - F.col("n_b")) <= 1).cast("double")).alias("within_one"))
    return m.crossJoin(c)  # one row each


def protein_score(rows: DataFrame) -> DataFrame:
    """33/33/34 points for equal domain counts, mean Jaccard and equal classes."""
    return rows.withColumn("score", F.when(F.col("n_a") == F.col("n_b"), 33.0).otherwise(0.0) + 33.0 * F.col("mean_jaccard") + 34.0 * F.col("same_class"))


def shared_proteins(a: DataFrame, b: DataFrame) -> DataFrame:
    """Proteins that both tables have."""
    return a.select("protein").intersect(b.select("protein"))


def report(differences: DataFrame, stages: DataFrame) -> DataFrame:
    """(step, critical, differences, verdict) of every compared stage: without a difference it passes, else it fails if it is critical and warns if not.

    ``differences``: step (a row for each); ``stages``: step, critical.
    """
    n = differences.groupBy("step").agg(F.count(F.lit(1)).alias("differences"))
    rows = stages.join(n, "step", "left").fillna(0, ["differences"])
    return rows.select("step", "critical", "differences", F.when(F.col("differences") == 0, "pass").when(F.col("critical"), "fail").otherwise("warn").alias("verdict"))


def with_jaccard(pairs: DataFrame, a: str = "resids_a", b: str = "resids_b") -> DataFrame:
    return pairs.withColumn("jaccard", lk.jaccard(a, b))
