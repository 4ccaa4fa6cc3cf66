"""Feature assembly, batch inference and confidence labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as lk


def best_per_template(rows: DataFrame, score: str) -> DataFrame:
    """The best overlapping hit per (protein, domain, template); of equals the first."""
    w = Window.partitionBy("protein", "domain", "template").orderBy(F.col(score).desc(), "line_no")
    return rows.withColumn("place", F.row_number().over(w)).filter("place = 1").drop("place")


def consensus(both: DataFrame, hh_query: str, hh_template: str, st_query: str, st_template: str, length: str) -> DataFrame:
    """Adds ``consensus_diff`` (mean distance of the template positions of shared query residues; -1 without) and ``consensus_cov``."""
    place = lambda q, t, x: F.get(F.col(t), F.array_position(q, x).cast("int") - 1)
    common = F.array_intersect(hh_query, st_query)
    rows = both.withColumn("common", common)
    diffs = F.filter(F.transform("common", lambda x: F.abs(place(hh_query, hh_template, x) - place(st_query, st_template, x))), lambda d: d.isNotNull())
    rows = rows.withColumn("diffs", diffs)
    mean = F.aggregate("diffs", F.lit(0.0), lambda a, d: a + d) / F.size("diffs")
    return rows.withColumn("consensus_diff", F.when(F.size("diffs") > 0, mean).otherwise(-1.0)).withColumn("consensus_cov", F.size("common") / F.col(length)).drop("common", "diffs")


def rank_floor(top: Column | str, least: float = 10.0) -> Column:
    """What a missing rank counts: the greatest one of the protein, ``least`` at least."""
    return F.greatest(F.coalesce(top, F.lit(least)), F.lit(least))


def features(hh: DataFrame, st: DataFrame, max_ranks: DataFrame) -> DataFrame:
    """One row per (protein, domain, template) found by either method, with the defaults of the other.

    ``hh``: protein, domain, template, hh_prob, hh_cov, hh_rank, hq, ht (arrays), length. ``st``: protein,
    domain, template, z, q, ztile, qtile, st_rank, sq, stt (arrays), length. ``max_ranks``: protein, max_hh, max_st.
    """
    keys = ["protein", "domain", "template"]
    both = hh.withColumn("has_hh", F.lit(True)).join(st.withColumn("has_st", F.lit(True)).withColumnRenamed("length", "st_length"), keys, "full_outer")
    both = both.withColumn("length", F.coalesce("length", "st_length")).join(max_ranks, "protein", "left")
    empty = F.array().cast("array<int>")
    for c in ("hq", "ht", "sq", "stt"):
        both = both.withColumn(c, F.coalesce(c, empty))
    both = consensus(both, "hq", "ht", "sq", "stt", "length")
    found = F.col("has_hh") & F.col("has_st")
    out = [F.coalesce(c, F.lit(d)).alias(c) for c, d in (("hh_prob", 0.0), ("hh_cov", 0.0), ("z", 0.0), ("q", 0.0), ("ztile", 10.0), ("qtile", 10.0))]
    out += [F.coalesce("hh_rank", rank_floor("max_hh")).alias("hh_rank"), F.coalesce("st_rank", rank_floor("max_st")).alias("st_rank")]
    out += [F.when(found, F.col("consensus_diff")).otherwise(-1.0).alias("consensus_diff"), F.when(found, F.col("consensus_cov")).otherwise(0.0).alias("consensus_cov")]
    return both.select(*keys, "length", *out)


def synthetic_weights(inputs: int, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Deterministic weights on a coarse grid for tests and demonstrations (trained ones are an input)."""
    rng = np.random.default_rng(seed)
    grid = lambda *shape: rng.integers(-8, 9, shape) / 16.0
    return {"w1": grid(inputs, hidden), "b1": grid(hidden), "w2": grid(hidden, 2), "b2": grid(2)}


def mlp(rows: DataFrame, columns: list[str], weights: dict[str, np.ndarray], name: str = "prob") -> DataFrame:
    """Adds the class-1 probability of a one-hidden-layer network, in Arrow batches; weights travel once per worker."""

    @F.pandas_udf("double")
    def infer(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in batches:
            x = np.stack([c.to_numpy(np.float32) for c in cols], axis=1).astype(np.float64)
            z = np.maximum(x @ weights["w1"] + weights["b1"], 0) @ weights["w2"] + weights["b2"]
            yield pd.Series(1 / (1 + np.exp(z[:, 0] - z[:, 1])))

    return rows.withColumn(name, infer(*columns))


def mlp_column(columns: list[str], weights: dict[str, np.ndarray]) -> Column:
    """The same network as a column expression (JVM-side, for narrow networks)."""
    w1, b1, w2, b2 = (weights[k].tolist() for k in ("w1", "b1", "w2", "b2"))
    hidden = [F.greatest(sum((F.col(c) * w1[i][j] for i, c in enumerate(columns)), F.lit(b1[j])), F.lit(0.0)) for j in range(len(b1))]
    out = [sum((h * w2[j][k] for j, h in enumerate(hidden)), F.lit(b2[k])) for k in range(2)]
    return 1 / (1 + F.exp(out[0] - out[1]))


def best_per_topology(predictions: DataFrame) -> DataFrame:
    """(protein, domain, tgroup, best): the greatest probability of each topology."""
    return predictions.groupBy("protein", "domain", "tgroup").agg(F.max("prob").alias("best"))


def prediction_summary(predictions: DataFrame, least: float = 0.6) -> DataFrame:
    """One row: number, least, greatest, mean and middle probability, and the share of ``least`` or more."""
    return predictions.agg(F.count(F.lit(1)).alias("n"), F.min("prob").alias("lowest"), F.max("prob").alias("highest"), F.avg("prob").alias("mean"), F.median("prob").alias("middle"), F.avg((F.col("prob") >= least).cast("double")).alias("share"))


def confident(predictions: DataFrame, least: float = 0.6, near: float = 0.05) -> DataFrame:
    """Predictions of probability ``least`` or more with their domain's label ``quality``.

    Topologies within ``near`` of the domain's best decide: one is good, one family is ok, else bad.
    """
    per = best_per_topology(predictions)
    top = per.withColumn("top", F.max("best").over(Window.partitionBy("protein", "domain"))).filter(F.col("best") >= F.col("top") - near)
    label = top.groupBy("protein", "domain").agg(lk.confidence_label(F.count_distinct("tgroup"), F.count_distinct(lk.hierarchy_prefix("tgroup", 2))).alias("quality"))
    return predictions.filter(F.col("prob") >= least).join(label, ["protein", "domain"])
