"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document has the key E / q: E is a standard exponential drawn from a hash of its id and text,
q its quality weight. Within a source, ascending keys are a weighted sample without replacement. A
source's target holds so many complete epochs of all its documents, and a fractional one: the
prefix, in key order, whose sizes come nearest to what is left.

No source is ever sorted in one task. The prefix sum is found by radix: sizes are added up per
(source, 12-bit digit of the key) with partial sums before the shuffle, the digit where the running
sum crosses the budget is entered, and so on for four digits. What comes out is one key bound per
source, so the selection itself is a filter. Sources may be as many as sites: their sizes, targets
and bounds are tables, and only sums over all of them pass through the driver.

Defined cases: null text is empty (size 0); a null source is a source of its own, last in order;
rows with equal id and text share a key and are taken or left together; empty tables give empty
results; sources without words have target 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import append_columns, broadcast_if_small, scratch, settle, shield, unshield

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
_BITS, _SHIFTS = 48, (36, 24, 12, 0)
_GOOD = np.zeros(256, bool)
_GOOD[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _sizes(col) -> list[np.ndarray]:
    """Words of each text and its quality weight: the share of letters among the bytes of its words, 0.1 at least."""
    data, off = tk.flat(col)
    _, _, first = tk.words(data, off)
    word = tk.sums(tk.IS_WORD[data].astype(np.int64), off)
    good = tk.sums(_GOOD[data].astype(np.int64), off)
    return [np.diff(first).astype(np.int64), np.maximum(good / np.maximum(word, 1), 0.1)]


def _keyed(docs: DataFrame, doc_id: str, source: str, text: str, seed: int, keep: list[str]) -> DataFrame:
    """``keep`` with mix_size, mix_source and the integer key mix_key, ascending with E / q."""
    rows = docs.withColumns({
        "mix_source": F.col(f"`{source}`").cast("string"),
        "mix_hash": F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.col(f"`{text}`")),
    })
    keep = [c for c in keep if c not in ("mix_source", "mix_hash", "mix_size", "mix_quality", "mix_key")]
    rows = append_columns(rows, text, _sizes, [("mix_size", "bigint"), ("mix_quality", "double")], [*keep, "mix_source", "mix_hash"])
    u = (F.shiftrightunsigned("mix_hash", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    key = -F.log(u) / F.col("mix_quality")
    return rows.withColumn("mix_key", F.floor(key / (1 + key) * F.lit(float(1 << _BITS))).cast("bigint")).drop("mix_hash", "mix_quality")


def _ranked(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``place``, the source's number by code point, null last: numbers within ranges and the ranges' sums."""
    order = [F.col("mix_source").isNull(), F.col("mix_source")]
    parts = settle(sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-ranges")
    sums = parts.groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    sums = sums.withColumn("before", F.sum("m").over(Window.orderBy("part")) - F.col("m"))  # a row for each range
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("within", within).join(F.broadcast(sums), "part").select("mix_source", "source_size", (F.col("before") + F.col("within")).alias("place"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(mix_source, source_size, target): ``share`` of all sizes by weight, at most ``most`` times a source's size, the excess reshared.

    A round finds what a unit of weight gets from the budget that the sources at their limit leave,
    and which sources that takes above theirs; those stay there, so rounds end.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = settle(_ranked(sizes).select("mix_source", "source_size", w.alias("weight")), "mix-weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    limit = most * F.col("source_size")
    bound = 0.0  # sources with a limit of less than this per unit of weight are at their limit
    while True:
        at = limit < F.lit(bound) * F.col("weight")
        spent, rest = rows.agg(F.sum(F.when(at, limit)), F.sum(F.when(~at, F.col("weight")))).first()
        per = max(share * total - (spent or 0.0), 0.0) / rest if rest else 0.0
        if not rest or per <= bound:
            break
        bound = per
    return rows.select("mix_source", "source_size", F.least(limit, F.lit(bound) * F.col("weight")).cast("double").alias("target"))


def plan(keyed: DataFrame) -> DataFrame:
    """One row per source: size, target, complete epochs and the key bound of the fractional one (-1: none).

    ``keyed`` has mix_source, mix_size and mix_key, and should be a settled table: it is read five times.
    """
    with scratch() as keep:
        sizes = settle(keyed.groupBy("mix_source").agg(F.sum("mix_size").alias("source_size")), "mix-sizes")
        rows = targets(sizes)
        epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
        rows = rows.withColumn("epochs", epochs).withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
        rows = settle(rows.withColumns({"prefix": F.when(F.col("left") > 0, F.lit(0).cast("bigint")), "bound": F.lit(-1).cast("bigint")}), "mix-plan")
        each = keyed.select("mix_source", "mix_key", "mix_size")
        for shift in _SHIFTS:  # sources with a prefix are still open
            at = rows.filter("prefix is not null").select(F.col("mix_source").alias("at_source"), F.col("prefix").alias("at_prefix"), "left")
            inside = each.join(broadcast_if_small(at), F.col("mix_source").eqNullSafe(F.col("at_source")) & (F.shiftright("mix_key", shift + 12) == F.col("at_prefix")))
            digits = inside.groupBy("at_source", "at_prefix", "left", F.shiftright("mix_key", shift).alias("digit")).agg(F.sum("mix_size").alias("n"))
            ran = F.sum("n").over(Window.partitionBy("at_source").orderBy("digit"))  # at most 4096 digits a source
            cross = digits.withColumn("ran", ran).filter(F.col("ran") > F.col("left")).groupBy("at_source").agg(F.min(F.struct("digit", (F.col("ran") - F.col("n")).alias("before"), "n")).alias("cross"))
            rows = rows.join(broadcast_if_small(settle(cross, "mix-cross")), F.col("mix_source").eqNullSafe(F.col("at_source")), "left")
            opened, crossed = F.col("prefix").isNotNull(), F.col("cross").isNotNull()
            over = F.col("cross.before") + F.col("cross.n") - F.col("left")
            last = F.when(over < F.col("left") - F.col("cross.before"), F.col("cross.digit")).otherwise(F.col("cross.digit") - 1)  # the key that crosses is taken if that is nearer to the budget
            all_fit = (F.shiftleft(F.col("prefix") + 1, shift + 12) - 1).cast("bigint")
            bound = F.when(opened & ~crossed, all_fit).when(crossed & F.lit(shift == 0), last).otherwise(F.col("bound"))
            prefix = F.when(crossed & F.lit(shift > 0), F.col("cross.digit"))
            left = F.when(crossed, F.col("left") - F.col("cross.before")).otherwise(F.col("left"))
            rows = settle(rows.select("mix_source", "source_size", "target", "epochs", left.alias("left"), prefix.cast("bigint").alias("prefix"), bound.cast("bigint").alias("bound")), "mix-plan")
        keep.append(rows)
    return broadcast_if_small(rows.select(F.col("mix_source").alias("plan_source"), "source_size", "target", "epochs", "bound"))


def copies() -> Column:
    """How often the mix takes a document."""
    return F.col("epochs") + (F.col("mix_key") <= F.col("bound")).cast("bigint")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 11) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every document."""
    keyed = settle(_keyed(docs, doc_id, source, text, seed, [doc_id]), "mix")
    out = keyed.join(plan(keyed), F.col("mix_source").eqNullSafe(F.col("plan_source")))
    return out.select(F.col(f"`{doc_id}`"), F.col("mix_size").alias("size"), "source_size", "target", (F.col("mix_size") * copies()).alias("taken"), copies().alias("copies"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))


def stage_mixing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; those it does not take go."""
    shielded, name = shield(docs)
    of = [name[k] for k in ("doc_id", "source", "text")]
    bounds = plan(settle(_keyed(shielded, *of, 11, of[:1]).drop(of[0]), "mix"))
    rows = _keyed(shielded, *of, 11, shielded.columns)
    out = rows.join(bounds, F.col("mix_source").eqNullSafe(F.col("plan_source"))).withColumn("mix_copies", copies())
    return unshield(out.withColumn("mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int")))), docs)
