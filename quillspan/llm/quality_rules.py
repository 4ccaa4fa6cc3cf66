"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Base statistics of whole texts are vectorised. Each (language, source) group gets an estimate of
location and scatter over all of its rows; a group of under ``least`` rows gets that of all rows of
its language, and where those are too few, that of all rows.

Three deterministic starts (quartile ranges; correlations of the hyperbolic tangents of standardised
statistics; spatial signs) take concentration steps each: a step bins the squared distances, adds the
moments up per bin (partial sums before the shuffle), and a small grouped map takes the least distant
bins that hold the fraction ``h``. The start whose covariance has the least determinant in the end is
the estimate. A document is rejected when its scaled Mahalanobis distance is beyond the cutoff.

Defined cases: null text is the empty text; null lang or source is a group value of its own;
repeated rows count each; empty tables give empty results; where even all rows are fewer than
``least``, the base rules alone decide.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import append_columns, scratch, settle, shield, unshield

SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b"!?=~_^\\@{}[]")] = True

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["q_lines", "q_upper", "q_marks"]
FIELDS = [(c, "bigint") for c in BASE + EXTRA]

#: Transformed statistics, each with the least standard deviation it is given: a statistic that is
#: constant in a group must not make a single stray character an outlier.
DIMS: list[tuple[str, float]] = [("symbols", 0.4), ("dup_lines", 0.6), ("repeats", 0.6), ("word_length", 0.12), ("upper", 0.5), ("marks", 0.75)]


def statistics(col) -> list[np.ndarray]:
    """BASE and EXTRA counts of each text of an Arrow column."""
    data, off = tk.flat(col)
    starts, ends, first = tk.words(data, off)
    n = len(off) - 1
    n_words = np.diff(first)
    chars = tk.IS_CHAR[data]
    word_chars = tk.sums((chars & tk.IS_WORD[data]).astype(np.int64), off)
    symbols = tk.sums(_IS_SYMBOL[data].astype(np.int64), off)
    upper = tk.sums(_IS_UPPER[data].astype(np.int64), off)
    marks = tk.sums(_IS_MARK[data].astype(np.int64), off)
    doc_salt = tk.mix(np.arange(1, n + 1, dtype=np.uint64))

    ls, le = tk.runs(data != 10, off)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le = ls[has_word], le[has_word]
    line_doc = np.searchsorted(off, ls, "right") - 1
    lines = np.bincount(line_doc, minlength=n) if n else np.zeros(0, np.int64)
    _, where = np.unique(tk.span_hashes(data, ls, le) ^ doc_salt[line_doc], return_index=True)
    distinct = np.bincount(line_doc[where], minlength=n)

    h = tk.span_hashes(data, starts, ends)
    count = np.maximum(n_words - 4, 0)
    at = tk.rows_of(first[:-1], count)
    covered = np.zeros(len(starts), np.int64)
    if len(at):
        full = np.zeros(len(h) - 4, np.uint64)
        for j in range(5):
            full += h[j : len(h) - 4 + j] * tk._MULT[j]
        _, inv, times = np.unique(tk.mix(full[at]) ^ np.repeat(doc_salt, count), return_inverse=True, return_counts=True)
        again = at[times[inv] > 1]
        for j in range(5):
            covered[again + j] = 1
    repeat = tk.sums(covered, first)
    return [x.astype(np.int64) for x in (n_words, word_chars, symbols, lines - distinct, repeat, lines, upper, marks)]


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    return append_columns(docs, text, statistics, FIELDS, keep)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistic vector, in the order of DIMS."""
    w = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    c = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [
        F.asinh(10 * F.col("n_symbols") / w),
        F.asinh(5 * F.col("n_dup_lines") / F.greatest(F.col("q_lines"), F.lit(1))),
        F.asinh(5 * F.col("n_repeat_words") / w),
        F.log(c / w),
        F.asinh(10 * F.col("q_upper") / c),
        F.asinh(10 * F.col("q_marks") / w),
    ]


def chi2_quantile(p: int, z: float) -> float:
    """Wilson-Hilferty: the chi-square quantile with p degrees at the normal quantile z."""
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def lower_gamma(a: float, x: float) -> float:
    """The regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1.0 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def consistency(p: int, h: float) -> float:
    """By what the covariance of the innermost fraction ``h`` of a normal sample of ``p`` dimensions is to be multiplied."""
    low, high = 0.0, 10.0 * p + 100.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if lower_gamma(p / 2, mid / 2) < h else (low, mid)
    return h / lower_gamma(p / 2 + 1, high / 2)


def _g0() -> Column:
    return F.concat_ws("\x1f", F.lit("s"), F.coalesce("q_lang", F.lit("\x00")), F.coalesce("q_source", F.lit("\x00")))


def _grouped(rows: DataFrame, least: int) -> DataFrame:
    """(g0, grp, into): of each (lang, source) the group whose estimate judges it, and the groups that its rows take part in."""
    rows = rows.withColumn("g1", F.concat_ws("\x1f", F.lit("l"), F.coalesce("q_lang", F.lit("\x00"))))
    n = settle(rows.filter("not failed").groupBy("g0", "g1").agg(F.count(F.lit(1)).alias("c0")), "mcd-counts")
    langs = n.groupBy("g1").agg(F.sum("c0").alias("c1"), F.min("c0").alias("smallest"))
    n = n.join(langs, "g1").crossJoin(F.broadcast(n.agg(F.sum("c0").alias("c2"))))  # one row
    n = n.withColumn("grp", F.when(F.col("c0") >= least, F.col("g0")).when(F.col("c1") >= least, F.col("g1")).when(F.col("c2") >= least, F.lit("all")))
    to_lang = (F.col("c1") >= least) & (F.col("smallest") < least)
    n = settle(n.select("g0", "grp", F.when(F.col("c0") >= least, F.col("g0")).alias("a"), F.when(to_lang, F.col("g1")).alias("b")), "mcd-own")
    any_all = n.agg(F.max(F.when(F.col("grp") == "all", F.lit("all"))).alias("c"))
    return n.crossJoin(F.broadcast(any_all)).select("g0", "grp", F.array_compact(F.array("a", "b", "c")).alias("into"))


def _distance(k: int) -> Column:
    """Squared Mahalanobis distance of x under the joined mu and (flattened, symmetric) precision."""
    d = [F.col(f"x{i}") - F.col("mu")[i] for i in range(k)]
    out = F.lit(0.0)
    for i in range(k):
        for j in range(i, k):
            out = out + (1.0 if i == j else 2.0) * F.col("prec")[i * k + j] * d[i] * d[j]
    return F.greatest(out, F.lit(0.0))


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + F.lit(2.0**-10)) * 12).cast("int")


STARTS = ("ranges", "tanh", "signs")
_EST = "grp string, start int, mu array<double>, prec array<double>, logdet double, scale double"


def _inverse(cov: np.ndarray, floors: np.ndarray) -> tuple[list[float], float]:
    """(precision, log determinant) of a covariance with no less than the floors on its diagonal."""
    cov = cov + np.diag(np.maximum(floors - np.diag(cov), 0))
    return np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def _moments(k: int, of: list[Column], tag: str) -> list[Column]:
    """Sums of values and of their products."""
    return [F.sum(c).alias(f"{tag}{i}") for i, c in enumerate(of)] + [F.sum(of[i] * of[j]).alias(f"{tag}{i}_{j}") for i in range(k) for j in range(i, k)]


def _second(pdf: pd.DataFrame, k: int, tag: str, upto: int) -> np.ndarray:
    """Summed products of the first rows, as a matrix."""
    out = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            out[i, j] = out[j, i] = pdf[f"{tag}{i}_{j}"].to_numpy(float)[:upto].sum()
    return out


def estimates(keyed: DataFrame, h: float = 0.75, steps: int = 5) -> DataFrame:
    """(grp, start, mu, prec, logdet, scale) of every group and start after all steps, from rows (grp, x0..)."""
    k = len(DIMS)
    floors = np.array([s for _, s in DIMS]) ** 2
    half, factor = chi2_quantile(k, 0.0), consistency(k, h)

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        """Median and quartile range of each statistic, from counts in bins of a 32nd."""
        mu, spread = [], []
        for i in range(k):
            mine = pdf[pdf["dim"] == i].sort_values("bin")
            upto = np.cumsum(mine["n"].to_numpy(float))
            low, mid, high = ((mine["bin"].to_numpy()[np.searchsorted(upto, q * upto[-1])] + 0.5) / 32 for q in (0.25, 0.5, 0.75))
            mu.append(float(mid))
            spread.append(max((high - low) / 1.349, math.sqrt(floors[i])))
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "mu": [mu], "spread": [spread]})

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        """The three starts of a group."""
        r = pdf.iloc[0]
        mu, s = np.array(r["mu"], float), np.array(r["spread"], float)
        mean = np.array([r[f"t{i}"] for i in range(k)], float) / r["n"]
        cov = _second(pdf, k, "t", 1) / r["n"] - np.outer(mean, mean)
        dev = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        shapes = [np.eye(k), cov / np.outer(dev, dev), k * _second(pdf, k, "u", 1) / r["n"]]
        got = [_inverse(0.9 * m * np.outer(s, s) + 0.1 * np.diag(s * s), floors) for m in shapes]  # never singular
        return pd.DataFrame({"grp": [r["grp"]] * 3, "start": [0, 1, 2], "mu": [mu.tolist()] * 3, "prec": [p for p, _ in got], "logdet": [d for _, d in got], "scale": [1.0] * 3})

    def concentrate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy(float)
        upto = np.cumsum(n)
        med = int(np.searchsorted(upto, 0.5 * upto[-1]))
        last = int(np.searchsorted(upto, h * upto[-1])) + 1
        m = upto[last - 1]
        mu = np.array([pdf[f"s{i}"].to_numpy(float)[:last].sum() for i in range(k)]) / m
        prec, logdet = _inverse((_second(pdf, k, "s", last) / m - np.outer(mu, mu)) * factor, floors)
        scale = max(2.0 ** ((pdf["bin"].to_numpy()[med] + 0.5) / 12) / half, 1.0)
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "start": [pdf["start"].iloc[0]], "mu": [mu.tolist()], "prec": [prec], "logdet": [logdet], "scale": [float(scale)]})

    each = keyed.select("grp", F.posexplode(F.array(*[F.col(f"x{i}") for i in range(k)])).alias("dim", "x"))
    counts = each.groupBy("grp", "dim", F.floor(F.col("x") * 32).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    centres = settle(counts.groupBy("grp").applyInPandas(centre, "grp string, mu array<double>, spread array<double>"), "mcd-centres")
    z = [(F.col(f"x{i}") - F.col("mu")[i]) / F.col("spread")[i] for i in range(k)]
    norm = F.sqrt(sum((c * c for c in z), F.lit(1e-12)))
    shapes = keyed.join(centres, "grp").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *_moments(k, [F.tanh(c) for c in z], "t"), *_moments(k, [c / norm for c in z], "u"))
    est = settle(shapes.join(centres, "grp").groupBy("grp").applyInPandas(start, _EST), "mcd-est")
    for step in range(steps + 1):
        binned = keyed.join(est, "grp").withColumn("bin", _bin(_distance(k))).groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *_moments(k, [F.col(f"x{i}") for i in range(k)], "s"))
        new = binned.groupBy("grp", "start").applyInPandas(concentrate, _EST)
        if step == steps:  # the scale under the last estimate
            new = est.drop("scale").join(new.select("grp", "start", "scale"), ["grp", "start"])
        est = settle(new.select(*[c.split()[0] for c in _EST.split(", ")]), "mcd-est")
    return est


def fit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", h: float = 0.75, steps: int = 5, least: int = 60) -> DataFrame:
    """Estimates: one row (g0, grp, mu, prec, logdet, start, scale) for each (lang, source) that has a verdict.

    All rows that pass the base rules take part. ``scale`` makes the median squared distance that of
    the chi-square distribution, so one cutoff holds for all groups.
    """
    two = docs.select(F.col(f"`{lang}`").alias("q_lang"), F.col(f"`{source}`").alias("q_source"), F.col(f"`{text}`").alias("q_text"))
    with scratch() as keep:
        rows = with_statistics(two, "q_text", ["q_lang", "q_source"]).withColumn("failed", base_failed())
        rows = settle(rows.select("q_lang", "q_source", "failed", _g0().alias("g0"), *[c.alias(f"x{i}") for i, c in enumerate(vector())]), "mcd-rows")
        of = settle(_grouped(rows, least), "mcd-groups")
        keyed = rows.filter("not failed").join(of.select("g0", "into"), "g0").withColumn("grp", F.explode("into")).drop("into")
        best = estimates(keyed, h, steps).groupBy("grp").agg(F.min_by(F.struct("mu", "prec", "logdet", "start", "scale"), F.struct("logdet", "start")).alias("best"))
        keep.append(settle(of.join(best, "grp").select("g0", "grp", "best.*"), "mcd-fit"))
        return keep[0]


def judge(docs: DataFrame, model: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", keep: list[str] | None = None, z_cut: float = 3.5) -> DataFrame:
    """Columns ``keep`` (all by default) with BASE, ``base_failed``, ``distance`` and ``kept``.

    Columns of ``docs`` with names of computed ones are left out.
    """
    k = len(DIMS)
    made = {*BASE, *EXTRA, "base_failed", "distance", "kept", "g0", "grp", "mu", "prec", "logdet", "start", "scale", *(f"x{i}" for i in range(k))}
    cols = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.withColumns({"q_lang": F.col(f"`{lang}`"), "q_source": F.col(f"`{source}`")})
    rows = with_statistics(rows, text, [*[c for c in cols if c not in ("q_lang", "q_source")], "q_lang", "q_source"])
    rows = rows.withColumn("g0", _g0())
    for i, c in enumerate(vector()):
        rows = rows.withColumn(f"x{i}", c)
    out = rows.join(model, "g0", "left").withColumn("base_failed", base_failed())
    out = out.withColumn("distance", F.sqrt(_distance(k) / F.col("scale")))
    cut = math.sqrt(chi2_quantile(k, z_cut))
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True)))
    return out.select(*[F.col(f"`{c}`") for c in cols], *BASE, "base_failed", "distance", "kept")


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base statistics, base rule and the method's verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judge(docs, fit(docs), keep=["doc_id"])


def stage_quality_rules(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    rows, name = shield(docs)
    of = {k: name[k] for k in ("lang", "source", "text")}
    return unshield(judge(rows, fit(rows, **of), **of).filter("kept"), docs)
