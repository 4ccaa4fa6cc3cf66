"""Quality classifier: a sparse rule ensemble over text statistics.

Gradient-boosted trees of small depth are grown on statistics of labelled texts. Every path from a
root becomes a conjunctive rule; a lasso logistic model weighs the rules and the winsorised
statistics; what keeps a weight is compiled into one Spark column expression. Scoring is then
JVM-side over statistics that a vectorised pass adds to each row.

The fit takes a sample of ``MAX_ROWS`` labelled rows at most, those with the smallest hashes of
their id (the documented bound, which also holds where documents repeat an id); labels meet texts by an
equi-join. Scores cover all documents.

Defined cases: null text is the empty text and gets a score like any other; rows without a label
only get scores; repeated labels of a document count each; without labels of both kinds the score
is the constant share of label 1 (1.0 without labels at all); empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import append_columns, crc_mod
from .quality_rules import statistics

MAX_ROWS = 20_000
STATS = ["n_words", "word_len", "symbols", "dup_lines", "repeats", "upper", "marks", "word_spread", "pipes", "lines", "distinct", "digits", "short"]
_FIELDS = [(f"st_{c}", "double") for c in STATS]
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def features(col) -> list[np.ndarray]:
    """The statistics STATS of each text."""
    data, off = tk.flat(col)
    n_words, word_chars, symbols, dup, repeat, lines, upper, marks = (x.astype(float) for x in statistics(col))
    starts, ends, first = tk.words(data, off)
    w = np.maximum(n_words, 1)
    lens = ends - starts
    square = tk.sums((lens * lens).astype(np.int64), first)
    mean = tk.sums(lens, first) / w
    pipes = tk.sums((data == 124).astype(np.int64), off)
    digits = tk.sums(_DIGIT[data].astype(np.int64), off)
    short = tk.sums((lens <= 2).astype(np.int64), first)
    salt = tk.mix(np.arange(1, len(off), dtype=np.uint64))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    _, where = np.unique(tk.span_hashes(data, starts, ends) ^ salt[doc], return_index=True) if len(starts) else (None, np.zeros(0, np.int64))
    distinct = np.bincount(doc[where], minlength=len(off) - 1)
    c = np.maximum(word_chars, 1)
    return [np.log1p(n_words), word_chars / w, symbols / w, dup / np.maximum(lines, 1), repeat / w, upper / c, marks / w, np.sqrt(np.maximum(square / w - mean * mean, 0)), pipes / w, np.log1p(lines), distinct / w, digits / c, short / w]


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, bins: list[np.ndarray], codes: np.ndarray, depth: int, least: int):
    """One boosted tree over binned statistics: (nested tuple of (statistic, cut, left, right) or value)."""

    def grow(rows, d):
        gs, hs = g[rows].sum(), h[rows].sum()
        value = gs / (hs + 1.0)
        if d == 0 or len(rows) < 2 * least:
            return float(value)
        best, found = gs * gs / (hs + 1.0) + 1e-6, None
        for f in range(x.shape[1]):
            k = len(bins[f])
            if not k:
                continue
            c = codes[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(c, weights=v, minlength=k + 1))[:k] for v in (g[rows], h[rows], np.ones(len(rows))))
            ok = (nl >= least) & (len(rows) - nl >= least)
            gain = np.where(ok, gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1), -np.inf)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, found = gain[i], (f, i)
        if found is None:
            return float(value)
        f, i = found
        left = codes[rows, f] <= i
        return f, float(bins[f][i]), grow(rows[left], d - 1), grow(rows[~left], d - 1)

    return grow(np.arange(len(x)), depth)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, left, right = tree
    return np.where(x[:, f] <= cut, _apply(left, x), _apply(right, x))


def paths(tree, above: tuple = ()) -> list[tuple]:
    """All paths of a tree but the empty one, each a tuple of (statistic, cut, is at most)."""
    out = [above] if above else []
    if isinstance(tree, tuple):
        f, cut, left, right = tree
        out += paths(left, (*above, (f, cut, True))) + paths(right, (*above, (f, cut, False)))
    return out


def holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, cut, low in rule:
        out &= (x[:, f] <= cut) == low
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """(intercept, weights) by accelerated proximal gradient descent; columns of x have unit scale."""
    n, k = x.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b, w = float(np.log(share / (1 - share))), np.zeros(k)
    step = 4.0 * n / max(np.linalg.norm(x, 2) ** 2 + n, 1.0)
    zb, zw, t = b, w.copy(), 1.0
    for _ in range(steps):
        r = _sigmoid(zb + x @ zw) - y
        nb = zb - step * r.mean()
        nw = zw - step * (x.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        zb, zw = nb + (t - 1) / nt * (nb - b), nw + (t - 1) / nt * (nw - w)
        b, w, t = nb, nw, nt
    return b, w


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 5e-4) -> dict:
    """An ensemble: intercept, rules with weights, and statistics with bounds and weights."""
    if len(y) == 0 or y.min() == y.max():
        return {"intercept": 35.0 if len(y) == 0 or y.min() == 1 else -35.0, "rules": [], "linear": []}
    bins = [np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, 99), method="lower")) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(b, x[:, f], "left") for f, b in enumerate(bins)], axis=1)
    rules: dict[tuple, None] = {}
    z = np.full(len(y), np.log(np.clip(y.mean(), 1e-3, 1 - 1e-3) / (1 - np.clip(y.mean(), 1e-3, 1 - 1e-3))))
    for _ in range(trees):
        p = _sigmoid(z)
        tree = _tree(x, y - p, p * (1 - p), bins, codes, depth, max(5, len(y) // 500))
        rules.update(dict.fromkeys(paths(tree)))
        z += 0.3 * _apply(tree, x)
    kept = [(r, v) for r in rules if 0.002 < (v := holds(r, x).astype(float)).mean() < 0.998]
    low, high = np.quantile(x, 0.01, axis=0), np.quantile(x, 0.99, axis=0)
    lin = np.clip(x, low, high)
    spread = lin.std(axis=0)
    use = np.flatnonzero(spread > 1e-9)
    scale = np.concatenate([[max(v.std(), 0.05) for _, v in kept], spread[use] / 0.4])
    design = np.concatenate([np.stack([v for _, v in kept], axis=1) if kept else np.zeros((len(y), 0)), lin[:, use]], axis=1)
    center = design.mean(axis=0)
    b, w = lasso_logistic((design - center) / scale, y.astype(float), penalty)
    w = np.where(np.abs(w) > 1e-4, w, 0) / scale
    return {
        "intercept": float(b - w @ center),
        "rules": [(r, float(c)) for (r, _), c in zip(kept, w[: len(kept)], strict=True) if c],
        "linear": [(int(f), float(low[f]), float(high[f]), float(c)) for f, c in zip(use, w[len(kept) :], strict=True) if c],
    }


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores outside Spark (the same sums as compile_rules)."""
    z = np.full(len(x), model["intercept"])
    for r, c in model["rules"]:
        z += c * holds(r, x)
    for f, low, high, c in model["linear"]:
        z += c * np.clip(x[:, f], low, high)
    return _sigmoid(z)


def compile_rules(model: dict) -> Column:
    """The score as one column expression over the columns st_*."""
    parts = [F.lit(model["intercept"])]
    for r, c in model["rules"]:
        conds = [(F.col(f"st_{STATS[f]}") <= cut) if low else (F.col(f"st_{STATS[f]}") > cut) for f, cut, low in r]
        cond = conds[0]
        for k in conds[1:]:
            cond = cond & k
        parts.append(F.when(cond, c).otherwise(0.0))
    for f, low, high, c in model["linear"]:
        parts.append(F.lit(c) * F.least(F.greatest(F.col(f"st_{STATS[f]}"), F.lit(low)), F.lit(high)))
    while len(parts) > 1:  # a balanced sum keeps the expression shallow
        parts = [a + b for a, b in zip(parts[::2], parts[1::2], strict=False)] + ([parts[-1]] if len(parts) % 2 else [])
    return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), parts[0]))))


def with_features(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return append_columns(docs, text, features, _FIELDS, keep)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    """Fit on the ``max_rows`` labelled rows of least id hash, outside the held-out quarter."""
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (crc_mod(F.col(doc_id), 4) != 2))
    known = known.select(F.col(doc_id).alias("lab_id"), F.col(label).cast("int").alias("lab"))
    sample = known.orderBy(F.xxhash64("lab_id"), "lab_id", "lab").limit(max_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("lab_doc"), F.col(f"`{text}`").alias("lab_text")).join(F.broadcast(sample), F.col("lab_doc") == F.col("lab_id"))  # ``max_rows`` numbers
    known = with_features(rows, "lab_text", ["lab_id", "lab"])
    got = known.orderBy(F.xxhash64("lab_id"), "lab_id", "lab", *[f"st_{c}" for c in STATS]).limit(max_rows).toPandas()  # documents may repeat an id
    got = got.sort_values(["lab_id", "lab"] + [f"st_{c}" for c in STATS], kind="stable")
    return fit(got[[f"st_{c}" for c in STATS]].to_numpy(float), got["lab"].to_numpy(float))


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = with_features(docs, text, [doc_id]).withColumn("score", compile_rules(model))
    return rows.select(F.col(f"`{doc_id}`"), (crc_mod(F.col(f"`{doc_id}`"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text by rules learnt from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score(docs, train(docs, labels))
