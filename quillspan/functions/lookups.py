"""Lookup tables, scores and decision tables as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ranges import _c

# Fixed values: (upper bound, inclusive; probability), and the probability beyond.
DISTANCE_BINS = [(3, 0.95), (6, 0.94), (9, 0.93), (12, 0.91), (15, 0.89), (18, 0.85), (21, 0.81), (24, 0.77), (27, 0.71), (30, 0.66), (35, 0.58), (40, 0.48), (45, 0.40), (50, 0.33), (55, 0.28), (60, 0.24), (70, 0.22), (80, 0.20), (120, 0.19), (160, 0.15), (200, 0.1)]
DISTANCE_BEYOND = 0.06
ERROR_BINS = [(1, 0.97), (2, 0.89), (3, 0.77), (4, 0.67), (5, 0.61), (6, 0.57), (7, 0.54), (8, 0.52), (9, 0.50), (10, 0.48), (11, 0.47), (12, 0.45), (14, 0.44), (16, 0.42), (18, 0.41), (20, 0.39), (22, 0.37), (24, 0.32), (26, 0.25), (28, 0.16)]
ERROR_BEYOND = 0.11
# Fixed values: (lower bound, inclusive; probability), and the probability below.
SEQUENCE_BINS = [(180, 0.98), (160, 0.94), (140, 0.92), (120, 0.88), (110, 0.87), (100, 0.81), (50, 0.76)]
SEQUENCE_BELOW = 0.5
STRUCTURE_BINS = [(35, 0.95), (25, 0.94), (20, 0.93), (18, 0.9), (16, 0.87), (14, 0.85), (12, 0.8), (11, 0.77), (10, 0.74), (9, 0.71), (8, 0.68), (7, 0.63), (6, 0.60), (5, 0.57), (4, 0.54), (3, 0.53), (2, 0.52)]
STRUCTURE_BELOW = 0.5
# Three- and one-letter codes of residues.
AMINO_ACIDS = {"ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I", "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V", "MSE": "M"}


def binned(value, bins: list[tuple[float, float]], beyond: float, upper: bool) -> Column:
    """The value of the first bin whose bound holds."""
    value, out = _c(value), None
    for bound, p in bins:
        cond = value <= bound if upper else value >= bound
        out = F.when(cond, p) if out is None else out.when(cond, p)
    return out.otherwise(beyond)


def distance_probability(d) -> Column:
    return binned(d, DISTANCE_BINS, DISTANCE_BEYOND, True)


def error_probability(e) -> Column:
    return binned(e, ERROR_BINS, ERROR_BEYOND, True)


def sequence_probability(p) -> Column:
    return binned(p, SEQUENCE_BINS, SEQUENCE_BELOW, False)


def structure_probability(z) -> Column:
    return binned(z, STRUCTURE_BINS, STRUCTURE_BELOW, False)


def combined_probability(d, e, h, z) -> Column:
    """Geometric mean of the four."""
    return F.pow(_c(d) * _c(e) * _c(h) * _c(z), F.lit(0.25))


def pooled_sequence_score(best, n) -> Column:
    """Best score and how many: 20 without any, best + 10 n - 10 up to ten, best + 100 beyond."""
    best, n = _c(best), F.coalesce(_c(n), F.lit(0))
    return F.when(n == 0, 20.0).when(n > 10, best + 100).otherwise(best + 10 * n - 10)


def pooled_structure_score(best, n) -> Column:
    """Best score and how many: 1 without any, best + n - 1 up to five, best + 5 beyond."""
    best, n = _c(best), F.coalesce(_c(n), F.lit(0))
    return F.when(n == 0, 1.0).when(n > 5, best + 5).otherwise(best + n - 1)


def _letters(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def three_to_one(code) -> Column:
    """X for what is unknown; upper and lower case alike."""
    return F.coalesce(F.element_at(_letters(AMINO_ACIDS), F.upper(_c(code))), F.lit("X"))


def one_to_three(letter) -> Column:
    """UNK for what is unknown."""
    back = {v: k for k, v in AMINO_ACIDS.items() if k != "MSE"}
    return F.coalesce(F.element_at(_letters(back), F.upper(_c(letter))), F.lit("UNK"))


def scaled(value: Column, digits: int) -> Column:
    """The size of a double times a power of ten as a whole number: rounded by its exact binary value, ties to even.

    The product is exact as a sum of two doubles.
    """
    size = F.abs(value.cast("double"))
    k = F.lit(float(10**digits))
    c = size * F.lit(134217729.0)
    high = c - (c - size)
    p = size * k
    rest = (high * k - p) + (size - high) * k  # what the product lost
    n = F.floor(p)
    over = ((p - n) - F.lit(0.5)) + rest
    return n + F.when((over > 0) | ((over == 0) & (n % 2 == 1)), 1).otherwise(0)


def rounded(value, digits: int) -> Column:
    """A double rounded to ``digits`` places by its exact binary value, ties to even (not by its decimal text)."""
    x = _c(value).cast("double")
    return F.signum(x) * scaled(x, digits) / F.lit(float(10**digits))


def round_signed(value, digits: int) -> Column:
    """SQL's round of a double: halves go away from zero, and what becomes zero keeps its sign (Spark's own round drops it)."""
    x = _c(value).cast("double")
    return F.when(x.cast("string").startswith("-"), -F.round(F.abs(x), digits)).otherwise(F.round(x, digits))


def is_amino_acid(code) -> Column:
    return F.element_at(_letters(AMINO_ACIDS), F.upper(_c(code))).isNotNull()


def sequence_support(prob, cov) -> Column:
    """superb, high, medium, low or no."""
    prob, cov = _c(prob), _c(cov)
    return F.when((prob >= 95) & (cov >= 0.6), "superb").when((prob >= 80) & (cov >= 0.4), "high").when((prob >= 50) & (cov >= 0.3), "medium").when((prob >= 20) & (cov >= 0.2), "low").otherwise("no")


def judge_score(rank, q, ztile, qtile, znorm, prob, cov) -> Column:
    """0-9: five marks of structure and four cumulative tiers of sequence support."""
    rank, q, ztile, qtile, znorm, prob, cov = map(_c, (rank, q, ztile, qtile, znorm, prob, cov))
    marks = [rank < 1.5, q > 0.5, (ztile < 0.75) & (ztile >= 0), (qtile < 0.75) & (qtile >= 0), znorm > 0.225]
    marks += [(prob >= p) & (cov >= c) for p, c in ((20, 0.2), (50, 0.3), (80, 0.4), (95, 0.6))]
    out = F.lit(0)
    for m in marks:
        out = out + F.coalesce(m, F.lit(False)).cast("int")
    return out


def percentile_above(value, history) -> Column:
    """Share of the history strictly greater than the value; -1 without history."""
    value, history = _c(value), _c(history)
    share = F.size(F.filter(history, lambda h: h > value)) / F.size(history)
    return F.when(history.isNull() | (F.size(history) == 0), -1.0).otherwise(share)


def overlaps_loosely(n_common, n_a, n_b) -> Column:
    """At least half of either set."""
    c, a, b = _c(n_common), _c(n_a), _c(n_b)
    return (c >= a * 0.5) | (c >= b * 0.5)


def overlaps_strictly(n_common, n_a, n_b) -> Column:
    """At least a third of the first set, and half of either."""
    return (_c(n_common) >= _c(n_a) * 0.33) & overlaps_loosely(n_common, n_a, n_b)


def template_evidence(structure, sequence) -> Column:
    """The structure's residues when they are more than half as many as the sequence's."""
    return F.when(F.size(_c(structure)) > F.size(_c(sequence)) * 0.5, _c(structure)).otherwise(_c(sequence))


def coverage_class(prob, weighted, length) -> Column:
    """full, part or miss."""
    prob, w, n = _c(prob), _c(weighted), _c(length)
    high, low = (w >= 0.66) | (n >= 0.66), (w >= 0.33) & (n >= 0.33)
    some = (w >= 0.33) | (n >= 0.33)
    return F.when(prob < 0.85, "miss").when(high & low, "full").when(high | some, "part").otherwise("miss")


def refined_class(kind, n_sse, hh_prob, weighted, length) -> Column:
    """The label of a domain by its class, its count of secondary structures and the quality of its match."""
    kind, few = _c(kind), _c(n_sse) < 3
    good = (_c(hh_prob) >= 0.95) & (_c(weighted) >= 0.8) & (_c(length) >= 0.8)
    simple = few & ~good
    return (
        F.when((kind == "miss") & few, "simple_topology")
        .when((kind == "part") & ~simple, "partial_domain")
        .when((kind == "full") & ~simple, "good_domain")
        .when(kind.isin("part", "full"), "simple_topology")
        .otherwise("low_confidence")
    )


def confidence_label(n_topologies, n_families) -> Column:
    """good for one topology, ok for one family, else bad."""
    return F.when(_c(n_topologies) == 1, "good").when(_c(n_families) == 1, "ok").otherwise("bad")


def best_label(labels) -> Column:
    """The best of good, ok, bad; na without any."""
    labels = _c(labels)
    return F.when(F.array_contains(labels, "good"), "good").when(F.array_contains(labels, "ok"), "ok").when(F.size(labels) > 0, "bad").otherwise("na")


def jaccard(a, b) -> Column:
    """Of two arrays as sets; 1 when both are empty."""
    union = F.size(F.array_union(_c(a), _c(b)))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(_c(a), _c(b))) / union)


def plain_id(name) -> Column:
    """AF-X-F1... becomes X."""
    return F.regexp_replace(_c(name), r"^AF-(.+?)-F\d+.*$", "$1")


def shard_key(key) -> Column:
    return F.right(_c(key), F.lit(2))


def hierarchy_prefix(code, parts: int) -> Column:
    return F.substring_index(_c(code), ".", parts)
