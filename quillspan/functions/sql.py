"""The engine in SQL: temporary views of its tables and temporary SQL functions (no Python behind them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import lookups as lk


def _case(value: str, bins: list[tuple[float, float]], beyond: float, op: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} {op} {b} THEN {p}D" for b, p in bins) + f" ELSE {beyond}D END"


_SEG = "regexp_replace(s, '^[^:]*:', '')"
_START, _END = (f"try_cast(substring_index({_SEG}, '-', {k}) AS INT)" for k in (1, -1))

#: name and signature: body
FUNCTIONS = {
    "parse_range(t STRING) RETURNS ARRAY<INT>": f"CASE WHEN t IS NULL OR t IN ('', 'na') THEN CAST(array() AS ARRAY<INT>) ELSE array_sort(array_distinct(flatten(transform(split(replace(t, ' ', ''), ','), s -> CASE WHEN {_START} <= {_END} THEN sequence({_START}, {_END}) ELSE CAST(array() AS ARRAY<INT>) END)))) END",
    "set_jaccard(a ARRAY<INT>, b ARRAY<INT>) RETURNS DOUBLE": "CASE WHEN size(array_union(a, b)) = 0 THEN 1.0D ELSE size(array_intersect(a, b)) / size(array_union(a, b)) END",
    "distance_probability(d DOUBLE) RETURNS DOUBLE": _case("d", lk.DISTANCE_BINS, lk.DISTANCE_BEYOND, "<="),
    "error_probability(e DOUBLE) RETURNS DOUBLE": _case("e", lk.ERROR_BINS, lk.ERROR_BEYOND, "<="),
    "sequence_probability(p DOUBLE) RETURNS DOUBLE": _case("p", lk.SEQUENCE_BINS, lk.SEQUENCE_BELOW, ">="),
    "structure_probability(z DOUBLE) RETURNS DOUBLE": _case("z", lk.STRUCTURE_BINS, lk.STRUCTURE_BELOW, ">="),
    "hierarchy_prefix(code STRING, parts INT) RETURNS STRING": "substring_index(code, '.', parts)",
    "plain_id(name STRING) RETURNS STRING": "regexp_replace(name, '^AF-(.+?)-F[0-9]+.*$', '$1')",
}


def register_functions(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_tables(tables: dict[str, DataFrame]) -> None:
    """All reference and evidence tables as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
