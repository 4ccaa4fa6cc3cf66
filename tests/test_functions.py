"""Range algebra, lookups and scores at their boundaries."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspan.functions import lookups as lk
from quillspan.functions import ranges as rg


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ints(xs):
    return F.array(*map(F.lit, xs)).cast("array<int>")


def test_formats(spark):
    assert value(spark, rg.format_short(ints([1, 2, 3, 5, 6, 7]))) == "1-3,5-7"
    assert value(spark, rg.format_short(ints([1, 2, 3, 5, 6, 7]), 1)) == "1-7"
    assert value(spark, rg.format_short(ints([5]))) == "5"
    assert value(spark, rg.format_full(ints([5]))) == "5-5"
    assert value(spark, rg.format_short(ints([3, 1, 2]), 0, "A")) == "A:1-3"
    assert value(spark, rg.format_short(ints([]))) == ""


def test_parsing(spark):
    assert value(spark, rg.parse_set(F.lit(" A:1-3, 5 ,B:4-4"))) == [1, 2, 3, 4, 5]
    assert value(spark, rg.parse_list(F.lit("5-6,1-2,5"))) == [5, 6, 1, 2, 5]
    for text in (None, "", "na", "9-3"):
        assert value(spark, rg.parse_set(F.lit(text).cast("string"))) == []


def test_segments(spark):
    assert value(spark, rg.filter_segments(F.lit("1-10,25-28,40-60,99"))) == "1-10,40-60"
    assert value(spark, rg.filter_segments(F.lit("1-10"))) == ""
    assert value(spark, rg.gap_filled(F.lit("1-3,13-14,30"))) == [*range(1, 15)]
    assert value(spark, rg.long_segments(ints([1, 2, 3, 4, 5, 20, 21]))) == [1, 2, 3, 4, 5]
    assert value(spark, rg.format_tolerant(ints([1, 2, 7, 13]))) == "1-7,13-13"
    assert value(spark, rg.merge_ranges(F.lit("1-4"), F.lit("3-6,9"))) == "1-6,9"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(1, 300), max_size=40))
def test_round_trip(spark, residues):
    assert value(spark, rg.parse_set(rg.format_short(ints(sorted(residues))))) == sorted(residues)
    assert value(spark, rg.parse_set(rg.format_full(ints(sorted(residues))))) == sorted(residues)


@pytest.mark.parametrize(("f", "x", "p"), [
    (lk.distance_probability, 3.0, 0.95), (lk.distance_probability, 3.01, 0.94), (lk.distance_probability, 200.0, 0.1), (lk.distance_probability, 200.1, 0.06),
    (lk.error_probability, 1.0, 0.97), (lk.error_probability, 12.5, 0.44), (lk.error_probability, 28.1, 0.11),
    (lk.sequence_probability, 180.0, 0.98), (lk.sequence_probability, 49.9, 0.5), (lk.structure_probability, 2.0, 0.52), (lk.structure_probability, 1.9, 0.5), (lk.structure_probability, 35.0, 0.95),
])
def test_bins(spark, f, x, p):
    assert value(spark, f(F.lit(x))) == p


@pytest.mark.parametrize(("n", "want"), [(0, 20), (1, 50), (10, 140), (11, 150)])
def test_pooled_sequence(spark, n, want):
    assert value(spark, lk.pooled_sequence_score(F.lit(50.0), F.lit(n))) == want


@pytest.mark.parametrize(("n", "want"), [(0, 1), (1, 7), (5, 11), (6, 12)])
def test_pooled_structure(spark, n, want):
    assert value(spark, lk.pooled_structure_score(F.lit(7.0), F.lit(n))) == want


def test_decisions(spark):
    assert value(spark, lk.percentile_above(F.lit(2.0), F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0), F.lit(4.0)))) == 0.5
    assert value(spark, lk.percentile_above(F.lit(2.0), F.array().cast("array<double>"))) == -1.0
    assert value(spark, lk.jaccard(ints([]), ints([]))) == 1.0
    assert value(spark, lk.jaccard(ints([1, 2]), ints([2, 3, 4]))) == 0.25
    assert value(spark, lk.coverage_class(F.lit(0.85), F.lit(0.66), F.lit(0.33))) == "full"
    assert value(spark, lk.coverage_class(F.lit(0.85), F.lit(0.66), F.lit(0.32))) == "part"
    assert value(spark, lk.coverage_class(F.lit(0.84), F.lit(1.0), F.lit(1.0))) == "miss"
    assert value(spark, lk.overlaps_strictly(F.lit(33), F.lit(100), F.lit(66))) is True
    assert value(spark, lk.overlaps_strictly(F.lit(32), F.lit(100), F.lit(10))) is False
    assert value(spark, lk.refined_class(F.lit("part"), F.lit(2), F.lit(0.95), F.lit(0.8), F.lit(0.8))) == "partial_domain"
    assert value(spark, lk.refined_class(F.lit("odd"), F.lit(2), F.lit(0.95), F.lit(0.8), F.lit(0.8))) == "low_confidence"
    assert value(spark, lk.plain_id(F.lit("AF-P123-F1-model_v4"))) == "P123"
    assert value(spark, lk.three_to_one(F.lit("mse"))) == "M" and value(spark, lk.one_to_three(F.lit("m"))) == "MET"


def test_sql_functions(spark):
    from quillspan.functions import sql

    sql.register_functions(spark)
    sql.register_tables({"some_ranges": spark.createDataFrame([("A:1-3, 5",), ("na",), (None,)], "t string")})
    got = [r[0] for r in spark.sql("SELECT parse_range(t) FROM some_ranges").collect()]
    assert got == [[1, 2, 3, 5], [], []]
    r = spark.sql("SELECT set_jaccard(array(1, 2), array(2, 3, 4)), distance_probability(3.01D), structure_probability(1.9D), plain_id('AF-P1-F1-m')").first()
    assert tuple(r) == (0.25, 0.94, 0.5, "P1")
