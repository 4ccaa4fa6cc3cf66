"""Residue-range codec and segment algebra as Column functions (no Python UDF).

A range string is ``seg(,seg)*`` with ``seg = [chain:]start-end | [chain:]n``; the canonical form
inside the engine is a sorted ARRAY<INT>. Null, empty and ``na`` strings are the empty array.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def span(start: Column, end: Column) -> Column:
    """start..end; empty when descending (Spark's sequence would count down)."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<int>"))


def parse_list(text) -> Column:
    """Residues in written order, repeats kept."""
    text = F.regexp_replace(_c(text), " ", "")

    def one(seg: Column) -> Column:
        body = F.regexp_replace(seg, "^[^:]*:", "")
        start = F.substring_index(body, "-", 1).try_cast("int")
        end = F.substring_index(body, "-", -1).try_cast("int")
        return F.coalesce(span(start, end), F.array().cast("array<int>"))

    return F.when(text.isNull() | (text == "") | (text == "na"), F.array().cast("array<int>")).otherwise(F.flatten(F.transform(F.split(text, ","), one)))


def parse_set(text) -> Column:
    """Sorted distinct residues."""
    return F.array_sort(F.array_distinct(parse_list(text)))


def segments(residues, gap: int | Column = 0) -> Column:
    """Islands of the residues: array of (first, last, members); a new one starts beyond last + 1 + gap."""
    gap = F.lit(gap) if isinstance(gap, int) else gap

    def of(a: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (F.get(a, i) > F.get(a, i - 1) + 1 + gap))
        return let(starts, lambda s: F.transform(s, lambda v, k: let(F.coalesce(F.get(s, k + 1), F.size(a)), lambda nxt: F.struct(F.get(a, v).alias("first"), F.get(a, nxt - 1).alias("last"), (nxt - v).alias("members")))))

    empty = F.array().cast("array<struct<first:int,last:int,members:int>>")
    return F.when(F.size(_c(residues)) > 0, let(F.array_sort(_c(residues)), of)).otherwise(empty)


def _joined(segs: Column, short: bool, chain: str | None = None) -> Column:
    head = F.lit(f"{chain}:" if chain else "")

    def one(s: Column) -> Column:
        both = F.concat(head, s["first"].cast("string"), F.lit("-"), s["last"].cast("string"))
        return F.when(s["first"] == s["last"], F.concat(head, s["first"].cast("string"))).otherwise(both) if short else both

    return F.array_join(F.transform(segs, one), ",")


def format_short(residues, gap: int | Column = 0, chain: str | None = None) -> Column:
    """A lone residue is written ``n``."""
    return _joined(segments(residues, gap), True, chain)


def format_full(residues, gap: int | Column = 0) -> Column:
    """A lone residue is written ``n-n``."""
    return _joined(segments(residues, gap), False)


def format_tolerant(residues) -> Column:
    """Segments joined over gaps up to max(5, 5 % of the residues)."""
    n = F.size(F.array_distinct(_c(residues)))
    return format_full(residues, (F.floor(F.greatest(F.lit(5.0), n * 0.05)) - 1).cast("int"))


def long_segments(residues, least: int = 5, gap: int = 10) -> Column:
    """Members of segments (split beyond ``gap`` after the last residue) with ``least`` members or more."""
    kept = F.filter(segments(residues, gap - 1), lambda s: s["members"] >= least)
    return let(kept, lambda k: F.filter(F.array_sort(_c(residues)), lambda r: F.exists(k, lambda s: (s["first"] <= r) & (r <= s["last"]))))


def written_spans(text) -> Column:
    """(first, last) of the written segments that have a dash; others are skipped."""
    parts = F.filter(F.split(F.regexp_replace(_c(text), " ", ""), ","), lambda s: F.contains(s, F.lit("-")))
    return F.transform(parts, lambda s: F.struct(F.substring_index(s, "-", 1).cast("int").alias("first"), F.substring_index(s, "-", -1).cast("int").alias("last")))


def _dashed(text) -> Column:
    return F.flatten(F.transform(written_spans(text), lambda s: span(s["first"], s["last"])))


def gap_filled(text, gap: int = 10) -> Column:
    """Residues of the written segments with gaps of up to ``gap`` filled in."""
    return F.flatten(F.transform(segments(_dashed(text), gap - 1), lambda s: F.sequence(s["first"], s["last"])))


def filter_segments(text, gap: int = 10, least: int = 5, total: int = 25) -> Column:
    """Segments whose span (gaps counted) is ``least`` or more, if they span ``total`` together; else the empty string."""
    length = lambda s: s["last"] - s["first"] + 1
    kept = F.filter(segments(_dashed(text), gap - 1), lambda s: length(s) >= least)
    return let(kept, lambda k: F.when(F.aggregate(k, F.lit(0), lambda a, s: a + length(s)) >= total, _joined(k, False)).otherwise(""))


def merge_ranges(a, b) -> Column:
    """The union of two range strings."""
    return format_short(F.array_union(parse_set(a), parse_set(b)))


parse_range = parse_set
format_range = format_short
