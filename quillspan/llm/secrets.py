"""Secret scans with corpus-wide ownership frequency.

A scan of every whole text finds the base kinds (assign, access, hex) and generic candidates (long
tokens that mix letters and digits). Candidate hashes are then counted over the corpus by distinct
repositories and owners: a candidate found with ``example_owners`` owners or more, or in
``example_repos`` repositories or more, is a widely copied example; one that stays below both looks
live. Live generic candidates are added to the
spans; base spans always stay, with their verdict.

The counts aggregate (candidate, owner, repository) triples before the shuffle, so a candidate that
a third of all rows hold costs one row per task; verdicts go back by an equi-join that adaptive
execution may split.

Defined cases: null text is empty; null owners and repositories count as one owner, the empty name;
repeated rows are each scanned and count once as owners; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import append_columns, settle, shield, unshield

KINDS = ["assign", "access", "hex", "generic"]
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_SPANS = "array<struct<kind:int,start:bigint,end:bigint,hash:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.int64())]))


def _value_hash(value: str) -> int:
    return int.from_bytes(hashlib.sha256(value.encode()).digest()[:8], "little", signed=True)


def scan_text(text: str, hex_runs, token_runs, keywords: bool) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, value hash) in code points; runs come from the vectorised pass."""
    found = []
    if keywords:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 12:
                found.append((0, m.start(), m.end(), _value_hash(m[2])))
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 18:
                found.append((1, m.start(), m.end(), _value_hash(m[0])))
    found += [(2, s, e, _value_hash(text[s:e])) for s, e in hex_runs]
    base = [(s, e) for _, s, e, _ in found]
    for s, e in token_runs:
        if not any(s < b and a < e for a, b in base):  # what overlaps a base span adds nothing
            found.append((3, s, e, _value_hash(text[s:e])))
    return sorted(found, key=lambda x: (x[1], x[0]))


def scan(col) -> list:
    """Spans of each text of an Arrow column: vectorised passes pick the few texts that need more."""
    data, off = tk.flat(col)
    n = len(off) - 1
    hs, he = tk.runs(_HEX[data], off)
    long = he - hs >= 16
    hs, he = hs[long], he[long]
    ts, te = tk.runs(_TOKEN[data], off)
    long = te - ts >= 20
    ts, te = ts[long], te[long]
    if len(ts):
        digits, upper, lower = (np.concatenate([[0], np.cumsum(m[data])]) for m in (_DIGIT, _UPPER, _LOWER))
        d, u, w = (c[te] - c[ts] for c in (digits, upper, lower))
        # keys mix cases and digits all along; identifiers and ruled lines don't
        good = (d >= 3) & (u >= 3) & (w >= 3) & (d + u + w >= 0.9 * (te - ts))
        ts, te = ts[good], te[good]
    raw = tk.LOWER[data].tobytes()
    need = np.zeros(n, bool)
    for word in _KEYWORDS:
        at = raw.find(word)
        while at >= 0:
            need[np.searchsorted(off, at, "right") - 1] = True
            at = raw.find(word, at + 1)
    raw = data.tobytes()
    at = raw.find(b"AKIA")
    while at >= 0:
        need[np.searchsorted(off, at, "right") - 1] = True
        at = raw.find(b"AKIA", at + 1)
    hd, td = np.searchsorted(off, hs, "right") - 1, np.searchsorted(off, ts, "right") - 1
    out: list = [[]] * n
    for i in np.flatnonzero(need | (np.bincount(hd, minlength=n) > 0) | (np.bincount(td, minlength=n) > 0)) if n else []:
        piece = data[off[i] : off[i + 1]]
        before = np.concatenate([[0], np.cumsum(tk.IS_CHAR[piece])])
        points = lambda s, e: [(int(before[a]), int(before[b])) for a, b in zip(s - off[i], e - off[i], strict=True)]  # noqa: B023, E731
        out[i] = scan_text(piece.tobytes().decode("utf-8"), points(hs[hd == i], he[hd == i]), points(ts[td == i], te[td == i]), bool(need[i]))
    return [pa.array([[{"kind": k, "start": s, "end": e, "hash": h} for k, s, e, h in x] for x in out], _SPAN_TYPE)]


def _text_of(spans) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", _kind(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _kind(code) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), code + 1)


def candidates(docs: DataFrame, text: str, owner: str, repository: str, keep: list[str]) -> DataFrame:
    """``keep`` with the spans of every text, the owner and the repository."""
    rows = docs.withColumns({"sec_owner": F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")), "sec_repo": F.concat_ws("\x1f", F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("")))})
    keep = [c for c in keep if c not in ("sec_owner", "sec_repo", "sec_spans")]
    return append_columns(rows, text, scan, [("sec_spans", _SPANS)], [*keep, "sec_owner", "sec_repo"])


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n_rows) of every candidate."""
    each = found.select("sec_owner", "sec_repo", F.explode("sec_spans.hash").alias("hash"))
    by = each.groupBy("hash", "sec_owner", "sec_repo").agg(F.count(F.lit(1)).alias("n"))
    by = by.groupBy("hash", "sec_owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"))
    return by.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repos"), F.sum("n").alias("n_rows"))


_JUDGED = "array<struct<start:bigint,kind:int,end:bigint,hash:bigint,live:boolean>>"


def judged(found: DataFrame, keep: list[str], example_owners: int = 3, example_repos: int = 4) -> DataFrame:
    """``keep`` and ``sec_judged``, the spans with their verdict ``live``, of each row of ``found``.

    ``found`` holds rows with a candidate and a row number ``sec_row``. Spans meet their candidate's
    counts by hash, and then the other spans of their row.
    """
    spans = found.select("sec_row", *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.explode("sec_spans").alias("s"))
    spans = spans.select("sec_row", *[f"k{i}" for i in range(len(keep))], "s.*").join(ownership(found), "hash")
    one = F.struct("start", "kind", "end", "hash", ((F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)).alias("live"))
    rows = spans.groupBy("sec_row").agg(*[F.first(f"k{i}").alias(c) for i, c in enumerate(keep)], F.array_sort(F.collect_list(one)).alias("sec_judged"))  # a text's own spans only
    return rows.drop("sec_row")


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "lang", example_owners: int = 3, example_repos: int = 4) -> DataFrame:
    """Counts, digests and spans of every document, with the number of spans that look live."""
    found = settle(candidates(docs, text, owner, repository, [doc_id]).withColumn("sec_row", F.monotonically_increasing_id()), "secrets")
    some = judged(found.filter(F.size("sec_spans") > 0), [doc_id], example_owners, example_repos)
    none = found.filter(F.size("sec_spans") == 0).select(F.col(f"`{doc_id}`"), F.array().cast(_JUDGED).alias("sec_judged"))
    base = F.filter("sec_judged", lambda s: s["kind"] < 3)
    kept = F.filter("sec_judged", lambda s: (s["kind"] < 3) | s["live"])
    count = lambda k: F.size(F.filter("sec_judged", lambda s: s["kind"] == k)).cast("bigint")
    return some.unionByName(none).select(
        F.col(f"`{doc_id}`"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_text_of(base).cast("binary"), 256).alias("base_sha256"), _text_of(kept).alias("spans"),
        F.size(F.filter(kept, lambda s: s["live"])).cast("bigint").alias("n_live"),
    )


def op6_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole text."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang"))


def stage_secret_scans(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; in their texts, each span that looks live is replaced by a mark of its kind.

    Texts are scanned once; only rows with a candidate are counted, joined and masked.
    """
    shielded, name = shield(docs)
    rows = candidates(shielded, name["text"], name["source"], name["lang"], shielded.columns)
    rows = settle(rows.withColumn("sec_row", F.monotonically_increasing_id()), "secrets")
    clean, found = rows.filter(F.size("sec_spans") == 0), rows.filter(F.size("sec_spans") > 0)
    some = judged(found.withColumn("sec_id", F.col("sec_row")), ["sec_id"]).select("sec_id", F.filter("sec_judged", lambda s: s["live"]).alias("sec_live"))
    masked = found.join(some, F.col("sec_row") == F.col("sec_id")).withColumn(name["text"], _masked(F.col(name["text"]), F.col("sec_live")))
    return unshield(clean, docs).unionByName(unshield(masked, docs))


def _masked(text, live):
    """The text with each live span (overlaps merged) replaced by [kind]."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    step = lambda a, s: F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
        F.struct(F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), _kind(s["kind"]), F.lit("]")).alias("out"), s["end"].alias("at"))
    )
    return F.when(F.size(live) == 0, text).otherwise(F.aggregate(live, zero, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))))
