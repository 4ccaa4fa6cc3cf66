"""Queries that run over all hits, against plain models."""

from collections import defaultdict

import duckdb
import pytest

from quillspan.functions import lookups as lk
from quillspan.operators import joins
from quillspan.plans import evidence_queries as eq
from quillspan.plans import format_queries as fq
from quillspan.plans import queries as q
from quillspan.plans import reader_queries as rq  # noqa: F401  (adds its queries)
from quillspan.plans import stage_query as sq

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hits(spark):
    return q.hits(spark, SF).collect()


def plain_pairs(hits):
    best, n = defaultdict(float), defaultdict(int)
    for h in hits:
        for a in range(h.qs, h.qe + 1):
            for b in range(a + 1, h.qe + 1):
                best[h.protein, a, b] = max(best[h.protein, a, b], float(h.prob))
                n[h.protein, a, b] += 1
    return {k: (best[k], n[k]) for k in n}


def first(value, bins, beyond, under):
    return next((p for b, p in bins if (value <= b if under else value >= b)), beyond)


def plain_matrix(spark, hits):
    """p of every pair of every chain, long enough for all hits."""
    pairs, n = plain_pairs(hits), max(h.qe for h in hits)
    out = {}
    for p in [r.s_suppkey for r in spark.read.parquet(f"{SF}/supplier.parquet").collect()]:
        for a in range(1, n + 1):
            for b in range(a + 1, n + 1):
                best, k = pairs.get((p, a, b), (None, 0))
                h = 20 if best is None else best + 100 if k > 10 else best + 10 * k - 10
                z = 1 if best is None else best / 5 + 5 if k > 5 else best / 5 + k - 1
                f = first(abs(a - b) * 0.75 + a * b % 11, lk.DISTANCE_BINS, lk.DISTANCE_BEYOND, True) * first((p * 31 + a * 7 + b * 13) % 300 / 10, lk.ERROR_BINS, lk.ERROR_BEYOND, True)
                out[p, a, b] = (f * first(h, lk.SEQUENCE_BINS, lk.SEQUENCE_BELOW, False) * first(z, lk.STRUCTURE_BINS, lk.STRUCTURE_BELOW, False)) ** 0.25
    return out


def test_pair_scores_of_all_hits(spark, hits):
    got = {(r.protein, r.r1, r.r2): (float(r.best), r.n) for r in q.pair_scores(spark, SF).collect()}
    want = plain_pairs(hits)
    assert got.keys() == want.keys() and max(b for _, _, b in got) > 60
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-9 for k in want)


def test_matrix_and_chunks_of_whole_chains(spark, hits):
    want = plain_matrix(spark, hits)
    got = {(r.protein, r.r1, r.r2): r.p for r in q.probability_matrix(spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)
    n = max(h.qe for h in hits)
    sums = defaultdict(lambda: [0, 0.0])
    for (p, a, b), x in want.items():
        i, j = (a - 1) // 5, (b - 1) // 5
        if i < j and a + 5 < b:
            sums[p, i, j][0] += 1
            sums[p, i, j][1] += x
    got = {(r.protein, r.i, r.j): (r.n, r.mean) for r in q.chunk_pairs(spark, SF).collect()}
    assert got.keys() == sums.keys() and all(got[k][0] == c and abs(got[k][1] - t / c) < 2e-6 for k, (c, t) in sums.items())
    assert eq.chunk_clusters(spark, SF).agg({"resid": "max"}).first()[0] > 60


def test_coverage_of_all_hits(spark, hits):
    domains = [(r.protein, r.domain, set(r.resids)) for r in q.domains(spark, SF).collect()]
    want = {(p, d, h.line_no): len(x & set(range(h.qs, h.qe + 1))) for p, d, x in domains for h in hits if h.protein == p}
    got = {(r.protein, r.domain, r.line_no): r.n for r in fq.interval_coverage(spark, SF).collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_stage_inputs_hold_all_hits(spark, hits):
    t = sq.stage_inputs(spark, SF)
    assert t["seq_search"].count() == t["struct_hits"].count() == t["struct_search"].count() == len(hits)
    n = max(h.qe for h in hits)
    assert {r.length for r in t["proteins"].collect()} == {n} and t["errors"].agg({"r2": "max"}).first()[0] == n


def test_support_of_all_hits(spark, hits):
    got = {(r.protein, r.line_no): (float(r.best_prob), float(r.best_cov)) for r in q.sequence_support(spark, SF).collect()}
    assert len(got) == len(hits)
    groups = defaultdict(list)
    for h in hits:
        groups[h.protein, h.family].append(h)
    for s in hits:
        of = groups[s.protein, s.family]
        best = max(float(h.prob) for h in of)
        cov = max(max(0, min(s.qe, h.qe) - max(s.qs, h.qs) + 1) / (h.qe - h.qs + 5) for h in of if float(h.prob) >= best - 0.1)
        assert abs(got[s.protein, s.line_no][0] - best) < 1e-9 and abs(got[s.protein, s.line_no][1] - cov) < 1e-9


def test_split_counts_all_hits(spark, hits):
    assert sum(r.hits for r in fq.split_by_query(spark, SF).collect()) == len(hits)


@pytest.mark.parametrize("name", ["strict_atoms", "pdb_round_trip"])
def test_atoms_of_residues_beyond_four_digits(spark, tmp_path, name):
    rows = [(i, [0.1, 0.2, 0.3], 7) for i in (9999, 10_000, 10_255, 51_281)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert sorted((r.resid, r.x) for r in q.QUERIES[name](spark, str(tmp_path)).collect()) == [(i, 5.0) for i, _, _ in rows]


@pytest.mark.parametrize("name", ["chunk_pairs", "probability_of_pairs"])
def test_no_pair_of_residues_is_joined(spark, name):
    """Pairs come from the grid of their hits; only hits, chains and sums by chunk are shuffled."""
    plan = q.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and not any("Join" in line for line in plan.split("MapInArrow")[0].splitlines())


@pytest.mark.parametrize("name", ["pdb_round_trip", "strict_atoms", "structure_read"])
def test_coordinates_keep_the_sign_of_zero(spark, tmp_path, name):
    """As the SQL's round, which makes -0.0 of a small negative number."""
    rows = [(i, [v, 0.2, 0.3], 7) for i, v in enumerate((-0.000005, 0.000005, -0.0, 0.0, -0.1, -0.0625))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.resid: str(r.x) for r in q.QUERIES[name](spark, str(tmp_path)).collect()}
    want = duckdb.sql(f"SELECT resid, CAST(x AS VARCHAR) FROM ({q.ORACLES[name].replace('FROM embeddings', f"FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")})").fetchall()
    assert got == dict(want) and got[0] == got[2] == "-0.0" and got[1] == got[3] == "0.0"


def test_parts_meet_hits_by_their_counted_rows(spark, monkeypatch):
    """Few parts are broadcast and lines are dealt once, by protein; many are merged, whatever Spark guesses."""
    at = "spark.sql.autoBroadcastJoinThreshold"
    plan = lambda: q.file_order_ranks(spark, SF)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    try:
        spark.conf.set(at, "1")
        few = plan()
        spark.conf.set(at, "10m")
        monkeypatch.setattr(joins, "_BROADCAST", 0)
        many = plan()
    finally:
        spark.conf.unset(at)
    assert few.count("BroadcastHashJoin") == 1 and few.count("Exchange hashpartitioning") == 2
    assert "Broadcast" not in many and many.count("SortMergeJoin") == 1


def test_asked_pairs_stay_with_their_protein(spark):
    """Hits are shuffled for their lines' numbers only: their blocks are counted where they are."""
    plan = q.probability_of_pairs(spark, SF)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "hashpartitioning(protein" in plan and not any("hashpartitioning" in x and ", i#" in x for x in plan.splitlines())


@pytest.mark.parametrize("dealt", [False, True])
def test_asked_pairs_of_odd_chains(spark, dealt):
    """Two blocks, a chain that ends before its pairs, and a protein without a chain."""
    hits = spark.createDataFrame([(1, [2, 300], 5.0, [(2, 300), (300, 2), (4, 4)]), (1, [2, 3], 7.0, [(2, 3)]), (2, [1, 2], 3.0, [(1, 2), (9, 2)]), (3, [1, 2], 1.0, [(1, 2)])], "protein long, res array<int>, prob double, asked array<struct<r1: int, r2: int>>")
    chains = spark.createDataFrame([(1, 300), (2, 5), (4, 9)], "protein long, length int")
    got = joins.pair_grid(hits, chains, "res", "prob", "asked", *[True] * dealt).collect()
    want = [(1, 2, 3, True, 7.0, 1), (1, 2, 300, True, 5.0, 1), (1, 4, 4, False, None, 0), (1, 300, 2, True, 5.0, 1), (2, 1, 2, True, 3.0, 1), (2, 9, 2, False, None, 0), (3, 1, 2, False, 1.0, 1)]
    assert sorted(tuple(r) for r in got) == want


def test_chains_of_chunks_read_hits_once(spark, monkeypatch):
    """The longest chain is found once, from each part's last residue, not from the hits."""
    calls, whole = [], q.hits
    monkeypatch.setattr(q, "hits", lambda *a: calls.append(a) or whole(*a))
    q.chunk_pairs(spark, SF)
    assert len(calls) == 1
