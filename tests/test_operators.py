"""Operators against plain models, parsers, sinks, state and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.operators import align, cluster, graph, joins, ml, running, windows
from quillspan.plans import state, validate
from quillspan.sources import parsers, sinks
from quillspan.streaming import ingest


def test_coverage_cap_equals_the_sequential_scan(spark):
    rng = np.random.default_rng(0)
    rows = [("p", i, int(a), int(a + rng.integers(0, 30)), float(rng.integers(0, 40))) for i, a in enumerate(rng.integers(1, 40, 300))]
    df = spark.createDataFrame(rows, "protein string, line_no long, qs int, qe int, evalue double")
    counts, want = {}, set()
    for _, i, a, b, _ in sorted(rows, key=lambda r: (r[4], r[1])):
        for r in range(a, b + 1):
            counts[r] = counts.get(r, 0) + 1
        if sum(counts[r] <= 20 for r in range(a, b + 1)) >= 10:
            want.add(i)
    assert {r.line_no for r in running.coverage_cap(df, F.col("evalue"), 10, 20).collect()} == want


def plain_clusters(pairs, threshold=0.64):
    n, t = {}, {}
    for i, j, c, s, _ in pairs:
        n[i, j] = n[j, i] = c
        t[i, j] = t[j, i] = s
    out = []
    for i, j, *_ in sorted([p for p in pairs if p[4] > threshold], key=lambda p: -p[4]):
        mine = [c for c in out if i in c or j in c]
        inner = lambda c: (sum(n.get((x, y), 0) for x in c for y in c if x < y), sum(t.get((x, y), 0) for x in c for y in c if x < y))
        between = lambda a, b: (sum(n.get((x, y), 0) for x in a for y in b), sum(t.get((x, y), 0) for x in a for y in b))
        rate = lambda c: c[1] / c[0] if c[0] else 0
        if not mine:
            out.append({i, j})
        elif len(mine) == 2:
            a, b = inner(mine[0]), inner(mine[1])
            x = rate(between(*mine)) * 1.1
            if a[0] <= 20 or b[0] <= 20 or x >= rate(a) or x >= rate(b):
                out = [c for c in out if c not in mine] + [mine[0] | mine[1]]
        elif not (i in mine[0] and j in mine[0]):
            new = j if i in mine[0] else i
            a = inner(mine[0])
            if a[1] <= 20 or rate(between(mine[0], {new})) * 1.1 >= rate(a):
                mine[0].add(new)
    return out


def test_agglomeration_equals_a_plain_model():
    rng = np.random.default_rng(1)
    for _ in range(40):
        k = int(rng.integers(3, 14))
        pairs = [(i, j, int(rng.integers(1, 26)), 0.0, round(float(rng.random()), 3)) for i in range(k) for j in range(i + 1, k)]
        pairs = [(i, j, c, c * m, m) for i, j, c, _, m in pairs]
        assert sorted(map(sorted, cluster.agglomerate(pairs, 0.4))) == sorted(map(sorted, plain_clusters(pairs, 0.4)))


def test_last_residue_is_never_disordered(spark):
    df = spark.createDataFrame([("p", r, 0, 0) for r in range(1, 31)], "protein string, resid int, contacts long, hit int")
    assert {r.resid for r in windows.sliding_disorder(df).collect()} == set(range(1, 30))


def test_closure(spark):
    df = spark.createDataFrame([("p", "A", "B"), ("p", "B", "C"), ("p", "D", "E"), ("q", "A", "D")], "protein string, a string, b string")
    assert {(r.protein, r.node, r.label) for r in graph.closure(df).collect()} == {("p", "A", "A"), ("p", "B", "A"), ("p", "C", "A"), ("p", "D", "D"), ("p", "E", "D"), ("q", "A", "A"), ("q", "D", "A")}


def test_iterative_alignment():
    seen = []

    def aligner(left, template):
        seen.append(list(left))
        return (1.0, [(i + 1, i + 1) for i in range(25)]) if len(left) >= 25 else None

    got = align.rounds(list(range(1, 61)), "t", aligner)
    assert [len(q) for *_, q, _ in got] == [25, 25] and seen[1] == list(range(26, 61)) and len(seen) == 2
    assert align.tolerant_span([1, 2, 8]) == {1, 2, 8} and align.tolerant_span([1, 2, 7]) == set(range(1, 8))


def test_merge_needs_two_template_parts(spark):
    df = spark.createDataFrame([("p", 1, "A", "t", 0.9, list(range(1, 50))), ("p", 2, "B", "t", 0.9, list(range(60, 99))), ("p", 3, "C", "t", 0.9, list(range(1, 50)))], "protein string, row_no int, domain string, template string, prob double, tres array<int>")
    assert {(r.d1, r.d2) for r in joins.merge_candidates(df).collect()} == {("A", "B"), ("B", "C")}


def test_network_forms_agree(spark):
    w = ml.synthetic_weights(3, 5)
    df = spark.createDataFrame([(float(i) / 8, float(i % 3), 1.0) for i in range(20)], "a double, b double, c double")
    rows = ml.mlp(df, ["a", "b", "c"], w).withColumn("q", ml.mlp_column(["a", "b", "c"], w)).collect()
    assert all(abs(r.prob - r.q) < 1e-6 for r in rows)


def whole(spark, text, name="f"):
    return spark.createDataFrame([(name, text)], "file string, value string")


def test_fasta(spark):
    r = parsers.fasta(parsers.to_lines(whole(spark, ">one\nAC\nGT\n>two\n TT \n"))).first()
    assert (r.header, r.sequence) == ("two", "ACGTTT")


def test_sequence_search(spark):
    text = """Query x

>1abc_A Some protein
Probab=99.5 E-value=1e-20 Score=55.1 Aligned_cols=8 Identities=50% Similarity=0.9 Sum_probs=7.1

Q ss_pred             hhhh
Q query     3 AC-D    5 (20)
Q Consensus  3 ac-d    5 (20)
T Consensus  7 acgd   10 (99)
T 1abc_A    7 ACGD   10 (99)

Q query     6 EF       7 (20)
T 1abc_A   11 E-      11 (99)
>nothing here
"""
    rows = parsers.sequence_search(whole(spark, text)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.hit, r.probab, r.evalue, r.query, r.template) == ("1abc_A", "99.5", "1e-20", "AC-DEF", "ACGDE-")
    assert (r.q_start, r.q_end, r.t_start, r.t_end) == (3, 7, 7, 11)
    pairs = {(x.q, x.t) for x in joins.aligned_pairs(parsers.sequence_search(whole(spark, text))).collect()}
    assert pairs == {(3, 7), (4, 8), (5, 10), (6, 11)}


def test_structure_hits_without_pairs_go(spark):
    text = ">t1_1 12.5 2 100 0\nrotation1 1 0 0\nrotation2 0 1 0\nrotation3 0 0 1\ntranslation 1 2 3\n5 1\n6 2\n>t2_1 3.0 0 100 0\n"
    rows = parsers.structure_hits(parsers.to_blocks(whole(spark, text))).collect()
    assert [(r.hit, r.z, len(r.rotation), r.translation, [(p.q, p.t) for p in r.pairs]) for r in rows] == [("t1_1", 12.5, 3, "1,2,3", [(5, 1), (6, 2)])]


def test_alignment_report(spark):
    text = """  No:  Chain   Z    rmsd lali nres  %id
   1:  abcd-A 15.3  1.0   4   99   50
 1: mol1-A mol2-A   1 -   2 <=>    5 -   6
 1: mol1-A mol2-A   7 -   8 <=>   11 -  12
-matrix  "mol1-A mol2-A  U(1,.)  1.0 0.0 0.0 9.0"
"""
    r = parsers.alignment_report(whole(spark, text)).first()
    assert r.z == 15.3 and [(p.q, p.t) for p in r.pairs] == [(1, 5), (2, 6), (7, 11), (8, 12)] and len(r.matrix) == 1


@pytest.mark.parametrize("text", ['[{"predicted_aligned_error": [[0.0, 5.0], [6.0, 0.0]]}]', '{"pae": [[0, 5], [6, 0]]}', '{"residue1": [1, 1, 2, 2], "residue2": [1, 2, 1, 2], "distance": [0, 5, 6, 0]}'])
def test_pair_errors(spark, text):
    got = {(r.r1, r.r2): r.err for r in parsers.pair_errors(whole(spark, text)).collect()}
    assert got == {(1, 1): 0, (1, 2): 5, (2, 1): 6, (2, 2): 0}


def test_unknown_pair_errors_fail(spark):
    with pytest.raises(Exception, match="unknown pair error layout"):
        parsers.pair_errors(whole(spark, '{"x": 1}')).collect()


def test_segment_rules_of_secondary_structure(spark):
    codes = "HHH-HHH--EE-E--HH"
    df = spark.createDataFrame([("p", i + 1, c) for i, c in enumerate(codes)], "protein string, pos int, code string")
    got = {r.pos: r.sse_id for r in windows.secondary_structure(df, ["protein"]).collect()}
    assert [got[i] for i in (1, 7, 10, 13, 16)] == [1, 1, 2, 2, None] and got[4] is None


def test_pdb_round_trip(spark):
    atoms = spark.createDataFrame([("f", 3, 0, "CA", "C", "M", 1.5, -2.25, 100.125)], "file string, resid int, ord int, atom string, element string, letter string, x double, y double, z double")
    lines = sinks.pdb_lines(atoms).select("file", F.col("serial").cast("long").alias("line_no"), "value")
    r = parsers.pdb_atoms(lines.union(spark.createDataFrame([("f", 9, "ATOM  broken")], "file string, line_no long, value string"))).collect()
    assert [(x.atom, x.resname, x.resid, x.x, x.y, x.z) for x in r] == [("CA", "MET", 3, 1.5, -2.25, 100.125)]


def test_pdb_round_trip_of_long_numbers(spark):
    """Beyond four digits, beyond upper-case and lower-case base 36, and below -999."""
    want = [-1234567, -1000, -999, 0, 9999, 10_000, 10_255, 1_223_055, 1_223_056, 2_436_111, 2_436_112, 99_999_999]
    atoms = spark.createDataFrame([("f", r, 0, "CA", "C", "M", 1.5, -2.25, 100.125) for r in want], "file string, resid int, ord int, atom string, element string, letter string, x double, y double, z double")
    lines = sinks.pdb_lines(atoms).select("file", F.col("serial").cast("long").alias("line_no"), "value")
    assert {len(r.value) for r in lines.collect()} == {78} and {r.value[22:26] for r in lines.filter("line_no in (6, 9)").collect()} == {"A000", "a000"}
    for strict in (False, True):
        assert sorted((x.resid, x.x, x.y, x.z) for x in parsers.pdb_atoms(lines, strict).collect()) == [(r, 1.5, -2.25, 100.125) for r in want]
    serials = spark.range(1).select(F.explode(F.array(*map(F.lit, [99_999, 100_000, 43_770_015, 43_770_016, 87_440_031]))).alias("n"))
    assert [r.s for r in serials.select(sinks.hybrid36(F.col("n"), 5).alias("s")).collect()] == ["99999", "A0000", "ZZZZZ", "a0000", "zzzzz"]
    with pytest.raises(Exception, match="no form in 8 columns"):
        sinks.pdb_lines(atoms.limit(1).withColumn("resid", F.lit(100_000_000))).collect()


CIF = """data_x
loop_
_atom_site.group_PDB
_atom_site.type_symbol
_atom_site.label_atom_id
_atom_site.label_alt_id
_atom_site.label_comp_id
_atom_site.auth_asym_id
_atom_site.auth_seq_id
_atom_site.pdbx_PDB_model_num
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
ATOM C CA A MET A 1 1 1.0 2.0 3.0
ATOM C CA B MET A 1 1 9.0 9.0 9.0
ATOM H HA . MET A 1 1 0.0 0.0 0.0
ATOM C CA . GLY A 2 1 4.0 5.0 6.0
ATOM C CA . GLY A 2 2 7.0 7.0 7.0
HETATM O O . HOH A 3 1 0.0 0.0 0.0
#
loop_
_entity_poly_seq.entity_id
_entity_poly_seq.mon_id
1 MET
1 GLY
1 XXX
#
"""


def test_structure_file(spark):
    atoms = parsers.structure_atoms(whole(spark, CIF))
    assert sorted((r.resid, r.letter, r.x) for r in atoms.collect()) == [(1, "M", 1.0), (2, "G", 4.0)]
    seq = parsers.canonical_sequence(whole(spark, CIF))
    assert seq.first().sequence == "MGX"
    assert parsers.check_sequence(seq, atoms).first().observed == "MG-"


def test_state(spark):
    ev = spark.createDataFrame([("a", 2, "failed", "x", 1), ("b", 2, "failed", "x", 1), ("b", 2, "complete", None, 2), ("c", 5, "complete", None, 1), ("d", 3, "failed", None, 1)], "protein string, step int, status string, error string, at int")
    people = spark.createDataFrame([(p,) for p in "abcde"], "protein string")
    assert {r.protein for r in state.pending(people, state.steps(spark), ev, 5).collect()} == {"b", "e"}
    back = state.from_documents(state.to_document(ev).withColumnRenamed("protein", "file"))
    assert {(r.protein, r.step, r.status) for r in back.collect()} == {(r.protein, r.step, r.status) for r in state.latest(ev).collect()}
    legacy = state.from_documents(whole(spark, json.dumps({"protein": "z", "completed_steps": [1], "failed_steps": [2]})))
    assert {(r.step, r.status) for r in legacy.collect()} == {(1, "complete"), (2, "failed")}
    line = spark.createDataFrame([(state.log_line("a", 4, "done", 1.5),)], "value string")
    assert state.durations(state.logs(line)).first().mean == 1.5


def test_validation(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0 + 1e-9), (3, 2.0)], "k int, v double")
    assert {r.k for r in validate.tolerant_differences(a, b, ["k"], ["v"]).collect()} == {2, 3}
    assert validate.exact_differences(a, a).count() == 0


def test_stream_keeps_up(spark, tmp_path):
    rows = [(f"p{i % 2}", i, 1 + i % 5, 20 + i % 5, float(i)) for i in range(40)]
    schema = "protein string, line_no long, qs int, qe int, evalue double"
    src = f"{tmp_path}/in"
    run = lambda: ingest.capped(ingest.hit_stream(spark, src, schema), f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/ck", 10, 5)
    spark.createDataFrame(rows[:25], schema).write.parquet(src)
    ingest.run_now(run)
    spark.createDataFrame(rows[25:], schema).write.mode("append").parquet(src)
    ingest.run_now(run)
    want = running.coverage_cap(spark.createDataFrame(rows, schema), F.col("evalue"), 10, 5)
    assert {r.line_no for r in ingest.current(spark, f"{tmp_path}/out").collect()} == {r.line_no for r in want.collect()}


def plain_ranks(hits):
    out, seen = {}, {}
    for p, line, family, start, end in sorted(hits, key=lambda h: (h[0], h[1])):
        counts = []
        for r in range(min(start, end), max(start, end) + 1):
            seen.setdefault((p, r), set()).add(family)
            counts.append(len(seen[p, r]))
        out[p, line] = sum(counts) / len(counts)
    return out


def test_hit_ranks_over_blocks_and_batches(spark):
    """Hits over several blocks, more of a block than are counted at once, nulls, and no row for a residue on the way."""
    rng = np.random.default_rng(3)
    hits = [(f"p{i % 3}", i, None if i % 11 == 0 else f"f{rng.integers(40)}", int(a), int(a + rng.integers(0, 600 if i % 50 == 0 else 40))) for i, a in enumerate(rng.integers(1, 900, 5000))]
    hits[7] = (*hits[7][:3], hits[7][4], hits[7][3])
    rows = spark.createDataFrame(hits, "protein string, line_no int, family string, qs int, qe int")
    ranks = running.hit_ranks(rows.repartition(3), "family", [])
    assert "Generate explode(sequence(qs" not in ranks._jdf.queryExecution().toString()
    want = plain_ranks(hits)
    got = {(r.protein, r.line_no): r.rank for r in ranks.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_hits_are_dealt_once_for_ranks(spark):
    """The hits' own deal by protein serves the ranking: lines, templates, and sums by hit are all that is shuffled."""
    from pyspark.sql import functions as F

    from quillspan.plans import bindings, queries

    sf = "/root/testdata/sf0.001"
    assert queries.hits(spark, sf).exceptAll(bindings.bind(spark, sf, bindings.HITS)).count() == 0
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = running.hit_ranks(queries.hits(spark, sf), "family", [-F.col("z")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 4


def test_weighted_scores_send_nothing_through_the_driver(spark):
    """Weights listed twice add up, null positions and unknown ones count nothing, repeated positions count twice; no broadcast, no row for a position."""
    weights = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 1.0), ("a", 2, 5.0), ("a", None, 2.0), ("b", 1, 0.0), ("c", 1, None), ("c", 2, 4.0)], "template string, position int, weight double")
    hits = spark.createDataFrame([(1, "a", [1, 3]), (2, "a", [2, 2, None]), (3, "b", [1]), (4, "c", [1, 2]), (5, "a", []), (6, "x", [1])], "k int, template string, positions array<int>")
    got = joins.weighted_score(hits, weights, ["k"])
    assert {(r.k, r.template, r.qscore) for r in got.collect()} == {(1, "a", 0.3), (2, "a", 1.0), (3, "b", 0.0), (4, "c", 1.0)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan


def test_pair_grid_holds_every_pair_of_a_chain(spark):
    """Blocks, hits with gaps, chains without hits, hits beyond a chain, groups, and asked pairs in either order, on the diagonal and beyond."""
    rng = np.random.default_rng(5)
    hits = []
    for k in range(120):
        a = int(rng.integers(1, 500))
        res = list(range(a, a + int(rng.integers(1, 60))))
        hits.append((f"p{k % 2}", res if k % 3 else sorted({*res[::2], *(r + 270 for r in res[::5])}), None if k % 17 == 0 else float(rng.integers(1, 9))))
    lengths, groups = {"p0": 520, "p1": 300, "p2": 4}, {p: [None if r % 7 == 0 else r // 5 for r in range(1, n + 1)] for p, n in (("p0", 520), ("p1", 300), ("p2", 4))}
    df = spark.createDataFrame(hits, "protein string, res array<int>, score double")
    want = {(r.protein, r.r1, r.r2): (r.best, r.n) for r in joins.pair_scores(df, "res", "score").collect()}
    whole = {(p, a, b): want.get((p, a, b), (None, 0)) for p, n in lengths.items() for a in range(1, n + 1) for b in range(a + 1, n + 1)}
    chains = spark.createDataFrame(list(lengths.items()), "protein string, length int")
    grid = joins.pair_grid(df, chains, "res", "score")
    assert grid._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # hits, before they are pairs
    rows = grid.collect()
    assert len(rows) == len(whole) and {(r.protein, r.r1, r.r2): (r.best, r.n) for r in rows} == whole
    grouped = spark.createDataFrame([(p, n, groups[p]) for p, n in lengths.items()], "protein string, length int, groups array<int>")
    got = {(r.protein, r.r1, r.r2): (r.g1, r.g2, r.best, r.n) for r in joins.pair_grid(df, grouped, "res", "score").collect()}
    assert got == {(p, a, b): (groups[p][a - 1], groups[p][b - 1], *v) for (p, a, b), v in whole.items() if a % 7 and b % 7}
    asked = [(5, 9), (9, 5), (260, 3), (7, 7), (299, 302), (519, 520), (700, 2)]
    some = df.withColumn("asked", F.array(*[F.struct(F.lit(a).alias("r1"), F.lit(b).alias("r2")) for a, b in asked]))
    back = joins.pair_grid(some, chains, "res", "score", "asked").collect()
    assert len(back) == len(hits) * len(asked)
    for r in back:
        key = (r.protein, min(r.r1, r.r2), max(r.r1, r.r2))
        assert r.inside == (key in whole) and (not r.inside or (r.best, r.n) == whole[key])


def test_file_order_ranks_against_a_plain_model(spark):
    from quillspan.plans import queries

    sf = "/root/testdata/sf0.001"
    ranks = queries.file_order_ranks(spark, sf)
    assert "residue" not in ranks._jdf.queryExecution().toString()
    want = plain_ranks([(h.protein, h.line_no, h.family, h.qs, h.qe) for h in queries.hits(spark, sf).collect()])
    got = {(r.protein, r.line_no): r.rank for r in ranks.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k] / 10) < 2e-6 for k in want)
