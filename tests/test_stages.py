"""All stages on two small proteins of two compact domains each."""

import pytest
from pyspark.sql import functions as F

from quillspan.plans import stages


@pytest.fixture(scope="module")
def inputs(spark):
    n = 120
    proteins = [("p1", n), ("p2", n)]
    dom = lambda r: 0 if r <= 55 else 1 if r >= 66 else 2
    errors = [(p, a, b, 1.5 if dom(a) == dom(b) != 2 else 27.0) for p, _ in proteins for a in range(1, n + 1) for b in range(a + 1, n + 1)]
    atoms = [(p, r, 100.0 * dom(r) + (r % 5), float((r // 5) % 4), float(r % 3)) for p, _ in proteins for r in range(1, n + 1)]
    codes = [(p, r, "A", "H" if (r % 14) < 9 and dom(r) != 2 else "-") for p, _ in proteins for r in range(1, n + 1)]
    seq = [("p1", 1, "1ABC_A", 98.0, "A" * 50, "C" * 50, 3, 1), ("p1", 2, "2ABC_A", 97.0, "A" * 52, "C" * 52, 67, 1), ("p2", 1, "1ABC_A", 60.0, "A" * 20 + "-" * 5 + "A" * 25, "C" * 50, 3, 1), ("p2", 2, "9ZZZ_A", 99.0, "A" * 30, "C" * 30, 1, 1)]
    struct = [("p1", 1, "t1", 1, 55, 1e-9), ("p1", 2, "t2", 66, 118, 1e-8), ("p2", 1, "t1", 2, 54, 1e-7), ("p2", 2, "t3", 1, 6, 1e-3)]
    hits = [(p, i, t, z, [(a + k, 1 + k) for k in range(50)]) for p, i, t, z, a in [("p1", 1, "t1", 12.0, 3), ("p1", 2, "t2", 15.0, 67), ("p2", 1, "t1", 9.0, 3), ("p2", 2, "t2", 14.0, 67)]]
    templates = [("t1", "k1", "f1", "1.1.1.1", 55, 20.0, "fold one"), ("t2", "k2", "f2", "2.1.1.1", 55, 20.0, "fold two"), ("t3", "k3", "f3", "3.1.1.1", 55, 20.0, None)]
    make = spark.createDataFrame
    return {
        "proteins": make(proteins, "protein string, length int"), "errors": make(errors, "protein string, r1 int, r2 int, err double"), "atoms": make(atoms, "protein string, resid int, x double, y double, z double"),
        "codes": make(codes, "protein string, resid int, aa string, code string"), "seq_search": make(seq, "protein string, hit_no long, hit string, prob double, query string, template string, q_start int, t_start int"),
        "struct_search": make(struct, "protein string, line_no long, template string, qs int, qe int, evalue double"), "struct_hits": make(hits, "protein string, hit_no long, template string, z double, pairs array<struct<q:int,t:int>>"),
        "chain_map": make([("1ABC_A", "t1", list(range(1, 56))), ("2ABC_A", "t2", list(range(1, 56)))], "chain_key string, template string, resids array<int>"),
        "templates": make(templates, "template string, key string, family string, code string, length int, norm double, keyword string"),
        "weights": make([("t1", i, 1.0 + i % 3) for i in range(1, 56)], "template string, position int, weight double"),
        "history": make([("t1", z, 0.5) for z in (5.0, 10.0, 20.0)], "template string, z double, q double"),
        "residue_map": make([(t, i, i) for t in ("t1", "t2") for i in range(1, 56)], "template string, chain_resid int, template_resid int"), "tgroups": make([("1.1.1", 55.0)], "tgroup string, avg_length double"),
    }


@pytest.fixture(scope="module")
def tables(spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    weights = stages.ml.synthetic_weights(13, 64)
    weights = {"w1": weights["w1"] * 0, "b1": weights["b1"] * 0 + 1, "w2": weights["w2"] * 0, "b2": weights["b2"] * 0}
    weights["b2"][1] = 3.0  # every row is confident: 0.95
    keep = stages.infer
    plan = [(n, name, (lambda t, p: keep(t, p, weights)) if name == "predictions" else f) for n, name, f in stages.PLAN]
    old, stages.PLAN = stages.PLAN, plan
    try:
        yield stages.run(spark, inputs, folder)
    finally:
        stages.PLAN = old


def test_mapping_needs_aligned_residues(tables):
    got = {(r.protein, r.hit_no): r for r in tables["mapped"].collect()}
    assert set(got) == {("p1", 1), ("p1", 2), ("p2", 1)}  # the unknown chain goes
    assert got["p1", 1].coverage == 0.909 and len(got["p2", 1].e) == 45


def test_search_hits_need_ten_residues(tables):
    assert {(r.protein, r.template) for r in tables["capped"].collect()} == {("p1", "t1"), ("p1", "t2"), ("p2", "t1")}


def test_analysis(tables):
    got = {(r.protein, r.template): r for r in tables["analysed"].collect()}
    assert got["p1", "t1"].ztile == 0.33 and got["p1", "t2"].qscore == -1.0 and got["p1", "t1"].rank == 1.0


def test_domains_are_the_compact_parts(tables):
    got = {(r.protein, r.domain): r.range for r in tables["domains"].collect()}
    assert set(got) == {("p1", "D1"), ("p1", "D2"), ("p2", "D1"), ("p2", "D2")}
    for (_, d), text in got.items():
        a, b = map(int, text.split("-"))
        assert (a <= 5 and 45 <= b <= 60) if d == "D1" else (60 <= a <= 75 and b >= 110), got


def test_final_labels(tables):
    got = tables["final"].collect()
    assert {(r.protein, r.domain, r.template) for r in got} == {("p1", "nD1", "t1"), ("p1", "nD2", "t2"), ("p2", "nD1", "t1"), ("p2", "nD2", "t2")}
    assert all(r.label == "good_domain" and r.helices >= 3 for r in got)


def test_resume_reads_complete_stages(spark, inputs, tables, tmp_path):
    stages.run(spark, inputs, str(tmp_path), until=6)
    broken = dict(inputs, struct_search=inputs["struct_search"].withColumn("qs", F.raise_error(F.lit("run again")).cast("int")))
    again = stages.run(spark, broken, str(tmp_path), until=6)
    assert again["candidates"].count() == 3


def test_command_line(spark, inputs, tmp_path):
    from quillspan import cli

    for name, df in inputs.items():
        df.write.parquet(f"{tmp_path}/in/{name}")
    args = cli.parser().parse_args(["run", f"{tmp_path}/in", f"{tmp_path}/out", "--until", "5"])
    assert cli.execute(spark, args).count() == 3
    status = cli.execute(spark, cli.parser().parse_args(["status", f"{tmp_path}/out"]))
    assert {r.name for r in status.collect() if r.complete} == {"capped", "mapped"}
    same = cli.execute(spark, cli.parser().parse_args(["compare", f"{tmp_path}/in/weights", f"{tmp_path}/in/weights"]))
    assert same.count() == 0


def test_only_measured_tables_are_broadcast_in_a_run(spark):
    """A table exploded from few rows is not broadcast by the size of those; the settings come back."""
    at, later = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(at), spark.conf.get(later, None)
    small = spark.range(3).selectExpr("id", "explode(sequence(1, 1000)) AS place")
    plan = lambda: spark.range(9).join(small, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan()
    with stages.measured_broadcasts(spark):
        assert "Broadcast" not in plan() and spark.conf.get(later) == (before[1] or before[0])
    assert (spark.conf.get(at), spark.conf.get(later, None)) == before
