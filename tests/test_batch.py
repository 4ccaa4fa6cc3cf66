"""Runs: halts, resume, retries, layouts, the line readers over files of several splits, and the command line."""

import json

import pytest

from quillspan import cli
from quillspan.plans import stages, state
from quillspan.sources import parsers, shared, sinks
from test_stages import inputs  # noqa: F401  (a fixture)


def test_step_seven_runs_an_aligner(spark, inputs, tmp_path):  # noqa: F811
    def by_first_half(left, template):
        n = max(20, len(left) // 2)
        return (float(n), [(i + 1, i + 1) for i in range(min(n, len(left)))])

    got = stages.run(spark, inputs, str(tmp_path), stages.Params(aligner=by_first_half), until=7)["aligned"].collect()
    mine = sorted((r.hit_no, r.template, r.z, len(r.pairs)) for r in got if r.protein == "p1")
    assert mine == [(1, "t1", 60.0, 60), (2, "t1", 30.0, 30), (3, "t1", 20.0, 20), (4, "t2", 60.0, 60), (5, "t2", 30.0, 30), (6, "t2", 20.0, 20)]


def test_failed_critical_steps_halt_a_protein(spark, inputs, tmp_path):  # noqa: F811
    events = spark.createDataFrame([("p2", 3, "complete", None, 1), ("p2", 3, "failed", "no hits", 2), ("p1", 12, "failed", None, 1)], "protein string, step int, status string, error string, at long")
    got = stages.run(spark, inputs, str(tmp_path), until=6, events=events)
    assert {r.protein for r in got["candidates"].collect()} == {"p1"}
    done = spark.read.parquet(f"{tmp_path}/events")
    assert {(r.protein, r.step) for r in done.collect()} == {("p1", 4), ("p1", 5), ("p1", 6)}
    late = spark.createDataFrame([("p2", 7, "failed", None, 1)], events.schema)
    got = stages.run(spark, inputs, f"{tmp_path}/late", until=8, events=late)
    assert {r.protein for r in spark.read.parquet(f"{tmp_path}/late/step06_candidates").collect()} == {"p1", "p2"} and {r.protein for r in got["analysed"].collect()} == {"p1"}
    again = state.retry(events)
    assert state.pending(inputs["proteins"], state.steps(spark), events, 8).count() == 1
    assert state.pending(inputs["proteins"], state.steps(spark), again, 8).count() == 2


def test_resume_ends_where_inputs_change(spark, inputs, tmp_path):  # noqa: F811
    paths = {k: f"{tmp_path}/in/{k}" for k in inputs}
    for k, v in inputs.items():
        v.write.parquet(paths[k])
    load = lambda: {k: spark.read.parquet(p) for k, p in paths.items()}
    out = f"{tmp_path}/out"
    first = stages.run(spark, load(), out, until=4)["capped"].count()
    runs = lambda: spark.read.parquet(f"{out}/events").count()
    n = runs()
    stages.run(spark, load(), out, until=4)
    assert runs() == n  # read, not run again
    inputs["struct_search"].filter("template != 't2'").write.mode("overwrite").parquet(paths["struct_search"])
    assert stages.run(spark, load(), out, until=4)["capped"].count() == first - 1 and runs() == 2 * n


def test_latest_of_equal_times_is_a_failure(spark):
    rows = [("p", 1, "complete", None, 5), ("p", 1, "failed", "x", 5)]
    for data in (rows, rows[::-1]):
        got = state.latest(spark.createDataFrame(data, "protein string, step int, status string, error string, at long")).first()
        assert (got.status, got.error) == ("failed", "x")


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_over_splits(spark, tmp_path, small_splits):
    for name, n in (("a.txt", 200), ("b b.txt", 37), ("c.txt", 0)):
        (tmp_path / name).write_text("".join(f"{name} {i}\r\n" for i in range(n)))
    df = parsers.lines(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 1
    got = {(r.file, r.line_no): r.value for r in df.collect()}
    assert got == {(f, i): f"{f.replace('%20', ' ')} {i}" for f, n in (("a.txt", 200), ("b%20b.txt", 37)) for i in range(n)} or got == {(f, i): f"{f} {i}" for f, n in (("a.txt", 200), ("b b.txt", 37)) for i in range(n)}


def test_blocks_over_splits(spark, tmp_path, small_splits):
    (tmp_path / "x").write_text("".join(f">t{k}_1 {k}.5 9 100 0\nrotation1 1 0 0\n1\t{k}\n2\t{k + 1}\n" for k in range(1, 60)))
    got = parsers.structure_hits(parsers.blocks(spark, str(tmp_path))).collect()
    assert {(r.hit_no, r.hit, r.z, len(r.pairs), r.pairs[0].t) for r in got} == {(k, f"t{k}_1", k + 0.5, 2, k) for k in range(1, 60)}
    with pytest.raises(Exception, match="no pair of numbers"):
        parsers.simple_hits(parsers.blocks(spark, str(tmp_path))).collect()


def test_strict_atoms_fail_on_a_bad_line(spark):
    line = "ATOM      1  CA  GLY A   x       1.000   2.000   3.000  1.00  0.00           C"
    rows = spark.createDataFrame([("f", 1, line)], "file string, line_no long, value string")
    assert parsers.pdb_atoms(rows).count() == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parsers.pdb_atoms(rows, strict=True).collect()


def test_key_files_by_shard(spark, tmp_path):
    (tmp_path / "w" / "12").mkdir(parents=True)
    (tmp_path / "w" / "12" / "000000012.weight").write_text("1 x y 5\n")
    (tmp_path / "w" / "000000012.weight").write_text("1 x y 7\n")
    (tmp_path / "w" / "000000013.weight").write_text("1 x y 3\nshort\n")
    got = parsers.weight_rows(parsers.key_files(spark, str(tmp_path / "w"), "weight")).collect()
    assert {(r.template, r.position, r.weight) for r in got} == {("000000012", 1, 5.0), ("000000013", 1, 3.0)}


def test_databases_by_jdbc(spark):
    """The embedded database that comes with Spark; without one that answers, the files."""
    options = {"url": "jdbc:derby:memory:quillspan;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "template string, n int")
    keys = rows.filter("n > 1").select("template")
    try:
        rows.write.format("jdbc").options(**options).option("dbtable", "T").mode("overwrite").save()
    except Exception:  # noqa: BLE001
        pytest.skip("no embedded database here")
    got = parsers.table_or_files(spark, options, "T", keys, lambda: None)
    assert {(r.template, r.n) for r in got.collect()} == {("b", 2), ("c", 3)}
    assert parsers.table_or_files(spark, options, "NOT_THERE", keys, lambda: "files") == "files"
    assert parsers.table_or_files(spark, None, "T", keys, lambda: "files") == "files"


def test_folders_and_migration(spark):
    assert state.step_folder("r", 13) == "r/step13_parse_domains" and state.step_folder("r", 13, False) == "r" == state.step_folder("r", 99)
    files = spark.createDataFrame([("a.sse",), ("cache/x",), ("step01_prepare/a.fa",)], "file string")
    assert state.is_sharded(files) and not state.is_sharded(files.filter("file not like 'step%'"))
    known = spark.createDataFrame([(".sse", 11)], "suffix string, step int")
    got = {(r.file, r.action, r.target) for r in state.migration_plan(files, known, spark.createDataFrame([("a",)], "protein string"), ("cache",)).collect()}
    assert got == {("a.sse", "move", "step11_secondary_structure/a.sse"), ("cache/x", "move", "_batch/cache/x"), ("step01_prepare/a.fa", "skip", "step01_prepare/a.fa")}
    text = state.job_script("j", "in", "out", shared="hdfs://x/y")
    assert "spark.checkpoint.dir=hdfs://x/y" in text and text.startswith("#!/bin/sh")


def test_command_line(spark, inputs, tmp_path, capsys):  # noqa: F811
    for k, v in inputs.items():
        v.write.parquet(f"{tmp_path}/in/{k}")
    call = lambda *args: cli.execute(spark, cli.parser().parse_args([*map(str, args)]))
    assert call("run", f"{tmp_path}/in", f"{tmp_path}/out", "--until", 5).count() == 3
    status = {r.name: r.complete for r in call("status", f"{tmp_path}/out").collect()}
    assert status["mapped"] and not status["final"]
    assert call("summary", f"{tmp_path}/out/events").count() == 2 and call("retry", f"{tmp_path}/out/events").count() == 4
    cli.main(["--to", f"{tmp_path}/st", "status", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/st").count() == len(stages.PLAN)
    cli.main(["status", f"{tmp_path}/out"])
    assert len([json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]) == len(stages.PLAN)


def test_aliases(spark, inputs, tmp_path):  # noqa: F811
    assert stages.ALIASES[14] == 13


def test_numbers_as_c_prints_them(spark):
    values = [0.005, 0.015, 1.005, 2.675, 0.125, 0.375, -0.125, -0.004, 0.0, -0.0, 123456.785, 2.5, 99.995, 1.115] + [i / 1000 + 0.0005 for i in range(500)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for d in (0, 2, 3):
        assert all(r.t == f"{r.x:.{d}f}" for r in df.select("x", sinks.fixed("x", d).alias("t")).collect())


def test_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())


def test_large_groups_are_closed_by_rounds(spark):
    from quillspan.operators import graph

    edges = spark.createDataFrame([("p", i, i + 1) for i in range(30)] + [("q", 5, 7), ("q", 9, 9)], "protein string, a long, b long")
    want = {("p", i, 0) for i in range(31)} | {("q", 5, 5), ("q", 7, 5), ("q", 9, 9)}
    for fold in (1000, 10, 1):
        assert {tuple(r) for r in graph.closure(edges, fold=fold).collect()} == want

