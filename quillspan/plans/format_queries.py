"""Queries of parsers, sinks, run state, features and validation: most write a format and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lookups as lk
from ..operators import align, graph, joins, ml, windows
from ..sources import parsers, sinks
from . import bindings as bd
from . import stages, state, validate
from .queries import DR, _DA, H, PR, domain_rows, domains, hits, query


def _file(c) -> F.Column:
    return F.concat(F.lit("p"), c.cast("string"))


@query("fasta_round_trip", "SELECT 'p' || doc_id AS file, 'h ' || doc_id AS header, regexp_replace(coalesce(text, ''), '\\s', '', 'g') AS sequence FROM documents")
def fasta_round_trip(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    seq = F.regexp_replace(F.coalesce("text", F.lit("")), r"[ \t\n\r\f\x0b]", "")
    rows = d.select(_file(F.col("doc_id")).alias("file"), F.concat(F.lit("h "), F.col("doc_id").cast("string")).alias("header"), F.concat(F.substring(seq, 1, 50), F.lit("\n"), F.substring(seq, 51, 1 << 30)).alias("sequence"))
    return parsers.fasta(parsers.to_lines(sinks.fasta_lines(rows)))


@query("pdb_round_trip", "SELECT 'p' || label AS file, CAST(vec_id AS INT) AS resid, 'CA' AS atom, round(CAST(embedding[1] AS DOUBLE) * 50, 2) AS x FROM embeddings")
def pdb_round_trip(spark, sf):
    a = bd.bind(spark, sf, bd.ATOMS).select(_file(F.col("protein")).alias("file"), "resid", F.lit(0).alias("ord"), F.lit("CA").alias("atom"), F.lit("C").alias("element"), F.lit("G").alias("letter"), *[lk.round_signed(c, 2).alias(c) for c in "xyz"])
    lines = sinks.pdb_lines(a).select("file", F.col("serial").cast("bigint").alias("line_no"), "value")
    return parsers.pdb_atoms(lines).select("file", "resid", "atom", "x")


@query("structure_search_parse", f"SELECT protein, CAST(template AS VARCHAR) AS template, qs, qe, evalue FROM {H}")
def structure_search_parse(spark, sf):
    cols = [F.lit("q"), F.concat(F.col("template").cast("string"), F.lit(".cif")), *[F.lit(0)] * 4, F.col("qs"), F.col("qe"), F.lit(1), F.lit(9), F.col("evalue"), F.lit(0)]
    lines = hits(spark, sf).select(F.col("protein").cast("string").alias("file"), "line_no", F.concat_ws("\t", *[c.cast("string") for c in cols]).alias("value"))
    return parsers.structure_search(lines).select(F.col("file").cast("bigint").alias("protein"), "template", "qs", "qe", "evalue")


def hit_text(spark, sf, rotated: bool):
    """(file, value): the hits of each protein in the alignment list's form."""
    h = hits(spark, sf)
    head = F.concat(F.lit(">"), F.col("template").cast("string"), F.lit("_1 "), F.col("z").cast("string"), F.lit(" 9 100 0"))
    rot = F.array(*[F.lit(f"rotation{k} 1 0 0") for k in (1, 2, 3)], F.lit("translation 1 2 3")) if rotated else F.array().cast("array<string>")
    pairs = F.transform(F.sequence("qs", "qe"), lambda q: F.concat(q.cast("string"), F.lit("\t"), (q - F.col("qs") + F.col("ts")).cast("string")))
    return h.select(F.col("protein").cast("string").alias("file"), F.col("line_no").cast("int").alias("hit_no"), F.array_join(F.concat(F.array(head), rot, pairs), "\n").alias("value"))


_HIT_SQL = f"SELECT protein, CAST(template AS VARCHAR) || '_1' AS hit, z, CAST(qe - qs + 1 AS BIGINT) AS n_pairs, qs AS q_first, CAST(ts + qe - qs AS INT) AS t_last FROM {H}"


def hit_shape(got):
    return got.select(F.col("file").cast("bigint").alias("protein"), "hit", "z", F.size("pairs").cast("bigint").alias("n_pairs"), F.col("pairs")[0]["q"].alias("q_first"), F.element_at("pairs", -1)["t"].alias("t_last"))


@query("structure_hits_parse", _HIT_SQL)
def structure_hits_parse(spark, sf):
    return hit_shape(parsers.structure_hits(parsers.to_blocks(hit_text(spark, sf, True))))


@query("simple_hits_parse", _HIT_SQL)
def simple_hits_parse(spark, sf):
    return hit_shape(parsers.simple_hits(parsers.to_blocks(hit_text(spark, sf, False))))


@query("pair_errors_parse", "SELECT user_id AS protein, CAST(i AS INT) AS r1, CAST(j AS INT) AS r2, CAST((user_id + i * 3 + j) % 30 AS DOUBLE) AS err FROM (SELECT DISTINCT user_id FROM events), generate_series(1, 12) a(i), generate_series(1, 12) b(j)")
def pair_errors_parse(spark, sf):
    u = spark.read.parquet(f"{sf}/events.parquet").select("user_id").distinct()
    grid = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.transform(F.sequence(F.lit(1), F.lit(12)), lambda j: ((F.col("user_id") + i * 3 + j) % 30).cast("double")))
    value = F.concat(F.lit("["), F.to_json(F.struct(grid.alias("predicted_aligned_error"))), F.lit("]"))
    return parsers.pair_errors(u.select(F.col("user_id").cast("string").alias("file"), value.alias("value"))).select(F.col("file").cast("bigint").alias("protein"), "r1", "r2", "err")


@query("sse_parse", "SELECT user_id AS entity, CAST(event_id AS INT) AS resid, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END AS sse_id FROM events")
def sse_parse(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    lines = sinks.tab_lines(e, [F.col("event_id"), F.lit("A"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 9), F.lit("H")])
    rows = e.select(F.col("user_id").cast("string").alias("file"), F.concat_ws("\t", F.col("event_id").cast("string"), F.lit("A"), F.coalesce(F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 9).cast("string"), F.lit("na")), F.lit("H")).alias("value"))
    assert lines.columns == ["value"]
    return parsers.sse_table(rows).select(F.col("file").cast("bigint").alias("entity"), "resid", "sse_id")


@query("good_residues_parse", f"SELECT protein, CAST(resid AS INT) AS resid FROM {DR} GROUP BY ALL")
def good_residues_parse(spark, sf):
    rows = domains(spark, sf).select(F.col("protein").cast("string").alias("file"), F.concat(F.lit("sequence\tp\t1\t2\t3\t4\t5\t6\t"), "text", F.lit("\t1-2\t1-2")).alias("value"))
    return parsers.good_residues(rows).select(F.col("file").cast("bigint").alias("protein"), "resid")


@query("dimension_last_wins", "SELECT CAST(p_size AS BIGINT) AS key, arg_max(p_retailprice, p_partkey) AS price FROM part GROUP BY p_size")
def dimension_last_wins(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    rows = p.select(F.lit("f").alias("file"), F.col("p_partkey").alias("line_no"), F.concat_ws(" ", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")).alias("value"))
    return parsers.dimension(rows, [("key", "bigint", 0), ("price", "double", 1)], "key")


@query("chain_map_parse", "SELECT chain_key, arg_max(template, k) AS template FROM (SELECT 'PDB' || p_size || '_A' AS chain_key, CAST(p_partkey AS VARCHAR) AS template, p_partkey AS k FROM part WHERE p_partkey % 4 <> 0) GROUP BY chain_key")
def chain_map_parse(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    ranges = F.when(F.col("p_partkey") % 4 == 0, F.lit("A:1-5,B:6-9")).otherwise(F.lit("A:1-5,A:8-9"))
    rows = p.select(F.col("p_partkey").alias("line_no"), F.concat_ws(" ", F.col("p_partkey").cast("string"), F.concat(F.lit("pdb"), F.col("p_size").cast("string")), ranges).alias("value"))
    return parsers.chain_map(rows).select("chain_key", "template")


@query("aligned_pairs", "SELECT o_orderkey, CAST(min(q) AS INT) AS q1, CAST(max(q) AS INT) AS q2, CAST(min(t) AS INT) AS t1, CAST(max(t) AS INT) AS t2, count(*) AS n FROM (SELECT o_orderkey, i, 10 + i - (CASE WHEN i > k THEN 1 ELSE 0 END) AS q, 20 + i - (CASE WHEN i > k + 3 THEN 2 WHEN i > k + 2 THEN 1 ELSE 0 END) AS t FROM (SELECT o_orderkey, CAST(o_orderkey % 9 AS BIGINT) AS k FROM orders), generate_series(0, 19) s(i) WHERE i <> k AND i <> k + 2 AND i <> k + 3) GROUP BY o_orderkey")
def aligned_pairs(spark, sf):
    from ..operators.joins import aligned_pairs as walk

    k = (F.col("o_orderkey") % 9).cast("int")
    letters = F.sequence(F.lit(0), F.lit(19))
    q = F.array_join(F.transform(letters, lambda i: F.when(i == k, "-").otherwise("A")), "")
    t = F.array_join(F.transform(letters, lambda i: F.when((i == k + 2) | (i == k + 3), "-").otherwise("C")), "")
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", q.alias("query"), t.alias("template"), F.lit(10).alias("q_start"), F.lit(20).alias("t_start"))
    return walk(o).groupBy("o_orderkey").agg(F.min("q").alias("q1"), F.max("q").alias("q2"), F.min("t").alias("t1"), F.max("t").alias("t2"), F.count(F.lit(1)).alias("n"))


@query("normalised_hits", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN 0.0 ELSE l_quantity / p_size END AS znorm, CASE WHEN l_quantity >= 20 AND l_tax * 10 >= 0.2 THEN CASE WHEN l_quantity >= 50 AND l_tax * 10 >= 0.3 THEN 'medium' ELSE 'low' END ELSE 'no' END AS support FROM lineitem JOIN part ON p_partkey = l_partkey")
def normalised_hits(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_partkey").alias("template"), F.col("l_quantity").alias("z"), F.col("l_quantity").alias("best_prob"), (F.col("l_tax") * 10).alias("best_cov"))
    norms = spark.read.parquet(f"{sf}/part.parquet").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("template"), F.col("p_size").alias("norm"))
    return sinks.normalised_hits(li, norms).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "znorm", "support")


@query("split_by_query", f"SELECT s_suppkey AS protein, count(line_no) AS hits FROM supplier LEFT JOIN {H} h ON h.protein = s_suppkey GROUP BY s_suppkey")
def split_by_query(spark, sf):
    wanted = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("protein"))
    return sinks.split_by_query(hits(spark, sf), wanted)[1]


@query("substructures", f"SELECT protein, domain, CAST(resid AS INT) AS resid FROM {DR} WHERE resid % 3 = 0")
def substructures(spark, sf):
    d = domains(spark, sf).select(F.col("protein").alias("file"), "domain", "resids")
    atoms = d.select("file").distinct().withColumn("resid", F.explode(F.sequence(F.lit(3), F.lit(400), F.lit(3))))
    return sinks.substructures(atoms, d).select(F.col("file").alias("protein"), "domain", "resid")


@query("group_union", f"SELECT protein, domain % 2 AS label, CAST(count(DISTINCT resid) AS BIGINT) AS n FROM {DR} GROUP BY ALL")
def group_union(spark, sf):
    """Domains of a protein joined to those two places on: the even and the odd ones."""
    d = domains(spark, sf)
    edges = d.select("protein", F.col("domain").alias("a"), F.col("domain") % 2).toDF("protein", "a", "b")
    return graph.merged_domains(edges, d.select("protein", "domain", "resids")).select("protein", "label", F.size("resids").cast("bigint").alias("n"))


@query("group_sizes", f"SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS members, CAST(max(n) AS INT) AS largest, avg(n) AS mean FROM (SELECT protein, domain % 2 AS g, count(DISTINCT domain) AS n FROM {DR} GROUP BY ALL)")
def group_sizes(spark, sf):
    d = domains(spark, sf)
    edges = d.select("protein", F.col("domain").alias("a"), F.col("domain") % 2).toDF("protein", "a", "b")
    return graph.group_sizes(graph.merged_domains(edges, d.select("protein", "domain", "resids"))).withColumn("members", F.col("members").cast("bigint"))


@query("interval_coverage", f"SELECT d.protein, domain, line_no, count(*) AS n FROM {DR} d JOIN {H} h ON h.protein = d.protein AND d.resid BETWEEN h.qs AND h.qe GROUP BY ALL")
def interval_coverage(spark, sf):
    """Every hit with the domains it covers, and how many of their residues."""
    return joins.common_residues(domains(spark, sf).select("protein", "domain", "resids"), hits(spark, sf).withColumn("residues", F.sequence("qs", "qe"))).select("protein", "domain", "line_no", F.col("n_common").cast("bigint").alias("n"))


# ---- features

_HB = f"(SELECT protein, domain, template, prob / 100 AS hh_prob, qs, qe, ts, line_no FROM (SELECT *, row_number() OVER (PARTITION BY protein, domain, template ORDER BY prob DESC, line_no) AS k FROM (SELECT *, CAST(line_no % 4 AS BIGINT) AS domain FROM {H} WHERE line_no % 2 = 0)) WHERE k = 1)"
_SB = f"(SELECT protein, domain, template, z / 10 AS z, qs, qe, ts, line_no FROM (SELECT *, row_number() OVER (PARTITION BY protein, domain, template ORDER BY z DESC, line_no) AS k FROM (SELECT *, CAST((line_no + 1) % 4 AS BIGINT) AS domain FROM {H} WHERE line_no % 2 = 1)) WHERE k = 1)"


@query(
    "feature_rows",
    f"""SELECT protein, domain, template, coalesce(hh_prob, 0.0) AS hh_prob, coalesce(s.z, 0.0) AS z, CAST(CASE WHEN s.z IS NULL THEN 10.0 ELSE 0.5 END AS DOUBLE) AS ztile,
    CASE WHEN hh_prob IS NOT NULL AND s.z IS NOT NULL THEN round(greatest(0, least(h.qe, s.qe) - greatest(h.qs, s.qs) + 1) / 100, 6) ELSE 0.0 END AS consensus_cov,
    CASE WHEN hh_prob IS NOT NULL AND s.z IS NOT NULL AND least(h.qe, s.qe) >= greatest(h.qs, s.qs) THEN round(CAST(abs((h.ts - h.qs) - (s.ts - s.qs)) AS DOUBLE), 6) ELSE -1.0 END AS consensus_diff
    FROM {_HB} h FULL JOIN {_SB} s USING (protein, domain, template)""",
)
def feature_rows(spark, sf):
    h = hits(spark, sf)
    hh = ml.best_per_template(h.filter("line_no % 2 = 0").withColumn("domain", F.col("line_no") % 4), "prob")
    st = ml.best_per_template(h.filter("line_no % 2 = 1").withColumn("domain", (F.col("line_no") + 1) % 4), "z")
    tres = F.sequence("ts", F.col("ts") + F.col("qe") - F.col("qs"))
    hh = hh.select("protein", "domain", "template", (F.col("prob") / 100).alias("hh_prob"), F.lit(0.5).alias("hh_cov"), F.lit(1.0).alias("hh_rank"), F.sequence("qs", "qe").alias("hq"), tres.alias("ht"), F.lit(100).alias("length"))
    st = st.select("protein", "domain", "template", (F.col("z") / 10).alias("z"), F.lit(0.5).alias("q"), F.lit(0.5).alias("ztile"), F.lit(0.5).alias("qtile"), F.lit(1.0).alias("st_rank"), F.sequence("qs", "qe").alias("sq"), tres.alias("stt"), F.lit(100).alias("length"))
    ranks = h.select("protein").distinct().withColumns({"max_hh": F.lit(4.0), "max_st": F.lit(12.0)})
    f = ml.features(hh, st, ranks)
    return f.select("protein", "domain", "template", "hh_prob", "z", "ztile", F.round("consensus_cov", 6).alias("consensus_cov"), F.round("consensus_diff", 6).alias("consensus_diff"))


@query("max_rank_floor", f"SELECT protein, greatest(coalesce(max(z), 10.0), 10.0) AS top FROM {H} GROUP BY protein")
def max_rank_floor(spark, sf):
    return hits(spark, sf).groupBy("protein").agg(ml.rank_floor(F.max("z")).alias("top"))


@query("best_per_topology", f"SELECT protein, domain, tgroup, max(prob) AS best FROM {PR} GROUP BY ALL")
def best_per_topology(spark, sf):
    return ml.best_per_topology(bd.bind(spark, sf, bd.PREDICTIONS))


_BC = f"(SELECT *, CASE WHEN prob < 0.85 THEN 3 WHEN line_no % 3 = 0 THEN 1 WHEN line_no % 3 = 1 THEN 2 ELSE 3 END AS r FROM {PR})"


@query("best_classified", f"SELECT protein, domain, template, prob, CASE r WHEN 1 THEN 'full' WHEN 2 THEN 'part' ELSE 'miss' END AS kind FROM (SELECT *, row_number() OVER (PARTITION BY protein, domain ORDER BY r, prob DESC, line_no) AS k FROM {_BC}) WHERE k = 1")
def best_classified(spark, sf):
    p = bd.bind(spark, sf, bd.PREDICTIONS)
    w = F.when(F.col("line_no") % 3 == 0, 0.9).when(F.col("line_no") % 3 == 1, 0.5).otherwise(0.1)
    p = p.withColumn("kind", lk.coverage_class("prob", w, w))
    return stages.best_classified(p, ["protein", "domain"], ["line_no"]).select("protein", "domain", "template", "prob", "kind")


@query(
    "iterative_alignment",
    f"""WITH RECURSIVE r(protein, template, k, residues) AS (SELECT protein, domain, 1, list_sort(list(resid)) FROM {DR} GROUP BY ALL
      UNION ALL SELECT protein, template, k + 1, residues[greatest(20, len(residues) // 2) + 1:] FROM r WHERE len(residues) >= 20)
    SELECT protein, template || '_' || k AS hit, CAST(greatest(20, len(residues) // 2) AS DOUBLE) AS z, CAST(greatest(20, len(residues) // 2) AS INT) AS n, CAST(residues[1] AS INT) AS q_first FROM r WHERE len(residues) >= 20""",
)
def iterative_alignment(spark, sf):
    """An injected aligner that takes the first half of what is left, 20 residues at least."""

    def halves(left, template):
        n = max(20, len(left) // 2)
        return (float(n), [(i + 1, i + 1) for i in range(min(n, len(left)))])

    return align.iterate(domains(spark, sf).select("protein", F.col("domain").alias("template"), "resids"), halves).select("protein", "hit", "z", "n", F.array_min("query").alias("q_first"))


# ---- state, validation, layout

_EV = "(SELECT 'p' || user_id AS protein, CAST(event_id % 9 + 1 AS INT) AS step, CASE WHEN event_id % 11 = 0 THEN 'failed' ELSE 'complete' END AS status, ts AS at, event_id FROM events)"
_LATEST = f"(SELECT protein, step, status FROM (SELECT *, row_number() OVER (PARTITION BY protein, step ORDER BY event_id DESC) AS k FROM {_EV}) WHERE k = 1)"


def run_events(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("protein"), (F.col("event_id") % 9 + 1).cast("int").alias("step"), F.when(F.col("event_id") % 11 == 0, "failed").otherwise("complete").alias("status"), F.lit(None).cast("string").alias("error"), F.col("event_id").alias("at"))


@query("run_latest", f"SELECT protein, step, status FROM {_LATEST}")
def run_latest(spark, sf):
    return state.latest(run_events(spark, sf)).select("protein", "step", "status")


@query("run_pending", f"SELECT DISTINCT protein FROM {_EV} e WHERE NOT EXISTS (SELECT 1 FROM {_LATEST} l WHERE l.protein = e.protein AND l.step = 8 AND l.status = 'complete') AND NOT EXISTS (SELECT 1 FROM {_LATEST} l WHERE l.protein = e.protein AND l.step IN (2, 3, 7) AND l.step < 8 AND l.status = 'failed')")
def run_pending(spark, sf):
    e = run_events(spark, sf)
    return state.pending(e.select("protein"), state.steps(spark), e, 8)


@query("run_summary", f"SELECT step, count(*) FILTER (status = 'complete') AS complete, count(*) FILTER (status = 'failed') AS failed FROM {_LATEST} GROUP BY step")
def run_summary(spark, sf):
    return state.summary(run_events(spark, sf))


@query("batch_summary", f"SELECT count(*) AS total, count(*) FILTER (bad = 0) AS success, count(*) FILTER (bad = 1) AS failed FROM (SELECT protein, max(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS bad FROM {_LATEST} GROUP BY protein)")
def batch_summary(spark, sf):
    e = run_events(spark, sf)
    return state.batch_summary(e, e.select("protein"))


@query("run_incomplete", f"SELECT DISTINCT protein FROM {_EV} e WHERE NOT EXISTS (SELECT 1 FROM {_LATEST} l WHERE l.protein = e.protein AND l.step = 9 AND l.status = 'complete')")
def run_incomplete(spark, sf):
    e = run_events(spark, sf)
    return state.incomplete(e.select("protein").distinct(), e, 9).select("protein")


@query("state_documents", f"SELECT protein, step, status FROM {_LATEST}")
def state_documents(spark, sf):
    docs = state.to_document(run_events(spark, sf)).select(F.col("protein").alias("file"), "value")
    return state.from_documents(docs).select("protein", "step", "status")


@query("classified_files", "SELECT 'x' || p_partkey || s AS file, 'x' || p_partkey AS protein, CASE s WHEN '.sse' THEN 11 WHEN '.diso' THEN 12 WHEN '.step16_predictions' THEN 16 END AS step FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '.sse' WHEN 1 THEN '.diso' WHEN 2 THEN '.step16_predictions' ELSE '.other' END AS s FROM part) WHERE s <> '.other'")
def classified_files(spark, sf):
    s = F.element_at(F.array(*map(F.lit, [".sse", ".diso", ".step16_predictions", ".other"])), (F.col("p_partkey") % 4 + 1).cast("int"))
    files = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("x"), F.col("p_partkey").cast("string"), s).alias("file"))
    known = spark.createDataFrame([(".sse", 11), (".diso", 12), (".step16_predictions", 16), ("predictions", 99)], "suffix string, step int")
    return state.classify_files(files, F.broadcast(known))


@query("clean_plan", "SELECT 'f' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '.tmp' WHEN 1 THEN '.keep.tmp' ELSE '.out' END AS file FROM part WHERE p_partkey % 3 = 0")
def clean_plan(spark, sf):
    end = F.element_at(F.array(*map(F.lit, [".tmp", ".keep.tmp", ".out"])), (F.col("p_partkey") % 3 + 1).cast("int"))
    files = spark.read.parquet(f"{sf}/part.parquet").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string"), end).alias("file"))
    return state.clean_plan(files, [r"\.tmp$"], [r"\.keep\."])


@query("exact_differences", "SELECT * FROM ((SELECT l_partkey, l_quantity, 'left' AS side FROM (SELECT l_partkey, l_quantity FROM lineitem EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 5 <> 0)) UNION ALL (SELECT l_partkey, l_quantity, 'right' FROM (SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 5 <> 0 EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem)))")
def exact_differences(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return validate.exact_differences(li.select("l_partkey", "l_quantity"), li.filter("l_orderkey % 5 <> 0").select("l_partkey", "l_quantity"))


@query("tolerant_differences", "SELECT p_partkey, p_retailprice AS p_retailprice_a, p_retailprice + 1 AS p_retailprice_b FROM part WHERE p_partkey % 10 = 0")
def tolerant_differences(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_retailprice")
    q = p.withColumn("p_retailprice", F.when(F.col("p_partkey") % 10 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice") + 1e-9))
    return validate.tolerant_differences(p, q, ["p_partkey"], ["p_retailprice"])


@query("backend_differences", "SELECT count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 11 <> 0) AS shared, count(*) FILTER (p_partkey % 11 = 0 AND p_partkey % 7 <> 0) AS left_only, count(*) FILTER (p_partkey % 7 = 0 AND p_partkey % 11 <> 0) AS right_only, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 2 = 0) AS z_far, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 3 = 0) AS n_far, CAST(0 AS BIGINT) AS q_far FROM part")
def backend_differences(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("template"), F.lit(1.0).alias("z"), F.lit(10).alias("n"), F.lit(0.5).alias("q"))
    b = p.withColumn("z", F.when(F.col("template") % 2 == 0, 3.0).otherwise(1.2)).withColumn("n", F.when(F.col("template") % 3 == 0, 20).otherwise(12))
    return validate.backend_differences(p.filter("template % 7 <> 0"), b.filter("template % 11 <> 0"))


@query("agreement_rubric", "SELECT avg(CASE WHEN j >= 0.8 THEN 1.0 ELSE 0.0 END) AS jaccard_80, round(avg(j), 6) AS mean_jaccard, avg(CASE WHEN j >= 0.2 THEN CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.0 END END) AS t_agreement, avg(CASE WHEN j < 0.2 THEN 1.0 ELSE 0.0 END) AS missed, (SELECT CAST(sum(p_size + 1) AS DOUBLE) / sum(p_size) FROM part) AS count_ratio FROM (SELECT p_size, CAST(p_partkey % 11 AS DOUBLE) / 10 AS j FROM part)")
def agreement_rubric(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    m = p.select((F.col("p_partkey") % 11 / 10).alias("jaccard"), (F.col("p_size") % 2 == 0).alias("same_t"), F.lit(True).alias("same_judge"))
    c = p.select(F.col("p_size").alias("n_a"), (F.col("p_size") + 1).alias("n_b"))
    return validate.rubric(m, c).select("jaccard_80", F.round("mean_jaccard", 6).alias("mean_jaccard"), "t_agreement", "missed", "count_ratio")


@query("shared_proteins", "SELECT l_suppkey AS protein FROM lineitem INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0")
def shared_proteins(spark, sf):
    li, s = spark.read.parquet(f"{sf}/lineitem.parquet"), spark.read.parquet(f"{sf}/supplier.parquet")
    return validate.shared_proteins(li.select(F.col("l_suppkey").alias("protein")), s.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("protein")))


@query("segment_islands", f"SELECT protein, domain, count(*) AS segments FROM (SELECT protein, domain, resid - row_number() OVER (PARTITION BY protein, domain ORDER BY resid) AS g FROM {DR} GROUP BY protein, domain, resid, g) GROUP BY protein, domain, g".replace("GROUP BY protein, domain, resid, g) GROUP BY protein, domain, g", ") GROUP BY protein, domain").replace("count(*) AS segments", "count(DISTINCT g) AS segments"))
def segment_islands(spark, sf):
    return windows.islands(domain_rows(spark, sf), ["protein", "domain"], "resid").groupBy("protein", "domain").agg(F.count(F.lit(1)).alias("segments"))
