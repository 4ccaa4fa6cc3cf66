"""Queries of the stages' inner joins, choices and counts on derived relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lookups as lk
from ..operators import cluster, joins, windows
from ..sources.shared import settle
from . import bindings as bd
from . import stages, state, validate
from .format_queries import _EV, _LATEST, run_events
from .queries import _LONGEST, DR, ORACLES, A, H, all_chunks, domain_rows, domains, hits, pair_stats, query

_LI = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- joins


@query(
    "mapped_hits",
    f"""SELECT protein, hit_no, template, n, CAST(format('{{:.3f}}', n / length) AS DOUBLE) AS coverage, CAST(format('{{:.3f}}', (last - first + 1) / length) AS DOUBLE) AS span_coverage FROM (
      SELECT protein, line_no AS hit_no, CAST(template AS VARCHAR) AS template, CAST(p_size + 40 AS DOUBLE) AS length, count(*) AS n, min(e) AS first, max(e) AS last
      FROM (SELECT protein, line_no, template, unnest(generate_series(ts, ts + qe - qs)) AS t FROM {H}) JOIN (SELECT p_partkey, p_size, unnest(generate_series(2, 60)) AS r FROM part WHERE p_partkey % 4 <> 0) ON p_partkey = template AND r = t, (SELECT 1) AS one, LATERAL (SELECT t - 1 AS e) GROUP BY ALL) WHERE n >= 10""",
)
def mapped_hits(spark, sf):
    """Sequence hits by their chain's template (every fourth chain is unknown), as positions among the template's residues 2-60."""
    h, part = hits(spark, sf), read(spark, sf, "part")
    n = F.col("qe") - F.col("qs") + 1
    seq = h.select("protein", F.col("line_no").alias("hit_no"), F.concat(F.lit("C"), F.col("template").cast("string")).alias("hit"), "prob", F.repeat(F.lit("A"), n).alias("query"), F.repeat(F.lit("C"), n).alias("template"), F.col("qs").alias("q_start"), F.col("ts").alias("t_start"))
    t = part.select(F.col("p_partkey").cast("string").alias("template"), (F.col("p_size") + 40).alias("length"), "p_partkey")
    chains = t.filter("p_partkey % 4 <> 0").select(F.concat(F.lit("C"), "template").alias("chain_key"), "template", F.sequence(F.lit(2), F.lit(60)).alias("resids"))
    got = stages.map_hits({"seq_search": seq, "chain_map": chains, "templates": t.select("template", "length")})
    return got.select("protein", "hit_no", "template", F.size("q").cast("bigint").alias("n"), "coverage", "span_coverage")


@query(
    "history_sentinels",
    f"""WITH k AS (SELECT * FROM {H} WHERE template % 3 <> 0), o AS (SELECT h.protein, h.line_no, avg(CASE WHEN k.z > h.z THEN 1.0 ELSE 0.0 END) AS ztile, avg(CASE WHEN k.z / 40 > h.prob / 100 THEN 1.0 ELSE 0.0 END) AS qtile FROM {H} h JOIN k ON k.template = h.template GROUP BY ALL)
    SELECT h.protein, h.line_no, CASE WHEN has THEN prob / 100 ELSE -1.0 END AS qscore, CASE WHEN has THEN ztile ELSE -1.0 END AS ztile, CASE WHEN has THEN qtile ELSE -1.0 END AS qtile
    FROM (SELECT *, template % 3 <> 0 AND template % 4 <> 0 AS has FROM {H}) h LEFT JOIN o USING (protein, line_no)""",
)
def history_sentinels(spark, sf):
    """Scores by weights that every fourth template lacks, and histories that every third lacks: -1 without either."""
    h = hits(spark, sf).select("protein", "line_no", "template", "z", "prob")
    score = h.filter("template % 4 <> 0").select("protein", "line_no", (F.col("prob") / 100).alias("qscore"))
    past = h.filter("template % 3 <> 0").select("template", "z", (F.col("z") / 40).alias("q"))
    return stages.with_history(h, score, past, ["protein", "line_no"]).select("protein", "line_no", "qscore", "ztile", "qtile")


@query("hits_with_metadata", f"SELECT protein, line_no, p_brand AS family FROM {H} JOIN part ON p_partkey = template WHERE p_partkey % 5 <> 0")
def hits_with_metadata(spark, sf):
    """Aligned hits joined to the templates' families as the analysis does; hits of unknown templates go."""
    h = hits(spark, sf)
    pairs = F.transform(F.sequence("qs", "qe"), lambda q: F.struct(q.alias("q"), (q - F.col("qs") + F.col("ts")).alias("t")))
    part = read(spark, sf, "part")
    w = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("template"), F.explode(F.sequence(F.lit(1), F.lit(90))).alias("position")).withColumn("weight", F.lit(1.0))
    got = stages.analyse({"aligned": h.select("protein", F.col("line_no").alias("hit_no"), "template", "z", pairs.alias("pairs")), "templates": part.filter("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("template"), F.col("p_brand").alias("family")), "weights": w, "history": h.select("template", "z", (F.col("z") / 40).alias("q"))})
    return got.select("protein", F.col("hit_no").alias("line_no"), "family")


_IC = f"""(SELECT protein, d1, d2, count(DISTINCT (r1, r2)) AS contacts FROM (
    SELECT a.protein, x.domain AS d1, y.domain AS d2, a.resid AS r1, b.resid AS r2 FROM {A} a JOIN {A} b ON a.protein = b.protein AND a.resid <> b.resid AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) <= 8
    JOIN (SELECT protein, resid, resid % 4 AS domain FROM {A}) x ON x.protein = a.protein AND x.resid = a.resid JOIN (SELECT protein, resid, resid % 4 AS domain FROM {A}) y ON y.protein = b.protein AND y.resid = b.resid WHERE x.domain < y.domain) GROUP BY ALL)"""


@query("interfaces", f"SELECT protein, CAST(d1 AS INT) AS d1, CAST(d2 AS INT) AS d2, contacts, contacts >= 9 AS connected FROM {_IC}")
def interfaces(spark, sf):
    """Residue pairs within reach between the residues of four domains, and whether they are enough."""
    a = bd.bind(spark, sf, bd.ATOMS)
    d = a.select("protein", "resid", (F.col("resid") % 4).alias("domain")).distinct()
    return joins.interfaces(d, a).withColumn("connected", F.col("contacts") >= 9)


@query("judged_pairs", f"SELECT protein, d1, d2, CASE WHEN n % 3 = 0 THEN 1 WHEN n >= 9 THEN 2 ELSE 0 END AS judgment FROM (SELECT protein, CAST(d1 AS INT) AS d1, CAST(d2 AS INT) AS d2, contacts AS n FROM {_IC})")
def judged_pairs(spark, sf):
    i = settle(interfaces(spark, sf).drop("connected"), "interfaces")  # a few rows a protein, asked three times
    near = i.filter("contacts % 3 = 0").select("protein", "d1", "d2", F.lit(1).alias("seq"))
    return stages.judged_pairs(i.select("protein", "d1", "d2"), near, i).select("protein", "d1", "d2", "judgment")


@query("connected_groups", f"WITH RECURSIVE j AS ({ORACLES['judged_pairs']}), e AS (SELECT protein, d1 AS a, d2 AS b FROM j WHERE judgment > 0 UNION SELECT protein, d2, d1 FROM j WHERE judgment > 0), r(protein, node, label) AS (SELECT DISTINCT protein, a, a FROM e UNION SELECT e.protein, e.b, r.label FROM r JOIN e ON e.protein = r.protein AND e.a = r.node) SELECT protein, label, string_agg(CAST(node AS VARCHAR), ',' ORDER BY node) AS members FROM (SELECT protein, node, min(label) AS label FROM r GROUP BY ALL) GROUP BY ALL")
def connected_groups(spark, sf):
    """Pairs that are judged to belong together, as groups with sorted members."""
    from ..operators.graph import merged_domains

    d = bd.bind(spark, sf, bd.ATOMS).groupBy("protein", (F.col("resid") % 4).alias("domain")).agg(F.array_sort(F.collect_set("resid")).alias("resids"))
    return merged_domains(stages.connected(judged_pairs(spark, sf)), d).select("protein", "label", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"))


@query("keyword_default", f"SELECT protein, line_no, CASE WHEN p_partkey % 3 <> 0 THEN p_type ELSE 'na' END AS keyword FROM {H} JOIN part ON p_partkey = template")
def keyword_default(spark, sf):
    t = read(spark, sf, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("template"), F.col("p_type").alias("keyword"))
    return stages.with_keywords(hits(spark, sf).select("protein", "line_no", "template"), t).select("protein", "line_no", "keyword")


@query("length_ratios", f"SELECT protein, line_no, CASE WHEN p_size % 2 = 0 THEN CAST(qe - qs + 1 AS DOUBLE) / p_size ELSE CAST(greatest(1, qe - qs) AS DOUBLE) / 80 END AS ratio FROM {H} JOIN part ON p_partkey = template")
def length_ratios(spark, sf):
    """Lengths over their topology's mean; without one, the evidence over the template's length."""
    part = read(spark, sf, "part").select(F.col("p_partkey").alias("template"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("double")).alias("avg_length"))
    h = hits(spark, sf).join(part, "template").withColumns({"resids": F.sequence("qs", "qe"), "tres": F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("qe") - F.col("qs"))), "t_length": F.lit(80)})
    return h.select("protein", "line_no", stages.length_ratio().alias("ratio"))


# ---- choices and counts


@query("evidence_choice", f"SELECT protein, line_no, CASE WHEN s > n * 0.5 THEN 'structure' ELSE 'sequence' END AS kind FROM (SELECT protein, line_no, CAST(prob AS BIGINT) % 23 AS s, qe - qs + 1 AS n FROM {H})")
def evidence_choice(spark, sf):
    some = lambda n, first: F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda x: x + first)).otherwise(F.array().cast("array<int>"))
    h = hits(spark, sf).withColumns({"st": some((F.col("prob").cast("bigint") % 23).cast("int"), 1000), "hh": some(F.col("qe") - F.col("qs") + 1, 0)})
    got = h.withColumn("chosen", lk.template_evidence("st", "hh"))
    return got.select("protein", "line_no", F.when((F.size("chosen") > 0) & (F.get("chosen", F.lit(0)) > 1000), "structure").otherwise("sequence").alias("kind"))


@query("evidence_counts", f"SELECT count(*) AS mapped, count(*) FILTER (line_no % 3 > 0) AS hh, count(*) FILTER (line_no % 4 > 0) AS st, count(*) FILTER (line_no % 3 > 0 AND line_no % 4 > 0) AS both FROM {H}")
def evidence_counts(spark, sf):
    some = lambda k: F.when(F.col("line_no") % k > 0, F.sequence("qs", "qe")).otherwise(F.array().cast("array<int>"))
    return stages.evidence_counts(hits(spark, sf).withColumns({"hh": some(3), "st": some(4)}))


@query("best_predictions", f"SELECT protein, label, template, line_no FROM (SELECT protein, family AS label, template, line_no, row_number() OVER (PARTITION BY protein, family, template ORDER BY prob DESC, line_no) AS k FROM {H}) WHERE k = 1")
def best_predictions(spark, sf):
    return stages.best_predictions(hits(spark, sf).withColumns({"label": F.col("family"), "domain": F.col("line_no")})).select("protein", "label", "template", "line_no")


@query("long_domains", f"SELECT protein, domain, count(*) AS n FROM {DR} GROUP BY ALL HAVING count(*) >= 45")
def long_domains(spark, sf):
    return windows.long_domains(domain_rows(spark, sf), 45).groupBy("protein", "domain").agg(F.count(F.lit(1)).alias("n"))


@query("unique_templates", f"SELECT DISTINCT template FROM {H} WHERE z >= 8 OR prob >= 50")
def unique_templates(spark, sf):
    h = hits(spark, sf)
    c = stages.candidates({"mapped": h.filter("prob >= 50"), "capped": h.filter("z >= 8")})
    return stages.unique_templates({"candidates": c})


@query("disjoint_domains", f"SELECT d.protein, d.domain, len(list_intersect(a.r, d.r)) = 0 AS apart FROM (SELECT protein, domain, list(resid) AS r FROM {DR} GROUP BY ALL) d JOIN (SELECT protein, list(resid) AS r FROM {DR} WHERE domain = 0 GROUP BY ALL) a USING (protein) WHERE d.domain > 0")
def disjoint_domains(spark, sf):
    d = domains(spark, sf)
    first = d.filter("domain = 0").select("protein", F.col("resids").alias("r"))
    return d.filter("domain > 0").join(first, "protein").select("protein", "domain", (F.size(F.array_intersect("resids", "r")) == 0).alias("apart"))


# ---- greedy agglomeration as recursive SQL

_AGG_PAIRS = "(SELECT l_orderkey AS protein, a AS i, b AS j, 25 AS n, CAST(25 * m AS DOUBLE) AS total, CAST(m AS DOUBLE) AS mean FROM (SELECT l_orderkey, x.l_linenumber AS a, y.l_linenumber AS b, CAST((x.l_partkey * 7 + y.l_partkey * 3 + x.l_linenumber) % 64 AS DOUBLE) / 64 AS m FROM lineitem x JOIN lineitem y USING (l_orderkey) WHERE x.l_linenumber < y.l_linenumber QUALIFY row_number() OVER (PARTITION BY l_orderkey, a, b ORDER BY m) = 1))"


def agglomeration_sql(pairs: str, threshold: float) -> str:
    """(protein, members: list of chunks) of (protein, i, j, n, total, mean), one pair a round."""
    mean = "(CASE WHEN link[1] > 0 THEN link[2] / link[1] ELSE 0 END) * 1.1"
    sums = lambda test: f"(SELECT [CAST(sum(e.n) AS DOUBLE), sum(e.t)] FROM (SELECT unnest(list_filter(ps, lambda q: {test})) AS e))"
    return f"""(WITH RECURSIVE p AS MATERIALIZED {pairs},
    o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY protein ORDER BY mean DESC, i, j) AS k FROM p WHERE mean > {threshold}),
    whole AS MATERIALIZED (SELECT protein, list({{'i': i, 'j': j, 'n': n, 't': total}}) AS ps FROM p GROUP BY protein),
    s(protein, k, c) AS (SELECT protein, CAST(0 AS BIGINT), CAST([] AS BIGINT[][]) FROM whole
      UNION ALL SELECT protein, k, CASE WHEN x IS NULL AND y IS NULL THEN list_append(c, [i, j])
          WHEN x IS NOT NULL AND y IS NOT NULL AND x = y THEN c
          WHEN x IS NULL OR y IS NULL THEN CASE WHEN nx[2] <= 20 OR {mean} >= nx[2] / nx[1] THEN list_transform(c, lambda z: CASE WHEN z = coalesce(x, y) THEN list_append(z, CASE WHEN x IS NULL THEN i ELSE j END) ELSE z END) ELSE c END
          WHEN nx[1] <= 20 OR ny[1] <= 20 OR {mean} >= least(nx[2] / nx[1], ny[2] / ny[1]) THEN list_append(list_filter(c, lambda z: z <> x AND z <> y), list_concat(x, y))
          ELSE c END
      FROM (SELECT *, {sums("(list_contains(coalesce(x, [i]), q.i) AND list_contains(coalesce(y, [j]), q.j)) OR (list_contains(coalesce(x, [i]), q.j) AND list_contains(coalesce(y, [j]), q.i))")} AS link,
          {sums("list_contains(coalesce(x, y), q.i) AND list_contains(coalesce(x, y), q.j)")} AS nx, {sums("list_contains(y, q.i) AND list_contains(y, q.j)")} AS ny
        FROM (SELECT s.protein, o.k, o.i, o.j, s.c, w.ps, list_filter(s.c, lambda z: list_contains(z, o.i))[1] AS x, list_filter(s.c, lambda z: list_contains(z, o.j))[1] AS y
          FROM s JOIN o ON o.protein = s.protein AND o.k = s.k + 1 JOIN whole w ON w.protein = s.protein)))
    SELECT protein, z AS members FROM (SELECT protein, unnest(c) AS z FROM s QUALIFY k = max(k) OVER (PARTITION BY protein)))"""


@query("agglomerated", f"SELECT protein, array_to_string(list_sort(members), ',') AS members FROM {agglomeration_sql(_AGG_PAIRS, 0.64)}")
def agglomerated(spark, sf):
    """Clusters of the lines of an order by made-up means of their pairs."""
    li = read(spark, sf, "lineitem")
    x, y = (li.select("l_orderkey", F.col("l_linenumber").alias(c), F.col("l_partkey").alias(f"p{c}")) for c in "ij")
    m = ((F.col("pi") * 7 + F.col("pj") * 3 + F.col("i")) % 64).cast("double") / 64
    pairs = x.join(y, "l_orderkey").filter("i < j").groupBy(F.col("l_orderkey").alias("protein"), "i", "j").agg(F.min(m).alias("mean"))
    pairs = pairs.select("protein", "i", "j", F.lit(25).alias("n"), (25 * F.col("mean")).alias("total"), "mean")
    return cluster.clusters(pairs).groupBy("protein", "cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list("chunk")), lambda c: c.cast("string")), ",").alias("members")).drop("cluster")


_SHOWN = f"(SELECT protein, i, j, n, round(coalesce(total, 0), 6) AS total, round(coalesce(total, 0) / n, 6) AS mean FROM ({ORACLES['chunk_pairs'].rpartition('SELECT protein, CAST(i AS BIGINT)')[0].rstrip()} SELECT * FROM g))"


@query(
    "chunk_clusters",
    f"""WITH m AS MATERIALIZED {agglomeration_sql(_SHOWN, 0.5)}, r AS (SELECT protein, members, 5 * unnest(members) AS low, row_number() OVER () AS no FROM m),
    x AS (SELECT protein, members, unnest(generate_series(low + 1, least(low + 5, {_LONGEST}))) AS resid FROM r),
    n AS (SELECT protein, members, row_number() OVER (PARTITION BY protein ORDER BY avg(resid)) AS domain FROM x GROUP BY protein, members)
    SELECT x.protein, CAST(n.domain AS INT) AS domain, CAST(x.resid AS INT) AS resid FROM x JOIN n ON n.protein = x.protein AND n.members = x.members""",
)
def chunk_clusters(spark, sf):
    """Domains of whole chains by all hits; sums rounded, so that their order of adding decides nothing."""
    s = pair_stats(spark, sf)
    s = s.withColumns({"mean": F.round("mean", 6), "total": F.round("total", 6)})
    return cluster.cluster_chunks(s, all_chunks(spark, sf), 0.5)


# ---- runs


@query("retried", f"SELECT protein, step, event_id AS at FROM {_EV} e WHERE NOT EXISTS (SELECT 1 FROM {_LATEST} l WHERE l.protein = e.protein AND l.step = e.step AND l.status = 'failed')")
def retried(spark, sf):
    return state.retry(run_events(spark, sf)).select("protein", "step", "at")


@query("migration", "SELECT action, target, count(*) AS n FROM (SELECT unnest(CASE k WHEN 0 THEN [{'action': 'move', 'target': 'step11_secondary_structure/' || f}] WHEN 1 THEN [{'action': 'move', 'target': 'step24_integrate/' || f}, {'action': 'copy', 'target': 'results/' || f}] WHEN 2 THEN [{'action': 'move', 'target': '_batch/' || f}] ELSE [{'action': 'skip', 'target': f}] END, recursive := true) FROM (SELECT p_partkey % 4 AS k, CASE p_partkey % 4 WHEN 0 THEN 'x' || p_partkey || '.sse' WHEN 1 THEN 'x' || p_partkey || '.finished' WHEN 2 THEN 'cache/x' || p_partkey ELSE 'y' || p_partkey || '.sse' END AS f FROM part)) GROUP BY ALL")
def migration(spark, sf):
    """What becomes of the files of a flat folder; those of proteins that nobody asked for stay."""
    k, n = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    p = read(spark, sf, "part")
    files = p.select(F.when(k == 0, F.concat(F.lit("x"), n, F.lit(".sse"))).when(k == 1, F.concat(F.lit("x"), n, F.lit(".finished"))).when(k == 2, F.concat(F.lit("cache/x"), n)).otherwise(F.concat(F.lit("y"), n, F.lit(".sse"))).alias("file"))
    known = spark.createDataFrame([(".sse", 11), (".finished", 24)], "suffix string, step int")
    got = state.migration_plan(files, F.broadcast(known), p.select(F.concat(F.lit("x"), n).alias("protein")), ("cache",))
    return got.groupBy("action", "target").agg(F.count(F.lit(1)).alias("n"))


@query("comparison_report", "SELECT step, critical, n AS differences, CASE WHEN n = 0 THEN 'pass' WHEN critical THEN 'fail' ELSE 'warn' END AS verdict FROM (SELECT s.step, s.step IN (2, 3, 7) AS critical, count(event_id) AS n FROM (SELECT CAST(unnest(generate_series(1, 12)) AS INT) AS step) s LEFT JOIN events ON event_id % 9 = s.step GROUP BY ALL)")
def comparison_report(spark, sf):
    e = read(spark, sf, "events").select((F.col("event_id") % 9).cast("int").alias("step"))
    return validate.report(e, state.steps(spark).filter("step <= 12").select("step", "critical"))


@query("protein_scores", "SELECT p_partkey AS part, round(CASE WHEN p_size % 4 = p_partkey % 4 THEN 33.0 ELSE 0.0 END + 33 * (p_size / 50.0) + 34 * (p_partkey % 3 / 2.0), 6) AS score FROM part")
def protein_scores(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("part"), (F.col("p_size") % 4).alias("n_a"), (F.col("p_partkey") % 4).alias("n_b"), (F.col("p_size") / 50).alias("mean_jaccard"), (F.col("p_partkey") % 3 / 2).alias("same_class"))
    return validate.protein_score(p).select("part", F.round("score", 6).alias("score"))


@query("spaces_collapsed", "SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') AS value FROM documents")
def spaces_collapsed(spark, sf):
    return validate.collapse_space(read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("value")))
