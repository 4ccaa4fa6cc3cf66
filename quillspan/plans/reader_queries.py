"""Queries of the readers and writers that have a text form: each writes its format from a derived relation and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lookups as lk
from ..sources import parsers, shared, sinks
from . import bindings as bd
from . import state
from .queries import H, ORACLES, hits, query


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lined(rows, file, order, value):
    """(file, line_no, value)."""
    return rows.select(file.cast("string").alias("file"), order.cast("bigint").alias("line_no"), value.alias("value"))


# ---- structures and sequences

_ATOM_SQL = "SELECT DISTINCT ON (protein, resid) protein, resid, x, y, z FROM (SELECT label AS protein, CAST(vec_id AS INT) AS resid, round(CAST(embedding[1] AS DOUBLE) * 50, 3) AS x, round(CAST(embedding[2] AS DOUBLE) * 50, 3) AS y, round(CAST(embedding[3] AS DOUBLE) * 50, 3) AS z FROM embeddings)"
_CIF_HEAD = ["data_x", "loop_", *(f"_atom_site.{c}" for c in ("group_PDB", "id", "type_symbol", "label_atom_id", "label_alt_id", "label_comp_id", "auth_asym_id", "auth_seq_id", "Cartn_x", "Cartn_y", "Cartn_z", "pdbx_PDB_model_num"))]


def atom_rows(spark, sf):
    return bd.bind(spark, sf, bd.ATOMS).select("protein", "resid", *[lk.round_signed(c, 3).alias(c) for c in "xyz"])


@query("structure_read", f"SELECT protein, resid, 'CA' AS atom, 'C' AS element, 'L' AS letter, x FROM ({_ATOM_SQL})")
def structure_read(spark, sf):
    """Structure files with a second model, hydrogens, another chain, other records and alternate locations, of which one atom a residue stays."""
    a = atom_rows(spark, sf)
    row = lambda group, el, atom, alt, chain, model: F.concat_ws(" ", F.lit(group), F.col("resid").cast("string"), F.lit(el), F.lit(atom), F.lit(alt), F.lit("LEU"), F.lit(chain), F.col("resid").cast("string"), *[F.col(c).cast("string") for c in "xyz"], F.lit(model))
    kinds = [("ATOM", "C", "CA", "A", "A", "1"), ("ATOM", "C", "CA", "B", "A", "1"), ("ATOM", "H", "HA", ".", "A", "1"), ("ATOM", "C", "CA", ".", "B", "1"), ("HETATM", "C", "C1", ".", "A", "1"), ("ATOM", "C", "CA", ".", "A", "2")]
    lines = a.select("protein", F.col("resid"), F.posexplode(F.array(*[row(*k) for k in kinds])).alias("k", "line"))
    whole = lines.groupBy("protein").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "resid", "line"))), lambda s: s["line"]), "\n").alias("body"))
    whole = whole.select(F.col("protein").cast("string").alias("file"), F.concat(F.lit("\n".join(_CIF_HEAD) + "\n"), "body", F.lit("\n#\n")).alias("value"))
    got = parsers.structure_atoms(whole)
    return got.select(F.col("file").cast("bigint").alias("protein"), "resid", "atom", "element", "letter", "x")


@query("first_models", "SELECT label AS protein, count(*) AS n, CAST(max(vec_id) AS INT) AS last FROM embeddings GROUP BY label")
def first_models(spark, sf):
    """Atom lines of two models: those of the second go."""
    a = bd.bind(spark, sf, bd.ATOMS).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    line = F.concat(F.lit("ATOM "), F.col("resid").cast("string"))
    rows = lined(a, F.col("protein"), F.col("k") * 10_000_000 + F.col("resid"), line).unionByName(lined(a.select("protein").distinct(), F.col("protein"), F.lit(9_999_999), F.lit("ENDMDL")))
    got = parsers.first_model(rows).filter("value != 'ENDMDL'")
    return got.groupBy(F.col("file").cast("bigint").alias("protein")).agg(F.count(F.lit(1)).alias("n"), F.max(F.split("value", " ")[1].cast("int")).alias("last"))


_SEQ = "['ALA', 'GLY', 'MSE', 'TRP', 'SEP'][CAST(1 + event_id % 5 AS INT)]"


@query("canonical_sequences", f"SELECT user_id AS entity, CASE user_id % 3 WHEN 2 THEN repeat('K', CAST(1 + user_id % 40 AS INT)) ELSE string_agg(CASE {_SEQ} WHEN 'ALA' THEN 'A' WHEN 'GLY' THEN 'G' WHEN 'MSE' THEN 'M' WHEN 'TRP' THEN 'W' ELSE 'S' END, '' ORDER BY event_id) END AS sequence FROM events GROUP BY user_id")
def canonical_sequences(spark, sf):
    """By the residue scheme, the entity's residues (no scheme) or its one-letter code; a modified residue counts as its parent."""
    e = read(spark, sf, "events")
    mon = F.element_at(F.array(*map(F.lit, ["ALA", "GLY", "MSE", "TRP", "SEP"])), (F.col("event_id") % 5 + 1).cast("int"))
    per = e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", mon.alias("m")))), lambda s: s["m"]).alias("ms"))
    scheme = F.concat(F.lit("loop_\n_pdbx_poly_seq_scheme.asym_id\n_pdbx_poly_seq_scheme.mon_id\n"), F.array_join(F.transform("ms", lambda m: F.concat(F.lit("A "), m)), "\n"), F.lit("\n#\n"))
    poly = F.concat(F.lit("loop_\n_entity_poly_seq.entity_id\n_entity_poly_seq.mon_id\n"), F.array_join(F.transform("ms", lambda m: F.concat(F.lit("1 "), m)), "\n"), F.lit("\n#\n"))
    code = F.concat(F.lit("_entity_poly.entity_id 1\n_entity_poly.pdbx_seq_one_letter_code_can "), F.repeat(F.lit("K"), (F.col("user_id") % 40 + 1).cast("int")), F.lit("\n#\n"))
    value = F.concat(F.lit("data_x\n#\n"), F.when(F.col("user_id") % 3 == 0, scheme).when(F.col("user_id") % 3 == 1, poly).otherwise(F.concat(code, poly)))
    parents = spark.createDataFrame([("SEP", "SER"), ("MSE", "MET")], "code string, parent string")
    got = parsers.canonical_sequence(per.select(F.col("user_id").cast("string").alias("file"), value.alias("value")), parents)
    return got.select(F.col("file").cast("bigint").alias("entity"), "sequence")


@query("observed_sequences", "SELECT user_id AS entity, string_agg(CASE WHEN i % 4 = 0 THEN '-' ELSE 'G' END, '' ORDER BY i) AS observed FROM (SELECT user_id, unnest(generate_series(1, 1 + user_id % 50)) AS i FROM (SELECT DISTINCT user_id FROM events)) GROUP BY user_id")
def observed_sequences(spark, sf):
    u = read(spark, sf, "events").select(F.col("user_id").cast("string").alias("file"), (1 + F.col("user_id") % 50).cast("int").alias("n")).distinct()
    residues = u.select("file", F.explode(F.sequence(F.lit(1), "n")).alias("resid")).filter("resid % 4 <> 0").withColumn("letter", F.lit("G"))
    got = parsers.check_sequence(u.select("file", F.repeat(F.lit("G"), F.col("n")).alias("sequence")), residues)
    return got.select(F.col("file").cast("bigint").alias("entity"), "observed")


@query("strict_atoms", f"SELECT protein, resid, x FROM ({_ATOM_SQL.replace(', 3)', ', 2)')})")
def strict_atoms(spark, sf):
    """Atom lines by the strict reader, which fails on a malformed one (tested apart)."""
    a = bd.bind(spark, sf, bd.ATOMS).select(F.col("protein").cast("string").alias("file"), "resid", F.lit(0).alias("ord"), F.lit("CA").alias("atom"), F.lit("C").alias("element"), F.lit("G").alias("letter"), *[lk.round_signed(c, 2).alias(c) for c in "xyz"])
    lines = sinks.pdb_lines(a).select("file", F.col("serial").cast("bigint").alias("line_no"), "value")
    return parsers.pdb_atoms(lines, strict=True).select(F.col("file").cast("bigint").alias("protein"), "resid", "x")


_PAIR = "CAST((user_id + i * 3 + j) % 30 AS DOUBLE)"


@query("pair_error_layouts", f"SELECT user_id AS protein, CAST(i AS INT) AS r1, CAST(j AS INT) AS r2, {_PAIR} AS err FROM (SELECT DISTINCT user_id FROM events), generate_series(1, 8) a(i), generate_series(1, 8) b(j) WHERE user_id % 2 = 0 OR i <= j")
def pair_error_layouts(spark, sf):
    """The layout of one matrix for even ids, that of listed pairs for odd ones."""
    u = read(spark, sf, "events").select("user_id").distinct()
    err = lambda i, j: ((F.col("user_id") + i * 3 + j) % 30).cast("double")
    eight = F.sequence(F.lit(1), F.lit(8))
    dense = F.to_json(F.struct(F.transform(eight, lambda i: F.transform(eight, lambda j: err(i, j))).alias("pae")))
    pairs = F.flatten(F.transform(eight, lambda i: F.transform(F.sequence(i, F.lit(8)), lambda j: F.struct(i.alias("i"), j.alias("j"), err(i, j).alias("e")))))
    u = u.withColumn("ps", pairs)
    sparse = F.to_json(F.struct(*[F.col(f"ps.{k}").alias(n) for k, n in (("i", "residue1"), ("j", "residue2"), ("e", "distance"))]))
    whole = u.select(F.col("user_id").cast("string").alias("file"), F.when(F.col("user_id") % 2 == 0, dense).otherwise(F.concat(F.lit("["), sparse, F.lit("]"))).alias("value"))
    return parsers.pair_errors(whole).select(F.col("file").cast("bigint").alias("protein"), "r1", "r2", "err")


# ---- searches


@query("sequence_search_parse", f"SELECT protein, 'T' || template AS hit, CAST(prob AS VARCHAR) AS probab, qs AS q_start, qe AS q_end, CAST(qe - qs + 1 AS INT) AS letters, ts AS t_start FROM {H}")
def sequence_search_parse(spark, sf):
    """Reports whose blocks have consensus and structure rows, and alignments over two rows."""
    h = hits(spark, sf)
    n = F.col("qe") - F.col("qs") + 1
    half = F.floor(n / 2).cast("int")
    row = lambda side, name, seq, a, b: F.concat_ws(" ", F.lit(side), F.lit(name), a.cast("string"), seq, b.cast("string"), F.lit("(300)"))
    two = lambda side, name, start, letter: F.array(row(side, name, F.repeat(F.lit(letter), half), start, start + half - 1), row(side, name, F.repeat(F.lit(letter), n - half), start + half, start + n - 1))
    one = lambda side, name, start, letter: F.array(row(side, name, F.repeat(F.lit(letter), n), start, start + n - 1))
    sides = [F.when(half > 0, two(s, name, F.col(c), x)).otherwise(one(s, name, F.col(c), x)) for s, name, c, x in (("Q", "query", "qs", "A"), ("T", "templ", "ts", "C"))]
    noise = F.array(F.lit("Q Consensus 1 aaaa 4 (9)"), F.lit("T ss_pred hhhh"))
    head = F.concat(F.lit(">T"), F.col("template").cast("string"), F.lit(" about it\nProbab="), F.col("prob").cast("string"), F.lit(" E-value=1e-5 Score=9.1 Aligned_cols=4 Identities=10% Similarity=0.1 Sum_probs=3.0"))
    block = F.array_join(F.concat(F.array(head), sides[0], noise, sides[1]), "\n")
    whole = h.select("protein", F.struct("line_no", block.alias("b")).alias("s")).groupBy("protein").agg(F.array_sort(F.collect_list("s")).alias("s"))
    whole = whole.select(F.col("protein").cast("string").alias("file"), F.concat(F.lit("Query x\n\n"), F.array_join(F.transform("s", lambda s: s["b"]), "\n\n")).alias("value"))
    return parsers.sequence_search(whole).select(F.col("file").cast("bigint").alias("protein"), "hit", "probab", "q_start", "q_end", F.length("query").alias("letters"), "t_start")


@query("alignment_report_parse", "SELECT p_partkey AS part, CAST(p_size AS DOUBLE) / 2 AS z, CAST(2 * (p_size + 1) AS BIGINT) AS n, CAST(1 AS INT) AS q_first, CAST(p_size + 112 + p_size AS INT) AS t_last FROM part")
def alignment_report_parse(spark, sf):
    """A report's first hit: two segments of equal lengths on both sides, one of unequal lengths that does not count, and a second hit."""
    p = read(spark, sf, "part")
    k = F.col("p_size")
    seg = lambda hit, q, t, m: F.concat(F.lit(f"   {hit}: mol1-A mol2-A "), q.cast("string"), F.lit(" - "), (q + k).cast("string"), F.lit(" <=> "), t.cast("string"), F.lit(" - "), (t + k + m).cast("string"))
    body = F.concat_ws("\n", F.lit("# No: Chain Z rmsd lali nres %id"), F.concat(F.lit("   1:  mol2-A "), (k / 2).cast("string"), F.lit("  2.1   90   100   20")), F.lit("   2:  mol3-A  1.0  2.1   90   100   20"), F.lit("# Structural equivalences"), seg(1, F.lit(1), F.lit(101), 0), seg(1, k + 11, k + 112, 0), seg(1, 2 * k + 40, 3 * k + 200, 1), seg(2, F.lit(1), F.lit(1), 0), F.lit('-matrix  "mol1-A mol2-A U(1,.) 1.0 0.0 0.0 5.0"'))
    got = parsers.alignment_report(p.select(F.col("p_partkey").cast("string").alias("file"), body.alias("value")))
    return got.select(F.col("file").cast("bigint").alias("part"), "z", F.size("pairs").cast("bigint").alias("n"), F.array_min(F.transform("pairs", lambda x: x["q"])).alias("q_first"), F.array_max(F.transform("pairs", lambda x: x["t"])).alias("t_last"))


@query("structure_codes_parse", ORACLES["secondary_structure"])
def structure_codes_parse(spark, sf):
    """Secondary-structure reports: what stands before the header row goes, and so do chain breaks."""
    c = bd.bind(spark, sf, bd.CODES)
    line = F.concat(F.lpad(F.col("pos").cast("string"), 5, " "), F.lpad(F.col("pos").cast("string"), 5, " "), F.lit(" A "), F.lit("G"), F.lit("  "), F.when(F.col("code") == "-", " ").otherwise(F.col("code")), F.lit("  X"))
    rows = lined(c, F.col("entity"), F.col("pos") + 10, line)
    files = c.select("entity").distinct()
    for k, text in ((0, "==== a report"), (1, "    7    7 A G  H"), (2, "  #  RESIDUE AA STRUCTURE"), (3, "    8        !*             0")):
        rows = rows.unionByName(lined(files, F.col("entity"), F.lit(k), F.lit(text)))
    return parsers.structure_codes(rows).select(F.col("file").cast("bigint").alias("entity"), F.col("pos").cast("bigint").alias("pos"), "sse_type", "sse_id")


@query("union_split", f"SELECT protein, tag, count(*) AS n, CAST(max(cells) AS INT) AS cells FROM (SELECT protein, 'sequence' AS tag, 8 AS cells FROM {H} WHERE prob >= 40 UNION ALL SELECT protein, 'structure', 15 FROM {H} WHERE z >= 6) GROUP BY ALL")
def union_split(spark, sf):
    """The tagged layout, written and split into its two kinds of rows."""
    h = hits(spark, sf).withColumns({"file": F.col("protein").cast("string"), "ecodnum": F.col("template"), "ecodid": F.col("family"), "probability": F.col("prob"), "coverage": F.lit(0.5), "ecodlen": F.lit(90), "qrange": F.lit("1-9"), "trange": F.lit("1-9"), "filtered": F.lit("1-9"), "hitname": F.lit("h"), "zscore": F.col("z"), "znorm": F.col("z") / 7, "support": F.lit("no"), "qscore": F.lit(0.1), "ztile": F.lit(0.1), "qtile": F.lit(0.1), "rank": F.lit(1.0), "bestprob": F.lit(0.0), "bestcov": F.lit(0.0)})
    rows = sinks.union_lines(h.filter("prob >= 40"), h.filter("z >= 6")).withColumn("line_no", F.lit(0))
    seq, st = parsers.tagged_hits(rows)
    both = seq.withColumn("tag", F.lit("sequence")).unionByName(st.withColumn("tag", F.lit("structure")))
    return both.groupBy(F.col("file").cast("bigint").alias("protein"), "tag").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("t")).alias("cells"))


@query("template_map_parse", f"SELECT h.protein, h.template, prob, CAST(qe - qs + 1 AS INT) AS n, p_size AS length FROM {H} h JOIN part ON p_partkey = h.template WHERE p_partkey % 3 <> 0")
def template_map_parse(spark, sf):
    """Mapped hits of 13 fields; templates without a length or metadata go, and so do the header and short rows."""
    h, part = hits(spark, sf), read(spark, sf, "part")
    cells = [F.col("template").cast("string"), F.lit("id"), F.col("prob").cast("string"), *[F.lit("0")] * 8, F.concat(F.col("qs").cast("string"), F.lit("-"), F.col("qe").cast("string")), F.lit("1-5")]
    rows = lined(h, F.col("protein"), F.col("line_no"), F.concat_ws("\t", *cells)).unionByName(lined(h.select("protein").distinct(), F.col("protein"), F.lit(0), F.lit("a\tb"))).unionByName(lined(h.select("protein").distinct(), F.col("protein"), F.lit(10**9), F.lit("short\trow")))
    t = part.select(F.col("p_partkey").cast("string").alias("template"), "p_size", "p_partkey")
    got = parsers.template_map(rows, t.filter("p_partkey % 3 <> 0").select("template", F.col("p_size").alias("length")), t.select("template"))
    return got.select(F.col("file").cast("bigint").alias("protein"), F.col("template").cast("bigint").alias("template"), "prob", F.size("query_resids").alias("n"), "length")


@query("candidate_keys", f"SELECT protein, CAST(template AS VARCHAR) AS key FROM {H} GROUP BY ALL")
def candidate_keys(spark, sf):
    """The first column of hit tables, without header and repeats."""
    h = hits(spark, sf)
    rows = lined(h, F.col("protein"), F.col("line_no"), F.concat_ws("\t", F.col("template").cast("string"), F.col("evalue").cast("string"))).unionByName(lined(h.select("protein").distinct(), F.col("protein"), F.lit(0), F.lit("ecodnum\tevalue")))
    return parsers.first_column(rows).select(F.col("file").cast("bigint").alias("protein"), "key")


@query("sorted_keys", f"SELECT protein, row_number() OVER (PARTITION BY protein ORDER BY key) AS line_no, key FROM (SELECT DISTINCT protein, CAST(template AS VARCHAR) AS key FROM {H})")
def sorted_keys(spark, sf):
    """Candidate keys one a line, in the order of their text (10 before 9)."""
    return sinks.key_lines(hits(spark, sf)).select(F.col("file").cast("bigint").alias("protein"), "line_no", F.col("value").alias("key"))


@query("capped_hits", f"SELECT protein, line_no FROM (SELECT *, row_number() OVER (PARTITION BY protein ORDER BY evalue, line_no) AS k FROM {H}) WHERE k <= 50")
def capped_hits(spark, sf):
    """A search's own limit on its output, 50 hits of a protein."""
    return sinks.capped(hits(spark, sf), ["protein"], [F.col("evalue"), F.col("line_no")], 50).select("protein", "line_no")


# ---- tables


@query("disorder_parse", "SELECT user_id AS protein, CAST(event_id AS INT) AS resid FROM events WHERE event_id % 5 <> 0")
def disorder_parse(spark, sf):
    e = read(spark, sf, "events")
    rows = e.select(F.col("user_id").cast("string").alias("file"), F.when(F.col("event_id") % 5 == 0, "x").otherwise(F.concat(F.lit(" "), F.col("event_id").cast("string"))).alias("value"))
    return parsers.disorder_table(rows).select(F.col("file").cast("bigint").alias("protein"), "resid")


@query("feature_layout", f"""SELECT protein, domain, template, CAST(CAST(format('{{:.3f}}', prob / 100) AS FLOAT) AS DOUBLE) AS f3, CAST(CAST(format('{{:.2f}}', z / 3) AS FLOAT) AS DOUBLE) AS f5, CAST(CAST(format('{{:.2f}}', z * 1.005) AS FLOAT) AS DOUBLE) AS f11
    FROM (SELECT protein, 'D' || line_no AS domain, CAST(template AS VARCHAR) AS template, prob, z, line_no FROM {H}) WHERE line_no % 10 <> 0""")
def feature_layout(spark, sf):
    """Feature rows in their layout, with decimals as C prints them, read back as 32-bit numbers; rows with a bad number go."""
    h = hits(spark, sf)
    number = F.when(F.col("line_no") % 10 == 0, F.lit(None).cast("double"))
    cols = {"domID": F.concat(F.lit("D"), F.col("line_no").cast("string")), "domRange": F.lit("1-9"), "tgroup": F.lit("1.1.1"), "ecodid": F.col("template"), "domLen": F.lit(9), "Helix_num": F.lit(1), "Strand_num": F.lit(2), "HHprob": F.col("prob") / 100, "HHcov": F.lit(0.5), "HHrank": F.col("z") / 3, "Dzscore": F.col("z"), "Dqscore": F.lit(0.5), "Dztile": F.lit(0.5), "Dqtile": F.lit(0.5), "Drank": F.lit(1.0), "Cdiff": F.when(F.col("line_no") % 10 == 0, number).otherwise(F.col("z") * 1.005), "Ccov": F.lit(0.5), **{c: F.lit("x") for c in ("HHname", "Dname", "Drot1", "Drot2", "Drot3", "Dtrans")}}
    rows = sinks.relation_lines(h.withColumns(cols).withColumn("file", F.col("protein").cast("string")), "features")
    got = parsers.feature_table(rows)
    return got.select(F.col("file").cast("bigint").alias("protein"), "domain", "template", *[F.col(c).cast("double").alias(c) for c in ("f3", "f5", "f11")])


@query("relation_layouts", f"""SELECT protein, line_no, value FROM (
    SELECT protein, row_number() OVER (PARTITION BY protein ORDER BY evalue, line_no) AS line_no, template || chr(9) || CAST(CAST(floor(evalue) AS BIGINT) AS VARCHAR) || chr(9) || qs || '-' || qe AS value FROM {H}
    UNION ALL SELECT DISTINCT protein, 0, 'ecodnum' || chr(9) || 'evalue' || chr(9) || 'range' FROM {H})""")
def relation_layouts(spark, sf):
    """The capped hits' text: a header and three columns, in the order of the search."""
    h = hits(spark, sf).withColumns({"ecodnum": F.col("template"), "score": F.col("evalue"), "range": F.concat(F.col("qs").cast("string"), F.lit("-"), F.col("qe").cast("string"))})
    h = h.withColumn("evalue", F.floor("score"))
    return sinks.relation_lines(h, "filtered_search", "protein", ["score", "line_no"]).withColumnRenamed("file", "protein")


@query("fixed_numbers", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, format('{:.2f}', l_extendedprice / 7) AS two, format('{:.3f}', (l_quantity - 25) / 8) AS three, format('{:.1f}', -l_discount * 2.5) AS one FROM lineitem")
def fixed_numbers(spark, sf):
    """Numbers as C prints them, ties among them."""
    li = read(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sinks.fixed(F.col("l_extendedprice") / 7, 2).alias("two"), sinks.fixed((F.col("l_quantity") - 25) / 8, 3).alias("three"), sinks.fixed(-F.col("l_discount") * 2.5, 1).alias("one"))


@query("residue_map_parse", "SELECT p_partkey AS part, CAST(i AS INT) AS chain_resid, CAST(i + p_size AS INT) AS template_resid FROM part, generate_series(1, 20) s(i) WHERE i % 6 <> 0")
def residue_map_parse(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_size", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("i"))
    rows = p.select(F.col("p_partkey").cast("string").alias("file"), F.concat_ws("\t", F.when(F.col("i") % 6 == 0, "-").otherwise(F.col("i").cast("string")), (F.col("i") + F.col("p_size")).cast("string")).alias("value"))
    return parsers.residue_map(rows).select(F.col("file").cast("bigint").alias("part"), "chain_resid", "template_resid")


@query("sharded_weights", "SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS template, CAST(i AS INT) AS position, CAST(i * CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 3 END AS DOUBLE) AS weight FROM part, generate_series(1, 5) s(i)")
def sharded_weights(spark, sf):
    """Weight files of even keys in their shard's folder (and, staler, in the flat one and in a wrong shard), of odd keys in the flat one only."""
    p = read(spark, sf, "part").select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("key"), "p_partkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i"))
    line = lambda k: F.concat_ws(" ", F.col("i").cast("string"), F.lit("x y"), (F.col("i") * k).cast("string"))
    none = F.lit(None).cast("string")
    even = p.filter("p_partkey % 2 = 0")
    rows = even.select("key", lk.shard_key("key").alias("shard"), line(2).alias("value"))
    rows = rows.unionByName(even.select("key", none.alias("shard"), line(7).alias("value"))).unionByName(p.select("key", F.lit("zz").alias("shard"), line(9).alias("value")))
    return parsers.weight_rows(rows.unionByName(p.filter("p_partkey % 2 = 1").select("key", none.alias("shard"), line(3).alias("value"))))


@query("history_files", "SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS template, CAST(p_size AS DOUBLE) / 4 AS z, CAST(p_size AS DOUBLE) / 100 AS q FROM part WHERE p_partkey % 5 <> 0")
def history_files(spark, sf):
    """History files written to a folder, of even keys below their shard, and read from there; every fifth key has none."""
    p = read(spark, sf, "part").filter("p_partkey % 5 <> 0").select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("key"), "p_size", "p_partkey")
    rows = p.select("key", F.when(F.col("p_partkey") % 2 == 0, lk.shard_key("key")).alias("shard"), F.concat_ws(" ", F.lit("x"), (F.col("p_size") / 4).cast("string"), (F.col("p_size") / 100).cast("string")).alias("value"))
    return parsers.history_rows(rows)


@query("reference_tables", "SELECT p_partkey AS part, p_size AS length, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS DOUBLE) / 2 END AS norm, CAST(p_size % 5 AS VARCHAR) || '.' || (p_partkey % 3) AS family FROM part")
def reference_tables(spark, sf):
    """All dimensions from their text tables, joined as the templates' table and queried as a view."""
    from ..functions.sql import register_tables

    p = read(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    rows = lambda value, where="true": p.filter(where).select(F.lit("f").alias("file"), F.col("p_partkey").alias("line_no"), value.alias("value"))
    code = F.concat_ws(".", (F.col("p_size") % 5).cast("string"), (F.col("p_partkey") % 3).cast("string"), F.lit("7"), F.lit("1"))
    tables = parsers.reference_tables(rows(F.concat_ws(" ", key, F.lit("k"), F.col("p_size").cast("string"))), rows(F.concat_ws(" ", key, (F.col("p_size") / 2).cast("string")), "p_partkey % 4 <> 0"), rows(F.concat_ws(" ", key, F.concat(F.lit("pdb"), key), F.lit("A:1-5"))), rows(F.concat_ws("\t", key, F.lit("e1"), F.lit("m"), code)))
    register_tables({f"reference_{name}": t for name, t in tables.items()})
    return spark.sql("SELECT CAST(template AS BIGINT) AS part, length, norm, family FROM reference_templates")


@query("database_lookup", "SELECT p_partkey AS template, p_size AS size FROM part WHERE p_partkey % 3 = 0")
def database_lookup(spark, sf):
    """Keys looked up in an embedded database table; where none answers, in the files."""
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("template"), F.col("p_size").alias("size"))
    keys = p.filter("template % 3 = 0").select("template")
    options = {"url": "jdbc:none://no.such.database/x", "driver": "no.such.Driver"}
    return parsers.table_or_files(spark, options, "parts", keys, lambda: p.join(keys, "template", "left_semi"))


@query("published_twice", "SELECT 2 * count(*) AS n, CAST(2 * sum(p_size) AS BIGINT) AS size FROM part")
def published_twice(spark, sf):
    """One table at two places, each overwritten, and both read back."""
    p = read(spark, sf, "part").select("p_partkey", "p_size")
    paths = [shared.fresh(spark, f"publish-{k}") for k in "ab"]
    sinks.publish(p.limit(0), *paths)
    sinks.publish(p, *paths)
    return spark.read.parquet(paths[0]).unionByName(spark.read.parquet(paths[1])).agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"))


@query("log_lines", "SELECT CAST(event_id % 9 + 1 AS INT) AS step, count(*) AS runs, avg(CAST(event_id % 13 AS DOUBLE)) AS mean, max(CAST(event_id % 13 AS DOUBLE)) AS longest FROM events WHERE event_id % 4 <> 0 GROUP BY 1")
def log_lines(spark, sf):
    """Structured log lines, read back and summed up; lines without a duration do not count."""
    e = read(spark, sf, "events")
    value = F.to_json(F.struct(F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("protein"), (F.col("event_id") % 9 + 1).cast("int").alias("step"), F.lit("done").alias("message"), F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 13).cast("double")).alias("duration")))
    return state.durations(state.logs(e.select(value.alias("value"))))




_EVERY = " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST(line_no AS BIGINT) AS line_no, value FROM (VALUES " + (f"(0, '{header}" + "' || chr(9) || '".join(c for c, _ in columns) + "'), " if header is not None else "") + ", ".join(f"({k}, " + " || chr(9) || ".join("'x'" if d is None else f"format('{{:.{d}f}}', {k} / CAST(7 AS DOUBLE))" for _, d in columns) + ")" for k in (1, 2)) + ") v(line_no, value)"
    for name, (columns, header) in sinks.LAYOUTS.items()
)


@query("every_layout", _EVERY)
def every_layout(spark, sf):
    """Two rows in each layout, with its header if it has one."""
    two = spark.range(1, 3)
    out = None
    for name, (columns, _) in sinks.LAYOUTS.items():
        rows = two.select(F.lit(name).alias("file"), "id", *[(F.lit("x") if d is None else F.col("id") / 7).alias(c) for c, d in columns])
        lines = sinks.relation_lines(rows, name, order=["id"]).withColumnRenamed("file", "name")
        out = lines if out is None else out.unionByName(lines)
    return out


@query("protein_ids", "SELECT DISTINCT 'Q' || (c_custkey % 97) AS protein FROM customer WHERE c_custkey % 5 <> 0")
def protein_ids(spark, sf):
    """Ids of structure and error files; other files do not count."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("Q"), (k % 97).cast("string"))
    files = F.when(k % 5 == 0, F.concat(name, F.lit(".txt"))).when(k % 5 == 1, F.concat(F.lit("AF-"), name, F.lit("-F1-model_v4.cif"))).when(k % 5 == 2, F.concat(name, F.lit(".json"))).otherwise(F.concat(name, F.lit(".pdb")))
    return parsers.protein_ids(read(spark, sf, "customer").select(files.alias("file")))


@query("template_cache", f"SELECT p_partkey AS template, p_size AS size FROM part WHERE p_partkey IN (SELECT template FROM {H} WHERE z >= 8)")
def template_cache(spark, sf):
    """The rows of templates that any protein needs, written once and read twice."""
    from . import stages

    part = read(spark, sf, "part").select(F.col("p_partkey").alias("template"), F.col("p_size").alias("size"))
    tables, path = {"candidates": hits(spark, sf).filter("z >= 8").select("protein", "template")}, shared.fresh(spark, "templates")
    stages.template_cache(tables, part, path)
    return stages.template_cache(tables, part, path)
