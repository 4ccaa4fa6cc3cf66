"""Readers of the text formats, over line tables.

``lines(spark, path)`` gives (file, line_no, value); every parser takes such a table (or one made
in a test), so files of any number are parsed in one job. Whole-file formats take ``texts``:
(file, value).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lookups as lk
from ..functions import ranges as rg
from ..operators.windows import secondary_structure


_FILE = "element_at(split(_metadata.file_path, '/'), -1)"


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): whole files, for formats of one small document a file."""
    return spark.read.text(path, wholetext=True).select(F.expr(_FILE).alias("file"), "value")


def numbered(rows: DataFrame) -> DataFrame:
    """(file, line_no, value) of rows (file, block, value) as Spark reads a file's splits.

    A split is read by one task in order; the rows of the splits before it in its file are added, so
    no file is ever held or sorted by one task.
    """
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    sizes = rows.groupBy("file", "block").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each split
    return rows.join(sizes.withColumn("before", before), ["file", "block"]).select("file", (F.col("before") + F.col("seq") - F.col("first")).alias("line_no"), "value")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value), from 0 in file order; files of any size are read in splits."""
    return numbered(spark.read.text(path).select(F.expr(_FILE).alias("file"), F.expr("_metadata.file_block_start").alias("block"), "value"))


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, hit_no, block): what stands after each ``>``, from 1; a combined report is split while it is read."""
    rows = numbered(spark.read.option("lineSep", ">").text(path).select(F.expr(_FILE).alias("file"), F.expr("_metadata.file_block_start").alias("block"), "value"))
    return rows.filter("line_no > 0").select("file", F.col("line_no").alias("hit_no"), F.col("value").alias("block"))


def protein_ids(files: DataFrame, pattern: str = r"^(?:AF-)?(.+?)(?:-F\d+.*)?\.(?:cif|pdb|json)$") -> DataFrame:
    """(protein) of file names: what the pattern's group holds, each once."""
    return files.select(F.regexp_extract("file", pattern, 1).alias("protein")).filter("protein <> ''").distinct()


def to_lines(whole: DataFrame) -> DataFrame:
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value")).select("file", F.col("line_no").cast("long"), "value")


def to_blocks(whole: DataFrame) -> DataFrame:
    """(file, hit_no, block) of whole texts."""
    return whole.select("file", F.posexplode(F.split("value", ">")).alias("hit_no", "block")).filter("hit_no > 0")


def _ordered(value: str, by: str = "line_no") -> F.Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(by, value))), lambda s: s[value])


def fasta(rows: DataFrame) -> DataFrame:
    """(file, header, sequence): the last header wins, all other lines are joined."""
    rows = rows.withColumn("value", F.trim("value"))
    head = F.col("value").startswith(">")
    return rows.groupBy("file").agg(
        F.max_by(F.when(head, F.substring("value", 2, 1 << 30)), F.when(head, F.col("line_no"))).alias("header"),
        F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda s: ~s["value"].startswith(">")), lambda s: s["value"]), "").alias("sequence"),
    )


def pdb_atoms(rows: DataFrame, strict: bool = False, records: tuple[str, ...] = ("ATOM",)) -> DataFrame:
    """(file, line_no, atom, resname, chain, resid, x, y, z) of fixed-width atom lines; malformed ones go, or fail if ``strict``.

    Residue numbers in hybrid-36, and such as run on over the columns up to the coordinates, are read too.
    """
    cell = lambda a, n: F.trim(F.substring("value", a, n))
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    resid, first = F.when(cell(28, 3) != "", cell(23, 8)).otherwise(cell(23, 4)), 36**3
    base36 = F.conv(resid, 36, 10).cast("int") + 10_000 - 10 * first
    number = F.when(resid.rlike("^[A-Z][0-9A-Z]{3}$"), base36).when(resid.rlike("^[a-z][0-9a-z]{3}$"), base36 + 26 * first)
    got = rows.filter(F.trim(F.substring("value", 1, 6)).isin(*records)).select(
        "file", "line_no", cell(13, 4).alias("atom"), cell(18, 3).alias("resname"), cell(22, 1).alias("chain"),
        F.coalesce(number, cast(resid, "int")).alias("resid"), *[cast(cell(a, 8), "double").alias(c) for c, a in (("x", 31), ("y", 39), ("z", 47))],
    )
    return got if strict else got.dropna(subset=["resid", "x", "y", "z"])


def first_model(rows: DataFrame) -> DataFrame:
    """Lines of a file up to its first ENDMDL."""
    ended = F.coalesce(F.max(F.col("value").startswith("ENDMDL").cast("int")).over(Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("ended", ended).filter("ended = 0").drop("ended")


def pair_errors(whole: DataFrame) -> DataFrame:
    """(file, r1, r2, err), 1-based, of the JSON layouts predicted_aligned_error, pae, or residue1/residue2/distance; another layout fails."""
    schema = "predicted_aligned_error array<array<double>>, pae array<array<double>>, residue1 array<int>, residue2 array<int>, distance array<double>"
    body = F.from_json(F.regexp_replace("value", r"^\s*\[(?=\s*\{)|(?<=\})\s*\]\s*$", ""), schema)
    rows = whole.select("file", body.alias("j")).withColumn("dense", F.coalesce("j.predicted_aligned_error", "j.pae"))
    rows = rows.withColumn("ok", F.when(F.col("dense").isNull() & F.col("j.distance").isNull(), F.raise_error(F.lit("unknown pair error layout"))).otherwise(True)).filter("ok")
    dense = rows.filter("dense is not null").select("file", F.posexplode("dense").alias("i", "row")).select("file", (F.col("i") + 1).alias("r1"), F.posexplode("row").alias("j", "err")).select("file", "r1", (F.col("j") + 1).alias("r2"), "err")
    sparse = rows.filter("dense is null").select("file", F.explode(F.arrays_zip("j.residue1", "j.residue2", "j.distance")).alias("z"))
    return dense.unionByName(sparse.select("file", F.col("z")["residue1"].alias("r1"), F.col("z")["residue2"].alias("r2"), F.col("z")["distance"].alias("err")))


def sequence_search(whole: DataFrame) -> DataFrame:
    """Hits of a sequence search report: (file, hit_no, hit, probab, evalue, score, ..., query, template, q_start, q_end, t_start, t_end).

    Blocks start at ``>``; rows of the query and the template are joined over lines, without consensus
    and structure rows; the first start and the last end count; blocks without id or sequence go.
    """
    blocks = whole.select("file", F.posexplode(F.slice(F.split(F.concat(F.lit("\n"), "value"), "\n>"), 2, 1 << 30)).alias("hit_no", "block"))

    def rows_of(letter: str):
        found = F.regexp_extract_all("block", F.lit(rf"(?m)^({letter} +(?!Consensus|ss_)\S+ +\d+ +\S+ +\d+)"), 1)
        return F.transform(found, lambda r: F.split(F.regexp_replace(r, " +", " "), " "))

    key = lambda k: F.nullif(F.regexp_extract("block", rf"{k}=(\S+)", 1), F.lit(""))
    rows = blocks.withColumn("hit", F.split(F.col("block"), r"\s")[0]).withColumn("qr", rows_of("Q")).withColumn("tr", rows_of("T"))
    out = rows.filter((F.col("hit") != "") & (F.size("qr") > 0) & (F.size("tr") > 0))
    side = lambda r: [F.array_join(F.transform(r, lambda x: x[3]), ""), F.col(r)[0][2].cast("int"), F.element_at(F.element_at(r, -1), 5).cast("int")]
    names = [("query", "q_start", "q_end"), ("template", "t_start", "t_end")]
    cols = [c.alias(n) for r, ns in zip(("qr", "tr"), names, strict=True) for c, n in zip(side(r), ns, strict=True)]
    return out.select("file", "hit_no", "hit", *[key(k).alias(n) for k, n in (("Probab", "probab"), ("E-value", "evalue"), ("Score", "score"), ("Aligned_cols", "aligned_cols"), ("Identities", "idents"), ("Similarity", "similarities"), ("Sum_probs", "sum_probs"))], *cols)


def structure_search(rows: DataFrame) -> DataFrame:
    """(file, line_no, template, qs, qe, evalue) of tabular lines with 11 fields or more; the target ends at its first dot."""
    t = F.split(F.trim("value"), r"\s+")
    got = rows.withColumn("t", t).filter(F.size("t") >= 11)
    return got.select("file", "line_no", F.split_part(F.get("t", F.lit(1)), F.lit("."), F.lit(1)).alias("template"), F.get("t", F.lit(6)).try_cast("int").alias("qs"), F.get("t", F.lit(7)).try_cast("int").alias("qe"), F.get("t", F.lit(10)).try_cast("double").alias("evalue"))


def structure_hits(hits: DataFrame) -> DataFrame:
    """Hits of an alignment list, from its ``blocks``: a line ``name z n qlen tlen``, rotation rows and a translation row if any, then q-t pairs.

    (file, hit_no, hit, z, n, qlen, tlen, rotation, translation, pairs); hits without pairs go. A
    block is parsed in its row.
    """
    cut = F.instr("block", "\n")
    rows = hits.withColumn("head", F.split(F.trim(F.regexp_replace(F.when(cut > 0, F.expr("left(block, instr(block, '\\n') - 1)")).otherwise(F.col("block")), "\r", "")), r"[ \t]+"))
    rows = rows.withColumn("body", F.when(cut > 0, F.expr("substring(block, instr(block, '\\n') + 1)")).otherwise("")).filter("head[0] <> ''")
    every = lambda pattern, group: F.regexp_extract_all("body", F.lit(rf"(?m)^[ \t]*{pattern}[ \t]*$"), group)
    pair = r"(-?\d+)[ \t]+(-?\d+)(?:[ \t][^\r\n]*)?"
    named = lambda word: F.transform(every(rf"(?i:{word})\S*[ \t]*([^\r\n]*)", 1), lambda x: F.regexp_replace(F.trim(x), r"[ \t]+", ","))
    rows = rows.select("file", "hit_no", "head", F.regexp_count("body", F.lit(r"(?m)^.*\S.*$")).alias("m"), every(pair, 1).cast("array<int>").alias("q"), every(pair, 2).cast("array<int>").alias("t"), named("rotation").alias("rotation"), named("trans").alias("moved"))
    known = F.size("q") + F.size("rotation") + F.size("moved")
    ok = F.when(F.col("m") != known, F.raise_error(F.lit("a row of a hit is no pair of numbers")).cast("boolean")).otherwise(True)
    head = lambda i, kind: F.get("head", F.lit(i)).cast(kind)
    out = rows.filter(ok).filter(F.size("q") > 0)
    return out.select(
        "file", "hit_no", head(0, "string").alias("hit"), head(1, "double").alias("z"), *[head(i, "int").alias(c) for i, c in ((2, "n"), (3, "qlen"), (4, "tlen"))],
        "rotation", F.get("moved", F.lit(0)).alias("translation"), F.arrays_zip("q", "t").alias("pairs"),
    )


def simple_hits(hits: DataFrame) -> DataFrame:
    """Hits of the simple form: after its first line a block has pairs of numbers only; another row fails."""
    got = structure_hits(hits)
    bad = (F.size("rotation") > 0) | F.col("translation").isNotNull()
    ok = F.when(bad, F.raise_error(F.lit("a row of a simple hit is no pair of numbers")).cast("boolean")).otherwise(True)
    return got.filter(ok).select("file", "hit_no", "hit", "z", "n", "qlen", "tlen", "pairs")


def alignment_report(whole: DataFrame) -> DataFrame:
    """(file, z, pairs, matrix) of the first hit of an alignment program's report: its score row, segments and matrix rows."""
    z = F.regexp_extract("value", r"(?m)^\s*1:(?!.*<=>)\s+\S+\s+([-\d.]+)", 1).try_cast("double")
    segs = F.regexp_extract_all("value", F.lit(r"(?m)^\s*(1:.*?\d+\s*-\s*\d+\s*<=>\s*\S*\s*\d+\s*-\s*\d+)"), 1)
    nums = lambda s: F.transform(F.regexp_extract_all(F.regexp_replace(s, r"^.*?(\d+\s*-\s*\d+\s*<=>)", "$1"), F.lit(r"(\d+)\s*-\s*(\d+)"), 0), lambda p: F.transform(F.split(p, r"\s*-\s*"), lambda x: x.cast("int")))
    spans = F.transform(segs, nums)
    good = F.filter(spans, lambda p: (F.size(p) >= 2) & (p[0][1] - p[0][0] == F.element_at(p, -1)[1] - F.element_at(p, -1)[0]))
    pairs = F.flatten(F.transform(good, lambda p: F.transform(F.sequence(p[0][0], p[0][1]), lambda q: F.struct(q.alias("q"), (q - p[0][0] + F.element_at(p, -1)[0]).alias("t")))))
    return whole.select("file", z.alias("z"), pairs.alias("pairs"), F.regexp_extract_all("value", F.lit(r'(?m)^-matrix\s+"(.*?)"'), 1).alias("matrix"))


def structure_codes(rows: DataFrame) -> DataFrame:
    """(file, pos, aa, code, sse_type, sse_id) of a secondary-structure report: rows after the ``#`` header."""
    body = rows.withColumn("started", F.coalesce(F.max(F.col("value").rlike(r"^\s*#\s+RESIDUE").cast("int")).over(Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    body = body.filter((F.col("started") == 1) & (F.length("value") >= 17))
    got = body.select("file", F.trim(F.substring("value", 6, 5)).try_cast("int").alias("pos"), F.substring("value", 14, 1).alias("aa"), F.substring("value", 17, 1).alias("code")).dropna(subset=["pos"])
    return secondary_structure(got, ["file"])


def tagged_hits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequence rows, structure rows) of the union table, as token arrays without the tag."""
    t = rows.select("file", "line_no", F.split("value", "\t").alias("t"))
    pick = lambda tag: t.filter(F.get("t", F.lit(0)) == tag).select("file", "line_no", F.slice("t", 2, 100).alias("t"))
    return pick("sequence"), pick("structure")


def good_residues(rows: DataFrame, filtered: bool = False) -> DataFrame:
    """(file, resid) of the union table's query ranges: the unfiltered ones by default, as consumers expect."""
    t = rows.select("file", F.split("value", "\t").alias("t"))
    seq, st = (10, 15) if filtered else (8, 14)
    text = F.when(F.get("t", F.lit(0)) == "sequence", F.get("t", F.lit(seq))).when(F.get("t", F.lit(0)) == "structure", F.get("t", F.lit(st)))
    return t.select("file", F.explode(rg.parse_set(text)).alias("resid")).distinct()


def template_map(rows: DataFrame, lengths: DataFrame, metadata: DataFrame) -> DataFrame:
    """Mapped hits with 13 fields or more after the header, joined to their template's length and metadata (inner)."""
    t = rows.filter("line_no > 0").select("file", "line_no", F.split(F.trim("value"), r"\s+").alias("t")).filter(F.size("t") >= 13)
    cols = t.select("file", "line_no", F.get("t", F.lit(0)).alias("template"), F.get("t", F.lit(2)).cast("double").alias("prob"), rg.parse_list(F.get("t", F.lit(11))).alias("query_resids"), rg.parse_list(F.get("t", F.lit(12))).alias("template_resids"))
    return cols.join(lengths, "template").join(metadata, "template")


def first_column(rows: DataFrame) -> DataFrame:
    """Distinct keys in the first column, header skipped."""
    return rows.filter("line_no > 0 and trim(value) != ''").select("file", F.split(F.trim("value"), r"\s+")[0].alias("key")).distinct()


def sse_table(rows: DataFrame) -> DataFrame:
    """(file, resid, aa, sse_id, sse_type); ``na`` is null."""
    t = rows.select("file", F.split(F.trim("value"), r"\s+").alias("t")).filter(F.size("t") >= 4)
    return t.select("file", F.get("t", F.lit(0)).try_cast("int").alias("resid"), F.get("t", F.lit(1)).alias("aa"), F.get("t", F.lit(2)).try_cast("int").alias("sse_id"), F.get("t", F.lit(3)).alias("sse_type"))


def disorder_table(rows: DataFrame) -> DataFrame:
    return rows.select("file", F.trim("value").try_cast("int").alias("resid")).dropna()


def feature_table(rows: DataFrame) -> DataFrame:
    """(file, line_no, domain, range, tgroup, template, f0..f12 float): rows with a bad number go."""
    t = rows.filter("line_no > 0").select("file", "line_no", F.split("value", "\t").alias("t")).filter(F.size("t") >= 17)
    feats = [F.get("t", F.lit(4 + i)).try_cast("float").alias(f"f{i}") for i in range(13)]
    return t.select("file", "line_no", F.get("t", F.lit(0)).alias("domain"), F.get("t", F.lit(1)).alias("range"), F.get("t", F.lit(2)).alias("tgroup"), F.get("t", F.lit(3)).alias("template"), *feats).dropna(subset=[f"f{i}" for i in range(13)])


def residue_map(rows: DataFrame) -> DataFrame:
    """(file, chain_resid, template_resid): read in either direction."""
    t = rows.select("file", F.split(F.trim("value"), r"\s+").alias("t")).filter(F.size("t") >= 2)
    return t.select("file", F.get("t", F.lit(0)).try_cast("int").alias("chain_resid"), F.get("t", F.lit(1)).try_cast("int").alias("template_resid")).dropna()


def dimension(rows: DataFrame, columns: list[tuple[str, str, int]], key: str | None = None) -> DataFrame:
    """Columns (name, type, place) of white-space tables without comments; with ``key`` the last row of each key wins."""
    t = rows.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select("line_no", F.split(F.trim("value"), r"\s+").alias("t"))
    got = t.select("line_no", *[F.get("t", F.lit(i)).try_cast(kind).alias(n) for n, kind, i in columns]).dropna(subset=[columns[0][0]])
    if key is None:
        return got.drop("line_no")
    names = [n for n, _, _ in columns if n != key]
    return got.groupBy(key).agg(F.max_by(F.struct(*names), "line_no").alias("r")).select(key, "r.*")


def chain_map(rows: DataFrame) -> DataFrame:
    """(chain_key, template, resids) of ``chain:range,...`` rows; templates over several chains go, the last template of a chain wins."""
    t = rows.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select("line_no", F.split(F.trim("value"), r"\s+").alias("t")).filter(F.size("t") >= 3)
    chains = F.array_distinct(F.transform(F.split(F.get("t", F.lit(2)), ","), lambda s: F.split_part(s, F.lit(":"), F.lit(1))))
    rows = t.withColumn("chains", chains).filter(F.size("chains") == 1)
    rows = rows.select("line_no", F.concat(F.upper(F.get("t", F.lit(1))), F.lit("_"), F.col("chains")[0]).alias("chain_key"), F.get("t", F.lit(0)).alias("template"), rg.parse_list(F.get("t", F.lit(2))).alias("resids"))
    return rows.groupBy("chain_key").agg(F.max_by(F.struct("template", "resids"), "line_no").alias("r")).select("chain_key", "r.*")


def position_weights(weights: DataFrame, lengths: DataFrame) -> DataFrame:
    """(template, position, weight): a template without weights gets 1.0 at each of its positions."""
    missing = lengths.join(weights.select("template").distinct(), "template", "left_anti")
    uniform = missing.select("template", F.explode(F.sequence(F.lit(1), "length")).alias("position"), F.lit(1.0).alias("weight"))
    return weights.select("template", "position", "weight").unionByName(uniform)


def sharded(rows: DataFrame) -> DataFrame:
    """Of rows (key, shard, ...) those of a key's own shard if it has some there, else the flat ones (null shard); other shards go."""
    own = rows.filter(F.col("shard") == lk.shard_key("key"))
    flat = rows.filter(F.col("shard").isNull()).join(own.select("key").distinct(), "key", "left_anti")
    return own.unionByName(flat).drop("shard")


def key_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(key, shard, value): lines of ``folder``/key.suffix and ``folder``/shard/key.suffix."""
    path = F.expr("_metadata.file_path")
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}").text(folder).select(path.alias("path"), "value")
    parent = F.element_at(F.split("path", "/"), -2)
    return rows.select(F.regexp_extract("path", rf"([^/]*)\.{suffix}$", 1).alias("key"), F.when(parent != folder.rstrip("/").rpartition("/")[2], parent).alias("shard"), "value")


def weight_rows(rows: DataFrame) -> DataFrame:
    """(template, position, weight) of (key, shard, value): the first and the fourth field; a key without a file has no row."""
    t = sharded(rows).select("key", F.split(F.trim("value"), r"\s+").alias("t")).filter(F.size("t") >= 4)
    return t.select(F.col("key").alias("template"), F.get("t", F.lit(0)).cast("int").alias("position"), F.get("t", F.lit(3)).cast("double").alias("weight"))


def history_rows(rows: DataFrame) -> DataFrame:
    """(template, z, q) of (key, shard, value): the second and the third field."""
    t = sharded(rows).select("key", F.split(F.trim("value"), r"\s+").alias("t")).filter(F.size("t") >= 3)
    return t.select(F.col("key").alias("template"), F.get("t", F.lit(1)).cast("double").alias("z"), F.get("t", F.lit(2)).cast("double").alias("q"))


def reference_tables(length: DataFrame, norms: DataFrame, chains: DataFrame, latest: DataFrame) -> dict[str, DataFrame]:
    """All dimensions from their line tables: lengths, norms, chain_map and templates."""
    lengths = dimension(length, [("template", "string", 0), ("key", "string", 1), ("length", "int", 2)], "template")
    norm = dimension(norms, [("template", "string", 0), ("norm", "double", 1)], "template")
    t = latest.filter(~F.col("value").startswith("#")).select("line_no", F.split("value", "\t").alias("t")).filter(F.size("t") >= 4)
    domains = t.groupBy(F.get("t", F.lit(0)).alias("template")).agg(F.max_by(F.struct(F.get("t", F.lit(1)).alias("id"), F.get("t", F.lit(3)).alias("code")), "line_no").alias("r")).select("template", "r.*").withColumn("family", lk.hierarchy_prefix("code", 2))
    return {"lengths": lengths, "norms": norm, "chain_map": chain_map(chains), "templates": domains.join(lengths, "template", "left").join(norm, "template", "left")}


def table_or_files(spark: SparkSession, options: dict[str, str] | None, table: str, keys: DataFrame, files) -> DataFrame:
    """A database table restricted to ``keys``; without options, or where the database does not answer, what ``files()`` reads.

    No credentials are kept here: ``options`` are the caller's.
    """
    if not options:
        return files()
    try:
        return jdbc_table(spark, options, table, keys)
    except Exception as e:  # noqa: BLE001  (drivers fail in ways of their own)
        if "SQLException" not in str(e) and "ClassNotFound" not in str(e) and "No suitable driver" not in str(e):
            raise
        return files()


def jdbc_table(spark: SparkSession, options: dict[str, str], table: str, keys: DataFrame | None = None, key: str = "template") -> DataFrame:
    """A database table by the caller's options, restricted to the wanted keys."""
    got = spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    return got if keys is None else got.join(keys.select(key).distinct(), key, "left_semi")


def _cif_loops(text: str, wanted: str) -> list[dict[str, str]]:
    """Rows of the category ``wanted`` (loop or single values) of a CIF text."""
    out, names, in_loop, single = [], [], False, {}
    held: list[str] = []

    def tokens(line: str) -> list[str]:
        got, i = [], 0
        while i < len(line):
            c = line[i]
            if c.isspace():
                i += 1
            elif c in "'\"":
                j = i + 1
                while j < len(line) and not (line[j] == c and (j + 1 == len(line) or line[j + 1].isspace())):
                    j += 1
                got.append(line[i + 1 : j])
                i = j + 1
            elif c == "#":
                break
            else:
                j = i
                while j < len(line) and not line[j].isspace():
                    j += 1
                got.append(line[i:j])
                i = j
        return got

    rows = text.splitlines()
    k = 0
    while k < len(rows):
        line = rows[k]
        if line.startswith(";") and (in_loop and names or single):
            block = [line[1:]]
            k += 1
            while k < len(rows) and not rows[k].startswith(";"):
                block.append(rows[k])
                k += 1
            value = ["".join(block)]
        elif line.strip() == "loop_":
            in_loop, names, held = True, [], []
            value = []
        elif line.startswith("_"):
            parts = tokens(line)
            if in_loop and not held and len(parts) == 1:
                names.append(parts[0])
                value = []
            else:
                if in_loop and held:
                    in_loop, names, held = False, [], []
                if not in_loop:
                    if parts[0].startswith(wanted + "."):
                        single[parts[0]] = parts[1] if len(parts) > 1 else ""
                value = []
        elif line.startswith(("data_", "#")) or not line.strip():
            if line.startswith("#"):
                in_loop, names, held = False, [], []
            value = []
        else:
            value = tokens(line)
        if in_loop and names and value:
            held += value
            while len(held) >= len(names):
                if names[0].startswith(wanted + "."):
                    out.append({n[len(wanted) + 1 :]: v for n, v in zip(names, held, strict=False)})
                held = held[len(names) :] or [""][:0]
                if not held:
                    held = []
            in_loop = True
        k += 1
    return out or ([{n[len(wanted) + 1 :]: v for n, v in single.items()}] if single else [])


def structure_atoms(whole: DataFrame, chain: str = "A", model: str | None = None) -> DataFrame:
    """(file, resid, atom, element, resname, letter, x, y, z) of a structure file's chain.

    The model asked for, else the only one, else the least number; ATOM records only, no hydrogens, the
    first alternate location of each atom.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["file", "ord", "model", "resid", "atom", "element", "resname", "x", "y", "z"]
        for pdf in batches:
            rows = []
            for f, text in zip(pdf["file"], pdf["value"], strict=True):
                for i, a in enumerate(_cif_loops(text, "_atom_site")):
                    if a.get("group_PDB") == "ATOM" and a.get("auth_asym_id", a.get("label_asym_id")) == chain and a.get("type_symbol") not in ("H", "D"):
                        rows.append((f, i, a.get("pdbx_PDB_model_num", "1"), int(a["auth_seq_id"] if a.get("auth_seq_id", ".") not in ".?" else a["label_seq_id"]), a["label_atom_id"], a.get("type_symbol"), a.get("label_comp_id"), float(a["Cartn_x"]), float(a["Cartn_y"]), float(a["Cartn_z"])))
            yield pd.DataFrame(rows, columns=names)

    atoms = whole.mapInPandas(run, "file string, ord int, model string, resid int, atom string, element string, resname string, x double, y double, z double")
    least = F.min(F.col("model").try_cast("int")).over(Window.partitionBy("file"))
    atoms = atoms.filter(F.col("model") == model) if model is not None else atoms.withColumn("least", least).filter(F.col("model").try_cast("int") == F.col("least")).drop("least")
    first = F.row_number().over(Window.partitionBy("file", "resid", "atom").orderBy("ord"))
    return atoms.withColumn("place", first).filter("place = 1").withColumn("letter", lk.three_to_one("resname")).drop("place", "model")


def canonical_sequence(whole: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """(file, sequence) of a structure file: the residue scheme, else the one-letter code, else the entity's residues.

    ``parents``: (code, parent) of modified residues.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for f, text in zip(pdf["file"], pdf["value"], strict=True):
                scheme = [r for r in _cif_loops(text, "_pdbx_poly_seq_scheme") if r.get("asym_id", "A") == "A"]
                code = next((r.get("pdbx_seq_one_letter_code_can", "") for r in _cif_loops(text, "_entity_poly")), "")
                poly = [r["mon_id"] for r in _cif_loops(text, "_entity_poly_seq") if r.get("entity_id", "1") == "1"]
                rows.append((f, [r["mon_id"] for r in scheme], "".join(code.split()), poly))
            yield pd.DataFrame(rows, columns=["file", "scheme", "code", "poly"])

    got = whole.mapInPandas(run, "file string, scheme array<string>, code string, poly array<string>")
    side = lambda c: got.select("file", F.posexplode(c).alias("i", "mon"))

    def spelt(c: str) -> DataFrame:
        rows = side(c)
        if parents is not None:
            rows = rows.join(parents, F.col("mon") == F.col("code"), "left").withColumn("mon", F.coalesce("parent", "mon"))
        return rows.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", lk.three_to_one("mon").alias("l")))), lambda s: s["l"]), "").alias(f"by_{c}"))

    out = got.select("file", "code").join(spelt("scheme"), "file", "left").join(spelt("poly"), "file", "left")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return out.select("file", F.coalesce(blank("by_scheme"), blank("code"), blank("by_poly")).alias("sequence"))


def check_sequence(sequences: DataFrame, residues: DataFrame) -> DataFrame:
    """(file, sequence, observed): the structure's letters along the sequence, ``-`` where a residue is missing."""
    grid = sequences.select("file", "sequence", F.explode(F.sequence(F.lit(1), F.length("sequence"))).alias("resid"))
    seen = residues.select("file", "resid", "letter").dropDuplicates(["file", "resid"])
    rows = grid.join(seen, ["file", "resid"], "left")
    return rows.groupBy("file", "sequence").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("resid", F.coalesce("letter", F.lit("-")).alias("l")))), lambda s: s["l"]), "").alias("observed"))
