"""Writers of the text formats, as line tables and Spark text output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as lk


def fasta_lines(sequences: DataFrame) -> DataFrame:
    """(file, value): a header and a sequence."""
    return sequences.select("file", F.concat(F.lit(">"), "header", F.lit("\n"), "sequence").alias("value"))


def hybrid36(number: Column, width: int, beyond: Column | None = None) -> Column:
    """A whole number in ``width`` characters: as digits, then in base 36 from A00.. and from a00.. on; ``beyond`` (or an error) for what needs more."""
    first, digits = 36 ** (width - 1), 10**width
    base36 = lambda k: F.conv(k.cast("string"), 10, 36)
    upper, lower = number - digits + 10 * first, number - digits - 16 * first
    beyond = F.raise_error(F.concat(number.cast("string"), F.lit(f" has no form in {width} columns"))) if beyond is None else beyond
    out = F.when((number > -digits // 10) & (number < digits), F.lpad(number.cast("string"), width, " "))
    return out.when((number >= digits) & (upper < 36 * first), base36(upper)).when((number >= digits) & (lower < 36 * first), F.lower(base36(lower))).otherwise(beyond)


def pdb_lines(atoms: DataFrame, chain: str = "A") -> DataFrame:
    """(file, serial, value): fixed-width atom records, numbered per file by residue and order.

    ``atoms``: file, resid, ord, atom, element, letter, x, y, z. Names under four characters are padded left; unknown letters give UNK.
    Numbers too long for their columns are in hybrid-36; residues beyond that run on into the four blank columns that follow.
    """
    resid = F.col("resid").cast("bigint")
    wide = F.when(F.length(resid.cast("string")) <= 8, F.lpad(resid.cast("string"), 8, " ")).otherwise(F.raise_error(F.concat(resid.cast("string"), F.lit(" has no form in 8 columns"))))
    serial = F.row_number().over(Window.partitionBy("file").orderBy("resid", "ord"))
    name = F.when(F.length("atom") < 4, F.concat(F.lit(" "), F.rpad("atom", 3, " "))).otherwise(F.col("atom"))
    rows = atoms.withColumn("serial", serial)
    number = lambda c: F.lpad(F.format_string("%.3f", F.col(c)), 8, " ")
    value = F.concat(
        F.lit("ATOM  "), hybrid36(F.col("serial").cast("bigint"), 5), F.lit(" "), name, F.lit(" "), lk.one_to_three("letter"), F.lit(f" {chain}"),
        F.rpad(hybrid36(resid, 4, wide), 8, " "), number("x"), number("y"), number("z"), F.lit("  1.00  0.00          "), F.lpad(F.coalesce("element", F.lit("")), 2, " "),
    )
    return rows.select("file", "serial", value.alias("value"))


def tab_lines(rows: DataFrame, columns: list[str | Column], header: str | None = None) -> DataFrame:
    """(value) of tab-separated columns; nulls are ``na``."""
    cols = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("na")) for c in columns]
    return rows.select(F.concat_ws("\t", *cols).alias("value"))


def fixed(value: str | Column, digits: int) -> Column:
    """A double with ``digits`` places as C prints it."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    k, n = 10**digits, lk.scaled(x, digits)
    whole = F.floor(n / k).cast("bigint") if digits else n
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    text = F.concat(sign, whole.cast("string"), *([F.lit("."), F.lpad((n - whole * k).cast("string"), digits, "0")] if digits else []))
    return F.when(x.isNotNull(), text)


#: The columns of each text relation, with their decimals where they have some, and what its header row begins with (None: it has none).
LAYOUTS: dict[str, tuple[list[tuple[str, int | None]], str | None]] = {
    "good_hits": ([("hitname", None), ("ecodnum", None), ("ecodkey", None), ("hgroup", None), ("zscore", None), ("qscore", None), ("ztile", None), ("qtile", None), ("rank", None), ("qrange", None), ("erange", None), ("rotation1", None), ("rotation2", None), ("rotation3", None), ("translation", None)], ""),
    "sequence_result": ([("hitname", None), ("ecodid", None), ("family", None), ("probability", None), ("coverage", None), ("ecodlen", None), ("qrange", None), ("trange", None)], None),
    "structure_result": ([("hitname", None), ("ecodid", None), ("family", None), ("zscore", None), ("qscore", None), ("ztile", None), ("qtile", None), ("rank", None), ("bestprob", None), ("bestcov", None), ("qrange", None), ("srange", None)], None),
    "filtered_search": ([("ecodnum", None), ("evalue", None), ("range", None)], ""),
    "sse": ([("resid", None), ("aa", None), ("sse_id", None), ("sse_type", None)], None),
    "disorder": ([("resid", None)], None),
    "domains": ([("domain", None), ("range", None)], None),
    "features": ([("domID", None), ("domRange", None), ("tgroup", None), ("ecodid", None), ("domLen", None), ("Helix_num", None), ("Strand_num", None), ("HHprob", 3), ("HHcov", 3), ("HHrank", 2), ("Dzscore", 3), ("Dqscore", 3), ("Dztile", 3), ("Dqtile", 3), ("Drank", 2), ("Cdiff", 2), ("Ccov", 3), ("HHname", None), ("Dname", None), ("Drot1", None), ("Drot2", None), ("Drot3", None), ("Dtrans", None)], ""),
    "mapped": ([(c, None) for c in ("uid", "ecod_domain_id", "hh_prob", "hh_eval", "hh_score", "aligned_cols", "idents", "similarities", "sum_probs", "coverage", "ungapped_coverage", "query_range", "template_range", "template_seqid_range")], ""),
    "predictions": ([("Domain", None), ("Range", None), ("Tgroup", None), ("ECOD_ref", None), ("prob", 4), ("HH_prob", 3), ("HH_cov", 3), ("HH_rank", 2), ("DALI_zscore", 3), ("DALI_qscore", 3), ("DALI_ztile", 3), ("DALI_qtile", 3), ("DALI_rank", 2), ("Consensus_diff", 2), ("Consensus_cov", 3), ("HH_hit", None), ("DALI_hit", None), ("DALI_rot1", None), ("DALI_rot2", None), ("DALI_rot3", None), ("DALI_trans", None)], ""),
    "confident": ([(c, None) for c in ("domain", "domain_range", "tgroup", "ecod_ref", "prob", "quality")], "# "),
    "mappings": ([(c, None) for c in ("domain", "domain_range", "ecod_id", "tgroup", "prob", "quality", "hh_template_range", "dali_template_range")], "# "),
    "merge_candidates": ([(c, None) for c in ("domain1", "range1", "domain2", "range2")], "# "),
    "comparisons": ([(c, None) for c in ("protein", "domain1", "domain2", "judgment", "range1", "range2")], "# "),
    "merged": ([(c, None) for c in ("protein", "merged_domains", "merged_range")], "# "),
    "classified": ([(c, None) for c in ("classification", "domain", "range", "ecod", "tgroup", "prob", "hh_prob", "dali_zscore", "weighted_ratio", "length_ratio", "quality")], "# "),
    "final": ([("Domain", None), ("Range", None), ("ECOD_num", None), ("ECOD_key", None), ("T-group", None), ("prob", 3), ("HH_prob", 1), ("DALI_zscore", 1), ("Hit_cov", 3), ("Tgroup_cov", 3), ("Judge", None), ("Hcount", None), ("Scount", None)], ""),
}


def relation_lines(rows: DataFrame, name: str, file: str = "file", order: list[str] | None = None, heads: dict[str, str] | None = None) -> DataFrame:
    """(file, line_no, value): a relation's rows in its layout, in the given order; a header has line 0 of each file; nulls are ``na``.

    ``heads``: other names of columns in the header.
    """
    columns, header = LAYOUTS[name]
    cells = [F.coalesce(F.col(f"`{c}`").cast("string") if digits is None else fixed(F.col(f"`{c}`"), digits), F.lit("na")) for c, digits in columns]
    order = [F.col(f"`{c}`") for c in order or [columns[0][0]]]
    place = F.row_number().over(Window.partitionBy(file).orderBy(*order))
    body = rows.select(F.col(file).alias("file"), place.cast("bigint").alias("line_no"), F.concat_ws("\t", *cells).alias("value"))
    if header is None:
        return body
    return body.select("file").distinct().select("file", F.lit(0).cast("bigint").alias("line_no"), F.lit(header + "\t".join((heads or {}).get(c, c) for c, _ in columns)).alias("value")).unionByName(body)


def union_lines(sequence: DataFrame, structure: DataFrame) -> DataFrame:
    """(file, value): rows of both kinds in the tagged layout; the structure's score by its template's norm has two places."""
    seq = ["ecodnum", "ecodid", "family", "probability", "coverage", "ecodlen", "qrange", "trange"]
    st = ["hitname", "ecodid", "family", "zscore", "qscore", "ztile", "qtile", "rank", "bestprob", "bestcov", "qrange", "filtered"]
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("na"))
    one = sequence.select("file", F.concat_ws("\t", F.lit("sequence"), *map(text, seq)).alias("value"))
    two = structure.select("file", F.concat_ws("\t", F.lit("structure"), text("support"), text("ecodnum"), fixed("znorm", 2), *map(text, st)).alias("value"))
    return one.unionByName(two)


def key_lines(rows: DataFrame, key: str = "template", file: str = "protein") -> DataFrame:
    """(file, line_no, value): the distinct keys of each file, one a line, in the order of their text."""
    keys = rows.select(F.col(file).alias("file"), F.col(key).cast("string").alias("value")).distinct()
    return keys.withColumn("line_no", F.row_number().over(Window.partitionBy("file").orderBy("value")).cast("bigint")).select("file", "line_no", "value")


def capped(rows: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group: the searches' own limits on their output."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= most).drop("place")


def write_tsv(rows: DataFrame, path: str, columns: list[str] | None = None, header: bool = True) -> None:
    (rows if columns is None else rows.select(*columns)).write.mode("overwrite").csv(path, sep="\t", header=header, nullValue="na", emptyValue="")


def normalised_hits(hits: DataFrame, norms: DataFrame) -> DataFrame:
    """``hits`` with ``znorm`` = z / norm, 0 without a norm, and the support tier."""
    out = hits.join(norms, "template", "left")
    return out.withColumn("znorm", F.when(F.col("norm") > 0, F.col("z") / F.col("norm")).otherwise(0.0)).withColumn("support", lk.sequence_support("best_prob", "best_cov")).drop("norm")


def tagged_union(sequence: DataFrame, structure: DataFrame) -> DataFrame:
    """Both row shapes in one table with a tag; columns that one lacks are null."""
    return sequence.withColumn("tag", F.lit("sequence")).unionByName(structure.withColumn("tag", F.lit("structure")), allowMissingColumns=True)


def split_by_query(hits: DataFrame, wanted: DataFrame, key: str = "protein") -> tuple[DataFrame, DataFrame]:
    """(hits of wanted queries, hits per wanted query, 0 where none): queries that nobody asked for go."""
    mine = hits.join(wanted.select(key).distinct(), key, "left_semi")
    counts = wanted.select(key).distinct().join(mine.groupBy(key).agg(F.count(F.lit(1)).alias("hits")), key, "left").fillna(0, ["hits"])
    return mine, counts


def write_partitioned(rows: DataFrame, path: str, key: str = "protein") -> None:
    """One folder per key: dealt by the key first, so a key's rows come from few tasks."""
    rows.repartition(key).write.mode("overwrite").partitionBy(key).parquet(path)


def substructures(atoms: DataFrame, domains: DataFrame) -> DataFrame:
    """Atoms of each domain's residues: ``domains`` has file, domain, resids; the first of repeated domains counts.

    A merge, not a broadcast: residues are many more than Spark expects of their domains.
    """
    res = domains.dropDuplicates(["file", "domain"]).select("file", "domain", F.explode(F.array_distinct("resids")).alias("resid"))
    return atoms.hint("merge").join(res.hint("merge"), ["file", "resid"])


def publish(rows: DataFrame, *paths: str) -> None:
    """The same final table at several places, each overwritten."""
    for p in paths:
        rows.write.mode("overwrite").parquet(p)
