"""N-gram Jaccard self-join by grouped prefixes.

A document's set is its distinct word shingles (lower-cased A-Z). Documents with equal sets form
one class. Two classes link when 100 * intersection >= 80 * union; the result is the connected
components, so no link between different texts may be lost, but pairs already known to be
connected need no verification there.

1. Blocks of texts are shingled; each block sends its (shingle hash, local class) postings, packed
   by hash range, to reducers, which find how many classes hold a shingle and answer each block for
   the shingles held more than once. Of a shingle that ``HOT`` classes of a block or more hold, the reducer
   gets the number only; its classes go to where the block's answers meet. So a shingle of any frequency
   costs a reducer under ten bytes times ``HOT`` a block.
2. Per class, shingles are ordered by (frequency, hash). A class whose prefix of n - ceil(0.8 n) + 1
   shingles has only shingles of its own has no partner and goes. Shingles of its own never
   intersect, so the others suffice to verify.
3. Classes with equal size and prefix collapse into a group. Groups are indexed by their prefix
   shingles. First each group meets three pivots of each of its lists (one with the fewest shingles
   of its own, two by hash), and each member its group's lead: linear in the postings. What links
   is joined into components.
4. Then, only in lists that still hold several components, all pairs of groups of different
   components that pass the size and position filters are expanded to their members and verified.
5. Where links are counted, the classes of each component are verified chunk by chunk: all pairs of
   classes whose sizes let them link, without a row for a pair.

Defined cases: null, empty and wordless texts have an empty set (no links); a text with fewer words
than a shingle has its whole sequence as one; repeated rows are one class; a component's id is its
least doc id (null ids only where it has no other); empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import bound_batches, broadcast_if_small, buckets_for, discard, release, scratch, settle, shield, small_batches, tidy, unshield
from .components import components
from .exchange import exchange

WIDTH, NUM, DEN = 5, 80, 100
HOT = 8
BLOCK_BYTES, BLOCK_CLASSES = 16 << 20, 60_000  # a class of a block is a number of two bytes


def _sets(col, width: int):
    """Sorted distinct shingle hashes of each text of an Arrow column."""
    data, off = tk.flat(col)
    data = tk.LOWER[data]
    starts, ends, first = tk.words(data, off)
    h, at = tk.shingle_hashes(tk.span_hashes(data, starts, ends), first, width)
    return [np.unique(h[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def digest_of(text: str) -> Column:
    """16 bytes that name a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))


def _meta(rows: DataFrame, width: int, keep: list[str] = []) -> DataFrame:  # noqa: B006
    """(doc_id, ``keep``, n, sig) of every row; sig is null for the empty set."""
    names = ["doc_id", *keep]
    schema = ", ".join([f"{c} {rows.schema[c].dataType.simpleString()}" for c in names] + ["n bigint", "sig binary"])

    def run(batches):
        for b in small_batches(batches, "text"):
            sets = _sets(b.column("text"), width)
            made = [pa.array([len(s) for s in sets], pa.int64()), pa.array([_signature(s) if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *made], names=[*names, "n", "sig"])

    return rows.mapInArrow(run, schema)


def _planes(sorted_keys: np.ndarray) -> bytes:
    """Keys as eight planes of bytes: of sorted keys the upper ones are runs, which the shuffle's compression takes away."""
    return np.ascontiguousarray(sorted_keys.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(body, m: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(body, np.uint8, 8 * m).reshape(8, m).T).view("<u8").ravel().astype(np.uint64)


def _postings(rows: DataFrame, width: int, n: int) -> DataFrame:
    """(bucket, block, kind, body): a block's postings by hash range, as far as it has some, and its classes (kind 1)."""

    def run(batches):
        part = TaskContext.get().partitionId()
        seq, size = 0, 0
        local: dict[bytes, int] = {}
        sets: list[np.ndarray] = []

        def flush():
            nonlocal seq, size
            block = (part << 32) | seq
            k = np.concatenate(sets)
            d = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
            order = np.argsort(k, kind="stable")
            k, d = k[order], d[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            held = np.diff(np.append(first, len(k)))
            hot, many = np.repeat(held >= HOT, held), held[held >= HOT].astype(np.uint32)
            of_hot, held_k, held_d = k[first[held >= HOT]], k[~hot], d[~hot]
            some = np.unique(np.concatenate([tk.range_of(held_k, n), tk.range_of(of_hot, n)]))
            at, hot_at = (np.searchsorted(tk.range_of(x, n), np.append(some, n)).tolist() for x in (held_k, of_hot))
            bodies = [np.array([b - a, y - x], np.uint32).tobytes() + _planes(held_k[a:b]) + held_d[a:b].tobytes() + _planes(of_hot[x:y]) + many[x:y].tobytes() for a, b, x, y in zip(at[:-1], at[1:], hot_at[:-1], hot_at[1:], strict=True)]
            meta = np.array([len(sets), len(of_hot)], np.uint32).tobytes() + np.array([len(s) for s in sets], np.uint32).tobytes() + b"".join(local) + many.tobytes() + d[hot].tobytes()
            out = pa.RecordBatch.from_arrays(
                [pa.array([*some.tolist(), block % n], pa.int32()), pa.array([block] * (len(some) + 1), pa.int64()), pa.array([0] * len(some) + [1], pa.int32()), pa.array([*bodies, meta], pa.binary())],
                names=["bucket", "block", "kind", "body"],
            )
            seq, size = seq + 1, 0
            local.clear()
            sets.clear()
            return out

        for b in small_batches(batches, "text"):
            for s in _sets(b.column("text"), width):
                if len(s):
                    sig = _signature(s)
                    if sig not in local:
                        local[sig] = len(sets)
                        sets.append(s)
                        size += 8 * len(s)
                if size >= BLOCK_BYTES or len(sets) >= BLOCK_CLASSES:
                    yield flush()
        if sets:
            yield flush()

    return rows.select("text").mapInArrow(run, "bucket int, block bigint, kind int, body binary")


def _parts(body, width: int) -> list[np.ndarray]:
    """Of a body: shingles with what belongs to each (``width`` bytes), and hot shingles with a number each."""
    m, h = np.frombuffer(body, np.uint32, 2).tolist()
    view = memoryview(body)[8:]
    light = _from_planes(view[: 8 * m], m), view[8 * m : (8 + width) * m]
    view = view[(8 + width) * m :]
    return [*light, _from_planes(view[: 8 * h], h), np.frombuffer(view, np.uint32, h, 8 * h)]


def _count(batches):
    """Reducer of hash ranges: answers each block with (hash, frequency, class) of shingles held more than once, and (hash, frequency) of hot ones."""
    blocks, got = [], []
    for b in batches:
        for block, kind, body in zip(b.column("block").to_pylist(), b.column("kind").to_pylist(), b.column("body").to_pylist(), strict=True):
            if kind:
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([1], pa.int32()), pa.array([body], pa.binary())], names=["block", "kind", "body"])
            else:
                k, d, hot, many = _parts(body, 2)
                blocks.append(block)
                got.append((k, np.frombuffer(d, np.uint16).copy(), hot, many.copy()))  # copies, so that no body is held
    if not got:
        return
    every = np.concatenate([g[0] for g in got])
    every.sort()
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    u, c = every[first], np.diff(np.append(first, len(every)))
    del every, first
    hot, of = np.unique(np.concatenate([g[2] for g in got]), return_inverse=True)
    more = np.bincount(of, weights=np.concatenate([g[3] for g in got]).astype(np.float64)).astype(np.int64) if len(hot) else np.zeros(0, np.int64)
    if len(hot):  # hot in some blocks, and what the others hold
        u, place = np.unique(np.concatenate([u, hot]), return_inverse=True)
        c = np.bincount(place, weights=np.concatenate([c, more])).astype(np.int64)
    u, c = u[c > 1], c[c > 1].astype(np.uint32)
    if not len(u):
        return
    for block, (k, d, mine, _) in zip(blocks, got, strict=True):
        i = np.minimum(np.searchsorted(u, k), len(u) - 1)
        hit = u[i] == k
        if hit.any() or len(mine):
            head = np.array([int(hit.sum()), len(mine)], np.uint32).tobytes()
            body = head + _planes(k[hit]) + c[i[hit]].tobytes() + d[hit].tobytes() + _planes(mine) + c[np.searchsorted(u, mine)].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([0], pa.int32()), pa.array([body], pa.binary())], names=["block", "kind", "body"])


_RECORD = "sig binary, grp binary, n bigint, own bigint, prefix array<bigint>, items binary"


def _assemble(batches):
    """Per block: the classes that can have partners, with their prefix and all their shared shingles."""
    metas, answers = {}, {}
    for b in batches:
        for block, kind, body in zip(b.column("block").to_pylist(), b.column("kind").to_pylist(), b.column("body").to_pylist(), strict=True):
            if kind:
                metas[block] = body
            else:
                answers.setdefault(block, []).append(body)
    for block, bodies in answers.items():
        meta = metas[block]
        m, h = np.frombuffer(meta, np.uint32, 2).tolist()
        size, sigs = np.frombuffer(meta, np.uint32, m, 8).astype(np.int64), 8 + 4 * m
        many = np.frombuffer(meta, np.uint32, h, sigs + 16 * m)
        of_hot = np.frombuffer(meta, np.uint16, int(many.sum()), sigs + 16 * m + 4 * h)
        parts = [_parts(x, 6) for x in bodies]
        k, hot, often = (np.concatenate([p[i] for p in parts]) for i in (0, 2, 3))
        f = np.concatenate([np.frombuffer(p[1], np.uint32, len(p[0])) for p in parts])
        d = np.concatenate([np.frombuffer(p[1], np.uint16, len(p[0]), 4 * len(p[0])) for p in parts])
        by = np.argsort(hot)  # as the block has them
        k, f, d = np.concatenate([k, np.repeat(hot[by], many)]), np.concatenate([f, np.repeat(often[by], many)]), np.concatenate([d, of_hot])
        order = np.lexsort((k, f, d))
        k, d = k[order], d[order]
        at = np.searchsorted(d, np.arange(m + 1))
        own = size - np.diff(at)
        need = size - (4 * size + 4) // 5 + 1  # ceil(0.8 n) shingles are in every partner
        rows = []
        for i in np.flatnonzero(need - own > 0).tolist():
            sig = meta[sigs + 16 * i : sigs + 16 * i + 16]
            mine = k[at[i] : at[i + 1]]
            prefix = mine[: need[i] - own[i]]
            grp = hashlib.blake2b(struct.pack("<Q", size[i]) + prefix.tobytes() + (sig if own[i] else b""), digest_size=16).digest()
            rows.append((sig, grp, int(size[i]), int(own[i]), prefix.view(np.int64), np.sort(mine).tobytes()))
        for j in range(0, len(rows), 500):
            cols = list(zip(*rows[j : j + 500], strict=True))
            types = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["sig", "grp", "n", "own", "prefix", "items"])


def _verify(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that link, by the intersection of their shared shingles."""
    left = records.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("items").alias("ia"))
    right = records.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))

    def run(batches):
        for b in batches:
            keep = []
            for na, x, nb, y in zip(*(b.column(c).to_pylist() for c in ("na", "ia", "nb", "ib")), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                i = np.searchsorted(y, x)
                same = int((y[np.minimum(i, len(y) - 1)] == x).sum()) if len(x) and len(y) else 0
                keep.append(DEN * same >= NUM * (na + nb - same))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(tidy(run), "a binary, b binary")


def _fits(nx: Column, px: Column, ny: Column, py: Column) -> Column:
    """Size and position filters: even if all that follows the shared shingle were equal, would the pair link?"""
    need = NUM * (nx + ny)
    return (DEN * F.least(nx, ny) >= NUM * F.greatest(nx, ny)) & ((NUM + DEN) * F.least(nx - px, ny - py) >= need)


def _lists(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups, and (key, grp, lead, n, own, pos) of their prefix shingles."""
    groups = records.groupBy("grp").agg(F.min("sig").alias("lead"), F.first("n").alias("n"), F.first("own").alias("own"), F.first("prefix").alias("prefix"))
    lists = groups.select("grp", "lead", "n", "own", F.posexplode("prefix").alias("i", "key")).withColumn("pos", F.col("i") + F.col("own"))
    return groups, settle(lists.select("key", "grp", "lead", "n", "own", "pos"), "join-lists")


def _linked(na: np.ndarray, a: list[np.ndarray], nb: np.ndarray, b: list[np.ndarray]) -> np.ndarray:
    """Of two chunks of classes: whether each of the one links with each of the other (in order of their sizes), by all their shared shingles."""
    every, ids = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    sizes = [len(x) for x in b]
    at = np.concatenate([[0], np.cumsum([*(len(x) for x in a), *sizes])])
    theirs, first = ids[at[len(a)] :], np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(every), np.int8)
    out = np.zeros((len(a), len(b)), bool)
    for k, n in enumerate(na.tolist()):
        low, high = np.searchsorted(DEN * nb, NUM * n, "left"), np.searchsorted(NUM * nb, DEN * n, "right")
        if high > low:
            mine = ids[at[k] : at[k + 1]]
            mark[mine] = 1
            upto = np.concatenate([[0], np.cumsum(mark[theirs[first[low] : first[high]]], dtype=np.int64)])
            mark[mine] = 0
            same = np.diff(upto[first[low : high + 1] - first[low]])
            out[k, low:high] = DEN * same >= NUM * (n + nb[low:high] - same)
    return out


def _count_links(batches):
    """Links of the classes of each group of rows that come one after the other."""
    names = ("label", "band", "kind", "i", "j")
    held, key = [], None

    def done():
        sides = [sorted((x for x in held if x[0] == s), key=lambda x: x[2]) for s in (0, 1)]
        sig, n, items = ([[x[k] for x in side] for side in sides] for k in (1, 2, 3))
        n, items = [np.array(x, np.int64) for x in n], [[np.frombuffer(x, np.uint64) for x in side] for side in items]
        _, _, kind, i, j = key
        if kind == 0 and i == j:  # a chunk with itself
            found = _linked(n[0], items[0], n[0], items[0])
            np.fill_diagonal(found, False)  # whether a class links with itself here depends on shingles of its own
            got = [(found.sum(axis=1), sig[0])]
        else:
            found = _linked(n[0], items[0], n[1], items[1]) if sides[0] and sides[1] else np.zeros((len(sides[0]), len(sides[1])), bool)
            got = [(found.sum(axis=1), sig[0]), (found.sum(axis=0), sig[1])]
        return [(s, int(c)) for many, of in got for s, c in zip(of, many, strict=True) if c]

    out = []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in (*names, "side", "sig", "n", "items")), strict=True):
            if row[:5] != key:
                out += done() if held else []
                held, key = [], row[:5]
                if len(out) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64())], names=["sig", "n_links"])
                    out = []
            held.append(row[5:])
    out += done() if held else []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64())], names=["sig", "n_links"])


def count_links(records: DataFrame, labels: DataFrame, chunk: int = 512 << 10) -> DataFrame:
    """(sig, n_links): with how many other classes each one links, as far as there are some.

    Classes that link are of one component and, by their sizes, of one band or of two that meet. The
    classes of a band are dealt by hash to chunks of ``chunk`` bytes; each pair of chunks is one
    task's group, in which all pairs are verified. No pair is a row.
    """
    rows = labels.withColumnRenamed("node", "sig").join(records.select("sig", "n", "items"), "sig")
    rows = settle(rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / float(np.log(1.26))).cast("int")), "join-linking")
    sizes = rows.groupBy("label", "band").agg(F.ceil(F.sum(F.octet_length("items") + 64) / chunk).cast("int").alias("k"))
    sizes = settle(sizes.groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("band", "k"))).alias("bands")), "join-chunks")  # a band for each quarter of size
    k_of = lambda d: F.try_element_at("bands", F.col("band") + d)
    each = rows.join(broadcast_if_small(sizes), "label").withColumns({"k": k_of(0), "over": k_of(1), "under": k_of(-1)})
    each = each.withColumn("c", F.expr("pmod(xxhash64(sig), k)").cast("int"))
    upto = lambda k: F.when(F.col(k).isNotNull(), F.sequence(F.lit(0), F.col(k) - 1)).otherwise(F.array().cast("array<int>"))
    to = lambda kind, i, j, side, band=F.col("band"): F.struct(band.alias("band"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    mine = F.transform(upto("k"), lambda o: to(0, F.least("c", o), F.greatest("c", o), F.col("c") > o))
    above = F.transform(upto("over"), lambda o: to(1, F.col("c"), o, F.lit(0)))
    below = F.transform(upto("under"), lambda o: to(1, o, F.col("c"), F.lit(1), F.col("band") - 1))
    dealt = each.select("label", F.explode(F.concat(mine, above, below)).alias("to"), "sig", "n", "items").select("label", "to.*", "sig", "n", "items")
    keys = ["label", "band", "kind", "i", "j"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(tidy(_count_links), "sig binary, n_links bigint").groupBy("sig").agg(F.sum("n_links").alias("n_links"))


def links(records: DataFrame) -> DataFrame:
    """(node, label) of every class with a partner: its component, named by a class."""
    groups, lists = _lists(records)

    entry = F.struct("own", "n", "lead", "pos")
    pivots = lists.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(entry).alias("p0"), *[F.min(F.struct(F.xxhash64("lead", F.lit(s)).alias("h"), *[F.col(c) for c in ("own", "n", "lead", "pos")])).alias(f"p{s}") for s in (1, 2)])
    pivots = pivots.filter("m > 1").select("key", F.explode(F.array(*[F.struct(*[F.col(f"p{s}")[c].alias(c) for c in ("own", "n", "lead", "pos")]) for s in (0, 1, 2)])).alias("p")).select("key", F.col("p.n").alias("pn"), F.col("p.lead").alias("pl"), F.col("p.pos").alias("pp")).distinct()
    pivots = settle(pivots, "join-pivots")  # so that both sides of the join are dealt anew, and a hot list's rows can be split
    star = lists.join(pivots, "key").filter(F.col("lead") != F.col("pl")).filter(_fits(F.col("n"), F.col("pos"), F.col("pn"), F.col("pp")))
    star = star.select(F.least("lead", "pl").alias("a"), F.greatest("lead", "pl").alias("b"))
    within = records.join(groups.select("grp", "lead"), "grp").filter("sig != lead").select(F.col("lead").alias("a"), F.col("sig").alias("b"))
    first = settle(_verify(settle(star.union(within).distinct(), "join-star"), records), "join-links")

    # what is left: lists (and groups) that hold several components
    labels = components(first)
    member = records.select("sig", "grp", "n").join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    member = settle(member, "join-members")
    span = member.groupBy("grp").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_keys = lists.join(span, "grp").groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low != high").select("key")
    open_keys = settle(open_keys, "join-open")
    rest = settle(lists.join(open_keys, "key", "left_semi").join(span, "grp"), "join-rest")
    x = rest.select("key", *[F.col(c).alias(f"{c}_x") for c in ("grp", "n", "pos", "low", "high")])
    y = rest.select("key", *[F.col(c).alias(f"{c}_y") for c in ("grp", "n", "pos", "low", "high")])
    several = (F.col("low_x") != F.col("low_y")) | (F.col("high_x") != F.col("high_y")) | (F.col("low_x") != F.col("high_x"))
    pairs = x.join(y, (x["key"] == y["key"]) & (F.col("grp_x") <= F.col("grp_y")) & several & _fits(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y")))
    pairs = settle(pairs.select("grp_x", "grp_y").distinct(), "join-group-pairs")
    one = member.select(F.col("grp").alias("grp_x"), F.col("sig").alias("a"), F.col("label").alias("la"))
    two = member.select(F.col("grp").alias("grp_y"), F.col("sig").alias("b"), F.col("label").alias("lb"))
    more = pairs.join(one, "grp_x").join(two, "grp_y").filter("la != lb and a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = settle(_verify(more, records), "join-more-links")
    if second.limit(1).count() == 0:
        return labels
    # components that the rest connects, as a graph of labels
    ends = [member.select(F.col("sig").alias(c), F.col("label").alias(f"label_{c}")) for c in ("a", "b")]
    between = second.join(ends[0], "a").join(ends[1], "b").select("a", "b", "label_a", "label_b")
    between = settle(between, "join-between")
    joined = components(between.select("label_a", "label_b").distinct(), "label_a", "label_b").select(F.col("node").alias("label"), F.col("label").alias("whole"))
    known = labels.union(between.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("label_a").alias("label")), F.struct(F.col("b").alias("node"), F.col("label_b").alias("label")))).alias("x")).select("x.*")).distinct()
    return settle(known.join(joined, "label", "left").select("node", F.coalesce("whole", "label").alias("label")), "join-labels")


def at_home(answers: DataFrame, n: int) -> DataFrame:
    """Answers with the partition ``home`` of their block, one of ``n``: first blocks of tasks go round."""
    return answers.withColumn("home", F.expr(f"pmod(shiftright(block, 32) + (block & 4294967295) * 7919, {n})").cast("int"))


def _found(rows: DataFrame, width: int, n: int) -> DataFrame:
    """Classes that can have partners, by way of the packed postings."""
    posted = exchange(_postings(rows, width, n), n, "bucket")
    return exchange(at_home(posted.mapInArrow(tidy(_count), "block bigint, kind int, body binary"), n), n, "home").mapInArrow(tidy(_assemble), _RECORD)


def _grouped(rows: DataFrame, meta: DataFrame, width: int, count: bool) -> DataFrame:
    """(sig, label, n_links if counted) of every class: ``label`` names its component."""
    spark = rows.sparkSession
    n = buckets_for(rows, "text")
    with scratch() as keep:
        found = settle(_found(rows, width, n), "join-found")
        release(spark)  # the postings
        records = settle(found.groupBy("sig").agg(*[F.first(c).alias(c) for c in ("grp", "n", "own", "prefix", "items")]), "join-records")
        discard(found)
        del found
        labels = links(records)
        release(spark)  # the pairs
        classes = meta.filter("sig is not null").select("sig").distinct()
        classes = classes.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
        if count:
            classes = classes.join(settle(count_links(records, labels), "join-counted"), "sig", "left")
        keep.append(settle(classes, "join-labelled"))
        return keep[0]


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, count: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every row: a class is the documents with one set, named by its least id.

    With ``count`` also n_links, the number of other classes that link with the row's.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    meta = settle(_meta(rows, width), "join-meta")
    least = meta.filter("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("class_id"))
    classes = settle(_grouped(rows, meta, width, count).join(least, "sig"), "join-classes")
    named = settle(classes.groupBy("label").agg(F.min("class_id").alias("component_id")), "join-named")  # settled, so that a hot component's classes can be split
    named = settle(classes.join(named, "label").drop("label"), "join-named-classes")
    discard(classes)
    out = meta.join(named, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), *[F.coalesce(c, "doc_id").alias(c) for c in ("component_id", "class_id")], *[F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")] * count)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates over every whole text, with the number of links of each class."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), count=True)


def stage_ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the row with the least id (ids before nulls) and, of those, the least digest of its text.

    A row is known by its id and its text's digest, so different texts of one id go or stay each by
    itself. Of rows with equal id and text the least in all columns stays. Rows without words stay.
    Only names of rows that go are joined, so texts are not shuffled while those are few.
    """
    bound_batches(spark)
    shielded, name = shield(docs)
    d, t = name["doc_id"], name["text"]
    digest = digest_of(t)
    rows = shielded.select(F.col(d).alias("doc_id"), F.col(t).alias("text"))
    meta = settle(_meta(rows.withColumn("digest", digest_of("text")), WIDTH, ["digest"]), "join-meta")
    classes = _grouped(rows, meta, WIDTH, False)
    who = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "digest")
    each = meta.filter("sig is not null").groupBy("sig", "doc_id", "digest").agg(F.count(F.lit(1)).alias("rows")).join(classes, "sig")
    each = settle(each, "join-each")
    least = settle(each.groupBy("label").agg(F.min(who).alias("stays")), "join-stays")
    each = each.join(least, "label").withColumn("stays", who == F.col("stays"))
    gone = settle(each.filter("not stays").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")), "join-gone")
    again = settle(each.filter("stays and rows > 1").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")), "join-again")
    named = shielded.withColumn("row_digest", digest)
    same = F.col(d).eqNullSafe(F.col("gone_id")) & (F.col("row_digest") == F.col("gone_digest"))
    kept = named.join(broadcast_if_small(gone), same, "left_anti")
    if again.limit(1).count() == 0:
        return unshield(kept, docs)
    rest, twice = (kept.join(broadcast_if_small(again), same, how) for how in ("left_anti", "left_semi"))
    row, order = F.struct(*shielded.columns), F.struct(*[F.to_json(F.struct(c)).alias(c) for c in shielded.columns])
    one = twice.groupBy(d, "row_digest").agg(F.min_by(row, order).alias("row")).select("row.*")
    return unshield(rest.select(*shielded.columns).unionByName(one), docs)
