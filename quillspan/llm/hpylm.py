"""Language-model scoring by a hierarchical Pitman-Yor model.

Context restaurants (one for each token before) share one parent restaurant, whose base is uniform
over the training vocabulary and one unknown token. Customers are training tokens; each table of a
context restaurant is a customer of the parent. Gibbs sweeps reseat all customers of every dish by
the Chinese-restaurant rule, given the seating of the rest as the sweep before left it; predictive
probabilities are averaged over the sweeps after burn-in.

All counts are of whole texts and of all training documents. A block of texts keeps its tokens in a
file of its own, as numbers of its types (word after context), and sends each type once, with its
training count. Shards are a grid of ranges of words' and of contexts' hashes: a word or context that a
third of all documents hold is spread over a row of the grid, and a block counts before it sends. A shard holds its types' counts
and seating. What restaurants and dishes have in all shards is added up by owners, spread by the
hashes of contexts and words: after each sweep a shard sends one number for each context and word it
holds, the owners add, reseat the parent's dishes and answer. Every sweep reads the types and the
totals of the sweep before, once; names of files are a table, and only single sums pass through the
driver. Seeds and totals fix a sweep, so a lost executor costs a recomputation and no state. In the
end shards answer each block with one probability for each of its types.

Defined cases: null and empty texts are one end token; a null id counts as the empty text in the
hold-out rule; repeated rows count each; without training tokens all probabilities are uniform over
the unknown token alone (score 0); empty tables give empty results.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import bound_batches, buckets_for, fetch, fresh, publish, release, settle, small_batches, tidy
from .exchange import exchange
from .ngram_join import _from_planes, _planes, at_home

BURN, KEEP = 1, 2
STRENGTH, PARENT_STRENGTH = 1.0, 10.0
EXACT, STEP = 64, 16
END = np.uint64(0x9AE16A3B2F90404F)
BLOCK_TOKENS, BLOCK_DOCS = 2_500_000, 200_000


def tokens(col) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, first token of each text and one more): lower-cased words, then one end."""
    data, off = tk.flat(col)
    data = tk.LOWER[data]
    starts, ends, first = tk.words(data, off)
    h = tk.span_hashes(data, starts, ends)
    n = np.diff(first)
    at = first + np.arange(len(first))
    out = np.full(len(h) + len(n), END, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
    return out, at


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


# ---- packed columns


def _publish(path: str, *columns: np.ndarray) -> None:
    """A file of columns of integers, as compressed planes of bytes."""
    body = b"".join(map(_planes, columns))
    publish(path, np.array([len(columns), len(body), *map(len, columns)], np.int64).tobytes() + pa.compress(body, "zstd", asbytes=True))


def _fetch(path: str) -> list[np.ndarray]:
    """The columns of such a file."""
    data = fetch(path)
    n, total = np.frombuffer(data, np.int64, 2).tolist()
    sizes = np.frombuffer(data, np.int64, n, 16)
    body = pa.decompress(memoryview(data)[8 * (n + 2) :], total, "zstd", asbytes=True) if total else b""
    ends = np.cumsum([0, *sizes.tolist()]).tolist()
    return [_from_planes(memoryview(body)[8 * a : 8 * b], b - a).astype(np.int64) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _body(*groups: list[np.ndarray]) -> bytes:
    """Groups of columns of one length each."""
    return np.array([len(g[0]) for g in groups], np.uint32).tobytes() + b"".join(_planes(x) for g in groups for x in g)


def _groups(body, widths: tuple[int, ...]) -> list[list[np.ndarray]]:
    """The groups of such a body, of ``widths`` columns."""
    sizes = np.frombuffer(body, np.uint32, len(widths)).tolist()
    at, out = 4 * len(widths), []
    for n, width in zip(sizes, widths, strict=True):
        out.append([_from_planes(memoryview(body)[at + 8 * n * k : at + 8 * n * (k + 1)], n) for k in range(width)])
        at += 8 * n * width
    return out


# ---- blocks


def _blocks(rows: DataFrame, n: int, base: str) -> DataFrame:
    """(bucket, block, kind, body): a block's types by shard, as far as it has some, and the name of its file (kind 1).

    The file has, in the order of the block's tokens, the numbers of their types; for each type
    whether its word is another than that of the type before; and its documents.
    """
    across = max(1, math.isqrt(n))  # shards are a grid of ranges of words and of contexts

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        held: list = [[], []]

        def flush():
            nonlocal seq
            block = (part << 32) | seq
            h, sizes = np.concatenate(held[0]), np.concatenate(held[1])
            out = np.array([held_out(d) for d in ids], bool)
            words, w = np.unique(h, return_inverse=True)
            c = np.empty_like(w)  # the token before; a text's first token follows an end
            c[1:] = w[:-1]
            c[np.cumsum(sizes) - sizes] = np.searchsorted(words, END)
            code, of = np.unique(w * len(words) + c, return_inverse=True)
            count = np.bincount(of, weights=~np.repeat(out, sizes), minlength=len(code)).astype(np.int64)
            w, c = code // len(words), code % len(words)
            shard = tk.range_of(words[w], across) * (n // across) + tk.range_of(words[c], n // across)
            order = np.argsort(shard, kind="stable")  # by shard, word and context
            w, c, count, shard = w[order], c[order], count[order], shard[order]
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            opens = np.concatenate([[True], (w[1:] != w[:-1]) | (shard[1:] != shard[:-1])])
            path = f"{base}/block-{part}-{seq}-{uuid.uuid4().hex}"
            _publish(path, place[of], opens, sizes, np.array([0 if d is None else d for d in ids], np.int64), np.array([d is not None for d in ids]), out)
            some = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
            bodies = []
            for a, b in zip(some.tolist(), [*some[1:].tolist(), len(shard)], strict=True):
                heads = a + np.flatnonzero(opens[a:b])
                before, at = np.unique(c[a:b], return_inverse=True)
                parts = (np.diff(np.append(heads, b)).astype(np.uint32), at.astype(_index(len(before))), count[a:b].astype(np.uint32))
                bodies.append(np.array([len(heads), b - a, len(before)], np.uint32).tobytes() + _planes(words[w[heads]]) + _planes(words[before]) + b"".join(x.tobytes() for x in parts))
            got = pa.RecordBatch.from_arrays(
                [pa.array([*shard[some].tolist(), block % n], pa.int32()), pa.array([block] * (len(some) + 1), pa.int64()), pa.array([0] * len(some) + [1], pa.int32()), pa.array([*bodies, path.encode()], pa.binary())],
                names=["bucket", "block", "kind", "body"],
            )
            seq += 1
            ids.clear()
            for x in held:
                x.clear()
            return got

        size = 0
        for b in small_batches(batches, "text"):
            h, at = tokens(b.column("text"))
            if ids and (size + len(h) > BLOCK_TOKENS or len(ids) + b.num_rows > BLOCK_DOCS):
                yield flush()
                size = 0
            held[0].append(h)
            held[1].append(np.diff(at))
            ids += b.column("doc_id").to_pylist()
            size += len(h)
        if ids:
            yield flush()

    return rows.mapInArrow(run, "bucket int, block bigint, kind int, body binary")


def _index(n: int):
    return np.uint16 if n <= 1 << 16 else np.uint32


def _types(body) -> list[np.ndarray]:
    """Words, contexts, types of each word, and each type's context and count."""
    nw, n, nc = np.frombuffer(body, np.uint32, 3).tolist()
    at, got = 12, []
    for m in (nw, nc):
        got.append(_from_planes(memoryview(body)[at : at + 8 * m], m))
        at += 8 * m
    for dtype, m in ((np.uint32, nw), (_index(nc), n), (np.uint32, n)):
        x = np.frombuffer(body, dtype, m, at)
        at += x.nbytes
        got.append(x.astype(np.int64))
    return got


# ---- the model


def seat(count: np.ndarray, mass: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of each dish after its customers are seated one by one.

    ``mass`` is what a new table of the dish weighs; a dish with i customers at t tables weighs
    i - discount * t. The first EXACT customers come one at a time; later ones in groups of a STEPth of
    those that sit, whose chances of a new table differ by as little: their new tables are one
    binomial draw at the chance in the group's middle.
    """
    t = np.minimum(count, 1).astype(np.float64)
    live = np.flatnonzero(count > 1)
    i = 1
    while len(live) and i < EXACT:
        t[live] += rng.random(len(live)) * (mass[live] + i - discount * t[live]) < mass[live]
        i += 1
        live = live[count[live] > i]
    while len(live):
        group = np.minimum(count[live] - i, max(i // STEP, 1))
        half = (group - 1) / 2
        chance = mass[live] / (mass[live] + i - discount * t[live])
        chance = mass[live] / (mass[live] + i + half - discount * (t[live] + half * chance))  # in the middle of the group
        t[live] += rng.binomial(group, np.minimum(chance, 1.0))
        i += max(i // STEP, 1)
        live = live[count[live] > i]
    return t


def parent(model: dict, c0: np.ndarray, t0: np.ndarray, s: int) -> np.ndarray:
    """The parent's probability of words with ``c0`` customers at ``t0`` tables, after sweep ``s``."""
    tables, customers = model["parents"][s]
    return (c0 - model["d0"] * t0 + (PARENT_STRENGTH + model["d0"] * tables) / (model["V"] + 1)) / (PARENT_STRENGTH + customers)


def predictive(model: dict, count, t, customers, tables, p0) -> np.ndarray:
    """Probability of a word with ``count`` customers at ``t`` tables of a restaurant with ``customers`` at ``tables``."""
    return (np.maximum(count - model["d"] * t, 0) + (STRENGTH + model["d"] * tables) * p0) / (STRENGTH + customers)


class Shard:
    """Types: their words, contexts and counts; totals of the restaurants and dishes that they are of."""

    def __init__(self, path: str, totals: list[str]):
        self.words, self.contexts, key, self.count = _fetch(path)
        self.word, self.ctx = key >> 32, key & 0xFFFFFFFF
        first = _fetch(totals[0])
        self.customers, self.word_count = first[0], first[2]
        self.totals = [(first[1], first[3], first[4]), *map(_fetch, totals[1:])]

    def sweep(self, model: dict, s: int, seating: Callable, seed: int) -> np.ndarray:
        """Tables of all types in sweep ``s``, given what the one before left."""
        tables, c0, t0 = self.totals[s - 1 - self.skipped]
        mass = parent(model, c0, t0, s - 1)[self.word] * (STRENGTH + model["d"] * tables[self.ctx])
        return seating(self.count, mass, model["d"], np.random.default_rng([seed, s]))

    skipped = 0  # totals of that many sweeps were not loaded


# ---- exchanges

#: Parts below 0: a task's numbers, a shard's files of types and of blocks' places, an owner's file of places, a shard's file of totals, a block's file.
NUMBERS, TYPES, INDEX, PLACES, TOTALS, BLOCK = -1, -2, -3, -4, -5, -6
_SENT = "bucket int, src bigint, part int, body binary"


def _rows(batches):
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("bucket", "src", "part", "body")), strict=True)


def _batch(*rows):
    cols = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "src", "part", "body"])


def _text(numbers) -> bytes:
    return ",".join(str(int(x)) for x in numbers).encode()


def _send(src: int, contexts: np.ndarray, words: np.ndarray, n: int, of_contexts: list[np.ndarray], of_words: list[np.ndarray]):
    """Rows of _SENT to the owners of ascending ``contexts`` and ``words``."""
    (c_some, c_at), (w_some, w_at) = tk.ranges(contexts, n), tk.ranges(words, n)
    spans = {int(j): [(int(a), int(b)), (0, 0)] for j, a, b in zip(c_some, c_at[:-1], c_at[1:], strict=True)}
    for j, a, b in zip(w_some, w_at[:-1], w_at[1:], strict=True):
        spans.setdefault(int(j), [(0, 0), (0, 0)])[1] = (int(a), int(b))
    for j, ((a, b), (x, y)) in spans.items():
        yield _batch((j, src, j, _body([v[a:b] for v in of_contexts], [v[x:y] for v in of_words])))


def _gather(n: int, base: str):
    """Per shard: stores its types and where each block has them; sends customers and types per context, and counts and contexts per word."""

    def run(batches):
        parts, src = [], None
        for b in batches:
            for bucket, block, kind, body in zip(*(b.column(c).to_pylist() for c in ("bucket", "block", "kind", "body")), strict=True):
                if kind:
                    yield _batch((bucket, block, BLOCK, body))
                else:
                    src = bucket
                    parts.append((block, *_types(body)))
        if src is None:
            return
        parts.sort(key=lambda p: p[0])
        words, contexts = (np.unique(np.concatenate([p[k] for p in parts])) for k in (1, 2))
        at = [np.searchsorted(words, p[1]) for p in parts]
        keys = [(np.repeat(w, p[3]) << 32) | np.searchsorted(contexts, p[2])[p[4]] for w, p in zip(at, parts, strict=True)]
        key, of = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(of, weights=np.concatenate([p[5] for p in parts])).astype(np.int64)
        name = uuid.uuid4().hex
        _publish(f"{base}/types-{src}-{name}", words, contexts, key, count)
        steps = lambda x, sizes: np.concatenate([np.diff(y, prepend=0) for y in np.split(x, np.cumsum(sizes)[:-1])])  # noqa: E731  (a block's numbers ascend)
        n_types, n_words = [len(k) for k in keys], [len(w) for w in at]
        _publish(f"{base}/index-{src}-{name}", np.array([p[0] for p in parts]), np.array(n_types), steps(of, n_types), np.array(n_words), steps(np.concatenate(at), n_words))
        yield _batch((src, src, TYPES, f"{base}/types-{src}-{name}".encode()), (src, src, INDEX, f"{base}/index-{src}-{name}".encode()))
        del parts, keys, of, at
        word, ctx, seen = key >> 32, key & 0xFFFFFFFF, count > 0
        per = lambda x, m, w=None: np.bincount(x, weights=w, minlength=m).astype(np.int64)
        yield _batch((src, src, NUMBERS, _text([(count == 1).sum(), (count == 2).sum(), 0, 0, 0, 0, 0, 0])))
        yield from _send(src, contexts, words, n, [contexts, per(ctx, len(contexts), count), per(ctx[seen], len(contexts))], [words, per(word, len(words), count), per(word[seen], len(words))])

    return run


def _add(base: str, model: dict | None, s: int, seating: Callable):
    """Per owner: adds the shards' numbers up, seats the parent's dishes of its words, and answers each shard. Without ``model``: finds and stores who has what."""

    def run(batches):
        got, places, owner = [], None, None
        for row in _rows(batches):
            if row[2] == PLACES:
                places = bytes(row[3]).decode()
            elif row[2] < 0:
                yield _batch(row)
            else:
                owner = row[2]
                got.append((row[1], row[3]))
        if owner is None:
            return
        got.sort(key=lambda x: x[0])
        parsed = [_groups(body, (3, 3) if model is None else (1, 1)) for _, body in got]
        column = lambda g, k: np.concatenate([p[g][k] for p in parsed])
        if model is None:
            at = [np.unique(column(g, 0), return_inverse=True)[1] for g in (0, 1)]
            path = f"{base}/places-{owner}-{uuid.uuid4().hex}"
            _publish(path, *at)
            yield _batch((owner, owner, PLACES, path.encode()))
        else:
            at = _fetch(places)
        total = lambda g, k: np.bincount(at[g], weights=column(g, k).astype(np.float64)).astype(np.int64) if len(at[g]) else np.zeros(0, np.int64)
        if model is None:
            count, c0 = total(1, 1), total(1, 2)
            t0 = np.minimum(c0, 1)
            columns = [[total(0, 1), total(0, 2)], [count, c0, t0]]
            numbers = [0, 0, (c0 == 1).sum(), (c0 == 2).sum(), count.sum(), (count > 0).sum(), t0.sum(), c0.sum()]
        else:
            c0 = total(1, 0)
            mass = (PARENT_STRENGTH + model["d0"] * model["parents"][s - 1][0]) / (model["V"] + 1)
            t0 = seating(c0, np.full(len(c0), mass), model["d0"], np.random.default_rng([owner, s, 1])).astype(np.int64)
            columns = [[total(0, 0)], [c0, t0]]
            numbers = [0, 0, 0, 0, 0, 0, t0.sum(), c0.sum()]
        yield _batch((owner, owner, NUMBERS, _text(numbers)))
        ends = [0, 0]
        for (src, _), p in zip(got, parsed, strict=True):
            sizes = [len(p[0][0]), len(p[1][0])]
            mine = [at[g][ends[g] : ends[g] + sizes[g]] for g in (0, 1)]
            yield _batch((src, src, owner, _body(*[[x[mine[g]] for x in columns[g]] for g in (0, 1)])))
            ends = [ends[g] + sizes[g] for g in (0, 1)]

    return run


def _keep(base: str, widths: tuple[int, int]):
    """Per shard: stores the answers of all owners, in the order of its contexts and words."""

    def run(batches):
        got, src = [], None
        for row in _rows(batches):
            if row[2] < 0:
                yield _batch(row)
            else:
                src = row[1]
                got.append((row[2], row[3]))
        if src is None:
            return
        parsed = [_groups(body, widths) for _, body in sorted(got, key=lambda x: x[0])]
        path = f"{base}/totals-{src}-{uuid.uuid4().hex}"
        _publish(path, *(np.concatenate([p[g][k] for p in parsed]) for g in (0, 1) for k in range(widths[g])))
        yield _batch((0, src, TOTALS, path.encode()))

    return run


def _exchanged(sent: DataFrame, places: DataFrame | None, n: int, base: str, model: dict | None, s: int, seating: Callable) -> tuple[list[int], DataFrame]:
    """(sums of the tasks' numbers, table of the files' names) after the owners have answered ``sent``."""
    if places is not None:
        sent = sent.unionByName(places)
    added = exchange(sent, n, "bucket").mapInArrow(tidy(_add(base, model, s, seating)), _SENT)
    names = settle(exchange(added, n, "bucket").mapInArrow(tidy(_keep(base, (2, 3) if model is None else (1, 2))), _SENT), "lm-names")
    numbers = F.split(F.col("body").cast("string"), ",")
    sums = names.filter(F.col("part") == NUMBERS).agg(*[F.sum(numbers[k].cast("bigint")) for k in range(8)]).first()
    return [int(x or 0) for x in sums], names


def _named(names: DataFrame, part: int, column: str) -> DataFrame:
    return names.filter(F.col("part") == part).select("src", F.col("body").cast("string").alias(column))


def _sweep(model: dict, s: int, n: int, seating: Callable):
    """Tables per context and per word after sweep ``s``."""

    def run(batches):
        for b in batches:
            for src, types, *totals in zip(*(c.to_pylist() for c in b.columns), strict=True):
                shard = Shard(types, totals)
                shard.skipped = s - len(totals)
                t = shard.sweep(model, s, seating, src)
                per = lambda x, keys: np.bincount(x, weights=t, minlength=len(keys)).astype(np.int64)  # noqa: B023, E731
                yield from _send(src, shard.contexts.astype(np.uint64), shard.words.astype(np.uint64), n, [per(shard.ctx, shard.contexts)], [per(shard.word, shard.words)])

    return run


def _answers(model: dict, sweeps: int, burn: int, seating: Callable):
    """(block, src, kind, body): to each block the logarithms of its types' probabilities and its words' counts."""

    def run(batches):
        for b in batches:
            for src, types, index, *totals in zip(*(c.to_pylist() for c in b.columns), strict=True):
                shard = Shard(types, totals)
                p = np.zeros(len(shard.count))
                for s in range(burn + 1, sweeps + 1):
                    t = shard.sweep(model, s, seating, src)
                    tables, c0, t0 = shard.totals[s]
                    p += predictive(model, shard.count, t, shard.customers[shard.ctx], tables[shard.ctx], parent(model, c0, t0, s)[shard.word])
                log = np.log10(p / (sweeps - burn))
                blocks, n_types, of, n_words, word = _fetch(index)
                x = y = 0
                for block, m, k in zip(blocks.tolist(), n_types.tolist(), n_words.tolist(), strict=True):
                    body = _body([log[np.cumsum(of[x : x + m])].view(np.uint64)], [shard.word_count[np.cumsum(word[y : y + k])]])
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([src], pa.int64()), pa.array([0], pa.int32()), pa.array([body], pa.binary())], names=["block", "src", "kind", "body"])
                    x, y = x + m, y + k

    return run


_OUT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"


def _documents(model: dict):
    def run(batches):
        files, answers = {}, {}
        for b in batches:
            for block, src, kind, body in zip(*(b.column(c).to_pylist() for c in ("block", "src", "kind", "body")), strict=True):
                if kind:
                    files[block] = bytes(body).decode()
                else:
                    answers.setdefault(block, []).append((src, body))
        for block in list(files):
            path = files.pop(block)
            of, opens, sizes, ids, known_id, out = _fetch(path)
            parts = [_groups(body, (1, 1)) for _, body in sorted(answers.pop(block), key=lambda x: x[0])]
            log = np.concatenate([p[0][0] for p in parts]).view(np.float64)
            count = np.concatenate([p[1][0] for p in parts])[np.cumsum(opens) - 1].astype(np.float64)  # of each type's word
            base = np.log10((count + 0.5) / (model["N"] + 0.5 * (model["V"] + 1)))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            score, base_score, known = (np.bincount(doc, weights=x[of], minlength=len(sizes)) for x in (log, base, (count > 0).astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=known_id == 0), pa.array(out.astype(bool)), pa.array(sizes), pa.array(known.astype(np.int64)), pa.array(np.full(len(sizes), model["N"], np.int64)), pa.array(base_score), pa.array(score), pa.array(10 ** (-score / sizes))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", burn: int = BURN, keep: int = KEEP, seating: Callable = seat) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n, base = buckets_for(rows, "text"), fresh(spark, "lm")
    sent = exchange(_blocks(rows, n, base), n, "bucket").mapInArrow(tidy(_gather(n, base)), _SENT)
    (n1, n2, m1, m2, n_tokens, vocabulary, tables, customers), names = _exchanged(sent, None, n, base, None, 0, seating)
    del sent
    release(spark)  # the types that were exchanged
    discount = lambda a, b: float(np.clip(a / (a + 2 * b), 0.05, 0.95)) if a else 0.5
    model = {"N": n_tokens, "V": vocabulary, "d": discount(n1, n2), "d0": discount(m1, m2), "parents": [(float(tables), float(customers))]}
    places = names.filter(F.col("part") == PLACES)
    blocks = names.filter(F.col("part") == BLOCK).select(F.col("src").alias("block"), F.lit(-1).cast("bigint").alias("src"), F.lit(1).alias("kind"), "body")
    shards = _named(names, TYPES, "types").join(_named(names, INDEX, "index"), "src").join(_named(names, TOTALS, "totals0"), "src")
    shards = settle(shards, "lm-shards")
    for s in range(1, burn + keep + 1):
        columns = ["totals0"] + [f"totals{s - 1}"] * (s > 1)
        dealt = exchange(shards.select(F.col("src").cast("int").alias("bucket"), "types", *columns), n, "bucket")
        swept = dealt.mapInArrow(tidy(_sweep({**model, "parents": list(model["parents"])}, s, n, seating)), _SENT)
        got, names = _exchanged(swept, places, n, base, {**model, "parents": list(model["parents"])}, s, seating)
        model["parents"].append((float(got[6]), float(got[7])))
        shards = settle(shards.join(_named(names, TOTALS, f"totals{s}"), "src"), "lm-shards")
        del dealt, swept
        release(spark)  # the sums that were exchanged
    dealt = exchange(shards.select(F.col("src").cast("int").alias("bucket"), "types", "index", *[f"totals{s}" for s in range(burn + keep + 1)]), n, "bucket")
    answers = dealt.mapInArrow(tidy(_answers(model, burn + keep, burn, seating)), "block bigint, src bigint, kind int, body binary")
    return exchange(at_home(answers.unionByName(blocks), n), n, "home").mapInArrow(tidy(_documents(model)), _OUT)


def op7_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text under a model of the training documents."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
