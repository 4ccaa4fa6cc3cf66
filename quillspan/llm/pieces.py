"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A model file's pieces and scores are read as they are (nothing is trained). A text gets the dummy
prefix and white-space markers of its model's settings; its best path maximises the sum of scores;
of equal sums the longest last piece wins. A character without a piece of its own costs the least
score less ten and falls back to its bytes' pieces (to the unknown piece without them).

No piece holds a marker after another character, and none holds a line feed, so best paths fall
apart before a marker run and around a line feed. Each distinct unit is solved once per cache, many
in lockstep: the trie is walked for all units at once, byte by byte.

Decoding maps markers to spaces, drops the dummy prefix and joins byte pieces; bytes that are no
UTF-8 become U+FFFD.

Defined cases: null and empty texts have no ids; very long texts are coded whole, and so are very long
units (a text without a space), which are solved by themselves; empty tables give empty results.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import append_columns, kept_by_worker
from .units import CachedEncoder, tile

MARK = "▁".encode()
ALONE = 20_000  # bytes beyond which a unit is solved by itself
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes):
    """(number, value) of a protocol buffer's fields."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, raw[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, struct.unpack("<f" if n == 4 else "<d", raw[at : at + n])[0]
            at += n


@dataclass
class Pieces:
    """A model: pieces with scores and kinds, settings, and the double-array trie of what text can match."""

    pieces: list[bytes]
    scores: np.ndarray
    kinds: np.ndarray
    prefix: bool
    squeeze: bool
    base: np.ndarray
    check: np.ndarray
    leaf: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    least: float
    key: str

    def lists(self) -> tuple[list, list, list, list]:
        """The trie and the scores as plain lists."""
        if "plain" not in self.__dict__:
            self.plain = tuple(x.tolist() for x in (self.base, self.check, self.leaf, self.scores))
        return self.plain


def load(path: str) -> Pieces:
    """Read a .model file."""
    raw = open(path, "rb").read()
    pieces, scores, kinds, prefix, squeeze = [], [], [], True, True
    for number, value in _fields(raw):
        if number == 1:
            got = dict(_fields(value))
            pieces.append(got[1])
            scores.append(got.get(2, 0.0))
            kinds.append(got.get(3, NORMAL))
        elif number == 3:
            got = dict(_fields(value))
            prefix, squeeze = bool(got.get(3, 1)), bool(got.get(4, 1))
    return build(pieces, scores, kinds, prefix, squeeze)


def build(pieces: list[bytes], scores: list[float], kinds: list[int], prefix: bool = True, squeeze: bool = False) -> Pieces:
    """A model of the given pieces."""
    byte_ids = np.full(256, -1, np.int32)
    words: dict[bytes, int] = {}
    unknown = 0
    for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
        if k == BYTE:
            byte_ids[int(p[3:5], 16)] = i
        elif k in (NORMAL, USER):
            words[p] = i
            body = p.replace(MARK, b"\x00")
            if b"\n" in p or b"\x00" in body.lstrip(b"\x00"):
                raise ValueError("a piece crosses the units that texts are cut in")
        elif k == UNKNOWN:
            unknown = i
    scores_a = np.array(scores, np.float64)
    least = float(min((scores_a[i] for i in words.values()), default=0.0)) - 10.0
    base, check, leaf = double_array(words)
    key = f"{zlib.crc32(b'|'.join(pieces))}-{len(pieces)}-{zlib.crc32(scores_a.tobytes())}-{prefix}-{squeeze}"
    return Pieces(pieces, scores_a, np.array(kinds), prefix, squeeze, base, check, leaf, byte_ids, unknown, least, key)


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, leaf): from state s, byte c leads to t = base[s] + c + 1 if check[t] is s; leaf[t] is a word's id or -1."""
    kids: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, i in words.items():
        node = 0
        for c in word:
            nxt = kids[node].get(c)
            if nxt is None:
                nxt = kids[node][c] = len(kids)
                kids.append({})
                ends.append(-1)
            node = nxt
        ends[node] = i
    size = 2 * len(kids) + 4096
    base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    free = np.ones(size, bool)
    free[0] = False
    one, lows, todo = 1, 1, [(0, 0)]  # the first free cell; where cells for several children are sought
    while todo:
        node, state = todo.pop()
        codes = np.array(sorted(kids[node]), np.int64) + 1
        if not len(codes):
            continue
        while not free[one]:
            one += 1
        if len(codes) == 1 and one >= codes[0]:
            b = one - int(codes[0])
        else:
            at = max(one, lows, int(codes[0]))
            while True:
                while at + 8192 + 257 >= len(free):
                    more = len(free)
                    free = np.concatenate([free, np.ones(more, bool)])
                    base, check, leaf = (np.concatenate([x, np.full(more, v, np.int32)]) for x, v in ((base, 0), (check, -1), (leaf, -1)))
                bases = at + np.flatnonzero(free[at : at + 8192]) - codes[0]
                good = free[bases[:, None] + codes].all(axis=1) if len(bases) else np.zeros(0, bool)
                if good.any():
                    b = int(bases[np.argmax(good)])
                    break
                at += 8192
            if at > lows + 8192:  # it is full there
                lows = at
        base[state] = b
        cells = b + codes
        free[cells] = False
        check[cells] = state
        for cell, code in zip(cells.tolist(), codes.tolist(), strict=True):
            child = kids[node][code - 1]
            leaf[cell] = ends[child]
            todo.append((child, cell))
    top = int(np.flatnonzero(~free).max()) + 258  # a step from any state stays inside
    top = max(top, int(base.max()) + 258)
    grow = max(0, top - len(base))
    return tuple(np.concatenate([x, np.full(grow, v, np.int32)])[:top] for x, v in ((base, 0), (check, -1), (leaf, -1)))


def viterbi(m: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units, count of each), byte fallback included."""
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    out: list = [None] * len(starts)
    at = 0
    while at < len(order):  # units of like length, in matrices of a bounded size
        if lengths[order[at]] > ALONE:
            for i in order[at:].tolist():
                out[i] = _alone(m, data[starts[i] : ends[i]])
            break
        top = max(int(lengths[order[at]]) * 3 // 2, 16)
        to = min(int(np.searchsorted(lengths[order], min(top, ALONE), "right")), at + max(1, 1_000_000 // top))
        which = order[at : max(to, at + 1)]
        for i, ids in zip(which.tolist(), _lockstep(m, data, starts[which], lengths[which]), strict=True):
            out[i] = ids
        at += len(which)
    return np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32), np.array([len(x) for x in out], np.int64)


def _alone(m: Pieces, text: np.ndarray) -> list[int]:
    """The ids of one long unit: the same sums and choices, character by character, in memory of a few numbers a byte."""
    base, check, leaf, scores = m.lists()
    codes, lead, n = text.tolist(), np.append(tk.IS_CHAR[text], True).tolist(), len(text)
    best, from_at, by = [-float("inf")] * (n + 1), array("i", bytes(4 * (n + 1))), array("i", bytes(4 * (n + 1)))
    best[0] = 0.0
    low = -float("inf")
    for i in range(n):
        here = best[i]
        if not lead[i] or here == low:
            continue
        end = i + 1
        while not lead[end]:
            end += 1
        state, single, j = 0, False, i
        while j < n:
            t = base[state] + codes[j] + 1
            if check[t] != state:
                break
            state = t
            j += 1
            w = leaf[t]
            if w >= 0:
                single = single or j == end
                score = here + scores[w]
                if score > best[j]:
                    best[j], from_at[j], by[j] = score, i, w
        if not single and here + m.least > best[end]:
            best[end], from_at[end], by[end] = here + m.least, i, -1
    back, j = [], n
    while j:
        i, w = from_at[j], by[j]
        back.append([w] if w >= 0 else m.byte_ids[text[i:j]].tolist() if m.byte_ids[0] >= 0 else [m.unknown])
        j = i
    return [x for part in reversed(back) for x in part]


def _lockstep(m: Pieces, data, starts, lengths) -> list:
    n, most = len(starts), int(lengths.max())
    text = np.zeros((n, most), np.uint8)
    inside = np.arange(most) < lengths[:, None]
    text[inside] = data[tk.rows_of(starts, lengths)]
    lead = tk.IS_CHAR[text] & inside
    best = np.full((n, most + 1), -np.inf)
    best[:, 0] = 0
    from_at = np.zeros((n, most + 1), np.int32)
    by = np.full((n, most + 1), -1, np.int32)  # -1: an unknown character
    char_end = np.zeros((n, most), np.int32)  # where the character at a position ends
    nxt = lengths.astype(np.int32).copy()
    for i in range(most - 1, -1, -1):
        char_end[:, i] = nxt
        nxt = np.where(lead[:, i], i, nxt)
    for i in range(most):
        rows = np.flatnonzero(lead[:, i] & (best[:, i] > -np.inf))
        if not len(rows):
            continue
        single = np.zeros(len(rows), bool)
        state, live = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for j in range(i, most):
            go = live[lengths[rows[live]] > j]
            if not len(go):
                break
            t = m.base[state[go]] + text[rows[go], j] + 1
            ok = m.check[t] == state[go]
            live, t = go[ok], t[ok]
            if not len(live):
                break
            state[live] = t
            word = m.leaf[t]
            hit = word >= 0
            if hit.any():
                k, w = live[hit], word[hit]
                r = rows[k]
                single[k[char_end[r, i] == j + 1]] = True
                score = best[r, i] + m.scores[w]
                more = score > best[r, j + 1]
                r = r[more]
                best[r, j + 1], from_at[r, j + 1], by[r, j + 1] = score[more], i, w[more]
        r = rows[~single]
        e = char_end[r, i]
        score = best[r, i] + m.least
        more = score > best[r, e]
        r, e = r[more], e[more]
        best[r, e], from_at[r, e], by[r, e] = score[more], i, -1
    # back along the paths, all units at once
    pos, live = lengths.astype(np.int64).copy(), np.arange(n)
    steps = []
    while len(live):
        p = pos[live]
        steps.append((live, from_at[live, p], by[live, p], p))
        pos[live] = from_at[live, p]
        live = live[pos[live] > 0]
    got: list = [[] for _ in range(n)]
    fallback = m.byte_ids[0] >= 0
    for rows, a, w, e in reversed(steps):
        for r, x, y, z in zip(rows.tolist(), a.tolist(), w.tolist(), e.tolist(), strict=True):
            if y >= 0:
                got[r].append(y)
            elif fallback:
                got[r] += m.byte_ids[text[r, x:z]].tolist()
            else:
                got[r].append(m.unknown)
    return got


def normalise(m: Pieces, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with the dummy prefix and markers in place of spaces; with the model's setting, runs of spaces and those at the ends are squeezed first."""
    space = data == 0x20
    if m.squeeze and len(data):
        n = len(data)
        ends = np.zeros(n + 1, bool)
        ends[off] = True
        before = np.concatenate([[True], space[:-1]]) | ends[:n]
        drop = space & before  # leading ones, and all but the first of a run
        keep = ~drop
        tail = keep & space  # a last one
        last = np.concatenate([np.cumsum((~space).astype(np.int64)), [0]])
        doc_last = np.repeat(np.concatenate([[0], np.cumsum(~space)])[off[1:]], np.diff(off))
        keep &= ~(tail & (last[:n] == doc_last))
        off = np.concatenate([[0], np.cumsum(keep)])[off]
        data, space = data[keep], space[keep]
    filled = np.diff(off) > 0
    width = np.where(space, 3, 1)
    grown = np.concatenate([[0], np.cumsum(width)])
    add = (3 * filled * m.prefix).astype(np.int64)
    new_off = np.concatenate([[0], np.cumsum(grown[off[1:]] - grown[off[:-1]] + add)])
    out = np.empty(int(new_off[-1]), np.uint8)
    at = grown[:-1] + np.repeat(np.cumsum(add), np.diff(off))
    out[at[~space]] = data[~space]
    marks = at[space]
    if m.prefix:
        marks = np.concatenate([marks, new_off[:-1][filled]])
    for k in range(3):
        out[marks + k] = MARK[k]
    return out, new_off


def cuts(data: np.ndarray) -> np.ndarray:
    """Before each marker run, and before and after each line feed."""
    n = len(data)
    if n < 3:
        return np.flatnonzero(data == 10)
    mark = np.zeros(n, bool)
    mark[:-2] = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
    feed = data == 10
    cut = mark | feed
    cut[3:] &= ~mark[:-3] | feed[3:]
    cut[1:] |= feed[:-1]
    return np.flatnonzero(cut)


_cached: dict[str, CachedEncoder] = kept_by_worker("pieces")


def encode_column(m: Pieces, col) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, count of each)."""
    if m.key not in _cached:
        _cached.clear()
        _cached[m.key] = CachedEncoder(lambda d, s, e: (*viterbi(m, d, s, e), np.arange(len(s))))
    data, off = normalise(m, *tk.flat(col))
    starts, ends = tile(off, cuts(data))
    ids, counts = _cached[m.key](data, starts, ends)
    return ids, tk.sums(counts, np.searchsorted(starts, off))


def _surfaces(m: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all pieces as text, offsets)."""
    spelt = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, b" ") for p, k in zip(m.pieces, m.kinds, strict=True)]
    return np.frombuffer(b"".join(spelt), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelt])])


def decode_flat(m: Pieces, ids: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that the ids spell, without the dummy prefix."""
    raw, at = _surfaces(m)
    n = np.diff(at)[ids]
    data = raw[tk.rows_of(at[ids], n)]
    off = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(per)])]
    if m.prefix and len(data):
        first = off[:-1][(np.diff(off) > 0)]
        first = first[data[first] == 0x20]
        keep = np.ones(len(data), bool)
        keep[first] = False
        off = np.concatenate([[0], np.cumsum(keep)])[off]
        data = data[keep]
    return data, off


def decode_column(m: Pieces, col) -> list[str]:
    """Texts of an Arrow list column of ids."""
    lists = [x or [] for x in col.to_pylist()]
    data, off = decode_flat(m, np.array([i for x in lists for i in x], np.int64), np.array([len(x) for x in lists], np.int64))
    raw = data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def encode(docs: DataFrame, m: Pieces, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` with ``ids``, their number, their score and ``exact``: whether decoding gives the text back."""

    def make(col):
        ids, per = encode_column(m, col)
        data, off = tk.flat(col)
        back, back_off = decode_flat(m, ids, per)
        same = np.diff(off) == np.diff(back_off)
        if m.squeeze or len(data) != len(back) or not np.array_equal(data, back):
            a, b = data.tobytes(), back.tobytes()
            same &= np.array([a[off[i] : off[i + 1]] == b[back_off[i] : back_off[i + 1]] for i in range(len(same))], bool)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.array(ids, pa.int32()))
        scores = np.where(m.kinds == BYTE, 0.0, m.scores)[ids]
        return [lists, per.astype(np.int64), tk.sums(scores, np.concatenate([[0], np.cumsum(per)])), pa.array(same)]

    return append_columns(docs, text, make, [("ids", "array<int>"), ("n_ids", "bigint"), ("score", "double"), ("exact", "boolean")], keep, "pieces")


def decode(encoded: DataFrame, m: Pieces, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` with ``decoded``, the text that the ids spell (null ids: empty)."""
    kept = [c for c in (encoded.columns if keep is None else keep) if c != "decoded"]
    schema = ", ".join([f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept] + ["decoded string"])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(decode_column(m, b.column(ids)), pa.string())], names=[*kept, "decoded"])

    return encoded.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, ids])]).mapInArrow(run, schema)


def _model() -> Pieces:
    import public_tokenizers

    return load(public_tokenizers.path("piece_bpe_32k.model"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, _model(), keep=["doc_id"])


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that the mix takes, with its other columns but the text."""
    return encode(docs, _model(), keep=[c for c in docs.columns if c != "text"])
