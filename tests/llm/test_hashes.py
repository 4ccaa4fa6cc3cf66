"""Texts made to collide under hashes by polynomials modulo powers of two, through every operator that hashes words."""

import numpy as np
import pyarrow as pa
import pytest

from quillspan.llm import hpylm, ngram_join, pieces, quality_rules, token_output, units
from quillspan.llm import textkernel as tk


def twins(n):
    """The Thue-Morse word of ``n`` letters and the one with its letters exchanged."""
    other = str.maketrans("ab", "ba")
    x = "a"
    while len(x) < n:
        x += x.translate(other)
    return x, x.translate(other)


@pytest.mark.parametrize("n", [1024, 2048])
def test_twins_have_hashes_of_their_own(n):
    x, y = twins(n)
    data, off = tk.flat(pa.array([x, y, x]))
    a, b, c = tk.span_hashes(data, off[:-1], off[1:])
    assert a == c != b


def test_hashes_tell_spans_apart():
    rng = np.random.default_rng(1)
    spans = list({bytes(rng.integers(0, 3, rng.integers(0, 40), dtype=np.uint8)) for _ in range(20000)})
    data = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(s) for s in spans])
    got = tk.span_hashes(data, ends - [len(s) for s in spans], ends)
    assert len(set(got.tolist())) == len(spans)
    again = tk.span_hashes(np.frombuffer(b"xyz" + b"".join(spans), np.uint8), ends + 3 - [len(s) for s in spans], ends + 3)
    assert (got == again).all()


@pytest.mark.parametrize("n", [1024, 2048])
def test_token_ids_of_twins(n):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    ids, per = token_output.encode_column(pa.array(list(twins(n))), path)
    x, y = (tok.encode(t, add_special_tokens=False).ids for t in twins(n))
    assert ids.tolist() == [*x, 0, *y, 0] and per.tolist() == [len(x) + 1, len(y) + 1]


@pytest.mark.parametrize("n", [1024, 2048])
def test_pieces_of_twins(n):
    m = pieces._model()
    texts = [f"{t} end" for t in twins(n)]
    ids, per = pieces.encode_column(m, pa.array(texts))
    data, off = pieces.decode_flat(m, ids, per)
    assert [data[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:], strict=True)] == texts


@pytest.mark.parametrize("n", [1024, 2048])
def test_lines_and_tokens_of_twins(n):
    x, y = twins(n)
    assert quality_rules.statistics(pa.array([f"{x}\n{y}", f"{x}\n{x}"]))[3].tolist() == [0, 1]
    h, _ = hpylm.tokens(pa.array([f"{x} {y}"]))
    assert len(set(h.tolist())) == 3


def test_documents_of_twins_do_not_link(spark):
    x, y = twins(1024)
    more = " ".join(f"w{chr(97 + i)}" for i in range(6))
    texts = [x, y, f"{x} {x} {x} {x} {x}", f"{y} {y} {y} {y} {y}", f"{more} {x}", f"{more} {x}"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.component_id for r in ngram_join.join(df).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4}
    assert {r.doc_id for r in ngram_join.stage_ngram_join(spark, df, "").collect()} == {0, 1, 2, 3, 4}


def test_cache_survives_equal_hashes(monkeypatch):
    """Units of one hash are told apart by their bytes."""
    calls = []

    def encode(data, starts, ends):
        calls.append(len(starts))
        spans = [data[a:b].tolist() for a, b in zip(starts, ends, strict=True)]
        order = np.arange(len(spans))[::-1]
        return np.array([x for i in order for x in spans[i]], np.int32), np.array([len(spans[i]) for i in order]), order

    cached = units.CachedEncoder(encode, limit=5)
    rng = np.random.default_rng(0)

    def check(k):
        spans = [rng.integers(0, 3, rng.integers(0, 20), dtype=np.uint8) for _ in range(k)]
        ends = np.cumsum([len(s) for s in spans])
        data = np.concatenate(spans)
        ids, n = cached(data, ends - [len(s) for s in spans], ends)
        assert ids.tolist() == data.tolist() and n.tolist() == [len(s) for s in spans]

    for k in (1, 3, 50, 50):
        check(k)
    monkeypatch.setattr(tk, "chunk_hashes", lambda parts, at, lengths: np.zeros(len(at) - 1, np.uint64))
    cached._clear()
    for k in (1, 1, 7, 50):
        check(k)
