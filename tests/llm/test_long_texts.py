"""Very long texts and words through every operator, and the whole pipeline against its stages."""

import hashlib
import json
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quillspan.llm import common, hpylm, media, mixing, ngram_join, pieces, quality_rules, rule_ensemble, secrets, token_output, warc


@pytest.fixture(scope="module")
def texts():
    """A text of over a MB, one word of 0.5 MB, the same with an end of its own, and a copy of the first."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé"), rng.integers(2, 10))) for _ in range(3000)]
    long = " ".join(rng.choice(words, 200_000)) + "\nsecret=abcdefghijkl0123\n" + "é" * 50
    word = "".join(rng.choice(list("abcdefgh日"), 500_000))
    return [long, word, word + "x", long + " end", "short text", None]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2).cache()
    df.count()
    return df


def test_ids_of_long_texts(docs, texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path, uri = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/ids"
    tok = Tokenizer.from_file(path)
    segments = token_output.write_ids(docs, uri, path).cache()
    got = {r.doc_id: r for r in token_output.read_ids(segments, uri).collect()}
    for i, t in enumerate(texts):
        want = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(want), zlib.crc32(want.tobytes()))


def test_pieces_of_long_units(texts):
    m = pieces._model()
    part = texts[1][:30_000]
    data = np.frombuffer(part.encode(), np.uint8)
    assert pieces._alone(m, data) == pieces._lockstep(m, data, np.array([0]), np.array([len(data)]))[0]
    odd = np.frombuffer("▁▁ab\tcé日本 x▁".encode() * 40, np.uint8)
    assert pieces._alone(m, odd) == pieces._lockstep(m, odd, np.array([0]), np.array([len(odd)]))[0]


def test_pieces_of_long_texts(docs, texts):
    got = pieces.encode(docs, pieces._model(), keep=["doc_id"]).select("doc_id", "n_ids", "exact").collect()
    assert len(got) == len(texts) and all(r.exact for r in got)


def test_statistics_of_long_texts(docs, texts):
    got = {r.doc_id: r for r in quality_rules.with_statistics(docs, "text", ["doc_id"]).collect()}
    assert [got[i].n_words for i in range(6)] == [len((t or "").split()) for t in texts]
    assert got[1].word_chars == len(texts[1])
    assert quality_rules.judge(docs, quality_rules.fit(docs, least=2), keep=["doc_id"]).count() == 6
    assert rule_ensemble.score(docs, rule_ensemble.fit(np.zeros((0, 13)), np.zeros(0))).count() == 6


def test_links_of_long_texts(docs):
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.join(docs, count=True).collect()}
    assert got == {0: (0, 1), 1: (1, 0), 2: (2, 0), 3: (0, 1), 4: (4, 0), 5: (5, 0)}


def test_scores_of_long_texts(docs, texts):
    got = {r.doc_id: r for r in hpylm.score(docs).collect()}
    assert [got[i].n_tokens for i in range(6)] == [len((t or "").split()) + 1 for t in texts] and all(r.score < 0 for r in got.values())


def test_media_of_long_texts(docs, texts):
    listed, stored, chunks = media.store(docs)
    got = {r.doc_id: r for r in listed.join(media.read_back(stored, chunks), "key").collect()}
    assert all(got[i].payload_sha256 == hashlib.sha256(media.payload(t)).hexdigest() for i, t in enumerate(texts))
    assert chunks.count() > 100


def test_secrets_and_mix_of_long_texts(docs, texts):
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    start = texts[0].index("secret=")
    assert f"assign:{start}:{start + 23}" in got[0].spans.split(",")
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == {i: len((t or "").split()) for i, t in enumerate(texts)}


def test_archives_of_long_pages(spark, texts, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x.org/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    uri = f"file://{tmp_path}/warc"
    got = warc.lookup_all(warc.keys_of(pages), warc.archive(pages, uri), f"{uri}/index", f"{uri}/data").collect()
    assert {r.page_id: r.payload_digest for r in got} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}


def test_the_pipeline_chains_its_stages(spark, odd, tmp_path):
    """Every stage's own result on what the one before kept, decoded in the end; nothing but results stays behind."""
    import corpus_pipeline

    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(400)]
    clean = [" ".join(rng.choice(words, 80)) for _ in range(120)]
    more = [*clean, *(clean[:5]), *(" ".join(w + "&&&" for w in rng.choice(words, 80)) for _ in range(10)), clean[7] + " key Zk9Qw3Rt7Yb2Nm5Xc8Vf1 here", "few words", "", None]
    data = spark.createDataFrame([(i, t, "en", f"s{i % 3}") for i, t in enumerate(more)], "doc_id long, text string, lang string, source string")
    data.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs, texts = data, dict(enumerate(more))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
    kept = sorted((r.doc_id, r.text) for r in docs.collect())
    ids = {r.doc_id for r in docs.collect()}
    assert ids <= set(range(120)) | {135} and len(ids) > 60 and not ids & set(range(120, 135))
    m = pieces._model()
    back = pieces.decode_column(m, pa.array([r.ids for r in got]))
    assert sorted(zip([r.doc_id for r in got], back, strict=True)) == kept
    assert all(t == texts[d] or t == texts[d].replace("Zk9Qw3Rt7Yb2Nm5Xc8Vf1", "[generic]") for d, t in kept)
    assert json.dumps(sorted(ids))


def test_scratch_deletes_what_is_not_kept(spark):
    with common.scratch() as keep:
        a, b = (common.settle(spark.range(3), "scratch-test") for _ in range(2))
        keep.append(b)
    assert b.count() == 3
    with pytest.raises(Exception, match="(?i)not.*exist|no such file"):
        a.count()
