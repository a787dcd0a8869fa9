"""The parallel scan against the library, and the pipeline against its parts."""

import random
from pathlib import Path

import pytest

from publicspend.llm import pieces

pytestmark = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="no tokenizer file")
ALPHABETS = ["ab", "the", "etaoinshr", "aA1 .é日😀\n\t", "    x", "in g", "a", " "]


def scanned(model, text, chunk):
    """Encode by chunks, as the operator does."""
    escaped = pieces.SPACE + text.replace(" ", pieces.SPACE)
    n, margin = max(1, len(escaped) // chunk), model.longest
    parts, matrices = [], []
    for k in range(n):
        left, right = k * chunk, (k + 1) * chunk if k + 1 < n else len(escaped)
        start = max(0, left - margin)
        part = escaped[start : right + margin], left - start, right - start
        parts.append(part)
        matrices.append(pieces.transfer(model, *part, k == 0, k == n - 1))
    half = n // 2
    if half:
        split = [pieces.multiplied(matrices[:half]), pieces.multiplied(matrices[half:])]
        assert pieces.multiplied(split) == pieces.multiplied(matrices)
    path = pieces.states_between(matrices, (0, 0), (0, 0))
    ids = []
    for (part, left, right), begin, end in zip(parts, path[:-1], path[1:], strict=True):
        ids += model.plain(part[left + begin[1] : right + end[1]])
    return ids


def test_scan_agrees_with_the_library():
    model, rng = pieces.pieces(pieces.MODEL), random.Random(1)
    for _ in range(250):
        text = "".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randrange(1, 400)))
        assert scanned(model, text, rng.choice([40, 64, 100])) == model.whole([text])[0]
    for alphabet in ALPHABETS:
        text = "".join(rng.choice(alphabet) for _ in range(700))
        assert scanned(model, text, 50) == model.whole([text])[0]


def test_last_pieces_are_those_of_every_prefix():
    model, rng = pieces.pieces(pieces.MODEL), random.Random(2)
    for alphabet in ALPHABETS:
        text = "".join(rng.choice(alphabet) for _ in range(50)).replace(" ", pieces.SPACE)
        last = model.last_pieces(text, 0, len(text))
        assert last[1:] == [model.spans(text[:i])[-1] for i in range(1, len(text) + 1)]


@pytest.mark.parametrize("chunk", [60, 1 << 15])
def test_encode(spark, documents, awkward, no_documents, chunk):
    model = pieces.pieces(pieces.MODEL)
    found = pieces.encode(documents, chunk=chunk)
    rows = [(r.doc_id, tuple(r.ids), r.lossless) for r in found.collect()]
    expected = [(i, tuple(model.whole([t or ""])[0]), True) for i, t, _ in awkward]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    texts = [(r.doc_id, r.text) for r in pieces.decode(found).collect()]
    assert sorted(texts, key=repr) == sorted(((i, t or "") for i, t, _ in awkward), key=repr)
    assert pieces.encode(no_documents, chunk=chunk).count() == 0


def test_sign_for_space_is_not_lossless(spark):
    docs = spark.createDataFrame([(1, "a▁b"), (2, "a b")], "doc_id bigint, text string")
    assert {r.doc_id: r.lossless for r in pieces.encode(docs).collect()} == {1: False, 2: True}


def test_pipeline(spark, tiny):
    import corpus_pipeline

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.stored(stage(spark, docs, tiny), "test")
        assert docs.columns == columns
        if name != names[3]:
            assert 0 < docs.count() <= before
        if name == names[1]:
            from test_documents import components

            groups = components([(r.doc_id, r.text) for r in docs.collect()])
            assert all(doc_id == group for doc_id, _, group in groups)
    model = pieces.pieces(pieces.MODEL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert not any("@mail" in text for text in texts.values())
    rows = corpus_pipeline.run(spark, tiny).collect()
    assert len(rows) == docs.count()
    assert all(list(r.ids) == model.whole([texts[r.doc_id]])[0] for r in rows)


def test_pipeline_stages_on_awkward_rows(spark, documents, no_documents):
    import corpus_pipeline

    for docs in (documents.select("doc_id", "text", "lang", "source", "n_chars"), no_documents):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            assert out.count() <= 3 * docs.count()
