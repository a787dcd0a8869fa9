"""Packing: every id once, no padding, and ids as the tokenizer gives them for whole texts."""

import json
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from publicspend.llm import packing
from publicspend.llm.packing import PackRules, Plan, fill_gaps, shortest_pack_first


MODEL = Tokenizer.from_file(packing.MODEL)


def whole(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(rows, texts, capacity):
    """``rows`` of (doc_id, start, length, doc_tokens, sequence_id, offset, ids)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc_id, start, length, n, sequence, offset, ids in rows:
        found = np.frombuffer(bytes(ids), "<u4").tolist()
        assert len(found) == length > 0 and n == len(texts[doc_id])
        by_doc[doc_id].append((start, found))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        place, joined = 0, []
        for start, found in sorted(pieces):
            assert start == place
            place += len(found)
            joined += found
        assert joined == texts[doc_id]
    padding = 0
    for pieces in by_sequence.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place
            place += length
        assert place <= capacity
        padding += 0 if place & (place - 1) == 0 else capacity - place
    return padding, len(by_sequence)


def test_pieces_of_awkward_texts(spark, awkward):
    rows = [(i, text, source) for i, (_, text, source) in enumerate(awkward)]
    rng = random.Random(2)
    odd = "<|endoftext|> \t\n\v\f\r\x1c\x85　 éİΣſ'S 's日本😀á ́#9"
    rows += [(100 + i, "".join(rng.choices(odd, k=200)), None) for i in range(60)]
    rows += [(200, "x<|endoftext|>y <|startoftext|>", "a")]
    rows += [(300 + i, "w" * (i % 7), "same") for i in range(300)]
    docs = spark.createDataFrame(
        [(s, i, t, "z") for i, t, s in rows], "ids string, doc_id bigint, text string, rest string"
    ).repartition(5)
    texts = {i: whole(text) for i, text, _ in rows}
    for rules in (PackRules(), PackRules(capacity=64, text_bytes=500, words=50)):
        pieces = packing.pack(docs, rules).collect()
        padding, n = check_pieces([tuple(p) for p in pieces], texts, rules.capacity)
        assert padding == 0
        assert n <= sum(map(len, texts.values())) // rules.capacity + 12


def test_shared_ids_null_ids_and_empty_table(spark):
    rows = [(None, "a b c"), (None, None), (7, "a b c"), (7, "a b c"), (7, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pieces = packing.pack(docs)
    assert pieces.groupBy("doc_id").agg({"length": "sum"}).count() == 2
    assert sum(p.length for p in pieces.collect()) == 4 * 3 + 1 + 2
    joined = packing.sequences(pieces).collect()
    assert sorted(s.length for s in joined) == [1, 2, 4, 8]
    assert all(len(s.ids) == 4 * s.length for s in joined)
    assert packing.pack(docs.limit(0)).collect() == []


def test_word_by_word_is_the_whole_text():
    spec = json.load(open(packing.MODEL, encoding="utf-8"))
    assert packing.splits_at_white_space(spec) and packing.maps_letters(spec)
    other = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    assert not packing.splits_at_white_space(other)
    rng = random.Random(8)
    every = [chr(c) for c in range(0x250)] + list("ΑΣσς\u0307\u0331\u0301日本😀ſKﬁ١Ⅷ²")
    common = list("abcdeABCDEéÉüßÀ.,;:!?'<|>019- \n")
    texts = ["".join(rng.choices(rng.choice([every, common]), k=60)) for _ in range(3000)]
    texts += ["H\u0331.", "I\u0307,", "<|ENDOFTEXT|>", "a<|endoftext|>.", "it's. he'LL?!", "", "x" * 500]
    model = packing.Encoder(packing.MODEL, 30)
    ids, sizes = model.encode(pa.array(texts))
    ends = np.cumsum(sizes)
    for text, start, end in zip(texts, ends - sizes, ends, strict=True):
        assert ids[start:end].tolist() == whole(text)[:-1], repr(text)


def test_tokenizer_that_keeps_white_space(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    texts = {1: " a  b\n", 2: "", 3: "Hello, world! " * 50}
    rules = PackRules(model=path, capacity=32, end=7)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    pieces = [tuple(p) for p in packing.pack(docs, rules).collect()]
    wanted = {i: model.encode(t, add_special_tokens=False).ids + [7] for i, t in texts.items()}
    assert check_pieces(pieces, wanted, 32)[0] == 0


@pytest.mark.parametrize("seed", range(12))
def test_plan_covers_every_rest_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([4, 16, 33, 100, 2048])
    lengths = range(1, capacity)
    some = rng.sample(lengths, rng.randrange(1, min(len(lengths), 200)))
    histogram = {length: rng.choice([1, 2, 17, 1000]) for length in some}
    packs = shortest_pack_first(histogram, capacity)
    assert all(same.used <= capacity for same in packs)
    uncut = defaultdict(int)
    for same in packs:
        for rest, _, start, length in same.parts:
            assert start == 0 and length == rest
            uncut[rest] += same.count
    assert uncut == histogram
    for same in fill_gaps(packs, capacity):
        assert same.used == capacity or same.used & (same.used - 1) == 0
    plan = Plan(histogram, capacity)
    rest = np.repeat(list(histogram), list(histogram.values()))
    rank = np.concatenate([np.arange(n) for n in histogram.values()])
    covered = np.zeros(len(rest), np.int64)
    used = defaultdict(list)
    for which, start, length, sequence, offset in plan.places(rest, rank):
        assert (covered[which] == start).all()
        covered[which] += length
        for q, o, size in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True):
            used[q].append((o, size))
    assert (covered == rest).all() and len(used) == plan.sequences
    for parts in used.values():
        place = 0
        for offset, size in sorted(parts):
            assert offset == place
            place += size
    total = sum(length * n for length, n in histogram.items())
    assert plan.sequences <= total // capacity + capacity.bit_length()


def test_equal_lengths_share_packs():
    packs = shortest_pack_first({512: 10}, 2048)
    assert sorted((same.count, len(same.parts)) for same in packs) == [(1, 2), (2, 4)]
