"""Pack documents into sequences: shortest pack first over the histogram of lengths.

Documents are turned into token ids once and stored. A document gives as many full sequences as it
fills; what is left over is shorter than a sequence and counts in a histogram of lengths, at most
one entry for each length. The histogram alone is packed: lengths are placed longest first, each
into the shortest pack with room for it, as many at once as the pattern of that pack occurs. A
pattern and the packs that share it are ranges: of sequence numbers, and of ranks among the
documents of a length. Documents may be cut, so the shortest packs are broken up at the end and
fill the gaps of the others; what remains is less than a sequence and is cut at powers of two.

Ranks are counted within each stored part and raised by the counts of the parts before. They find
their places in the ranges, and the ids are cut there.
"""

from __future__ import annotations

import json
import os
import re
import string
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from publicspend.llm.common import mapped, scratch, slices, take

MODEL = "/opt/tokenizers/word_bpe_49k.json"
TOKENIZED = (
    "part int, doc_id bigint, n bigint, rest int, rank bigint, full_before bigint, ids binary"
)
PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids binary"
)


@dataclass(frozen=True)
class PackRules:
    """``end`` closes every document; ``text_bytes`` of text are encoded at once, and a worker
    remembers ``words`` words of up to 100 characters."""

    model: str = MODEL
    capacity: int = 2048
    end: int = 1
    text_bytes: int = 4 << 20
    words: int = 400_000


# ---------------------------------------------------------------------------------------------
# Token ids


class Encoder:
    """Token ids of texts, word by word where the tokenizer drops white space.

    Words are remembered in two halves: when the newer one is full it becomes the older one, so
    frequent words stay.
    """

    def __init__(self, path: str, words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word, self.by_letters = splits_at_white_space(spec), maps_letters(spec)
        self.merges = self.model.model
        self.kind = np.dtype("<u4" if self.model.get_vocab_size() > 1 << 16 else "<u2")
        self.packed = [row.tobytes() for row in np.arange(self.model.get_vocab_size()).astype(self.kind)]
        self.half = max(1, words // 2)
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        texts = texts.fill_null("")
        if not self.by_word:
            found = self.model.encode_batch(texts.to_pylist(), add_special_tokens=False)
            sizes = np.array([len(e.ids) for e in found], np.int64)
            none = [np.zeros(0, self.kind)]
            return np.concatenate(none + [np.array(e.ids, self.kind) for e in found]), sizes
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        parts = self._of_words(_strings(coded.dictionary))
        ends = np.cumsum([0, *map(len, parts)]) // self.kind.itemsize
        ids = pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), self.kind))
        )
        each = ids.take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(each).to_numpy())])
        return each.flatten().to_numpy(), np.diff(ends[words.offsets.to_numpy()])

    def _of_words(self, words: list[str]) -> list[bytes]:
        found = list(map(self.newer.get, words))
        for place, ids in enumerate(found):
            if ids is None:
                found[place] = self._of_word(words[place])
        return found

    def _of_word(self, word: str) -> bytes:
        bare = word.rstrip(MARKS)
        if len(bare) < len(word) and bare and bare[-1].isalnum():
            # a run of marks after a letter or digit is a token of its own
            return self._known(bare) + self._known(word[len(bare) :])
        return self._known(word)

    def _known(self, word: str) -> bytes:
        ids = self.newer.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = self._ids(word)
            if len(word) <= 100:
                if len(self.newer) >= self.half:
                    self.older, self.newer = self.newer, {}
                self.newer[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        """Plain words go to the merges, the last step, by themselves."""
        if self.by_letters and word.isascii() and word.isprintable() and not OTHERS.intersection(word):
            return b"".join(map(self._merged, RUNS.findall(word.lower())))
        if self.by_letters and LETTERS.fullmatch(word):
            return self._merged(word.lower().encode().decode("latin-1").translate(SIGNS))
        return self._packed(self.model.encode(word, add_special_tokens=False).ids)

    def _merged(self, signs: str) -> bytes:
        return b"".join([self.packed[token.id] for token in self.merges.tokenize(signs)])

    def _packed(self, ids: list[int]) -> bytes:
        return b"".join([self.packed[i] for i in ids])


def _strings(words: pa.Array) -> list[str]:
    """Words, none of which holds a space, as one string that is split: faster than one by one."""
    if not len(words):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


def byte_signs() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it can be
    seen, else the next one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in seen]
    return {byte: chr(byte) for byte in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


SIGNS = byte_signs()
#: Signs that take part in added tokens or in the pattern's endings.
OTHERS = frozenset("'<|>")
MARKS = "".join(c for c in string.punctuation if c not in OTHERS)
RUNS = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")
#: Letters that no normal form changes and whose lower case is one letter.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def maps_letters(spec: dict) -> bool:
    """Whether runs of letters, single digits and runs of other signs go to the merges each by itself,
    in lower case and as byte signs, but for endings after an apostrophe."""
    if not splits_at_white_space(spec):
        return False
    steps = spec["normalizer"].get("normalizers", [])
    before = spec["pre_tokenizer"].get("pretokenizers", [])
    pattern = before[0]["pattern"]["Regex"].split("|")
    first = [part for part in pattern if not part.startswith("'")]
    return bool(
        any(step["type"] == "Lowercase" for step in steps)
        and first == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]
        and [step["type"] for step in before[1:]] == ["ByteLevel"]
        and not before[1]["use_regex"]
        and not before[1]["add_prefix_space"]
        and all(OTHERS.intersection(token["content"]) for token in spec.get("added_tokens", []))
        and spec["model"]["type"] == "BPE"
    )


def splits_at_white_space(spec: dict) -> bool:
    """Whether the ids of a text are those of its words one after another.

    That holds if the first step before the model keeps matches of a pattern only, the pattern
    matches no white space, the normaliser works character by character, and no added token holds
    or swallows white space.
    """
    normal, before = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [normal] if normal else [])
    first = before.get("pretokenizers", [before])[0]
    pattern = (first.get("pattern") or {}).get("Regex", r"\s")
    rewrites = [
        step
        for step in steps
        if step["type"] not in ("NFC", "Lowercase")
        and not (step["type"] == "Replace" and step["pattern"].get("Regex") == r"\s+")
    ]
    loose = [
        token
        for token in spec.get("added_tokens", [])
        if token["lstrip"] or token["rstrip"] or token["single_word"] or token["content"].split() != [token["content"]]
    ]
    keeps = first.get("type") == "Split" and first.get("behavior") == "Removed" and first["invert"]
    return bool(keeps and not rewrites and not loose and not regex.search(pattern, " \t\n\v\f\r"))


@lru_cache(maxsize=2)
def encoder(path: str, words: int) -> Encoder:
    """The tokenizer, loaded once in each worker."""
    return Encoder(path, words)


def tokenized(docs: DataFrame, rules: PackRules) -> DataFrame:
    """Each document's ids as little-endian unsigned numbers of 16 bits, 32 for large vocabularies.

    ``rank`` counts the documents before it in its part with the same number ``rest`` of ids beyond
    full sequences, ``full_before`` their full sequences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(rules.capacity, np.int64)
        full_so_far = 0
        model = encoder(rules.model, rules.words)
        kind = model.kind
        for piece in slices(batches, "text", rules.text_bytes):
            found, counts = model.encode(piece.column(1))
            n = counts.astype(np.int64) + 1
            ends = np.cumsum(n)
            ids = np.full(int(ends[-1]), rules.end, kind)
            inner = np.ones(len(ids), bool)
            inner[ends - 1] = False
            ids[inner] = found
            rest, full = n % rules.capacity, n // rules.capacity
            rank = seen[rest] + occurrence(rest)
            seen += np.bincount(rest, minlength=rules.capacity)
            before = full_so_far + np.cumsum(full) - full
            full_so_far += int(full.sum())
            offsets = np.concatenate([[0], ends]) * kind.itemsize
            binary = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                len(n),
                [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)],
            ).cast(pa.binary())
            columns = [
                pa.array(np.full(len(n), part, np.int32)),
                piece.column(0),
                pa.array(n),
                pa.array(rest.astype(np.int32)),
                pa.array(rank),
                pa.array(before),
                binary,
            ]
            names = [field.split()[0] for field in TOKENIZED.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, TOKENIZED)


def occurrence(values: np.ndarray) -> np.ndarray:
    """How many equal values come before each."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    places = np.arange(len(values))
    out = np.empty(len(values), np.int64)
    out[order] = places - np.maximum.accumulate(np.where(first, places, 0))
    return out


# ---------------------------------------------------------------------------------------------
# The plan, from the histogram alone

#: Of the documents whose rest is ``rest``, those from rank ``rank`` on, one for each pack of a
#: class, give ``length`` ids from ``start`` on.
Part = tuple[int, int, int, int]


@dataclass(frozen=True)
class Packs:
    """``count`` packs with the same pattern."""

    count: int
    parts: tuple[Part, ...]

    def split(self, k: int) -> tuple[Packs, Packs]:
        later = tuple((rest, rank + k, start, length) for rest, rank, start, length in self.parts)
        return Packs(k, self.parts), Packs(self.count - k, later)

    def with_part(self, part: Part) -> Packs:
        return Packs(self.count, (*self.parts, part))

    @property
    def used(self) -> int:
        return sum(length for *_, length in self.parts)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[Packs]:
    """Uncut rests in packs, by updating counts of patterns."""
    by_space: list[list[Packs]] = [[] for _ in range(capacity + 1)]
    most = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            while most and not by_space[most]:
                most -= 1
            if most >= length:
                packs = by_space[most].pop()
                if packs.count > left:
                    packs, others = packs.split(left)
                    by_space[most].append(others)
                by_space[most - length].append(packs.with_part((length, rank, 0, length)))
                rank += packs.count
                left -= packs.count
                continue
            copies = min(capacity // length, left)  # new packs, each filled with this length
            count = left // copies
            parts = tuple((length, rank + i * count, 0, length) for i in range(copies))
            space = capacity - copies * length
            by_space[space].append(Packs(count, parts))
            most = max(most, space)
            rank += copies * count
            left -= copies * count
    return [packs for same in by_space for packs in same]


def fill_gaps(packs: Iterable[Packs], capacity: int) -> list[Packs]:
    """Packs without padding: the shortest are broken up, and their parts cut to fill the others.

    As many are broken up as the gaps of the fullest need, so less than a pack is left at the end;
    it is cut at powers of two, which need no padding.
    """
    done, todo = [], []
    for same in packs:
        (done if _exact(same.used, capacity) else todo).append(same)
    todo.sort(key=lambda same: same.used, reverse=True)
    unfilled = deque(todo)
    loose: list[tuple[int, Part]] = []  # count and first part of each class of parts
    while unfilled:
        same = unfilled.popleft()
        gap = capacity - same.used
        if not loose:
            if unfilled:
                last = unfilled.pop()
                broken = min(last.count, -(-same.count * gap // last.used))
            else:
                last, same = same, None
                broken = -(-last.count * gap // capacity)
            taken, kept = last.split(broken)
            loose += [(taken.count, part) for part in taken.parts]
            if kept.count:
                unfilled.append(kept)
            if same:
                unfilled.appendleft(same)
            continue
        count, (rest, rank, start, length) = loose.pop()
        k, size = min(count, same.count), min(length, gap)
        filled, others = same.split(k)
        if others.count:
            unfilled.appendleft(others)
        if count > k:
            loose.append((count - k, (rest, rank + k, start, length)))
        if length > size:
            loose.append((k, (rest, rank, start + size, length - size)))
        filled = filled.with_part((rest, rank, start, size))
        (done.append if size == gap else unfilled.appendleft)(filled)
    remaining = [
        (rest, rank + i, start, length)
        for count, (rest, rank, start, length) in loose
        for i in range(count)
    ]
    return done + [Packs(1, parts) for parts in _powers(remaining)]


def _exact(used: int, capacity: int) -> bool:
    return used == capacity or used & (used - 1) == 0


def _powers(parts: list[Part]) -> Iterator[tuple[Part, ...]]:
    """The parts in a row, cut into stretches whose lengths are powers of two."""
    queue = deque(parts)
    total = sum(length for *_, length in parts)
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        stretch = []
        while size:
            rest, rank, start, length = queue.popleft()
            if length > size:
                queue.appendleft((rest, rank, start + size, length - size))
                length = size
            stretch.append((rest, rank, start, length))
            size -= length
        yield tuple(stretch)


class Plan:
    """Where the rests go: ranges of ranks, found by length, start and rank."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        rows, sequence = [], 0
        for same in fill_gaps(shortest_pack_first(histogram, capacity), capacity):
            offset = 0
            for rest, rank, start, length in same.parts:
                rows.append((rest * capacity + start, rank, length, sequence, offset))
                offset += length
            sequence += same.count
        self.sequences, self.capacity = sequence, capacity
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.codes = np.unique(table[:, 0])
        code = np.searchsorted(self.codes, table[:, 0])
        self.keys = (code << 40) + table[:, 1]
        self.rank, self.length, self.sequence, self.offset = table[:, 1:].T.copy()

    def places(self, rest: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(document, start, length, sequence, offset) of first parts, then of second ones, ..."""
        which = np.flatnonzero(rest)
        start = np.zeros(len(which), np.int64)
        while len(which):
            code = np.searchsorted(self.codes, rest[which] * self.capacity + start)
            at = np.searchsorted(self.keys, (code << 40) + rank[which], "right") - 1
            length = self.length[at]
            yield which, start, length, self.sequence[at] + rank[which] - self.rank[at], self.offset[at]
            more = start + length < rest[which]
            which, start = which[more], (start + length)[more]


# ---------------------------------------------------------------------------------------------
# The operator


def pack(
    docs: DataFrame,
    rules: PackRules = PackRules(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and ``ids``, its token ids as little-endian unsigned 32-bit numbers.

    A document's pieces cover its ids, with ``rules.end`` at the end, without gap or overlap. Every
    sequence is full but for some, a power of two long each, that hold less than one together.
    Null and empty texts have the end alone. Repeated rows and rows that share an id, or have none,
    are documents of their own, so pieces of such rows can not be told apart by id; other columns
    are left out; an empty table gives an empty result.

    The ids are stored once, in 2 or 4 bytes each. The driver sees one number for each length below
    ``rules.capacity``; what goes back to the tasks grows with the number of patterns, which the
    lengths bound, not with the corpus. Sequence numbers depend on how the input is split into
    tasks; one stored table read alike gives the same numbers again.
    """
    spark = docs.sparkSession
    rows = take(docs, doc_id=id_column, text=text_column)
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    path = scratch(spark, "tokenized")
    tokenized(rows, rules).write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(TOKENIZED).parquet(path)
    counted = stored.groupBy("part", "rest").agg(
        F.count("*").alias("n_docs"), F.sum(F.expr(f"n div {rules.capacity}")).alias("n_full")
    )
    # one row for each part and length, each column a sum over the parts before
    full = counted.groupBy("part").agg(F.sum("n_full").alias("n_full"))
    full = full.select(
        F.col("part").alias("full_part"),
        (F.sum("n_full").over(Window.orderBy("part")) - F.col("n_full")).alias("full_base"),
    )
    earlier = F.sum("n_docs").over(Window.partitionBy("rest").orderBy("part")) - F.col("n_docs")
    bases = counted.select(
        F.col("part").alias("base_part"), F.col("rest").alias("base_rest"), earlier.alias("base")
    ).join(full, F.col("base_part") == F.col("full_part"))
    histogram = counted.where("rest > 0").groupBy("rest").agg(F.sum("n_docs").alias("n_docs"))
    plan = Plan({row.rest: row.n_docs for row in histogram.collect()}, rules.capacity)
    ranked = stored.join(
        bases, (F.col("part") == F.col("base_part")) & (F.col("rest") == F.col("base_rest"))
    ).select(
        "doc_id",
        "n",
        "rest",
        (F.col("rank") + F.col("base")).alias("rank"),
        (F.col("full_before") + F.col("full_base") + F.lit(plan.sequences)).alias("full_from"),
        "ids",
    )
    return mapped(ranked, "ids", PIECES, _cutter(plan, rules))


def _cutter(plan: Plan, rules: PackRules):
    capacity = rules.capacity

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, rest, rank, full_from = (batch.column(i).to_numpy() for i in range(1, 5))
        full = n // capacity
        doc = np.repeat(np.arange(len(n)), full)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
        size = np.full(len(doc), capacity)
        found = [(doc, turn * capacity, size, full_from[doc] + turn, size * 0)]
        for which, start, length, sequence, offset in plan.places(rest.astype(np.int64), rank):
            found.append((which, full[which] * capacity + start, length, sequence, offset))
        doc, start, length, sequence, offset = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((start, doc))
        doc, start, length = doc[order], start[order], length[order]
        # pieces in this order cover the ids of all documents from end to end
        data = b"".join(batch.column(5).to_pylist())
        wide = len(data) > 2 * int(n.sum())
        ids = np.frombuffer(data, "<u4" if wide else "<u2").astype("<u4")
        ends = np.concatenate([[0], np.cumsum(length)]) * 4
        binary = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids)]
        ).cast(pa.binary())
        columns = [
            batch.column(0).take(pa.array(doc)),
            pa.array(start),
            pa.array(length),
            pa.array(n[doc]),
            pa.array(sequence[order]),
            pa.array(offset[order]),
            binary,
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PIECES.split(", ")])

    return run


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids``: the pieces of each sequence in their order."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    gathered = pieces.groupBy("sequence_id").agg(inside.alias("inside"))
    joined = F.aggregate("inside", F.unhex(F.lit("")), lambda all, one: F.concat(all, one["ids"]))
    return gathered.select(
        "sequence_id",
        (F.octet_length(joined) / 4).cast("bigint").alias("length"),
        F.transform("inside", lambda one: one["doc_id"]).alias("doc_ids"),
        joined.alias("ids"),
    )


def digest(pieces: DataFrame) -> DataFrame:
    """A checksum in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
