"""Removal of long repeated strings with run-length compressed suffix indexes.

Where a string of ``length`` bytes occurs twice, its least k-mer by hash, its *anchor*, does too. So
only text around anchors that occur again can repeat, and strings that are equal meet under one
anchor. Around each such anchor a document gives its *context*: all strings of ``length``
bytes that have it. Equal contexts collapse. The contexts of an anchor go to one block, and for
every block a run-length compressed Burrows-Wheeler transform is built, with suffix array samples
and common prefixes at the ends of its runs. Inside a run matches only lose their first
byte from one text position to the next, so the samples are enough to stream, over the
contexts, the matching statistics: how long a string that starts here also starts elsewhere. Where
that is ``length`` or more, the text is marked, and the marks go back to the documents.

An anchor with very many places (a passage a third of all documents hold) is split further,
by where in the string it stands and by a hash of the bytes that all such strings have around it;
equal strings agree in both. Blocks that are still too large are cut again, with smaller steps, down
to one offset: there a context is one string, equal ones collapse, and a block holds one context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.llm.common import slices, stored, take, texts_of

KMER = 32
PERIODS = 16
SLICE = 1 << 20
_GOLDEN = 0x9E3779B97F4A7C15
_FACTORS = tuple(np.uint64((_GOLDEN * (2 * i + 3) | 1) & (2**64 - 1)) for i in range(6))


@dataclass(frozen=True)
class RepeatRules:
    """Strings of ``length`` bytes; blocks of about ``block`` bytes; an anchor with over
    ``crowd`` places is split by offsets in steps of ``step``, and in smaller ones where the
    contexts of a block key exceed ``block``."""

    length: int = 200
    block: int = 1 << 20
    crowd: int = 2000
    step: int = 24


def kmer_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each k-mer its hash, and a sort key: periodic ones last, then by hash, then by place."""
    table = (np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN)) ^ np.uint64(0x5851F42D)
    table ^= table >> np.uint64(29)
    hashes, width, half = table[data], 1, None
    while width < KMER:
        hashes = hashes[:-width] * _FACTORS[width.bit_length() - 1] + hashes[width:]
        width *= 2
        if width == KMER // 2:
            half = hashes
    periodic = np.zeros(len(hashes), bool)
    for period in range(1, PERIODS + 1):
        periodic |= half[: len(hashes)] == half[period : period + len(hashes)]
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    keys = (mixed >> np.uint64(1)) & ~np.uint64(0xFFFFFFFF)
    keys |= periodic.astype(np.uint64) << np.uint64(63)
    keys |= np.arange(len(keys), dtype=np.uint64)
    return mixed, keys


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, hash, place, low, high): anchors, and the first and last start of the strings that
    have them, of texts that lie in ``data`` from ``offsets`` on."""
    span = length - KMER + 1
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none
    hashes, keys = kmer_keys(data)
    width = 1
    while width * 2 <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < span:
        keys = np.minimum(keys[: len(keys) - (span - width)], keys[span - width :])
    places = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(places))
    doc = np.searchsorted(offsets, starts, "right") - 1
    valid = starts + length <= offsets[doc + 1]
    starts, places, doc = starts[valid], places[valid], doc[valid]
    if not len(starts):
        return starts, hashes[:0], starts, starts, starts
    new = np.ones(len(starts), bool)
    new[1:] = (places[1:] != places[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return doc[first], hashes[places[first]], places[first], starts[first], starts[last]


def _anchor_rows(docs: DataFrame, rules: RepeatRules) -> DataFrame:
    """(anchor, doc_id, text_hash, times): the anchors of each document."""
    length = rules.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", SLICE):
            data, offsets = texts_of(piece.column("text"))
            doc, hashes, *_ = anchors(data, offsets, length)
            order = np.lexsort((hashes, doc))
            doc, hashes = doc[order], hashes[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(doc)))
            at = pa.array(doc[first])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[first].view(np.int64)),
                    piece.column("doc_id").take(at),
                    piece.column("text_hash").take(at),
                    pa.array(times, pa.int64()),
                ],
                ["anchor", "doc_id", "text_hash", "times"],
            )

    return docs.mapInArrow(
        run, "anchor bigint, doc_id bigint, text_hash bigint, times bigint"
    )


#: kind 0: a document; kind 1: a context, and where its anchor lies in it; kind 2: where a context
#: lies.
FOUND = (
    "kind int, doc_id bigint, text_hash bigint, n_bytes bigint, sha256 string, text string, "
    "block_key bigint, context binary, bytes binary, times bigint, low int"
)
_NAMES = [part.split()[0] for part in FOUND.split(", ")]
_KINDS = [
    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
    pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(),
]


def _rows(kind: int, size: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name, dtype in zip(_NAMES, _KINDS, strict=True):
        if name == "kind":
            arrays.append(pa.array(np.full(size, kind, np.int32)))
        elif name in columns:
            arrays.append(pa.array(columns[name], dtype))
        else:
            arrays.append(pa.nulls(size, dtype))
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _stretches(raw: bytes, place: int, low: int, high: int, step: int, rules: RepeatRules):
    """(salt, low, high) of the contexts of an anchor: one, or one for each ``step`` of offsets."""
    if not step:
        yield b"", low, high
        return
    for part in range((place - high) // step, (place - low) // step + 1):
        begin, end = max(low, place - part * step - step + 1), min(high, place - part * step)
        core = raw[place - part * step : place - part * step + rules.length - step + 1]
        yield part.to_bytes(2) + core, begin, end


def _block(key: int, salt: bytes) -> int:
    return key ^ xxhash.xxh64_intdigest(salt) >> 1 if salt else key


def _context_key(part: bytes, block: int) -> bytes:
    return xxhash.xxh3_128_digest(part, seed=block & (2**64 - 1))


def _contexts(docs: DataFrame, rules: RepeatRules) -> DataFrame:
    """The rows of FOUND for documents with the anchors they share (``shared``, ``crowded``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", SLICE):
            data, offsets = texts_of(piece.column("text"))
            ids, hashes_of = piece.column("doc_id"), piece.column("text_hash")
            shared = piece.column("shared").to_pylist()
            crowded = piece.column("crowded").to_pylist()
            known: dict[bytes, list] = {}
            docs_at, keys, lows = [], [], []
            clean, dirty = [], []
            raws = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            for i, raw in enumerate(raws):
                if not shared[i]:
                    clean.append(i)
                    continue
                dirty.append(i)
                mine = np.sort(np.array(shared[i], np.int64))
                crowds = set(crowded[i] or ())
                _, found, places, low, high = anchors(
                    np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), rules.length
                )
                found = found.view(np.int64)
                at = np.searchsorted(mine, found)
                held = mine[np.minimum(at, len(mine) - 1)] == found
                records = zip(*(x[held].tolist() for x in (found, places, low, high)), strict=True)
                for anchor, place, first, last in records:
                    step = rules.step if anchor in crowds else 0
                    for salt, a, b in _stretches(raw, place, first, last, step, rules):
                        part = raw[a : b + rules.length]
                        block = _block(anchor, salt)
                        key = _context_key(part, block)
                        entry = known.get(key)
                        if entry is None:
                            known[key] = [block, part, 1, place - a]
                        else:
                            entry[2] += 1
                        docs_at.append(i)
                        keys.append(key)
                        lows.append(a)
            yield _rows(
                0,
                len(clean),
                doc_id=ids.take(pa.array(clean, pa.int64())),
                n_bytes=[len(raws[i]) for i in clean],
                sha256=[hashlib.sha256(raws[i]).hexdigest() for i in clean],
            )
            at = pa.array(dirty, pa.int64())
            text = piece.column("text").take(at).cast(pa.string())
            yield _rows(
                0, len(dirty), doc_id=ids.take(at), text_hash=hashes_of.take(at), text=text
            )
            blocks, parts, times, offs = zip(*known.values(), strict=True) if known else ((),) * 4
            yield _rows(
                1,
                len(known),
                block_key=blocks,
                context=list(known),
                bytes=parts,
                times=times,
                low=offs,
            )
            at = pa.array(docs_at, pa.int64())
            yield _rows(
                2,
                len(keys),
                doc_id=ids.take(at),
                text_hash=hashes_of.take(at),
                context=keys,
                low=lows,
            )

    return docs.mapInArrow(run, FOUND)


class RunIndex:
    """A run-length compressed BWT of a block of texts, sampled at the ends of its runs.

    Texts end with signs of their own, so that no match reaches over an end. ``heads`` and
    ``starts`` are the runs; ``before`` and ``after`` the text places of the suffixes on both
    sides of each border between runs, and ``common`` how long their common prefix is.
    """

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) + 1 for t in texts])
        self.ends = np.cumsum(lengths)
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + len(texts)
        symbols[self.ends - 1] = np.arange(len(texts))
        order, levels = _suffixes(symbols, int(lengths.max()))
        column = symbols[order - 1]
        edges = np.flatnonzero(column[1:] != column[:-1]) + 1
        self.starts = np.concatenate([[0], edges])
        self.heads = column[self.starts]
        self.before, self.after = order[edges - 1], order[edges]
        self.common = _common_prefix(levels, self.before, self.after)

    def matching_statistics(self) -> np.ndarray:
        """For each text place, how long a string that starts there also starts elsewhere.

        Streams over the text: between samples a match that goes on loses a byte a place.
        """
        reach = np.zeros(int(self.ends[-1]), np.int64)
        np.maximum.at(reach, self.before, self.before + self.common)
        np.maximum.at(reach, self.after, self.after + self.common)
        places = np.arange(len(reach))
        return np.maximum(np.maximum.accumulate(reach) - places, 0)


def _suffixes(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list]:
    """The suffix array, and the ranks by prefixes of 1, 2, 4, ... symbols, by doubling."""
    n = len(symbols)
    levels = [(1, symbols.astype(np.int32))]
    ranks, width = symbols, 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - width] = ranks[width:] + 1
        keys = ranks * np.int64(max(n, int(ranks.max()) + 1) + 1) + later
        order = np.argsort(keys)
        ordered = keys[order]
        steps = np.zeros(n, np.int64)
        steps[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        ranks = np.empty(n, np.int64)
        ranks[order] = steps
        width *= 2
        if steps[-1] == n - 1 or width >= longest:
            return order, levels
        levels.append((width, ranks.astype(np.int32)))


def _common_prefix(levels: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefixes of pairs of different suffixes."""
    a, b = a.copy(), b.copy()
    total = np.zeros(len(a), np.int64)
    last = len(levels[0][1]) - 1
    for width, ranks in reversed(levels):
        same = ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)]
        while True:  # the widest level may fit more than once
            same &= (a <= last) & (b <= last)
            step = np.where(same, width, 0)
            total += step
            a += step
            b += step
            if width != levels[-1][0] or not same.any():
                break
            same &= ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)]
    return total


def repeated_parts(texts: list[bytes], copied: list[bool], length: int) -> list[list[list[int]]]:
    """For each text the stretches covered by strings of ``length`` bytes that occur elsewhere.

    ``copied`` texts stand for several equal ones, and are covered as a whole.
    """
    marks: list[list[list[int]]] = [[[0, len(t)]] if c else [] for t, c in zip(texts, copied, strict=True)]
    if len(texts) < 2:
        return marks
    index = RunIndex(texts)
    statistics = index.matching_statistics()
    long = np.flatnonzero(statistics >= length)
    if not len(long):
        return marks
    owner = np.searchsorted(index.ends, long, "right")
    new = np.ones(len(long), bool)
    stops = long + statistics[long]
    reach = np.maximum.accumulate(stops)
    new[1:] = (long[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(long)) - 1
    base = np.concatenate([[0], index.ends[:-1]])
    for text, a, b in zip(owner[first], long[first], reach[last], strict=True):
        if not copied[text]:
            marks[text].append([int(a - base[text]), int(b - base[text])])
    return marks


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The contexts of each block key: (context, bytes, times)."""
    group: list[tuple] = []
    previous = None
    for batch in batches:
        for block, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if group and block != previous:
                yield group
                group = []
            group.append(tuple(row))
            previous = block
    if group:
        yield group


def _indexed(waiting: list[tuple], rules: RepeatRules) -> list[tuple]:
    """(context, marks) by one index over all given contexts."""
    keys, texts, times = zip(*waiting, strict=True)
    marks = repeated_parts(list(texts), [n > 1 for n in times], rules.length)
    return [(k, m) for k, m in zip(keys, marks, strict=True) if m]


def _marks(contexts: DataFrame, rules: RepeatRules) -> DataFrame:
    """(context, marks) of contexts that hold a repeated string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.int32()))

        def marked(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.binary()), pa.array([m for _, m in rows], kind)],
                ["context", "marks"],
            )

        waiting: list[tuple] = []  # contexts that share their anchor with others
        alone: list[tuple] = []  # of these all places are alike
        size = 0
        for group in _groups(batches):
            if len(group) == 1:
                key, part, times = group[0]
                if times > 1:
                    alone.append((key, [[0, len(part)]]))
            else:
                waiting += group
                size += sum(len(part) for _, part, _ in group)
            if size >= rules.block:
                yield marked(_indexed(waiting, rules))
                waiting, size = [], 0
            if len(alone) > 10_000:
                yield marked(alone)
                alone = []
        yield marked(alone + (_indexed(waiting, rules) if waiting else []))

    dealt = contexts.repartition("block_key").sortWithinPartitions("block_key")
    return dealt.select("block_key", "context", "bytes", "times").mapInArrow(
        run, "context binary, marks array<array<int>>"
    )


def _cut(contexts: DataFrame, step: int, rules: RepeatRules) -> DataFrame:
    """Contexts cut by steps of offsets, each with the one it is from (``whole``, ``start``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "bytes", SLICE // 8):
            out = []
            rows = zip(*(piece.column(i).to_pylist() for i in range(5)), strict=True)
            for key, whole, raw, times, place in rows:
                last = len(raw) - rules.length
                for salt, a, b in _stretches(raw, place, 0, last, step, rules):
                    part, block = raw[a : b + rules.length], _block(key, salt)
                    out.append((block, _context_key(part, block), part, times, place - a, whole, a))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [
                pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int32(),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                ["block_key", "context", "bytes", "times", "low", "whole", "start"],
            )

    return contexts.select("block_key", "context", "bytes", "times", "low").mapInArrow(
        run,
        "block_key bigint, context binary, bytes binary, times bigint, low int, whole binary, "
        "start int",
    )


def _merged(parts: DataFrame) -> DataFrame:
    """Equal contexts as one."""
    return parts.groupBy("block_key", "context").agg(
        F.first("bytes").alias("bytes"), F.sum("times").alias("times"), F.first("low").alias("low")
    )


def _bounded_marks(parts: DataFrame, rules: RepeatRules, step: int | None = None) -> DataFrame:
    """(context, marks), where contexts of a key that exceed a block are cut by smaller steps.

    ``parts`` were cut by steps of ``step``, if given, else of ``rules.step`` or not at all. Rows
    are counted first, as if none were equal; only keys with many are looked at closely.
    """
    contexts = _merged(parts)
    if step == 1:
        return _marks(contexts, rules)
    most = max(1, rules.block // (2 * rules.length))
    many = parts.groupBy("block_key").agg(F.count("*").alias("n")).where(F.col("n") > most)
    many = stored(many.select("block_key"), "many")
    if many.isEmpty():
        return _marks(contexts, rules)
    close = parts.join(many, "block_key", "left_semi").select("block_key", "context", "bytes")
    sizes = (
        close.groupBy("block_key", "context")
        .agg(F.first(F.length("bytes")).alias("size"))
        .groupBy("block_key")
        .agg(F.sum("size").alias("size"))
    )
    large = stored(sizes.where(F.col("size") > rules.block).select("block_key"), "large")
    if large.isEmpty():
        return _marks(contexts, rules)
    fitting = _marks(_merged(parts.join(large, "block_key", "left_anti")), rules)
    smaller = max(1, (step or rules.step) // 4)
    cut = stored(
        _cut(_merged(parts.join(large, "block_key", "left_semi")), smaller, rules), "cut"
    )
    marks = stored(_bounded_marks(cut.drop("whole", "start"), rules, smaller), "cut_marks")
    moved = F.transform("marks", lambda m: F.array(m[0] + F.col("start"), m[1] + F.col("start")))
    joined = (
        cut.select("context", "whole", "start")
        .join(marks, "context")
        .select(F.col("whole").alias("context"), F.explode(moved).alias("mark"))
        .groupBy("context")
        .agg(F.collect_set("mark").alias("marks"))
    )
    return fitting.union(joined)


def _stripped(rows: DataFrame) -> DataFrame:
    """Documents without the bytes that their marks cover."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            out = []
            for text, marks in zip(
                piece.column("text").cast(pa.binary()).to_pylist(),
                piece.column("marks").to_pylist(),
                strict=True,
            ):
                spans: list[list[int]] = []
                for start, end in sorted(marks or ()):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                edges = [0, *(x for span in spans for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(text), len(text) - len(kept), len(spans), digest, kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)),
                ],
                names,
            )

    return rows.select("doc_id", "text", "marks").mapInArrow(
        run,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "kept binary",
    )


def remove_repeats(
    docs: DataFrame,
    rules: RepeatRules = RepeatRules(),
    with_kept: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` bytes.

    Every byte covered by a string of ``rules.length`` bytes that also starts elsewhere, in the
    same document or another, is removed; strings are judged on the input. Null text counts as
    empty. Rows that repeat are copies of each other, so long texts in them go whole. Null and
    shared ids are handled row by row; other columns are left out. ``kept`` is null where nothing
    was removed: the text is.
    """
    rows = take(docs, doc_id=id_column, text=text_column).withColumn(
        "text_hash", F.xxhash64("text")
    )
    found = stored(_anchor_rows(rows, rules), "anchors")
    shared = found.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1")
    crowded = F.when(F.col("n") > rules.crowd, F.col("anchor"))
    lists = (
        found.join(shared, "anchor")
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set("anchor").alias("shared"), F.collect_set(crowded).alias("crowded"))
    )
    same = rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["text_hash"] == F.col("_hash"))
    known = rows.join(lists, same, "left").select(
        "doc_id", "text_hash", "text", "shared", "crowded"
    )
    parts = stored(_contexts(known, rules), "contexts")
    contexts = parts.where("kind = 1").select("block_key", "context", "bytes", "times", "low")
    marks = stored(_bounded_marks(contexts, rules), "marks")
    spans = (
        parts.where("kind = 2")
        .select("doc_id", "text_hash", "context", "low")
        .join(marks, "context")
        .select(
            F.col("doc_id").alias("_id"),
            F.col("text_hash").alias("_hash"),
            F.explode(
                F.transform("marks", lambda m: F.array(m[0] + F.col("low"), m[1] + F.col("low")))
            ).alias("span"),
        )
        .groupBy("_id", "_hash")
        .agg(F.collect_set("span").alias("marks"))
    )
    touched = parts.where("kind = 0 AND text_hash IS NOT NULL")
    same = touched["doc_id"].eqNullSafe(F.col("_id")) & (touched["text_hash"] == F.col("_hash"))
    stripped = _stripped(touched.join(spans, same, "left").select("doc_id", "text", "marks"))
    zero = F.lit(0).cast("bigint")
    clean = parts.where("kind = 0 AND text_hash IS NULL").select(
        "doc_id",
        "n_bytes",
        zero.alias("n_removed"),
        zero.alias("n_spans"),
        F.col("sha256").alias("kept_sha256"),
        F.lit(None).cast("binary").alias("kept"),
    )
    result = clean.union(stripped)
    return result if with_kept else result.drop("kept")
