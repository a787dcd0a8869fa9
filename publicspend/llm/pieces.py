"""SentencePiece encoding and decoding, with a parallel scan over the chunks of giant texts.

The encoding of a text is the one path through the lattice of its pieces that the merges admit;
as weights of a max-plus lattice, steps the merges admit weigh 0 and all others minus infinity.
Two facts make it local. If the path has borders at p and q, its part between them is the
encoding of that stretch alone. And a path is admitted if and only if each two pieces that touch
are the encoding of their concatenation.

A giant text is cut into chunks. The state at a cut is the piece that reaches up to it or across
it. Each chunk yields its transfer matrix from states at its left cut to states at its right cut,
as the list of its finite entries. Matrices multiply associatively: products of runs of
chunks first, a scan over those, then back into each run. That gives every chunk its borders, and
each is encoded by itself.

Where no piece of the vocabulary holds two neighbouring characters, every path has a border. With
such a place inside a chunk the matrix has rank one, as in all text with spaces: what enters and
what leaves do not depend on each other, and both are found within a word of the cuts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.llm.common import mapped, release, slices, stored, take

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 15
RUN = 64
SPACE = "▁"

State = tuple[int, int]
Matrix = list[tuple[State, State]]


class Pieces:
    """A byte-pair model: whole encodings by the library, and what the lattice needs."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        special = (self.model.is_control, self.model.is_unknown, self.model.is_byte)
        normal = [i for i in range(size) if not any(kind(i) for kind in special)]
        texts = [self.model.id_to_piece(i) for i in normal]
        self.vocabulary = frozenset(texts)
        self.longest = max(map(len, texts))
        self.inside = frozenset(t[i : i + 2] for t in texts for i in range(len(t) - 1))
        characters = {c for t in texts for c in t}
        self.apart = next(c for c in map(chr, range(10, 0x10000)) if c not in characters)
        self.lead = len(self.model.encode(self.apart))
        self.alone: dict[str, bool] = {}
        self.compatible: dict[tuple[str, str], bool] = {}
        if self.model.encode("ﬁ  x") != self.model.encode("ﬁ") + self.model.encode(" x"):
            raise ValueError("a model that rewrites its text is not supported")

    def whole(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)

    def plain(self, stretch: str) -> list[int]:
        """The encoding of a stretch of escaped text, without the space that starts a text.

        A character that is in no piece stands before it; nothing merges with that.
        """
        return self.model.encode(self.apart + stretch.replace(SPACE, " "))[self.lead :]

    def spans(self, stretch: str) -> list[int]:
        """The lengths in characters of the pieces of a stretch; a character in bytes is one."""
        lengths, place, left = [], 0, 0
        for i in self.plain(stretch):
            if self.model.is_byte(i):
                if not left:
                    left = len(stretch[place].encode())
                    lengths.append(1)
                    place += 1
                left -= 1
            else:
                lengths.append(len(self.model.id_to_piece(i)))
                place += lengths[-1]
        return lengths

    def border(self, text: str, place: int) -> bool:
        return text[place - 1 : place + 1] not in self.inside

    def touch(self, left: str, right: str) -> bool:
        """Whether the two pieces are the encoding of their concatenation."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 1_000_000:
                self.compatible.clear()
            known = self.spans(left + right) == [len(left), len(right)]
            self.compatible[left, right] = known
        return known

    def last_pieces(self, text: str, start: int, end: int) -> list[int]:
        """For each place, the length of the last piece of the encoding of ``text[start:place]``."""
        last = [0] * (end - start + 1)
        for place in range(start + 1, end + 1):
            for length in range(1, min(self.longest, place - start) + 1):
                piece = text[place - length : place]
                if length > 1 and not self.stands(piece):
                    continue
                before = place - length
                if before == start or self.touch(
                    text[before - last[before - start] : before], piece
                ):
                    last[place - start] = length
                    break
        return last

    def stands(self, piece: str) -> bool:
        """Whether the piece is in the vocabulary and its own encoding."""
        if piece not in self.vocabulary:
            return False
        if piece not in self.alone:
            self.alone[piece] = self.spans(piece) == [len(piece)]
        return self.alone[piece]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The model, loaded once in each worker."""
    return Pieces(path)


def transfer(model: Pieces, text: str, left: int, right: int, first: bool, last: bool) -> Matrix:
    """The finite entries of a chunk's matrix, for its cuts at ``left`` and ``right`` of ``text``.

    ``text`` goes on for the longest piece on both sides, or to where the whole text ends. A state
    is (start, end) of the piece that starts before the cut and ends at it or after it, relative
    to the cut. At the ends of the whole text there is one state, (0, 0).
    """
    reach = model.longest
    places = [p for p in range(left + reach, right - reach + 1) if model.border(text, p)][:1]
    starts = [left] if first else range(max(0, left - reach), left)
    ends = [right] if last else range(right, min(len(text), right + reach - 1) + 1)
    if places:
        head = places[0]
        tail = next(p for p in range(right - reach, head - 1, -1) if model.border(text, p))
        entries = []
        for start in starts:
            span = model.spans(text[start:head])
            if first or start + span[0] >= left:
                entries.append((0, 0) if first else (start - left, start + span[0] - left))
        exits = []
        for end in ends:
            span = model.spans(text[tail:end])
            if last or end - span[-1] < right:
                exits.append((0, 0) if last else (end - span[-1] - right, end - right))
        return [(a, b) for a in entries for b in exits]
    matrix = []
    for start in starts:
        final = model.last_pieces(text, start, max(ends))
        for end in ends:
            size, place = final[end - start], end
            if not size or not (last or end - size < right):
                continue
            leaving = (0, 0) if last else (end - size - right, end - right)
            while place - final[place - start] > start:
                place -= final[place - start]
            if first or place >= left:
                matrix.append(((0, 0) if first else (start - left, place - left), leaving))
    return matrix


def multiplied(matrices: Sequence[Matrix]) -> Matrix:
    """The max-plus product of matrices whose finite entries are all 0."""
    product = matrices[0]
    for matrix in matrices[1:]:
        onward: dict[State, list[State]] = {}
        for entry, leaving in matrix:
            onward.setdefault(entry, []).append(leaving)
        product = sorted({(a, c) for a, b in product for c in onward.get(b, ())})
    return product


def states_between(matrices: Sequence[Matrix], entry: State, leaving: State) -> list[State]:
    """The states at all cuts of the path from ``entry`` to ``leaving``, both included."""
    came: list[dict[State, State]] = []
    reached = {entry}
    for matrix in matrices:
        step = {b: a for a, b in matrix if a in reached}
        came.append(step)
        reached = set(step)
    path = [leaving]
    for step in reversed(came):
        path.append(step[path[-1]])
    return path[::-1]


def _packed(matrix: Matrix) -> np.ndarray:
    return np.array([[*a, *b] for a, b in matrix], np.int16).reshape(-1, 4)


def _unpacked(data: bytes) -> Matrix:
    rows = np.frombuffer(data, np.int16).reshape(-1, 4).tolist()
    return [((a, b), (c, d)) for a, b, c, d in rows]


def _chunks(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    """(row, doc_id, text_hash, k, n, left, right, part): chunks with a margin on both sides.

    The last chunk takes what is too short for a chunk of its own.
    """
    names = ["row", "doc_id", "text_hash", "k", "n", "left", "right", "part"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        margin = pieces(path).longest
        rows: list[tuple] = []
        for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            escaped = SPACE + text.replace(" ", SPACE)
            n = max(1, len(escaped) // chunk)
            hashed = xxhash.xxh3_128_digest(text.encode())
            for k in range(n):
                left, right = k * chunk, (k + 1) * chunk if k + 1 < n else len(escaped)
                start = max(0, left - margin)
                part = escaped[start : right + margin]
                rows.append((row, doc_id, hashed, k, n, left - start, right - start, part))
        kinds = [pa.int64()] * 2 + [pa.binary()] + [pa.int32()] * 4 + [pa.string()]
        columns = list(zip(*rows, strict=True)) or [()] * 8
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
        )

    schema = (
        "row bigint, doc_id bigint, text_hash binary, k int, n int, left int, right int, part string"
    )
    return mapped(docs, "text", schema, run)


def _matrices(chunks: DataFrame, path: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = pieces(path)
        found = [
            _packed(transfer(model, part, left, right, k == 0, k == n - 1)).tobytes()
            for k, n, left, right, part in zip(
                *(batch.column(i).to_pylist() for i in range(1, 6)), strict=True
            )
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["row", "k", "matrix"]
        )

    chosen = chunks.select("row", "k", "n", "left", "right", "part")
    return mapped(chosen, "part", "row bigint, k int, matrix binary", run)


def _product(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("k")
    product = _packed(multiplied([_unpacked(m) for m in rows["matrix"]])).tobytes()
    return pd.DataFrame(
        {"row": rows["row"].iloc[:1], "run": [rows["k"].iloc[0] // RUN], "matrix": [product]}
    )


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("run")
    path = states_between([_unpacked(m) for m in rows["matrix"]], (0, 0), (0, 0))
    return pd.DataFrame(
        {
            "row": rows["row"],
            "run": rows["run"],
            "entry": [list(s) for s in path[:-1]],
            "leaving": [list(s) for s in path[1:]],
        }
    )


def _borders(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("k")
    entry, leaving = tuple(rows["entry"].iloc[0]), tuple(rows["leaving"].iloc[0])
    path = states_between([_unpacked(m) for m in rows["matrix"]], entry, leaving)
    return pd.DataFrame(
        {
            "row": rows["row"],
            "k": rows["k"],
            "begin": [s[1] for s in path[:-1]],
            "end": [s[1] for s in path[1:]],
        }
    )


def _encoded_chunks(chunks: DataFrame, path: str) -> DataFrame:
    matrices = stored(_matrices(chunks, path), "matrices").withColumn(
        "run", F.expr(f"k div {RUN}").cast("int")
    )
    products = matrices.groupBy("row", "run").applyInPandas(
        _product, "row bigint, run int, matrix binary"
    )
    scanned = products.groupBy("row").applyInPandas(
        _scan, "row bigint, run int, entry array<int>, leaving array<int>"
    )
    borders = (
        matrices.join(scanned, ["row", "run"])
        .groupBy("row", "run")
        .applyInPandas(_borders, "row bigint, k int, begin int, end int")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = pieces(path)
        ids = [
            model.plain(part[left + begin : right + end])
            for left, right, begin, end, part in zip(
                *(batch.column(i).to_pylist() for i in range(4, 9)), strict=True
            )
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(4)] + [pa.array(ids, pa.list_(pa.int32()))],
            ["row", "doc_id", "text_hash", "k", "ids"],
        )

    met = chunks.join(borders, ["row", "k"]).select(
        "row", "doc_id", "text_hash", "k", "left", "right", "begin", "end", "part"
    )
    encoded = mapped(
        met, "part", "row bigint, doc_id bigint, text_hash binary, k int, ids array<int>", run
    )
    parts = encoded.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_hash").alias("text_hash"),
        F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"),
    )
    return parts.select("doc_id", "text_hash", F.flatten(F.col("parts.ids")).alias("ids"))


def _checked(encoded: DataFrame, path: str) -> DataFrame:
    """With ``lossless``: whether decoding gives the text whose hash is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # giant ones, one at a time
                row = batch.slice(i, 1)
                text = pieces(path).model.decode(row.column(2)[0].as_py())
                same = xxhash.xxh3_128_digest(text.encode()) == row.column(1)[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [row.column(0), row.column(2), pa.array([same])], ["doc_id", "ids", "lossless"]
                )

    return encoded.select("doc_id", "text_hash", "ids").mapInArrow(run, ENCODED)


#: Text that is encoded at once.
ENCODED_BYTES = 1 << 19
ENCODED = "doc_id bigint, ids array<int>, lossless boolean"


def encode(
    docs: DataFrame,
    path: str = MODEL,
    chunk: int = CHUNK,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``ids`` and ``lossless``, one row for each document.

    ``ids`` are those of the library for the whole text, at every length; texts of two chunks or
    more are scanned in parallel. Null and empty texts have no ids. ``lossless`` tells whether
    decoding restores the text, which fails only for texts that hold the model's own sign for a
    space. Repeated rows, null ids and shared ids are handled row by row; other columns are left
    out. ``path`` must name the model on every executor.
    """
    rows = take(docs, doc_id=id_column, text=text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = pieces(path)
        for batch in batches:
            # ids are lists of Python numbers, many times the size of their text
            for piece in slices([batch], "text", ENCODED_BYTES):
                texts = [text or "" for text in piece.column(1).to_pylist()]
                ids = model.whole(texts)
                same = [a == b for a, b in zip(model.model.decode(ids), texts, strict=True)] if ids else []
                columns = [piece.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
                del texts, ids
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "lossless"])
            release()

    giant = F.coalesce(F.length("text"), F.lit(0)) >= 2 * chunk
    short = rows.where(~giant).mapInArrow(run, ENCODED)
    numbered = rows.where(giant).withColumn("row", F.monotonically_increasing_id())
    chunks = stored(_chunks(numbered.select("row", "doc_id", "text"), path, chunk), "chunks")
    return short.union(_checked(_encoded_chunks(chunks, path), path))


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id`` and ``text`` for rows of ``doc_id`` and ``ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [found or [] for found in batch.column(1).to_pylist()]
            texts = pieces(path).model.decode(ids) if ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return take(encoded, doc_id="doc_id", ids="ids").mapInArrow(run, "doc_id bigint, text string")
