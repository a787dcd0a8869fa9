"""Fill-in-the-middle: texts cut at two unit borders and written in another order.

A text is seen as UTF-8 bytes in blocks of fixed size. Each block counts the units that end in it
and the code points that start in it, and a Fenwick tree over the blocks holds both counts. The
border after k units is found by binary lifting: a descent finds the block it lies in, with the
units and code points before that block, and the border is then looked up inside the block alone.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from publicspend.llm.common import mapped, take, texts_of

PLAIN, PSM, SPM = "plain", "psm", "spm"
CUTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@dataclass(frozen=True)
class MiddleRules:
    """``percent`` of the texts are cut, of these ``spm_percent`` with the suffix first.

    ``marks`` come before prefix, suffix and middle; none may be the start of another's end, as
    with names in angle brackets. ``block`` is the size of a block in bytes.
    """

    seed: int = 7
    percent: int = 100
    spm_percent: int = 50
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    block: int = 4096

    def draws(self, doc_id: int | None) -> list[int]:
        """Four numbers of 32 bits that depend on the seed and the id alone; a null id is empty."""
        name = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digits = hashlib.sha256(name.encode()).hexdigest()
        return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


class BlockCounts:
    """Fenwick trees of units (lines) and code points over the blocks of one text."""

    def __init__(self, data: np.ndarray, block: int):
        self.data, self.block = data, block
        starts = np.arange(0, max(1, len(data)), block)
        self.blocks = len(starts) if len(data) else 0
        self.top = 1 << max(0, self.blocks.bit_length() - 1)
        self.units = self._tree(data == 10, starts)
        self.points = self._tree((data & 0xC0) != 0x80, starts)
        breaks = self._upto(self.units, self.blocks)
        self.open = bool(len(data)) and data[-1] != 10
        self.n = breaks + self.open

    @staticmethod
    def _tree(flags: np.ndarray, starts: np.ndarray) -> list[int]:
        """Place i sums the blocks after ``i - (i & -i)`` up to i."""
        if not len(flags):
            return [0]
        sums = np.concatenate([[0], np.cumsum(np.add.reduceat(flags, starts, dtype=np.int64))])
        places = np.arange(len(sums))
        return (sums - sums[places - (places & -places)]).tolist()

    @staticmethod
    def _upto(tree: list[int], place: int) -> int:
        total = 0
        while place:
            total += tree[place]
            place -= place & -place
        return total

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` units."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return len(self.data), self._upto(self.points, self.blocks)
        place, left, points, step = 0, k, 0, self.top
        while step:
            if place + step <= self.blocks and self.units[place + step] < left:
                place += step
                left -= self.units[place]
                points += self.points[place]
            step >>= 1
        inside = self.data[place * self.block : (place + 1) * self.block]
        end = int(np.flatnonzero(inside == 10)[left - 1]) + 1
        points += int(np.count_nonzero((inside[:end] & 0xC0) != 0x80))
        return place * self.block + end, points


def transform(raw: bytes, doc_id: int | None, rules: MiddleRules) -> tuple:
    """Number of units, form, code points of prefix and middle, and the output, of one text."""
    counts = BlockCounts(np.frombuffer(raw, np.uint8), rules.block)
    first, second, drawn, order = rules.draws(doc_id)
    marks = [mark.encode() for mark in rules.marks]
    if not raw or drawn % 100 >= rules.percent or any(mark in raw for mark in marks):
        return counts.n, PLAIN, None, None, raw
    low, high = sorted((first % (counts.n + 1), second % (counts.n + 1)))
    (begin, before), (end, upto) = counts.cut(low), counts.cut(high)
    prefix = marks[0] + raw[:begin]
    suffix = marks[1] + raw[end:]
    middle = marks[2] + raw[begin:end]
    spm = order % 100 < rules.spm_percent
    output = suffix + prefix + middle if spm else prefix + suffix + middle
    return counts.n, SPM if spm else PSM, before, upto - before, output


def fill_in_middle(
    docs: DataFrame,
    rules: MiddleRules = MiddleRules(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, units ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Units are lines with their break; the last may have none. Null text counts as empty; empty
    texts, and those that hold a mark, stay plain, with null counts. The draw depends on the id, so
    rows that share one are cut by the same numbers and null ids draw as an empty one. Repeated rows
    are handled row by row, other columns are left out, an empty table gives an empty result.
    Nothing is shuffled; memory grows with the longest text only.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = texts_of(batch.column(1))
        raw = data.tobytes()
        ids = batch.column(0).to_pylist()
        rows = [
            transform(raw[a:b], doc_id, rules)
            for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        ]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).view(pa.string()),
            ],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    rows = take(docs, doc_id=id_column, text=text_column)
    return mapped(rows.withColumn("doc_id", F.col("doc_id").cast("bigint")), "text", CUTS, run)


def restored(output: Column, form: Column, rules: MiddleRules = MiddleRules()) -> Column:
    """The text before, from an output and its form alone."""
    first, second, third = rules.marks
    head = F.substring_index(output, third, 1)
    middle = F.substring_index(output, third, -1)
    late = F.substring(head, F.lit(len(first) + 1), F.char_length(head))
    psm = F.concat(
        F.substring_index(late, second, 1), middle, F.substring_index(late, second, -1)
    )
    late = F.substring(head, F.lit(len(second) + 1), F.char_length(head))
    spm = F.concat(F.substring_index(late, first, -1), middle, F.substring_index(late, first, 1))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digest(cut: DataFrame, rules: MiddleRules = MiddleRules()) -> DataFrame:
    """Hashes of the output and of the text restored from it, in place of the output."""
    text = restored(F.col("output"), F.col("form"), rules)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )
