"""Delimited text files read as strings.

Spark cuts files into parts at line ends, and a quoted field may span lines and parts. One scan makes
an index of the parts: how many quote marks each holds, and the few lines at its ends that belong to
a record of a neighbour. Added up over the parts of a file that tells which parts begin inside a
field, and gives the records that cross a cut. A second scan gives all others.
"""

from __future__ import annotations

import csv
import io
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from publicspend.session import shared_folder

# What runs in the tasks is sent along, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
#: Longest record, in characters; two stray quote marks far apart would else make one of any size.
MOST_CHARS = 1 << 20
INDEX = (
    "file string, part bigint, odd boolean, spans boolean, whole boolean, head string, "
    "head_chars bigint, tail string, tail_chars bigint, tail_first boolean, first string, "
    "again boolean"
)


def read_text_table(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    most_chars: int = MOST_CHARS,
) -> DataFrame:
    """All columns as strings under the names in the header.

    Fields may be quoted, and quoted fields may span lines; their line breaks are kept as they
    are. A quote mark outside a quoted field or in the middle of an unquoted one, a field that is
    never closed, a record of more than ``most_chars`` characters, a row with too few or too many
    fields, whatever columns are used of it, names that differ only in case and a file whose header
    differs stop the read. All of that is the same for files of every size, wherever they are cut.

    The text is read twice: now for the index, which is stored with at most ``most_chars`` characters
    at each end of a part, and again when the table is used. Where no field spans lines the second
    read is Spark's own alone; both ways give the same rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines(spark, paths, encoding)
    index = text_index(lines, most_chars)
    seen = index.agg(F.max("spans").alias("spans"), F.max("again").alias("again")).first()
    parts = index if not seen.spans else _placed(index, most_chars)
    header = _header(parts, paths)
    records = [_plain(lines, header, most_chars)]
    if seen.spans or seen.again:
        # one entry for each part that begins inside a field; the driver lists all parts anyway
        inside: dict[str, list[int]] = {}
        for row in parts.where("inside").select("file", "part").collect():
            inside.setdefault(row.file, []).append(row.part)
        records = [
            _within(lines, header, inside, most_chars),
            _crossing(parts).where("NOT first").select("file", _without_return("text")),
        ]
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST"}
    return _parse(reduce(DataFrame.unionAll, records), header, options)


def _lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """``file, part, value, marks``: every line, with the number of its quote marks.

    Lines of a part follow each other in one task, in order. Encodings must write line ends as ASCII
    does.
    """
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):  # Spark reads lines as bytes
        value = F.decode(value.cast("binary"), encoding)
    return (
        spark.read.options(lineSep="\n")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("part"),
            value.alias("value"),
        )
        .withColumn("marks", _quote_marks(F.col("value")))
    )


def _quote_marks(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, QUOTE, ""))


def _without_return(name: str) -> Column:
    return F.regexp_replace(name, r"\r$", "").alias("text")


def _too_long(most_chars: int) -> str:
    return f"record of more than {most_chars} characters in "


# -------------------------------------------------------------------------------------- the index


@dataclass
class _Open:
    """Lines put together, of which at most ``most`` characters are kept."""

    most: int
    lines: list[str] = field(default_factory=list)
    chars: int = -1  # no break before the first line

    def add(self, values: pa.Array) -> None:
        if not len(values):
            return
        kept = self.chars <= self.most
        self.chars += int(pc.sum(pc.utf8_length(values)).as_py()) + len(values)
        if kept:
            self.lines.append("\n".join(values.to_pylist())[: self.most + 1])

    @property
    def text(self) -> str:
        return "\n".join(self.lines)


@dataclass
class _Part:
    """One part, seen as one that begins outside a field and as one that begins inside.

    Outside, a record begins at each line with an even number of marks before it; inside, at each
    with an odd number. ``since`` are the lines since the last of these, for both.
    """

    file: str
    part: int
    most: int
    parity: int = 0
    spans: bool = False
    whole: bool = True  # no line has an odd number of marks before it
    second: bool = False  # outside, a second record has begun
    line: str | None = None  # the first of a file
    again: bool = False  # and another like it
    head: _Open | None = None
    first: str | None = None
    since: list[_Open] = field(default_factory=list)

    def add(self, values: pa.Array, marks: np.ndarray) -> None:
        if not self.since:
            self.since = [_Open(self.most), _Open(self.most)]
            self.head = self.since[1]
        if self.part == 0:
            bare = pc.utf8_rtrim(values, "\r")
            if self.line is None:
                self.line, bare = bare[0].as_py(), bare[1:]
            self.again |= bool(pc.any(pc.equal(bare, self.line)).as_py())
        before = (self.parity + np.cumsum(marks) - marks) % 2
        self.spans |= bool((marks % 2).any())
        for case in (0, 1):
            starts = np.flatnonzero(before == case)
            if case == 0 and self.part == 0 and not self.second:
                begun = self.since[0].chars >= 0
                later = starts if begun else starts[1:]
                if len(later):
                    self.second = True
                    one = _Open(self.most, list(self.since[0].lines), self.since[0].chars)
                    one.add(values[: later[0]])
                    self.first = one.text
            if len(starts):
                if case == 1 and self.whole:
                    self.whole = False
                    self.head.add(values[: starts[0]])
                self.since[case] = _Open(self.most)
                self.since[case].add(values[starts[-1] :])
            else:
                self.since[case].add(values)
        self.parity = int((self.parity + marks.sum()) % 2)

    def row(self) -> tuple:
        tail = self.since[0 if self.parity else 1]  # of the case in which the part ends inside
        closed = self.part == 0 and not self.second and not self.parity
        return (
            self.file,
            self.part,
            bool(self.parity),
            self.spans,
            self.whole,
            self.head.text,
            self.head.chars,
            None if self.parity == 0 and self.whole else tail.text,
            tail.chars,
            self.part == 0 and not self.second,
            self.since[0].text if closed else self.first,
            self.again,
        )


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array, np.ndarray]]:
    """The lines of a batch by part."""
    files, parts = batch.column(0), batch.column(1).to_numpy()
    if not len(parts):
        return
    changes = np.flatnonzero(parts[1:] != parts[:-1]) + 1
    other = pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
    cuts = np.union1d(changes, np.flatnonzero(other) + 1).tolist()
    marks = batch.column(3).to_numpy()
    for start, end in zip([0, *cuts], [*cuts, len(parts)], strict=True):
        values = batch.column(2)[start:end]
        yield files[start].as_py(), int(parts[start]), values, marks[start:end]


def text_index(lines: DataFrame, most_chars: int = MOST_CHARS) -> DataFrame:
    """One row for each part of the files, stored; see ``INDEX``. ``inside`` is false, as it is where
    no line has an odd number of quote marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [part.split() for part in INDEX.split(", ")]
        kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
        names, schema = [n for n, _ in fields], pa.schema([(n, kinds[k]) for n, k in fields])
        now: _Part | None = None
        for batch in batches:
            done = []
            for file, part, values, marks in _stretches(batch):
                if now is None or (now.file, now.part) != (file, part):
                    done += [now.row()] if now else []
                    now = _Part(file, part, most_chars)
                now.add(values, marks)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in done], schema)
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(names, now.row(), strict=True))], schema)

    spark = lines.sparkSession
    run_id = f"{spark.sparkContext.applicationId}/text-index-{uuid.uuid4().hex[:12]}"
    path = f"{shared_folder(spark)}/publicspend/{run_id}"
    lines.select("file", "part", "value", "marks").mapInArrow(run, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path).withColumn("inside", F.lit(False))


def _placed(index: DataFrame, most_chars: int) -> DataFrame:
    """The index with ``inside``: whether a part begins inside a quoted field. Fields that are never
    closed and records that are too long and cross a cut stop here."""
    odd = F.col("odd").cast("int")
    in_order = Window.partitionBy("file").orderBy("part")
    parts = index.withColumn("inside", (F.sum(odd).over(in_order) - odd) % 2 == 1)
    last = parts.groupBy("file").agg(F.max_by(F.col("inside") != F.col("odd"), "part").alias("unclosed"))
    unclosed = last.where("unclosed").first()
    if unclosed:
        raise PySparkValueError(f"quoted field never closed in {unclosed.file}")
    chains = _fragments(parts).groupBy("file", "chain")
    chars = chains.agg((F.sum("piece.chars") + F.count("*") - 1).alias("chars"))
    long = chars.where(F.col("chars") > most_chars).first()
    if long:
        raise PySparkValueError(f"{_too_long(most_chars)}{long.file}")
    return parts


def _fragments(parts: DataFrame) -> DataFrame:
    """The ends of parts that belong to a record across a cut, numbered by record in each file."""
    ends_inside = F.col("inside") != F.col("odd")
    head = F.struct(
        "part",
        F.lit(0).alias("place"),
        F.col("head").alias("text"),
        F.col("head_chars").alias("chars"),
        F.lit(False).alias("first"),
    )
    tail = F.struct(
        "part",
        F.lit(1).alias("place"),
        F.col("tail").alias("text"),
        F.col("tail_chars").alias("chars"),
        F.col("tail_first").alias("first"),
    )
    begins = ends_inside & ~(F.col("inside") & F.col("whole"))
    pieces = F.array(F.when(F.col("inside"), head), F.when(begins, tail))
    found = parts.select("file", F.explode(F.array_compact(pieces)).alias("piece"))
    in_order = Window.partitionBy("file").orderBy("piece.part", "piece.place")
    return found.withColumn("chain", F.sum(F.col("piece.place")).over(in_order))


def _crossing(parts: DataFrame) -> DataFrame:
    """``file, first, text``: the records that cross a cut; ``first`` is a file's first record."""
    pieces = F.sort_array(F.collect_list("piece"))
    return (
        _fragments(parts)
        .groupBy("file", "chain")
        .agg(F.max("piece.first").alias("first"), F.array_join(pieces["text"], "\n").alias("text"))
        .select("file", "first", "text")
    )


def _header(parts: DataFrame, paths: list[str]) -> str:
    """The first record of the files, which must be the same in all."""
    found = parts.where("first IS NOT NULL").select("file", F.col("first").alias("text"))
    across = _crossing(parts).where("first").select("file", "text")
    firsts = found.union(across).select("file", _without_return("text"))
    one = firsts.agg(
        F.min_by("text", "file").alias("header"),
        F.min("text").alias("low"),
        F.max("text").alias("high"),
        F.max_by("file", "text").alias("last"),
        F.min_by("file", "text").alias("other"),
    ).first()
    if one.header is None:
        raise ValueError(f"no header in {', '.join(paths)}")
    if one.low != one.high:
        differs = one.last if one.high != one.header else one.other
        raise PySparkValueError(f"the header differs in {differs}")
    return one.header


# ------------------------------------------------------------------------------------- the records


def _plain(lines: DataFrame, header: str, most_chars: int) -> DataFrame:
    """``file, text``: every line, but for the one in each file's first part that is the header."""
    is_header = (F.col("part") == 0) & (_without_return("value") == header)
    error = F.raise_error(F.concat(F.lit(_too_long(most_chars)), "file"))
    text = F.when(F.char_length("value") > most_chars, error).otherwise(_without_return("value"))
    return lines.where(~is_header).select("file", text.alias("text"))


def _within(
    lines: DataFrame, header: str, inside: dict[str, list[int]], most_chars: int
) -> DataFrame:
    """``file, text``: the records that lie within a part, but for the headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_inside = {file: frozenset(parts) for file, parts in inside.items()}
        where: tuple[str, int] | None = None
        parity, pending, skip = 0, _Open(most_chars), False
        for batch in batches:
            files, texts = [], []
            for file, part, values, marks in _stretches(batch):
                if where != (file, part):
                    where, pending = (file, part), _Open(most_chars)
                    parity = int(part in begin_inside.get(file, ()))
                    # what a part begins with belongs to the part before, or is the header
                    skip = bool(parity) or part == 0
                after = (parity + np.cumsum(marks)) % 2
                parity = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if not len(ends):
                    pending.add(values)
                    _refuse(pending.chars, most_chars, file)
                    continue
                found = _joined(values[: ends[-1]], ends)
                if pending.chars >= 0:
                    pending.add(values[: ends[0]])
                    _refuse(pending.chars, most_chars, file)
                    found = pa.concat_arrays([pa.array([pending.text], pa.string()), found[1:]])
                if skip:
                    found, skip = found[1:], False
                if len(found):
                    _refuse(pc.max(pc.utf8_length(found)).as_py(), most_chars, file)
                pending = _Open(most_chars)
                pending.add(values[ends[-1] :])
                _refuse(pending.chars, most_chars, file)
                files.append(pa.repeat(pa.scalar(file), len(found)))
                texts.append(found)
            if texts:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(files), pa.concat_arrays(texts)], ["file", "text"]
                )

    records = lines.select("file", "part", "value", "marks").mapInArrow(run, "file string, text string")
    return records.select("file", _without_return("text"))


def _refuse(chars: int, most_chars: int, file: str) -> None:
    if chars > most_chars:
        raise ValueError(f"{_too_long(most_chars)}{file}")


def _joined(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines up to each end put together."""
    if len(ends) == len(values):
        return values
    bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(bounds, values), "\n")


def _parse(records: DataFrame, header: str, options: dict[str, str]) -> DataFrame:
    """Columns from the records; a record of another shape stops the read.

    The test of the shape is a filter, so it is made whatever columns are used later.
    """
    names = next(csv.reader(io.StringIO(header, newline=""), delimiter=options["sep"]))
    if len({name.lower() for name in names}) < len(names):
        raise ValueError(f"names in the header differ only in case, or not at all: {header}")
    sep = re.escape(options["sep"])
    field = f'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{sep}]*+)'
    shape = f"^{field}(?:{sep}{field}){{{len(names) - 1}}}$"
    quoting = f"^{field}(?:{sep}{field})*+$"
    problem = F.when(F.col("text").rlike(quoting), "too few or too many fields in ").otherwise(
        "quote mark inside an unquoted field in "
    )
    fits = (  # one expression, as Spark may put conditions in another order
        F.when(F.col("text") == "", False)
        .when(F.col("text").rlike(shape), True)
        .otherwise(F.raise_error(F.concat(problem, "file")).cast("boolean"))
    )
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    parsed = F.from_csv("text", schema, options)
    return records.where(fits).select(parsed.alias("row")).select("row.*")
