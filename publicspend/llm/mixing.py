"""Mix sources to target weights with a low-discrepancy schedule of equal-token blocks.

Every source is put in a shuffled order, as one stream of words that starts again at its end, and
cut into blocks of equal size. Slots of the mix are the points of the golden-ratio sequence on
[0, 1); the sources divide that interval by the number of blocks they owe, so any stretch of the
schedule holds the sources in nearly the wanted shares. The r-th slot of a source takes its r-th
block. How much a source gives is how often it is drawn, so sums come near the targets, within a few
blocks; and the mix is read in the order of the slots.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from publicspend.llm.common import mapped, running_start, stored, take, texts_of

GOLDEN = 0.6180339887498949
#: Points are whole multiples of a step of about GOLDEN, modulo this: exact at any length.
_CIRCLE = 1 << 31
_HASH_SPACE = 16**15
_ROWS_IN_BUCKET = 2000
_SLOTS_IN_BUCKET = 4096
_COPIES = 4096


@dataclass(frozen=True)
class MixRules:
    """Sources weigh ``weights`` in turn, in code point order; none gives more than ``most``
    times its words. A block holds ``block_words`` words, fewer in a source that would owe less
    than ``least_slots`` blocks."""

    weights: Sequence[int] = (1, 2, 3)
    most: int = 3
    block_words: int = 2048
    least_slots: int = 1024


def count_words(texts: pa.Array) -> np.ndarray:
    """Runs of anything but ASCII white space, for each text."""
    data, offsets = texts_of(texts)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] = ~space[inner]
    return np.diff(np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])[offsets])


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words and ``text_hash``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(count_words(batch.column(2))),
                batch.column(3),
            ],
            ["doc_id", "source", "size", "text_hash"],
        )

    schema = "doc_id bigint, source string, size bigint, text_hash bigint"
    return mapped(docs.withColumn("text_hash", F.xxhash64("text")), "text", schema, run, 1 << 20)


def source_targets(measured: DataFrame, rules: MixRules) -> DataFrame:
    """One row per source: its place in code point order, size, weight and target.

    Targets are shares by weight of all words. Those above ``most`` times the source's size stop
    there and the excess goes to the others by weight, until none is above: in order of size by
    weight, the sources that stop come first. One task sees one row per source: sources are names of
    collections, of which a task holds some millions.
    """
    sources = measured.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in rules.weights])
    named = sources.withColumn("sid", place).withColumn(
        "weight", weights[F.col("sid") % len(rules.weights)]
    )
    most = F.col("source_size") * rules.most
    ratio = named.withColumn("ratio", most / F.col("weight"))
    upward = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, 0)
    everyone = Window.partitionBy()
    stopped_before = F.sum(most).over(upward) - most
    weight_left = F.sum("weight").over(everyone) - F.sum("weight").over(upward) + F.col("weight")
    rate = (F.sum("source_size").over(everyone) - stopped_before) / weight_left
    rated = ratio.withColumn("rate", rate)
    final = F.min(F.when(F.col("rate") <= F.col("ratio"), F.struct("ratio", "sid", "rate")))
    level = rated.withColumn("final", final.over(everyone)["rate"])
    target = F.least(most.cast("double"), F.col("final") * F.col("weight"))
    return level.select("source", "sid", "source_size", "n_docs", "weight", target.alias("target"))


def _blocks(sources: DataFrame, rules: MixRules) -> DataFrame:
    """With the size of a ``block`` and the number of blocks that the source ``owes``."""
    fine = F.floor(F.col("target") / rules.least_slots).cast("bigint")
    block = F.least(F.lit(rules.block_words).cast("bigint"), F.greatest(F.lit(1), fine))
    return sources.withColumn("block", block).withColumn("owes", F.col("target") / F.col("block"))


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, sid, rank): which source is read when, and for the how manieth time.

    Slots find their source by a grid on [0, 1) that is as fine as there are sources.
    """
    totals = sources.agg(F.sum("owes").alias("owes"), F.count("*").alias("n")).first()
    owed, cells = totals["owes"] or 0.0, 4 * max(1, totals["n"])
    upto = F.sum("owes").over(Window.orderBy("sid"))
    bounds = (
        sources.where("owes > 0")
        .withColumn("high", upto / F.lit(owed or 1.0))
        .withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("sid")))
    )
    last = F.least(F.floor(F.col("high") * cells), F.lit(cells - 1))
    grid = bounds.select(
        "sid", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * cells), last)).alias("cell")
    )
    point = (F.col("slot") + 1) % _CIRCLE * golden_step() % _CIRCLE / F.lit(float(_CIRCLE))
    points = (
        sources.sparkSession.range(round(owed))
        .select(F.col("id").alias("slot"))
        .withColumn("point", point)
        .withColumn("cell", F.floor(F.col("point") * cells))
    )
    drawn = points.join(grid, "cell").where("point >= low AND point < high")
    return running_start(
        drawn.select("slot", "sid", F.lit(1).cast("bigint").alias("one")),
        "sid",
        [F.col("slot")],
        F.floor(F.col("slot") / _SLOTS_IN_BUCKET),
        "one",
        "rank",
    ).select("slot", "sid", "rank")


def golden_step() -> int:
    """An odd number, so that all points of the circle are reached before one comes again."""
    return round(GOLDEN * _CIRCLE) | 1


RESULT = ("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


def mix(
    docs: DataFrame,
    rules: MixRules = MixRules(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Per document its size, its source's size and target, the words the mix ``taken``, the
    ``first_slot`` that takes any and the number ``n_slots`` of those that do.

    Null ids, null sources (a source of their own, last) and null texts (size 0, none taken) are
    kept. Rows that repeat, or share an id, each have a place in the stream. An empty table
    gives an empty result. Other columns are left out. The shuffle depends on ids and texts alone,
    so reruns agree. A document that nothing is taken of has no first slot.
    """
    rows = take(docs, doc_id=id_column, source=source_column, text=text_column)
    placed, slots = _placed(rows, rules)
    first = placed.where("taken > 0").withColumn("rank", F.expr("start div block"))
    found = first.join(slots.withColumnRenamed("slot", "first_slot"), ["sid", "rank"])
    counted = found.withColumn("n_slots", sum(_slots_in(turn) for turn in range(rules.most)))
    none = placed.where("taken = 0").withColumns(
        {"first_slot": F.lit(None).cast("bigint"), "n_slots": F.lit(0).cast("bigint")}
    )
    return counted.select("source", *RESULT).union(none.select("source", *RESULT))


def _slots_in(turn: int) -> Column:
    """The slots that take words of a document in one turn through its source's stream."""
    low = turn * F.col("source_size") + F.col("start")
    held = F.least(F.col("size"), F.greatest(F.lit(0), F.col("words") - low))
    slots = F.floor((low + held - 1) / F.col("block")) - F.floor(low / F.col("block")) + 1
    return F.when(held > 0, slots).otherwise(0).cast("bigint")


def _placed(rows: DataFrame, rules: MixRules) -> tuple[DataFrame, DataFrame]:
    """Each document's place ``start`` in its source's stream and the words ``taken`` of it, and the
    schedule. ``words`` is what its source gives in all."""
    measured = stored(sizes(rows), "sizes")
    sources = stored(_blocks(source_targets(measured, rules), rules), "sources")
    slots = stored(schedule(sources), "schedule")
    drawn = slots.groupBy("sid").agg(F.count("*").alias("drawn"))
    given = F.coalesce(F.col("drawn"), F.lit(0)) * F.col("block")
    facts = (
        sources.join(drawn, "sid", "left")
        .withColumn("words", F.least(given, F.col("source_size") * rules.most))
        .withColumnRenamed("source", "of_source")
        .select("of_source", "sid", "source_size", "n_docs", "target", "block", "words")
    )
    # rows alike are one stretch of the stream, so that any number of them is one row here
    key = ["doc_id", "source", "size", "text_hash"]
    alike = measured.groupBy(*key).agg(F.count("*").alias("copies"))
    known = alike.join(facts, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_hash")
    digits = F.substring(F.md5(name), 1, 15)
    shuffled = known.withColumn("draw", F.conv(digits, 16, 10).cast("bigint")).withColumn(
        "all_words", F.col("size") * F.col("copies")
    )
    buckets = F.ceil(F.col("n_docs") / _ROWS_IN_BUCKET)
    bucket = F.floor(F.col("draw") / F.lit(float(_HASH_SPACE)) * buckets)
    order = [F.col(c) for c in ("draw", "doc_id", "text_hash", "size")]
    streamed = running_start(shuffled, "sid", order, bucket, "all_words", "first_start")
    # the copies again, some thousands at a time
    many = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {_COPIES}")))
    lots = streamed.withColumn("lot", many)
    last = F.least(F.col("copies") - 1, F.col("lot") * _COPIES + (_COPIES - 1))
    each = lots.withColumn("copy", F.explode(F.sequence(F.col("lot") * _COPIES, last)))
    start = F.col("first_start") + F.col("copy") * F.col("size")
    turns = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)
    rest = F.when(F.col("source_size") > 0, F.expr("words % source_size")).otherwise(0)
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("start")))
    placed = each.withColumn("start", start).withColumn("taken", turns * F.col("size") + part)
    return placed.drop("first_start", "copies", "copy", "lot", "all_words", "draw"), slots


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The documents in the order of the schedule, each as often as the mix takes it.

    In each turn through its source's stream a document comes at the slot that holds its first
    word; of the last turn, which may end inside a document, it is there if half of it or more is.
    Empty documents stay once, at the end. Null ids and null sources are kept. Rows alike in id,
    source and text come alike, at the earliest slots of any of them; other columns, of whatever
    names, are carried along. An empty table stays empty.
    """
    placed, slots = _placed(take(docs, doc_id="doc_id", source="source", text="text"), rules)
    turn = F.explode(F.sequence(F.lit(0), F.lit(rules.most - 1)))
    turns = placed.where("size > 0").withColumn("turn", turn)
    low = F.col("turn") * F.col("source_size") + F.col("start")
    held = F.least(F.col("size"), F.greatest(F.lit(0), F.col("words") - low))
    there = turns.where(2 * held >= F.col("size")).withColumn("at", low)
    met = there.withColumn("rank", F.expr("at div block")).join(slots, ["sid", "rank"])
    key = ["doc_id", "source", "text_hash"]
    earliest = met.groupBy(*key, "turn").agg(F.min(F.struct("slot", "at")).alias("place"))
    empty = placed.where("size = 0").select(*key).distinct()
    end = F.struct(F.lit(None).cast("bigint").alias("slot"), F.lit(None).cast("bigint").alias("at"))
    places = earliest.select(*key, "place").union(empty.select(*key, end.alias("place")))
    named = places.select(
        F.col("doc_id").alias("_llm_id"),
        F.col("source").alias("_llm_source"),
        F.col("text_hash").alias("_llm_hash"),
        F.col("place").alias("_llm_place"),
    )
    joined = docs.withColumn("_llm_own", F.xxhash64("text")).join(
        named,
        F.col("doc_id").eqNullSafe(F.col("_llm_id"))
        & F.col("source").eqNullSafe(F.col("_llm_source"))
        & (F.col("_llm_own") == F.col("_llm_hash")),
    )
    order = [F.col(f"_llm_place.{c}").asc_nulls_last() for c in ("slot", "at")]
    return joined.orderBy(*order).select(*docs.columns)
