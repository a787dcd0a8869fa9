"""Jaccard self-join of documents on word shingles, filtered by prefixes under several orders.

Sort the shingles of every set by one order that holds for the whole corpus. Two sets of
similarity t can only link if their prefixes, the first ``n - ceil(t n) + 1`` shingles, meet.
That is true of any order, so a pair must pass under all of them before it is verified. All
orders put rare shingles first, as a bounded sketch of the corpus ranks them; among equals each
uses another hash. The sketch decides what is cheap, never what is right.

Copies are not expanded into pairs. Equal sets collapse by hash before they meet. In a bucket of
sets that share a prefix shingle, each is compared with the smallest; what links becomes a
component, and only sets in different components are compared further: with a few drawn others
of the bucket, again and again, and in the end with all.
A comparison inside a component could not change it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from publicspend.llm.common import slices, stored, take
from publicspend.llm.components import components

_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORDS_KEPT = 200_000


@dataclass(frozen=True)
class JoinRules:
    """``words`` in a shingle, least similarity in ``percent``, token ``orders``.

    In the first of ``rounds`` rounds a bucket row meets about ``pairs`` others, in each further
    one four times as many, in the last one all.
    Up to ``broadcast_pairs`` pairs to verify are handed to all tasks, 16 bytes each.
    ``sketch_bits``: the sketch has 2 ** sketch_bits counters, whatever the corpus holds.
    """

    words: int = 5
    percent: int = 80
    orders: int = 3
    rounds: int = 4
    pairs: int = 16
    broadcast_pairs: int = 500_000
    sketch_bits: int = 18

    def drawn(self, turn: int) -> int:
        return self.pairs * 4 ** (turn - 1)

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


class _Hashes(dict):
    """Word hashes, forgotten when too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """Another 64-bit hash of each 64-bit hash."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int, hashes: dict) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a short text is one shingle."""
    words = text.lower().split()  # ASCII letters and white space only, as these are bytes
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total += each[i : len(words) - width + 1 + i] * np.uint64(2 * i + 1) + np.uint64(i)
        total = mixed(total, i)
    return np.unique(total)


def set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Rows and their shingle sets, a few megabytes of text at a time."""
    hashes = _Hashes()
    for piece in slices(batches, "text"):
        texts = piece.column("text").cast(pa.binary()).to_pylist()
        yield piece, [shingles(t or b"", width, hashes) for t in texts]


def describe(docs: DataFrame, rules: JoinRules) -> DataFrame:
    """Per document its set's size and key; in rows without a size, the sketch's counts.

    A partition reports shingles that lie in two of its sets or more, by counter.
    """
    schema = (
        "doc_id bigint, text_hash bigint, n_shingles bigint, set_key binary, node bigint, "
        "counter int, n bigint"
    )
    names = ["doc_id", "text_hash", "n_shingles", "set_key", "node", "counter", "n"]
    width, bits = rules.words, rules.sketch_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        seen: set[bytes] = set()
        waiting: list[np.ndarray] = []

        def count() -> None:
            values, times = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            often = times > 1
            np.add.at(counts, (values[often] >> np.uint64(64 - bits)).astype(np.int64), times[often])

        size = 0
        for piece, sets in _sets(batches, width):
            keys = [set_key(s) if len(s) else None for s in sets]
            for key, found in zip(keys, sets, strict=True):
                if key and key not in seen:
                    seen.add(key)
                    waiting.append(found)
                    size += len(found)
            if len(seen) > _WORDS_KEPT:
                seen.clear()
            if size > 2_000_000:
                count()
                size = 0
            blank = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int64())
            lengths = pa.array([len(s) for s in sets], pa.int64())
            nodes = pa.array([_node(key) if key else None for key in keys], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:3:2], lengths, pa.array(keys, pa.binary()), nodes, *blank], names
            )
        if waiting:
            count()
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.nulls(len(used), pa.int64())] * 3,
                pa.nulls(len(used), pa.binary()),
                pa.nulls(len(used), pa.int64()),
                pa.array(used, pa.int32()),
                pa.array(counts[used]),
            ],
            names,
        )

    # a partition must hold many documents to see what is common; but under dynamic allocation the
    # cores of now say little, so tasks are at least a quarter of a shuffle's, which follow the input
    spark = docs.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = docs.coalesce(max(4 * spark.sparkContext.defaultParallelism, shuffled // 4))
    return wide.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, schema)


def sketch_ranks(described: DataFrame, bits: int) -> np.ndarray:
    """How common each counter's shingles are: the binary logarithm of its count, one byte each."""
    rows = (
        described.where("counter IS NOT NULL").groupBy("counter").agg(F.sum("n").alias("n"))
    ).toArrow()  # 2 ** bits rows at most
    ranks = np.zeros(1 << bits, np.uint8)
    places = rows.column("counter").to_numpy()
    ranks[places] = np.ceil(np.log2(1 + rows.column("n").to_numpy())).astype(np.uint8)
    return ranks


def in_order(found: np.ndarray, ranks: np.ndarray, bits: int, order: int, length: int) -> np.ndarray:
    """The first ``length`` shingles under one of the orders."""
    rank = ranks[(found >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64)
    keys = (rank << np.uint64(56)) | (mixed(found, 101 + order) >> np.uint64(8))
    if length < len(found):
        places = np.argpartition(keys, length - 1)[:length]
    else:
        places = np.arange(len(found))
    return found[places[np.argsort(keys[places])]]


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def prefix_rows(docs: DataFrame, ranks: np.ndarray, rules: JoinRules) -> DataFrame:
    """(token, node, n, place) for each shingle of each set's prefix under the first order."""
    width, bits = rules.words, rules.sketch_bits
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # 2 ** bits bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        seen: set[bytes] = set()
        for _, sets in _sets(batches, width):
            tokens, nodes, sizes, lengths = [], [], [], []
            for found in sets:
                key = set_key(found)
                if not len(found) or key in seen:
                    continue
                if len(seen) > _WORDS_KEPT:
                    seen.clear()
                seen.add(key)
                part = in_order(found, ranks, bits, 0, rules.prefix(len(found)))
                tokens.append(part)
                nodes.append(_node(key))
                sizes.append(len(found))
                lengths.append(len(part))
            if not tokens:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(np.repeat(np.array(nodes, np.int64), lengths)),
                    pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])),
                ],
                ["token", "node", "n", "place"],
            )

    return docs.mapInArrow(run, "token bigint, node bigint, n int, place int")


def involved_sets(docs: DataFrame, ranks: np.ndarray, rules: JoinRules) -> DataFrame:
    """Whole sets, and their prefixes under the other orders, of the given documents."""
    width, bits = rules.words, rules.sketch_bits
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ["set_key", "node", "n", "found", "prefixes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        seen: set[bytes] = set()
        for _, sets in _sets(batches, width):
            new = {set_key(s): s for s in sets if len(s)}
            new = {key: s for key, s in new.items() if key not in seen}
            if len(seen) > _WORDS_KEPT:
                seen.clear()
            seen |= new.keys()
            if not new:
                continue
            keys, sets = list(new), list(new.values())
            prefixes = [
                [
                    in_order(s, ranks, bits, k, rules.prefix(len(s))).view(np.int64)
                    for k in range(1, rules.orders)
                ]
                for s in sets
            ]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array([_node(k) for k in keys], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([s.view(np.int64) for s in sets], kind),
                    pa.array(prefixes, pa.list_(kind)),
                ],
                names,
            )

    schema = (
        "set_key binary, node bigint, n int, found array<bigint>, prefixes array<array<bigint>>"
    )
    return docs.mapInArrow(run, schema)


def _close(n: str, m: str, percent: int) -> F.Column:
    """Whether sets of these sizes can be similar enough."""
    small, large = F.least(n, m).cast("bigint"), F.greatest(n, m).cast("bigint")
    return 100 * small >= percent * large


def _sides(pairs: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """The pairs (a, b) of nodes with what is known of both; each set travels once for each pair."""
    if pairs.count() <= rules.broadcast_pairs:
        pairs = F.broadcast(pairs)
    sides = []
    for side in "ab":
        named = sets.select(*[F.col(c).alias(f"{c}_{side}") for c in sets.columns])
        sides.append(named.join(pairs, F.col(f"node_{side}") == F.col(side)))
    return sides[0].join(sides[1], ["a", "b"])


def filtered(pairs: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """The pairs that pass under the other orders as well.

    What two sets share beyond their common prefix tokens lies behind the prefix of one of them.
    So the prefixes must share enough tokens for a link, not just one.
    """
    met = _sides(pairs, sets.select("node", "n", "prefixes"), rules)
    total = F.col("n_a").cast("bigint") + F.col("n_b")
    most = F.greatest("n_a", "n_b").cast("bigint")
    need = _share_up(total, rules.percent, 100 + rules.percent) - _share_up(most, rules.percent, 100)
    for k in range(rules.orders - 1):
        common = F.array_intersect(F.col("prefixes_a")[k], F.col("prefixes_b")[k])
        met = met.where(F.size(common) >= need + 1)
    return met.select("a", "b").distinct()


def _share_up(n: F.Column, part: int, whole: int) -> F.Column:
    """ceil(n * part / whole) in whole numbers."""
    return F.floor((n * part + (whole - 1)) / whole).cast("bigint")


def verified(pairs: DataFrame, sets: DataFrame, rules: JoinRules) -> DataFrame:
    """Of the pairs (a, b) of nodes, those that link, as pairs of set keys."""
    met = _sides(pairs, sets.select("node", "n", "set_key", "found"), rules)
    common = F.size(F.array_intersect("found_a", "found_b")).cast("bigint")
    total = F.col("n_a").cast("bigint") + F.col("n_b")
    return met.where(
        _close("n_a", "n_b", rules.percent) & (100 * common >= rules.percent * (total - common))
    ).select(F.col("set_key_a").alias("a"), F.col("set_key_b").alias("b"))


def live_buckets(rows: DataFrame, rules: JoinRules) -> DataFrame:
    """The prefix rows that may meet another set's at their token, each once.

    By size, the smaller set of a linking pair has the first token that both share in the first
    ``n - ceil(2 p / (100 + p) n) + 1`` places of its own prefix: its row ``leads``. So a row stays
    if a leading row of a set at most as large, and nearly as large, comes before it in its
    bucket, or if it leads and the next set is close. Equal rows, of copies in several
    partitions, count once.
    """
    need = F.ceil(2 * rules.percent * F.col("n") / (100 + rules.percent))
    bucket = Window.partitionBy("token").orderBy("n", "node")
    once = rows.withColumn("previous", F.lag("node").over(bucket))
    once = once.where("previous IS NULL OR previous <> node").drop("previous")
    met = once.withColumn("leads", F.col("place") <= F.col("n") - need)
    above = bucket.rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("lower", F.last(F.when(F.col("leads"), F.col("n")), True).over(above))
    met = met.withColumn("next", F.lead("n").over(bucket))
    after = F.col("leads") & F.col("next").isNotNull() & _close("n", "next", rules.percent)
    before = F.col("lower").isNotNull() & _close("lower", "n", rules.percent)
    return met.where(after | before).drop("lower", "next")


def open_buckets(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that still hold sets of different components.

    With their component, and how many rows of the bucket are ``leading``.
    """
    rows = live.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", F.col("node").cast("string").cast("binary"))
    )
    buckets = rows.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count_if("leads").alias("leading")
    )
    return rows.join(buckets.where("low <> high").select("token", "leading"), "token")


def _against(smaller: DataFrame, rows: DataFrame, rules: JoinRules) -> DataFrame:
    """(a, b, member) where a leading row of ``smaller`` meets a row of a larger set.

    Both are of different components and close in size, and what follows the token in both sets,
    the first that they share, is enough for a link.
    """
    x = smaller.where("leads").select("token", F.struct("node", "n", "place", "label").alias("x"))
    y = rows.select("token", F.struct("node", "n", "place", "label").alias("y"))
    rest = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    total = F.col("x.n").cast("bigint") + F.col("y.n")
    fits = (
        (F.struct("x.n", "x.node") < F.struct("y.n", "y.node"))
        & (F.col("x.label") != F.col("y.label"))
        & _close("x.n", "y.n", rules.percent)
        & ((100 + rules.percent) * rest.cast("bigint") >= rules.percent * total)
    )
    met = x.withColumnRenamed("token", "_token").join(y, (F.col("_token") == F.col("token")) & fits)
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def first_pairs(rows: DataFrame, rules: JoinRules) -> DataFrame:
    """Each set against the smallest set of the buckets it shares with it, the likeliest one."""
    least = F.min_by(F.struct("node", "n", "place", "label", "leads"), F.struct("n", "node"))
    smallest = rows.where("leads").groupBy("token").agg(least.alias("least"))
    pairs = _against(smallest.select("token", "least.*"), rows, rules)
    votes = pairs.groupBy("a", "b").agg(F.count("*").alias("votes"))
    best = F.max_by("a", F.struct("votes", "a")).alias("a")
    return votes.groupBy("b").agg(best).select("a", "b")


def drawn_pairs(rows: DataFrame, turn: int, rules: JoinRules) -> DataFrame:
    """Rows against a number of drawn leading rows of their bucket, in the last round all."""
    parts = 1 << 30
    share = F.lit(1.0) if turn == rules.rounds else rules.drawn(turn) / F.col("leading")
    drawn = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(parts)) < share * parts
    return _against(rows.where(drawn), rows, rules).distinct()


def link_sets(docs: DataFrame, described: DataFrame, rules: JoinRules) -> DataFrame:
    """``set_key`` and ``label`` of every set that links with another, by component."""
    spark = docs.sparkSession
    ranks = sketch_ranks(described, rules.sketch_bits)
    live = stored(live_buckets(prefix_rows(docs, ranks, rules), rules), "buckets")
    full = described.where("n_shingles > 0")
    firsts = (
        full.join(live.select("node").distinct(), "node", "left_semi")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("first_id"))
        .select("first_id")
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(firsts["first_id"])
    sets = stored(involved_sets(docs.join(firsts, same, "left_semi"), ranks, rules), "sets")
    labels = spark.createDataFrame([], "set_key binary, label binary")
    tried = []
    for turn in range(rules.rounds + 1):
        if turn == 0:
            pairs = first_pairs(live.withColumn("label", F.col("node")), rules)
        else:
            by_node = sets.select("set_key", "node").join(labels, "set_key").select("node", "label")
            rows = stored(open_buckets(live, by_node.distinct()), "open")
            if rows.isEmpty():
                break
            pairs = drawn_pairs(rows, turn, rules)
            # in smaller buckets every leading row was drawn
            live = rows.where(F.col("leading") > rules.drawn(turn)).drop("label", "leading")
        for earlier in tried:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried.append(pairs)
        found = stored(verified(stored(filtered(pairs, sets, rules), "passed"), sets, rules), "links")
        if found.isEmpty():
            continue
        known = labels.select(F.col("set_key").alias("a"), F.col("label").alias("b"))
        labels = components(found.union(known)).withColumnRenamed("node", "set_key")
    return labels


def near_duplicates(
    docs: DataFrame,
    rules: JoinRules = JoinRules(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, one row for each document.

    ``component_id`` is the smallest doc_id reachable by links. A text without words has an
    empty set and is linked with nothing; its component is its own id. Null text counts as
    empty. Rows that repeat, or share an id, are documents of their own; where all ids of a
    component are null, so is its name. Shingles are compared by 64-bit hashes, sets by 128-bit
    hashes. Other columns are left out.
    """
    return _members(take(docs, doc_id=id_column, text=text_column), rules).select(
        "doc_id", "n_shingles", "component_id"
    )


def _members(rows: DataFrame, rules: JoinRules) -> DataFrame:
    described = stored(describe(rows, rules), "described")
    labels = link_sets(rows, described, rules)
    documents = described.where("counter IS NULL").select(
        "doc_id", "text_hash", "n_shingles", "set_key"
    )
    classes = (
        documents.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.min("doc_id").alias("first_id"))
        .join(labels, "set_key", "left")
        .withColumn("label", F.coalesce("label", "set_key"))
    )
    names = classes.groupBy("label").agg(
        F.min("first_id").alias("component_id"), F.min("least").alias("kept")
    )
    members = classes.join(names, "label").select("set_key", "component_id", "kept")
    own = F.struct("doc_id", "text_hash")
    full = F.col("n_shingles") > 0
    return documents.join(members, "set_key", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(full, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(full, F.col("kept").eqNullSafe(own)).otherwise(True).alias("stays"),
    )


def first_of_each_group(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """The documents without near duplicates: of each component one row with the smallest id.

    Texts without words, null ones too, are linked with nothing and all stay. Rows that share an id,
    or have none, are documents of their own, but of rows alike in id and text one stays. Other
    columns are passed on unless their names start with ``_llm_``; an empty table stays empty.
    """
    members = _members(take(docs, doc_id="doc_id", text="text"), rules)
    stay = members.where("stays").select(
        F.col("doc_id").alias("_llm_id"), F.col("text_hash").alias("_llm_hash")
    )
    hashed = docs.withColumn("_llm_own", F.xxhash64("text"))
    same = hashed["doc_id"].eqNullSafe(F.col("_llm_id")) & (F.col("_llm_own") == F.col("_llm_hash"))
    met = hashed.join(stay.distinct(), same)
    copy = F.row_number().over(Window.partitionBy("_llm_id", "_llm_own").orderBy("_llm_own"))
    blank = ~F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False))
    kept = met.withColumn("_llm_copy", copy).where(blank | (F.col("_llm_copy") == 1))
    return kept.select(*docs.columns)
