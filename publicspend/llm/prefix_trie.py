"""Prefix trie of conversations: ternary search trees over ranges of turn sequences.

A conversation is the sequence of its turns, each a fingerprint of role and text. Equal sequences
become one row first, with the number of conversations that end there, so copies of any number cost
no more. The sequences are dealt to shards by range, so what shares a prefix lies together, and each
shard is read in order, a block of bounded size at a time. In a block turns are numbered by a
dictionary, which keeps their order, and the sequences go into a ternary search tree, the median of
the sorted ones first, then the medians of both halves, so that the trees of siblings are balanced.
One iterative walk in post-order adds up members, leaves and savings.

A node that is also in a neighbouring block is a prefix that the last sequence of one block and the
first of the next have in common. Blocks give those as partial rows. In the order in which they
first appear, block by block and then by depth, the nodes below such a node follow it without a gap,
up to the last block that holds it. So their sums are differences of running sums over blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from publicspend.llm.common import running_start, stored, take

#: A turn is 16 bytes of fingerprint and 4 bytes for the length of its text.
TURN = 20
#: Conversation ids that are joined to one string before strings are hashed in a row.
IDS_IN_STRING = 4096
EMPTY = hashlib.sha256().hexdigest()

SEQUENCE = "key binary, n_ends bigint, first_conv bigint, ends_sha256 string"
_NODE = (
    "node string, parent string, shard int, block bigint, depth bigint, conv_id bigint, "
    "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, text_bytes bigint, ends_sha256 string"
)
RESULT = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


@dataclass(frozen=True)
class TrieRules:
    """Sizes of the work: a block holds ``block_sequences`` different sequences and
    ``block_bytes`` of fingerprints at most, one sequence at least; a shard is to hold
    ``shard_sequences``. Results do not depend on them."""

    block_sequences: int = 20_000
    block_bytes: int = 8 << 20
    shard_sequences: int = 200_000


# ---------------------------------------------------------------------------------------------
# Sequences


def turn_sequences(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """``conv_id`` and ``turns``, the turns in order, each as the hexadecimal digits of TURN bytes.

    Null role or text counts as empty. Null turns come first; turns with equal numbers are ordered
    by fingerprint, and rows that repeat are turns of their own. Rows without an id are left out.
    Texts stay where they are: 40 digits for each turn are shuffled, and one row holds those of a
    conversation.
    """
    rows = take(
        conversations, conv_id=id_column, turn=turn_column, role=role_column, text=text_column
    )
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    code = F.concat(F.substring(F.sha2(named, 256), 1, 32), F.lower(size))
    coded = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.struct("turn", code.alias("code")).alias("at")
    )
    gathered = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    return gathered.select("conv_id", F.col("turns")["code"].alias("turns"))


def branched(sequences: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation with its first turns taken from the first of its family.

    Conversation c takes the first h turns of conversation ``c - c % family``, where h is the crc32
    of its decimal id modulo ``most``, and goes on with its own turns after the first h. A family's
    first that is absent gives none.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = sequences.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head")
    )
    own = sequences.withColumn("taken", taken.cast("int")).withColumn(
        "head_id", F.col("conv_id") - F.col("conv_id") % family
    )
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.array().cast("array<string>"))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(heads, "head_id", "left").select(
        "conv_id", F.concat(head, rest).alias("turns")
    )


def distinct_sequences(sequences: DataFrame, rules: TrieRules) -> DataFrame:
    """(shard, key, n_ends, first_conv, ends_sha256), stored, shards being ranges of keys.

    Ids are joined to strings where they lie in order, before one task gets those of a sequence, so
    that many copies reach it as few rows. It hashes them as they come; a hash can not be split.
    """
    key = F.unhex(F.array_join("turns", ""))
    keyed = stored(sequences.select(key.alias("key"), "conv_id"), "keys")
    n = keyed.count()
    partitions = max(1, -(-n // rules.shard_sequences))
    width = max(partitions, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = keyed.repartitionByRange(width, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    strings = ordered.mapInArrow(
        _joined_ids, "key binary, first_conv bigint, n_ends bigint, ids string"
    )
    dealt = strings.repartitionByRange(partitions, "key").sortWithinPartitions("key", "first_conv")
    hashed = dealt.mapInArrow(_hashed_ids, SEQUENCE)
    return stored(hashed.withColumn("shard", F.spark_partition_id()), "sequences")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "first_conv", "n_ends", "ids"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    last, ids = None, []
    for batch in batches:
        rows: list[tuple] = []
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (key != last or len(ids) == IDS_IN_STRING):
                rows.append((last, ids[0], len(ids), ",".join(map(str, ids))))
                ids = []
            last = key
            ids.append(conv)
        yield _batch(rows, names, kinds)
    if ids:
        yield _batch([(last, ids[0], len(ids), ",".join(map(str, ids)))], names, kinds)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "n_ends", "first_conv", "ends_sha256"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    last, n, first, state = None, 0, 0, hashlib.sha256()
    for batch in batches:
        rows: list[tuple] = []
        for key, conv, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if n and key == last:
                state.update(b",")
            else:
                if n:
                    rows.append((last, n, first, state.hexdigest()))
                last, n, first, state = key, 0, conv, hashlib.sha256()
            state.update(ids.encode())
            n += count
        yield _batch(rows, names, kinds)
    if n:
        yield _batch([(last, n, first, state.hexdigest())], names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


# ---------------------------------------------------------------------------------------------
# Trees


@dataclass
class TernaryTree:
    """A trie whose siblings form binary search trees.

    Place 0 is the root of the trie. ``below`` leads to the tree of a node's children, ``less`` and
    ``more`` to its siblings.
    """

    turn: list[int] = field(default_factory=lambda: [-1])
    less: list[int] = field(default_factory=lambda: [0])
    more: list[int] = field(default_factory=lambda: [0])
    below: list[int] = field(default_factory=lambda: [0])
    sequence: list[int] = field(default_factory=lambda: [-1])

    def _new(self, turn: int) -> int:
        self.turn.append(turn)
        for links in (self.less, self.more, self.below):
            links.append(0)
        self.sequence.append(-1)
        return len(self.turn) - 1

    def insert(self, turns: list[int], number: int) -> None:
        """Add a sequence of turns, known as ``number``."""
        at = 0
        for turn in turns:
            links, place = self.below, at
            while links[place]:
                other = links[place]
                if turn == self.turn[other]:
                    break
                links, place = (self.less if turn < self.turn[other] else self.more), other
            else:
                links[place] = self._new(turn)
            at = links[place]
        self.sequence[at] = number

    @classmethod
    def of_sorted(cls, sequences: list[list[int]]) -> TernaryTree:
        """The median first, then the medians of what lies before and after it."""
        tree = cls()
        ranges = [(0, len(sequences))]
        while ranges:
            low, high = ranges.pop()
            if low < high:
                middle = (low + high) // 2
                tree.insert(sequences[middle], middle)
                ranges += [(middle + 1, high), (low, middle)]
        return tree

    def post_order(self) -> Iterator[tuple[int, int, int]]:
        """(node, its parent, depth) of the trie, children in order before their parent."""
        stack = [(0, 0, 0, False)]
        while stack:
            node, parent, depth, seen = stack.pop()
            if seen:
                yield node, parent, depth
                continue
            # the last pushed comes first: smaller siblings, what lies below, the node, greater ones
            if node and self.more[node]:
                stack.append((self.more[node], parent, depth, False))
            stack.append((node, parent, depth, True))
            if self.below[node]:
                stack.append((self.below[node], node, depth + 1, False))
            if node and self.less[node]:
                stack.append((self.less[node], parent, depth, False))


@dataclass
class _Block:
    """Sequences in order, and how many turns the first and the last share with the neighbours;
    -1 where there is no neighbour."""

    shard: int
    number: int
    rows: list[tuple[bytes, int, int, str]]
    before: int
    after: int


def shared_turns(one: bytes, other: bytes) -> int:
    """The turns that two sequences start with alike."""
    low, high = 0, min(len(one), len(other)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if one[: middle * TURN] == other[: middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


def nodes_of_block(block: _Block) -> list[tuple]:
    """One row per node, in the order of _NODE. Those that a neighbour has too carry a name, and
    sums over what hangs on them here and is nowhere else; other nodes are complete but for the
    parent's first conversation, where the parent is in a neighbour too."""
    keys = [row[0] for row in block.rows]
    turns = sorted({key[i : i + TURN] for key in keys for i in range(0, len(key), TURN)})
    dictionary = {turn: number for number, turn in enumerate(turns)}
    sequences = [
        [dictionary[key[i : i + TURN]] for i in range(0, len(key), TURN)] for key in keys
    ]
    tree = TernaryTree.of_sorted(sequences)
    named = _shared_nodes(tree, sequences, block, keys)
    size = len(tree.turn)
    members, children, leaves, saved = [0] * size, [0] * size, [0] * size, [0] * size
    first: list[int | None] = [None] * size
    found = []
    for node, parent, depth in tree.post_order():
        ends = EMPTY
        if tree.sequence[node] >= 0:
            _, n_ends, conv, ends = block.rows[tree.sequence[node]]
            members[node] += n_ends
            first[node] = conv if first[node] is None else min(conv, first[node])
        text_bytes = int.from_bytes(turns[tree.turn[node]][-4:], "big") if node else 0
        name = named.get(node)
        if name is None:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * text_bytes
        found.append((node, parent, depth, name, text_bytes, ends))
        if node:
            members[parent] += members[node]
            if first[parent] is None or first[node] < first[parent]:
                first[parent] = first[node]
            if name is None:  # what a neighbour has too is added up later
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
    return [
        (
            name,
            named.get(parent) if node else None,
            block.shard,
            block.number,
            depth,
            first[node],
            first[parent] if node and parent not in named else None,
            members[node],
            children[node],
            leaves[node],
            saved[node],
            text_bytes,
            ends,
        )
        for node, parent, depth, name, text_bytes, ends in found
    ]


def _shared_nodes(
    tree: TernaryTree, sequences: list[list[int]], block: _Block, keys: list[bytes]
) -> dict[int, str]:
    """The nodes that a neighbour has too, by a name that depends on their turns alone."""
    named = {}
    for number, depth in ((0, block.before), (-1, block.after)):
        state, node = hashlib.sha256(), 0
        if depth >= 0:
            named[0] = state.hexdigest()[:32]
        for level in range(depth):
            state.update(keys[number][level * TURN : (level + 1) * TURN])
            turn, node = sequences[number][level], tree.below[node]
            while tree.turn[node] != turn:
                node = tree.less[node] if turn < tree.turn[node] else tree.more[node]
            named[node] = state.copy().hexdigest()[:32]
    return named


def _nodes(rules: TrieRules):
    names = [part.split()[0] for part in _NODE.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    types = [kinds[part.split()[1]] for part in _NODE.split(", ")]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
        """Each shard, which comes whole and in order, in blocks of bounded size."""
        rows: list[tuple] = []
        shard, size, number, before, after = None, 0, 0, -1, -1
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns)
            for key, n_ends, conv, ends, own, own_before, own_after in zip(*columns, strict=True):
                if rows and own != shard:
                    yield _Block(shard, number, rows, before, after)
                    rows = []
                elif rows and (len(rows) >= rules.block_sequences or size + len(key) > rules.block_bytes):
                    shared = shared_turns(rows[-1][0], key)
                    yield _Block(shard, number, rows, before, shared)
                    rows, size, number, before = [], 0, number + 1, shared
                if own != shard:
                    shard, size, number, before, after = own, 0, 0, own_before, own_after
                rows.append((key, n_ends, conv, ends))
                size += len(key)
        if rows:
            yield _Block(shard, number, rows, before, after)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = nodes_of_block(block)
            for start in range(0, len(found), 20_000):
                yield _batch(found[start : start + 20_000], names, types)

    return run


def _neighbours(sequences: DataFrame) -> DataFrame:
    """(of_shard, before, after): turns that each shard's ends share with the shards beside it."""
    order = Window.orderBy("shard")
    ends = sequences.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    beside = ends.select(
        "shard",
        "low",
        "high",
        F.lag("high").over(order).alias("previous"),
        F.lead("low").over(order).alias("next"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (
                    shard,
                    -1 if previous is None else shared_turns(previous, low),
                    -1 if following is None else shared_turns(high, following),
                )
                for shard, low, high, previous, following in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True
                )
            ]
            yield _batch(rows, ["of_shard", "before", "after"], [pa.int32()] * 3)

    return beside.mapInArrow(run, "of_shard int, before int, after int")


# ---------------------------------------------------------------------------------------------
# Nodes that several blocks have


def merged(partial: DataFrame) -> DataFrame:
    """One row for each node that several blocks have, with sums over its whole subtree."""
    at = F.struct("shard", "block")
    nodes = partial.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.max("text_bytes").alias("text_bytes"),
        F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))).alias("ends"),
        F.min(at).alias("from"),
        F.max(at).alias("to"),
    )
    below = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
        F.count("*").alias("n_shared")
    )
    counted = nodes.join(below, F.col("node") == F.col("of"), "left")
    children = F.col("n_children") + F.coalesce("n_shared", F.lit(0))
    own = counted.withColumn("n_children", children).withColumns(
        {
            "own_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
            "own_saved": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("text_bytes"),
            "ends_sha256": F.coalesce("ends", F.lit(EMPTY)),
        }
    )
    own = stored(
        own.select(
            "node", "parent", "depth", "conv_id", "n_convs", "n_children", "own_leaves",
            "own_saved", "ends_sha256", "from", "to",
        ),
        "shared_nodes",
    )
    # sums over the blocks before each block, of the nodes that first appear in them
    starting = own.groupBy(F.col("from").alias("at")).agg(
        F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved")
    )
    none = F.lit(0).cast("bigint")
    ending = own.select(F.col("to").alias("at"), none.alias("leaves"), none.alias("saved"))
    blocks = starting.union(ending).groupBy("at").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    sums = blocks.withColumns({"every": F.lit(0), "place": F.col("at")["shard"]})
    for name in ("leaves", "saved"):
        sums = running_start(sums, "every", [F.col("at")], F.col("place"), name, f"{name}_before")
    sums = stored(sums.drop("every", "place"), "block_sums")
    first = sums.select(
        F.col("at").alias("from"),
        (F.col("leaves_before") + F.col("leaves")).alias("leaves_from"),
        (F.col("saved_before") + F.col("saved")).alias("saved_from"),
    )
    last = sums.select(
        F.col("at").alias("to"),
        F.col("leaves_before").alias("leaves_to"),
        F.col("saved_before").alias("saved_to"),
    )
    chain = Window.partitionBy("from").orderBy(F.col("depth").desc())
    later = F.col("to") > F.col("from")
    placed = own.join(first, "from").join(last, "to")

    def total(name: str) -> Column:
        here = F.sum(f"own_{name}").over(chain)
        more = F.when(later, F.col(f"{name}_to") - F.col(f"{name}_from")).otherwise(0)
        return here + more

    return placed.select(
        "node",
        "parent",
        "depth",
        "conv_id",
        "n_convs",
        "n_children",
        total("leaves").alias("n_leaves"),
        total("saved").alias("saved_tokens"),
        "ends_sha256",
    )


# ---------------------------------------------------------------------------------------------
# The operator


def prefix_trie(sequences: DataFrame, rules: TrieRules = TrieRules()) -> DataFrame:
    """One row per node: ``conv_id``, its least member, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    ``sequences`` holds ``conv_id`` and ``turns`` as ``turn_sequences`` gives them, one row for each
    conversation; other columns are left out. A conversation without turns ends at the root. An
    empty table has no nodes. ``ends_sha256`` hashes the ids of the conversations that end at the
    node, in order, joined by commas. ``saved_tokens`` counts UTF-8 bytes.

    A task holds one block of distinct sequences; texts are never shuffled. The number of partial
    rows is that of blocks, times the turns that neighbours share.
    """
    chosen = take(sequences, conv_id="conv_id", turns="turns")
    distinct = distinct_sequences(chosen, rules)
    beside = _neighbours(distinct)
    shards = distinct.join(beside, F.col("shard") == F.col("of_shard")).select(
        "key", "n_ends", "first_conv", "ends_sha256", "shard", "before", "after"
    )
    n = max(1, distinct.select("shard").distinct().count())
    ordered = shards.repartitionByRange(n, "shard").sortWithinPartitions("shard", "key")
    nodes = stored(ordered.mapInArrow(_nodes(rules), _NODE), "nodes")
    partial = nodes.where("node IS NOT NULL")
    shared = stored(merged(partial), "merged")
    first = shared.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    whole = shared.join(first, F.col("parent") == F.col("above"), "left").select(
        *(F.col("above_conv").alias(c) if c == "parent_conv_id" else c for c in RESULT)
    )
    closed = nodes.where("node IS NULL")
    # a name is looked up once for each block, then the block's nodes take it from there
    in_block = partial.select("shard", "block", F.col("node").alias("parent")).join(
        first, F.col("parent") == F.col("above")
    )
    hanging = closed.where("parent IS NOT NULL").join(in_block, ["shard", "block", "parent"])
    hanging = hanging.select(
        *(F.col("above_conv").alias(c) if c == "parent_conv_id" else c for c in RESULT)
    )
    inner = closed.where("parent IS NULL").select(*RESULT)
    return whole.union(hanging).union(inner)
