"""The trie against one of Python dicts, with blocks and shards of many sizes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from publicspend.llm import prefix_trie
from publicspend.llm.prefix_trie import TernaryTree, TrieRules

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            code = hashlib.sha256(f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), code, said))
    turns = {conv: [said for *_, said in sorted(found)] for conv, found in own.items()}
    out = {}
    for conv, said in turns.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = turns.get(conv - conv % 5, [])[:h] + said[h:]
    return out


def expected(sequences):
    members = defaultdict(list)
    ends = defaultdict(list)
    for conv, turns in sorted(sequences.items()):
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
        ends[tuple(turns)].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        children[node[:-1]] += bool(node)
    for node, convs in members.items():
        size = len(node[-1][1].encode()) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(convs) - 1) * size
    return sorted(
        (
            (
                convs[0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(convs),
                children[node],
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
            )
            for node, convs in members.items()
        ),
        key=repr,
    )


def conversations(rng, n=160, vocabulary=3):
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 11)):
            rows.append((conv, turn, rng.choice(["user", "bot"]), rng.choice("aé日")[:vocabulary] * rng.randrange(2)))
    copies = [(conv, t, "user", f"copy {t}") for conv in range(1000, 1060) for t in range(12)]
    long = [(5000 + i, t, "user", f"long {t if t < 90 else (t, i)}") for i in range(3) for t in range(100)]
    odd = [
        (None, 0, "user", "nobody"),
        (2001, None, None, None),
        (2001, 3, "", ""),
        (2001, 3, "user", None),
        (2001, 3, "user", None),
        (2002, 1, "ab", "c"),
        (2003, 1, "a", "bc"),
        (2**40 + 3, 0, "user", "only"),
        (-7, 0, "user", "below"),
        (-7, 1, "user", "zero"),
    ]
    rows += copies + long + odd
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rules",
    [
        TrieRules(),
        TrieRules(block_sequences=1, shard_sequences=7),
        TrieRules(block_sequences=3, shard_sequences=40),
        TrieRules(block_bytes=400, shard_sequences=1000),
    ],
)
def test_nodes(spark, rules):
    rows = conversations(random.Random(4))
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, turns string, depth int")
    turns = prefix_trie.branched(prefix_trie.turn_sequences(given.repartition(4)))
    nodes = prefix_trie.prefix_trie(turns, rules)
    found = sorted((tuple(row) for row in nodes.collect()), key=repr)
    assert found == expected(rebuilt(rows))
    assert [kind for _, kind in nodes.dtypes] == ["bigint"] * 7 + ["string"]


def test_few_sequences(spark):
    for rows in ([], [(None, 1, "a", "b")], [(5, 0, "a", "b")], [(1, 0, "a", "b"), (2, 0, "a", "b")]):
        given = spark.createDataFrame(rows, SCHEMA)
        turns = prefix_trie.branched(prefix_trie.turn_sequences(given))
        found = [tuple(row) for row in prefix_trie.prefix_trie(turns).collect()]
        wanted = expected(rebuilt(rows)) if any(r[0] is not None for r in rows) else []
        assert sorted(found, key=repr) == wanted


def test_median_insertion_balances_siblings():
    tree = TernaryTree.of_sorted([[i] for i in range(1023)])

    def depth(node):
        return 0 if not node else 1 + max(depth(tree.less[node]), depth(tree.more[node]))

    assert depth(tree.below[0]) == 10
    walked = [tree.turn[node] for node, *_ in tree.post_order()]
    assert walked == [*range(1023), -1]
