"""Exact top-k search by inner product with a KD-tree for each shard.

Rows are dealt evenly to shards. A shard's tree splits at the median of its widest dimension and
keeps the tight bounding box of every node. The largest inner product that a query can have with
anything in a box comes from the box's corners, so nodes are visited best bound first, and the
visit ends when no box can reach the query's k-th score. Queries travel in blocks: each goes to one
shard first, and the k-th score it finds there goes along to all others.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from publicspend.llm.common import stored, take

#: Sums of whole numbers below this are exact in double precision.
EXACT = 2.0**53
LONG = 2**63 - 1


@dataclass(frozen=True)
class SearchRules:
    """``k`` results; rows in a shard, in a leaf and in a block of queries."""

    k: int = 5
    shard: int = 8192
    leaf: int = 64
    block: int = 256


@dataclass
class Tree:
    """Vectors in leaf order; a node's box, its range of vectors and its children, -1 in leaves."""

    rows: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    spans: np.ndarray

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.__dataclass_fields__}

    @classmethod
    def unpacked(cls, row: dict, width: int) -> Tree:
        def of(name: str, kind: type, columns: int) -> np.ndarray:
            return np.frombuffer(row[name], kind).reshape(-1, columns)

        return cls(
            np.frombuffer(row["rows"], np.int64),
            np.frombuffer(row["ids"], np.int64),
            of("vectors", np.float64, width),
            of("low", np.float64, width),
            of("high", np.float64, width),
            of("spans", np.int64, 4),
        )


def build(rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, leaf: int) -> Tree:
    """A tree over all given vectors, parents before children."""
    order = np.arange(len(vectors))
    low, high, spans = [], [], []
    waiting = [(0, len(vectors), -1, 0)]
    while waiting:
        start, stop, parent, side = waiting.pop()
        part = vectors[order[start:stop]]
        number = len(spans)
        if parent >= 0:
            spans[parent][2 + side] = number
        low.append(part.min(axis=0))
        high.append(part.max(axis=0))
        spans.append([start, stop, -1, -1])
        extent = high[-1] - low[-1]
        if stop - start > leaf and extent.max(initial=0) > 0:
            middle = (stop - start) // 2
            widest = int(extent.argmax())
            order[start:stop] = order[start:stop][np.argpartition(part[:, widest], middle)]
            waiting += [(start, start + middle, number, 0), (start + middle, stop, number, 1)]
    return Tree(
        rows[order], ids[order], vectors[order], np.array(low), np.array(high), np.array(spans)
    )


def search(
    tree: Tree, query: np.ndarray, row: int, bounds: np.ndarray, known: float, k: int, exact: bool
) -> list[tuple[int, int, int]]:
    """The tree's best (score, -id, -row) for a query, none below ``known``, its k-th so far."""
    best: list[tuple[int, int, int]] = []
    waiting = [(-bounds[0], 0)]
    while waiting:
        bound, node = heapq.heappop(waiting)
        least = max(known, best[0][0]) if len(best) == k else known
        if -bound < least:
            break
        start, stop, left, right = tree.spans[node]
        if left >= 0:
            for child in (left, right):
                if bounds[child] >= least:
                    heapq.heappush(waiting, (-bounds[child], child))
            continue
        if exact:
            scores = tree.vectors[start:stop] @ query
        else:
            scores = np.array([_whole(v, query) for v in tree.vectors[start:stop]], object)
        for i in np.flatnonzero(scores >= least):
            if tree.rows[start + i] == row:
                continue
            found = (int(scores[i]), -int(tree.ids[start + i]), -int(tree.rows[start + i]))
            if len(best) < k:
                heapq.heappush(best, found)
            elif found > best[0]:
                heapq.heapreplace(best, found)
    return best


def _whole(a: np.ndarray, b: np.ndarray) -> int:
    total = sum(int(x) * int(y) for x, y in zip(a, b, strict=True))
    return max(-LONG - 1, min(LONG, total))


def search_block(tree: Tree, block: dict, k: int) -> list[tuple[int, int, int, int, int]]:
    """(row, id, score, of vector id, of row) for each query of a block."""
    rows, ids = np.frombuffer(block["rows"], np.int64), np.frombuffer(block["ids"], np.int64)
    queries = np.frombuffer(block["vectors"], np.float64).reshape(len(rows), -1)
    known = np.frombuffer(block["known"], np.float64) if block["known"] else None
    bounds = np.maximum(queries, 0) @ tree.high.T + np.minimum(queries, 0) @ tree.low.T
    reach = np.abs(queries).max(initial=0) * np.abs(tree.vectors).max(initial=0)
    exact = reach * max(1, queries.shape[1]) < EXACT
    if not exact:  # rounding must not make a bound too small
        bounds = bounds + np.abs(bounds) * 1e-9 + reach * queries.shape[1] * 1e-12
    out = []
    for i in range(len(rows)):
        least = -np.inf if known is None else known[i]
        for score, vec_id, row in search(tree, queries[i], rows[i], bounds[i], least, k, exact):
            out.append((int(rows[i]), int(ids[i]), score, -vec_id, -row))
    return out


def _whole_matrix(part: pd.DataFrame) -> np.ndarray:
    return np.floor(np.stack([np.asarray(v, np.float64) for v in part["vector"]]))


PACKED = "width int, block bigint, rows binary, ids binary, vectors binary"
FOUND = "query_row bigint, query_id bigint, score bigint, vec_id bigint, row bigint"


def _trees(vectors: DataFrame, rules: SearchRules) -> DataFrame:
    leaf = rules.leaf

    def run(part: pd.DataFrame) -> pd.DataFrame:
        tree = build(
            part["row"].to_numpy(), part["vec_id"].to_numpy(), _whole_matrix(part), leaf
        ).packed()
        return pd.DataFrame(
            [{"width": part["width"].iloc[0], "shard": part["shard"].iloc[0], "block": -1, **tree}]
        )

    schema = PACKED + ", low binary, high binary, spans binary, shard bigint"
    return vectors.groupBy("width", "shard").applyInPandas(run, schema)


def _blocks(queries: DataFrame) -> DataFrame:
    def run(part: pd.DataFrame) -> pd.DataFrame:
        packed = {
            "width": part["width"].iloc[0],
            "block": part["block"].iloc[0],
            "rows": part["row"].to_numpy().tobytes(),
            "ids": part["vec_id"].to_numpy().tobytes(),
            "vectors": _whole_matrix(part).tobytes(),
        }
        return pd.DataFrame([packed])

    return queries.groupBy("width", "block").applyInPandas(run, PACKED)


def _visits(trees: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Every block's results in the shards it visits.

    A task sees a shard's tree, then the blocks that visit it, one by one.
    """
    both = trees.unionByName(visits, allowMissingColumns=True)
    if "known" not in both.columns:
        both = both.withColumn("known", F.lit(None).cast("binary"))
    dealt = both.repartition("width", "shard").sortWithinPartitions("width", "shard", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, kind = None, pa.int64()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] < 0:
                    tree = Tree.unpacked(row, row["width"])
                    continue
                found = search_block(tree, row, k)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c in zip(*found, strict=True)],
                        ["query_row", "query_id", "score", "vec_id", "row"],
                    )

    return dealt.mapInArrow(run, FOUND)


def _known_scores(found: DataFrame, blocks: DataFrame, order: DataFrame, k: int) -> DataFrame:
    """The blocks with each query's k-th score so far, or minus infinity, in the block's order."""
    kth = found.groupBy("query_row").agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("kth")
    )
    each = order.join(kth, order["row"] == kth["query_row"], "left").select(
        "width", "block", F.struct("row", F.coalesce("kth", F.lit(float("-inf")))).alias("kth")
    )
    lists = each.groupBy("width", "block").agg(F.collect_list("kth").alias("scores"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = []
            for rows, scores in zip(
                batch.column("rows").to_pylist(), batch.column("scores").to_pylist(), strict=True
            ):
                of = {s["row"]: s["col2"] for s in scores}
                order = np.frombuffer(rows, np.int64).tolist()
                known.append(np.array([of[r] for r in order], np.float64).tobytes())
            yield batch.drop_columns(["scores"]).append_column("known", pa.array(known, pa.binary()))

    joined = blocks.join(lists, ["width", "block"]).select(*blocks.columns, "scores")
    return joined.mapInArrow(run, PACKED + ", known binary")


def scaled_vector(values: Column) -> Column:
    """Every component times 256, as doubles; null if any is null or not finite, or none is there."""
    scaled = F.transform(values.cast("array<double>"), lambda x: x * 256)
    limit = F.lit(float("inf"))
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit))
    return F.when(~bad & (F.size(scaled) > 0), scaled)


def top_k(
    table: DataFrame,
    is_query: Column,
    rules: SearchRules = SearchRules(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k best rows for each query.

    Components count as floor(256 x); scores are whole numbers, held within 64 bits. Ties go to
    the smaller id. A query's own row is no result, another row with its id is. Rows with a null
    id, a null or empty vector, or a component that is null or not finite take no part. Vectors
    of different lengths do not meet. ``is_query`` is a condition on ``vec_id``. Other columns are
    left out.
    """
    rows = take(table, vec_id=id_column, vector=vector_column).where("vec_id IS NOT NULL")
    scaled = rows.withColumn("vector", scaled_vector(F.col("vector"))).where("vector IS NOT NULL")
    vectors = stored(
        scaled.withColumns({"width": F.size("vector"), "row": F.monotonically_increasing_id()}),
        "vectors",
    )
    counts = vectors.groupBy("width").agg(
        F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("n_queries")
    )
    parts = counts.select(
        "width",
        F.ceil(F.col("n") / rules.shard).cast("bigint").alias("shards"),
        F.ceil(F.col("n_queries") / rules.block).cast("bigint").alias("blocks"),
    )
    sized = vectors.join(parts, "width")
    # dealt by row number, so that rows alike do not meet in one shard
    in_shards = sized.withColumn("shard", F.pmod(F.xxhash64("row"), "shards"))
    trees = stored(_trees(in_shards, rules), "trees")
    queries = stored(
        sized.where(is_query).withColumn("block", F.pmod(F.xxhash64("row"), "blocks")), "queries"
    )
    blocks = stored(_blocks(queries).drop("shard"), "blocks")
    home = F.pmod("block", "shards").alias("shard")
    homes = blocks.join(parts, "width").select(*blocks.columns, home)
    first = stored(_visits(trees, homes, rules.k), "first_visits")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard")
    informed = _known_scores(first, blocks, queries, rules.k)
    others = (
        informed.join(parts, "width")
        .select(*informed.columns, "shards", every)
        .where(F.col("shard") != F.pmod("block", "shards"))
        .drop("shards")
    )
    found = first.union(_visits(trees, others, rules.k))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("row"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
