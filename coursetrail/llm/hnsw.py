"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard, results merged.

Shards. Equal vectors become one node, with the k + 1 smallest ids it stands for (no more can be among the k nearest, the
query's own left out). Nodes are dealt by a hash into shards of about `shard_rows`, apart for each number of dimensions: a query
meets vectors of its own dimensions only. Every shard's graph is a row: vectors, and for each layer a
flat array of neighbours.

Graph. Layers are built from the top. Nodes enter a layer in batches, no larger than what is in it: a batch searches the layer
together, in step, and links to a diverse choice among what it finds and its own batch; links back are pruned by the
same rule. So that larger inner products mean nearer nodes, one component is added that gives all vectors of a shard
the same norm; queries have zero there.

Search. Blocks of queries go to every shard; layers are followed from the top, the lowest one with a list of `ef` best nodes.
The scores returned are inner products of the original vectors in double precision.

Defined results: vectors that are null, of zeros or without components, or hold null or non-finite components take no part,
neither as query nor as candidate; nor do rows with a null id. Rows repeated with one id and vector are one. Ties go to
the smaller id. With fewer candidates than k, all are returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coursetrail.session import stored

LINKS = 16  # of a node in upper layers; twice as many in the lowest
EF_BUILD = 64
EF_SEARCH = 96
AT_ONCE = 4  # nodes a query opens in one step
BATCH = 1024
SHARD_ROWS = 4096
QUERY_BLOCK = 256


# ---------------------------------------------------------------- graph


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, likenesses), best first, of up to ef nodes of one layer near each query; -1 where there are fewer."""
    count, width = len(queries), links.shape[1]
    rows = np.arange(count)[:, None]
    ids = np.full((count, ef), -1)
    like = np.full((count, ef), -np.inf, vectors.dtype)
    ids[:, 0], like[:, 0] = entry, np.einsum("qd,qd->q", vectors[entry], queries)
    seen = np.zeros((count, len(vectors) + 1), bool)  # the last place is for no node
    seen[np.arange(count), entry] = True
    seen[:, -1] = True
    opened = np.zeros((count, ef), bool)
    live = np.arange(count)
    while len(live):
        closed = opened[live] | (ids[live] < 0)
        # Lists are sorted, so the first ones that are not opened are the best.
        pick = np.argsort(closed, axis=1, kind="stable")[:, :AT_ONCE]
        fresh = ~np.take_along_axis(closed, pick, 1)
        some = fresh.any(axis=1)
        live, pick, fresh = live[some], pick[some], fresh[some]
        if not len(live):
            break
        own = live[:, None]
        opened[own, pick] = True
        at = np.where(fresh, ids[own, pick], -1)
        near = np.where(at[:, :, None] >= 0, links[at], -1).reshape(len(live), AT_ONCE * width)
        near = np.where(seen[own, near], -1, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[own, near] = True
        score = np.matmul(vectors[near], queries[live][:, :, None])[:, :, 0]
        score[near < 0] = -np.inf
        all_ids, all_like = np.concatenate((ids[live], near), 1), np.concatenate((like[live], score), 1)
        best = np.argpartition(-all_like, ef - 1, axis=1)[:, :ef]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_like, best, 1), axis=1, kind="stable"), 1)
        all_opened = np.concatenate((opened[live], np.zeros(near.shape, bool)), 1)
        ids[live], like[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_like, best, 1)
        opened[live] = np.take_along_axis(all_opened, best, 1)
        ids[live] = np.where(np.isinf(like[live]), -1, ids[live])
    return ids, like


def diverse(vectors: np.ndarray, ids: np.ndarray, like: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` of each row's candidates (sorted, best first): those nearer to the row's node than to any chosen one."""
    between = np.matmul(vectors[ids], vectors[ids].transpose(0, 2, 1))
    chosen, taken = np.zeros(ids.shape, bool), np.zeros(len(ids), np.int64)
    for j in range(ids.shape[1]):
        crowded = (chosen & (between[:, j] > like[:, j, None])).any(axis=1)
        chosen[:, j] = (ids[:, j] >= 0) & ~crowded & (taken < most)
        taken += chosen[:, j]
    # Places left over go to the best of the rest, so that no node stands apart.
    order = np.argsort(~chosen * 2 + (ids < 0), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1)


def _sorted(ids: np.ndarray, like: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-like, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(like, order, 1)


def _enter(vectors: np.ndarray, links: np.ndarray, new: np.ndarray, found: np.ndarray, like: np.ndarray) -> None:
    """Link the new nodes to what was found for them and to their batch, and back."""
    most = links.shape[1]
    within = vectors[new] @ vectors[new].T
    np.fill_diagonal(within, -np.inf)
    size = min(len(new), EF_BUILD)
    best = np.argpartition(-within, size - 1, axis=1)[:, :size]
    inner = np.where(np.isinf(np.take_along_axis(within, best, 1)), -1, new[best])
    ids, like = _sorted(np.concatenate((found, inner), 1), np.concatenate((like, np.take_along_axis(within, best, 1)), 1), EF_BUILD)
    chosen = diverse(vectors, np.where(np.isinf(like), -1, ids), like, most // 2)
    links[new, :chosen.shape[1]] = chosen
    back, to = chosen.ravel(), np.repeat(new, chosen.shape[1])
    back, to = back[back >= 0], to[back >= 0]
    order = np.argsort(back, kind="stable")
    back, to = back[order], to[order]
    nodes, first, count = np.unique(back, return_index=True, return_counts=True)
    for some in (slice(i, i + BATCH) for i in range(0, len(nodes), BATCH)):
        node, begin, n = nodes[some], first[some], count[some]
        wide = int(n.max())
        place = np.arange(wide)
        extra = np.where(place < n[:, None], to[np.minimum(begin[:, None] + place, len(to) - 1)], -1)
        every = np.concatenate((links[node], extra), 1)
        every = -np.sort(-every, axis=1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
        score = np.matmul(vectors[every], vectors[node][:, :, None])[:, :, 0]
        score[every < 0] = -np.inf
        ids, like = _sorted(every, score, 2 * EF_BUILD)
        kept = diverse(vectors, np.where(np.isinf(like), -1, ids), like, most)
        links[node] = -1
        links[node, :kept.shape[1]] = kept


def levels(count: int, seed: int) -> np.ndarray:
    """How many nodes are in each layer, from the lowest; nodes of higher layers come first."""
    drawn = np.floor(-np.log(1 - np.random.default_rng(seed).random(count)) / np.log(LINKS)).astype(int)
    return np.array([(drawn >= level).sum() for level in range(drawn.max(initial=0) + 1)])


def build(vectors: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Flat neighbour arrays of each layer, from the lowest; layer l holds the first of all vectors."""
    sizes, upper = levels(len(vectors), seed), []
    for level in range(len(sizes) - 1, -1, -1):
        size = int(sizes[level])
        links = np.full((size, LINKS * (1 if level else 2)), -1)
        mine, done = vectors[:size], 0
        while done < size:
            new = np.arange(done, min(size, done + max(1, min(BATCH, done or BATCH))))
            if done:
                entry = descend(vectors, upper, vectors[new])
                # Nodes of the layer above are in this one too, if they have entered it yet.
                found, like = beam(mine, links, mine[new], np.where(entry < done, entry, 0), EF_BUILD)
            else:
                found, like = np.full((len(new), 1), -1), np.full((len(new), 1), -np.inf, vectors.dtype)
            _enter(mine, links, new, found, like)
            done = int(new[-1]) + 1
        upper.append(links)
    return upper[::-1]


def descend(vectors: np.ndarray, upper: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """The nearest node that a search through the upper layers (the highest first) ends at."""
    entry = np.zeros(len(queries), np.int64)
    for links in upper:
        entry = beam(vectors[:len(links)], links, queries, entry, 4)[0][:, 0]
    return entry


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more component, so that all have the same norm."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    scale = np.sqrt(squares.max(initial=0)) or 1.0
    return (np.concatenate((vectors, extra[:, None]), 1) / scale).astype(np.float32)


# ---------------------------------------------------------------- shards


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


INDEX = "dims int, shard int, vectors binary, layers array<binary>, ids array<bigint>, owners array<int>"


def _index_rows(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    # Ascending order of ids first, then a fixed shuffle, so that a shard's graph does not hang on the order of rows.
    order = np.argsort([x[0] for x in rows["ids"]], kind="stable")
    order = order[np.random.default_rng(len(order)).permutation(len(order))]
    vectors, ids = vectors[order], [rows["ids"].iloc[i] for i in order]
    layers = build(lifted(vectors), seed=int(key[1]))
    return pd.DataFrame({
        "dims": [key[0]], "shard": [key[1]], "vectors": [vectors.astype("<f8").tobytes()],
        "layers": [[x.astype("<i4").tobytes() for x in layers]], "ids": [np.concatenate(ids)],
        "owners": [np.repeat(np.arange(len(ids)), list(map(len, ids))).astype(np.int32)]})


def index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Graphs of vectors (vec_id, embedding), a row for each shard."""
    nearest_ids = W.partitionBy("embedding").orderBy("vec_id")
    nodes = stored(vectors.distinct().withColumn("rank", F.row_number().over(nearest_ids)).where(F.col("rank") <= k + 1)
                   .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vector-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select("embedding", "ids", F.size("embedding").alias("dims"), F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard"))
    return stored(dealt.groupBy("dims", "shard").applyInPandas(_index_rows, INDEX), "vector-graphs")


def _searched(batches: Iterator[pa.RecordBatch], k: int, ef: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            dims = row["dims"].as_py()
            vectors = np.frombuffer(row["vectors"].as_buffer(), "<f8").reshape(-1, dims)
            layers = [np.frombuffer(x.as_buffer(), "<i4").reshape(-1, LINKS * (2 if level == 0 else 1)).astype(np.int64)
                      for level, x in enumerate(row["layers"].values)]
            ids, owners = row["ids"].values.to_numpy(), row["owners"].values.to_numpy()
            asked = row["queries"].values
            query_ids = asked.field("vec_id").to_numpy()
            queries = asked.field("embedding").flatten().to_numpy().reshape(-1, dims).astype(np.float64)
            high = lifted(vectors)
            norm = np.sqrt((queries ** 2).sum(axis=1, keepdims=True))
            flat = np.concatenate((queries / norm, np.zeros((len(queries), 1))), 1).astype(np.float32)
            found, _ = beam(high, layers[0], flat, descend(high, layers[:0:-1], flat), max(ef, k + 1))
            yield _nearest(query_ids, queries, vectors, found, ids, owners, k)


def _nearest(query_ids, queries, vectors, found, ids, owners, k) -> pa.RecordBatch:
    q, place = np.nonzero(found >= 0)
    node = found[q, place]
    score = (vectors[node] * queries[q]).sum(axis=1)
    first = np.searchsorted(owners, node)
    size = np.searchsorted(owners, node, side="right") - first
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    q, score, vec = np.repeat(q, size), np.repeat(score, size), ids[at]
    other = vec != query_ids[q]
    q, score, vec = q[other], score[other], vec[other]
    order = np.lexsort((vec, -score, q))
    q, score, vec = q[order], score[order], vec[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    top = rank < k
    return pa.record_batch({"query_id": pa.array(query_ids[q[top]], pa.int64()), "vec_id": pa.array(vec[top], pa.int64()), "score": pa.array(score[top])})


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, ef: int = EF_SEARCH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of vectors (vec_id, embedding) that is a query."""
    plain = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    valid = plain.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    graphs = index(valid, k, shard_rows)
    asked = valid.where(is_query).distinct().withColumn("dims", F.size("embedding"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    blocked = asked.groupBy("dims", block.alias("block")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    # A stated query set, in blocks, against every shard of its dimensions.
    shards = graphs.select("dims", "shard")
    pairs = blocked.join(shards, "dims").join(graphs, ["dims", "shard"])
    found = pairs.select("dims", "vectors", "layers", "ids", "owners", "queries").mapInArrow(
        lambda b: _searched(b, k, ef), "query_id bigint, vec_id bigint, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
