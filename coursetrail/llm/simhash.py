"""Near-duplicate documents by 64-bit majority fingerprints and a binary trie joined with itself.

Fingerprints. Words are runs of non-white-space; A-Z are lower-cased. Every run of `shingle`
words, repeats included, is hashed by XXH64 with seed 42; a bit of the fingerprint is 1 if it is
set in over half of the hashes. A shorter text is one shingle, a text without words (null, empty,
white space) has fingerprint zero and is linked like any other.

Links. Two fingerprints are linked at `budget` or fewer differing bits. The 64 bits are cut
into `budget + agree` blocks. Whatever the differing bits hit, `agree` blocks stay equal, so for
every choice of that many blocks a trie is built that has those blocks as its topmost levels.
In each trie, pairs of nodes are followed downwards together from equal topmost levels: the
differing bits add up, and a pair is given up as soon as they exceed the budget. No pair
within the budget is missed and nothing is capped.

Scale. Only distinct fingerprints take part, so exact copies cost nothing. With two agreeing blocks
a subtree is shared by about n / 2^21 of n fingerprints. A subtree with over `hot` fingerprints is
dealt out in parts, and pairs of parts go to different tasks. A task hands on at most one link for
each fingerprint it holds (a spanning forest), so links stay linear in the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursetrail.llm.components import connected
from coursetrail.llm.order import free_name, parts
from coursetrail.llm.words import pieces_of
from coursetrail.session import stored

SEED = 42
BITS = 64
PIECE = 1 << 15  # shingles whose bits are spread out at once
FRONT = 1 << 20  # node pairs followed at once


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[:len(words) - shingle + 1].tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), PIECE):
        raw = np.array(hashes[i:i + PIECE], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Every row of docs with its text replaced by fp, the fingerprint's bits as a signed long."""
    others = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField("fp", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64)
            yield pa.record_batch([batch.column(c) for c in others] + [pa.array(fps.view(np.int64))], names=[*others, "fp"])

    return docs.select(*others, "text").mapInArrow(rows, schema)


# ---------------------------------------------------------------- tries


def blocks(count: int) -> list[tuple[int, int]]:
    """(shift, width) of each block, the highest bits first."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(BITS - b, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def tries(budget: int, agree: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of agreeing blocks: the order of all blocks, and the bits of the topmost ones."""
    every = blocks(budget + agree)
    found = []
    for chosen in combinations(range(len(every)), agree):
        top = [every[i] for i in chosen]
        found.append((top + [b for i, b in enumerate(every) if i not in chosen], sum(w for _, w in top)))
    return found


def turned(fps: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """Fingerprints with their blocks in another order; differing bits stay as many."""
    out = np.zeros_like(fps)
    for shift, width in order:
        out = (out << np.uint64(width)) | ((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    return out


def _split(sorted_fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Where the nodes lo..hi, which agree above the bit, pass from 0 to 1 in it."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        middle = (lo + hi) >> 1
        one = ((sorted_fps[np.minimum(middle, len(sorted_fps) - 1)] >> bit) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, middle, hi)
        lo = np.where(open_ & ~one, middle + 1, lo)


def joined(sorted_fps: np.ndarray, first: tuple[np.ndarray, ...], level: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked fingerprints below the given node pairs (lo1, hi1, lo2, hi2), which agree above `level`.

    A node is a range of the sorted fingerprints. Pairs go down one bit at a time; pairs of few
    fingerprints are finished by comparing whole values.
    """
    zero = np.zeros(len(first[0]), np.int64)
    stack = [(level, *first, zero)]
    while stack:
        bit, a, b, c, d, diff = stack.pop()
        if not len(a):
            continue
        if len(a) > FRONT:
            half = len(a) // 2
            stack.append((bit, *(x[:half] for x in (a, b, c, d, diff))))
            stack.append((bit, *(x[half:] for x in (a, b, c, d, diff))))
            continue
        n1, n2 = b - a, d - c
        small = (n1 * n2 <= 16) if bit >= 0 else np.ones(len(a), bool)
        if small.any():
            p, q = _products(a[small], n1[small], c[small], n2[small])
            near = (p < q) & (np.bitwise_count(sorted_fps[p] ^ sorted_fps[q]) <= budget)
            yield p[near], q[near]
            a, b, c, d, diff = (x[~small] for x in (a, b, c, d, diff))
            if not len(a):
                continue
        at = np.full(len(a), bit, np.uint64)
        m, n, same = _split(sorted_fps, a, b, at), _split(sorted_fps, c, d, at), a == c
        children = ((a, m, c, n, diff, slice(None)), (m, b, n, d, diff, slice(None)),
                    (a, m, n, d, diff + 1, slice(None)), (m, b, c, n, diff + 1, ~same))
        kept = []
        for w, x, y, z, s, which in children:
            w, x, y, z, s = (v[which] for v in (w, x, y, z, s))
            live = (w < x) & (y < z) & (s <= budget) & ~((w == y) & (x - w < 2))
            kept.append(tuple(v[live] for v in (w, x, y, z, s)))
        stack.append((bit - 1, *(np.concatenate(v) for v in zip(*kept, strict=True))))


def _products(a: np.ndarray, n1: np.ndarray, c: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = n1 * n2
    pair = np.repeat(np.arange(len(a)), counts)
    k = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return a[pair] + k // n2[pair], c[pair] + k % n2[pair]


def forest(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position that each position reaches by the pairs."""
    root = np.arange(count)
    for p, q in pairs:
        while len(p):
            x, y = root[p], root[q]
            differ = x != y
            p, q, x, y = p[differ], q[differ], x[differ], y[differ]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (above := root[root]).tobytes() != root.tobytes():
                root = above
    return root


def linked(fps: DataFrame, budget: int = 4, agree: int = 2, hot: int = 4096) -> DataFrame:
    """Links (a, b) among the distinct values of column fp; they join what the budget joins, directly or over others."""
    plan = tries(budget, agree)
    distinct = fps.select("fp").where("fp is not null").distinct()
    keys = [_key(F.col("fp"), order, top) for order, top in plan]
    dealt = stored(distinct.select("fp", F.posexplode(F.array(*keys)).alias("trie", "key")), "tries")
    sizes = dealt.groupBy("trie", "key").count()
    # A node with one fingerprint has no partner, so only shared ones go on.
    nodes = (dealt.join(sizes.where("count > 1"), ["trie", "key"])
             .withColumn("shares", F.ceil(F.col("count") / hot).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, shares - 1)")))
             .select("trie", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp"))
    group = ["trie", "key", "i", "j"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for trie, values, starts, sides in _groups(batches):
            yield _links(values, starts, sides, plan[trie], budget)

    return (nodes.repartition(parts(fps), *group).sortWithinPartitions(*group)
            .mapInArrow(rows, "a bigint, b bigint").distinct())


def _key(fp: Column, order: list[tuple[int, int]], top: int) -> Column:
    """The topmost bits of a trie as a number."""
    key, width = F.lit(0).cast("bigint"), 0
    for shift, w in order:
        if width < top:
            key = F.shiftleft(key, w).bitwiseOR(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << w) - 1)))
            width += w
    return key


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole groups of sorted rows, many at a time, each time of one trie: (trie, fps, starts of groups, parts)."""
    names, rest = ("trie", "key", "i", "j", "own", "fp"), None
    for batch in _and_end(batches):
        if batch is not None:
            now = [np.asarray(batch.column(n)).astype(np.int64) for n in names]
            rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if rest is None or not len(rest[0]):
            continue
        t, k, i, j, _, _ = rest
        new = np.flatnonzero((np.diff(t) != 0) | (np.diff(k) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        starts = np.concatenate(([0], new))
        if batch is not None:
            done = [x[:starts[-1]] for x in rest]
            rest = [x[starts[-1]:] for x in rest]
            starts = starts[:-1]
        else:
            done = rest
        for trie in np.unique(done[0]):
            mine = done[0] == trie
            first = np.flatnonzero(mine)[0] if mine.any() else 0
            yield int(trie), done[5][mine].view(np.uint64), starts[mine[starts]] - first, np.where(
                (done[2] == done[3])[mine], 0, np.where((done[4] == done[2])[mine], 1, 2))


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _links(values: np.ndarray, starts: np.ndarray, sides: np.ndarray, trie: tuple, budget: int) -> pa.RecordBatch:
    """Links of one trie's groups. Side 0: join the group with itself; 1 and 2: one part with the other."""
    order, top = trie
    number = np.searchsorted(starts, np.arange(len(values)), side="right") - 1
    turn = turned(values, order)
    by = np.lexsort((turn, sides, number))
    fps, number, sides = turn[by], number[by], sides[by]
    cuts = np.concatenate(([0], np.flatnonzero((np.diff(number) != 0) | (np.diff(sides) != 0)) + 1, [len(fps)]))
    lo, hi, side, group = cuts[:-1], cuts[1:], sides[cuts[:-1]], number[cuts[:-1]]
    own = (side == 0) & (hi - lo > 1)
    two = np.flatnonzero((side[:-1] == 1) & (side[1:] == 2) & (group[:-1] == group[1:]))
    first = (np.concatenate((lo[own], lo[two])), np.concatenate((hi[own], hi[two])),
             np.concatenate((lo[own], lo[two + 1])), np.concatenate((hi[own], hi[two + 1])))
    root = forest(len(fps), joined(fps, first, BITS - top - 1, budget))
    moved = np.flatnonzero(root != np.arange(len(fps)))
    original = values[by].view(np.int64)
    return pa.record_batch({"a": pa.array(original[moved]), "b": pa.array(original[root[moved]])})


# ---------------------------------------------------------------- documents


def classes(fps: DataFrame, budget: int = 4) -> DataFrame:
    """(fp, root) for every distinct fingerprint: the least fingerprint that it reaches over links."""
    roots = stored(connected(linked(fps, budget)), "roots")
    distinct = fps.select("fp").distinct()
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs (doc_id, text).

    fingerprint: 16 hex digits. component_id: the smallest doc_id among the documents reachable over
    links, itself included. Rows repeated with one doc_id each get a row. Rows with a null doc_id take part; their
    component_id is the smallest doc_id reachable, null if there is none. Other columns play no part.
    """
    every = stored(fingerprints(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), shingle), "fingerprints")
    smallest = every.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = classes(every, budget).join(smallest, "fp")
    least = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    class_of = groups.join(least, "root").select("fp", "component_id")
    return every.join(class_of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """docs with one row of each class: that with the smallest doc_id (a null one counts as largest), then the smallest
    hash of its text; of rows repeated with one id and text, one."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    every = stored(fingerprints(slim, shingle), "fingerprints")
    first = every.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = classes(every, budget).join(first, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    return rows_chosen(docs, chosen)


def rows_chosen(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of docs with a doc_id and text of chosen (doc_id, text_hash), each once."""
    keyed = docs.withColumn(name := free_name(docs, "text_hash"), F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(chosen["doc_id"]) & (keyed[name] == chosen["text_hash"])
    return keyed.join(chosen, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
