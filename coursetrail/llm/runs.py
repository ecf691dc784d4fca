"""Periodic runs in documents: stretches of words that repeat with a period, at least four times.

Runs are found from Lyndon words. In every run, under the order of words or under its reverse, each place where the run's least rotation
starts has that rotation as its longest Lyndon word (a text's end counts as smaller than any word in both orders). Four
repetitions hold three such places in a row, so a place i whose longest Lyndon word has length q, with the same at i + q, is a
candidate (i, q), and its run is as far as words q apart stay equal, to either side: longest common extensions, found by comparing
blocks of doubling size. Each run comes from one candidate chain or two.

Lyndon arrays. The first phase of Baier's suffix sorter gives them directly, without the suffix array. Places are grouped by a prefix
that is a Lyndon word, at first by their word; groups are taken from the highest to the lowest. When a group is taken, the
prefix u of its places is their longest Lyndon word. Each of them looks for the nearest place before it that has not been taken yet; that one's
prefix ends where u begins, or where the first of several u in a row begins, and grows by these. Places of a group that grew part from it
and stand above it, those that grew by more copies higher. Places taken are passed over by path halving.

What cannot be in a run is set aside first: a word of a run stands in it four times or more, so a word found fewer times in a stretch of the text
parts the stretch, and what is shorter than six words goes; again, until nothing changes. This is exact, and leaves little of plain prose.

Documents may be folded for the query (`folded`): their later words repeat with a period given by the id.

Scale. There is no shuffle; documents are cut into batches by size, and a document is one task's work, in time linear in its
words but for the sorting of what grew together.

Defined results. A null or empty text has no words and no runs. A null id folds nothing. Repeated rows get equal results. A very long text is a
batch of its own. An empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.llm.words import coded, pieces_of, ranges

REPEATS = 4
LEAST = 6  # words of a run
SPACE = pa.scalar(" ", pa.large_string())


# ---------------------------------------------------------------- Lyndon arrays


def lyndon(words: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place; words are numbers in their order, the end is the least.

    Number 0 parts texts: it is below all words, and its own entries mean nothing.
    """
    kinds = sorted(set(words))
    rank = {word: g for g, word in enumerate(kinds)}
    group_of = [rank[word] for word in words]
    members: list[list[int]] = [[] for _ in kinds]
    for i, g in enumerate(group_of):
        members[g].append(i)
    length = [1] * len(words)
    lower, upper = list(range(-1, len(kinds) - 1)), [*range(1, len(kinds)), -1]
    left = list(range(len(words) + 1))  # left[i + 1]: i + 1, or nearer to the nearest place that is not taken, once i is taken
    top = len(kinds) - 1
    while top >= 0 and (top or kinds[0]):
        taken = [i for i in members[top] if group_of[i] == top]
        grown: dict[int, int] = {}
        for i in taken:
            left[i + 1] = i
        for i in taken:
            while left[i] != i:
                left[i] = left[left[i]]
                i = left[i]
            if i and words[i - 1]:
                grown[i - 1] = grown.get(i - 1, 0) + 1
        if grown:
            size = length[taken[0]]
            parted: dict[tuple[int, int], list[int]] = {}
            for j, copies in grown.items():
                length[j] += copies * size
                parted.setdefault((group_of[j], copies), []).append(j)
            below = old = -1
            for key in sorted(parted):
                if key[0] != old:
                    below = old = key[0]
                new, above = len(members), upper[below]
                members.append(parted[key])
                for j in parted[key]:
                    group_of[j] = new
                lower.append(below)
                upper.append(above)
                upper[below] = lower[above] = new  # what is above is the group in hand at most
                below = new
        members[top] = []
        top = lower[top]
    return length


# ---------------------------------------------------------------- runs


def crowded(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the stretches, within texts, in which every word stands four times or more; all runs lie in them."""
    begin, end = offsets[:-1], offsets[1:]
    kinds = int(codes.max(initial=0)) + 1
    while True:
        long = end - begin >= LEAST
        begin, end = begin[long], end[long]
        if not len(begin):
            return begin, end
        at, stretch = ranges(begin, end - begin), np.repeat(np.arange(len(begin)), end - begin)
        _, which, counts = np.unique(stretch * kinds + codes[at], return_inverse=True, return_counts=True)
        often = counts[which] >= REPEATS
        if often.all():
            return begin, end
        at, stretch = at[often], stretch[often]
        if not len(at):
            return at, at
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(stretch) > 0)) + 1
        begin, end = at[np.concatenate(([0], cut))], at[np.concatenate((cut - 1, [len(at) - 1]))] + 1


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values agree from the start, of two arrays of one size; looked at in blocks of doubling size."""
    done, block = 0, 32
    while done < len(a):
        same = a[done:done + block] == b[done:done + block]
        if not same.all():
            return done + int(same.argmin())
        done, block = done + block, block * 2
    return len(a)


def _runs(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of some stretches of the codes."""
    sizes = end - begin
    first = np.cumsum(sizes + 1) - sizes - 1  # of each stretch in `flat`, where a 0 follows it
    flat = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    inner = ranges(first, sizes)
    _, words = np.unique(codes[ranges(begin, sizes)], return_inverse=True)
    found: set[tuple[int, int, int]] = set()
    for order in (words + 1, words.max() + 1 - words):
        flat[inner] = order
        length = np.array(lyndon(flat.tolist()))
        size = length[inner]
        ahead = np.minimum(inner + size, len(flat) - 1)
        again = (length[ahead] == size) & (flat[ahead] == flat[inner])
        seen: dict[int, int] = {}  # where the last stretch of a period stops
        for i, q in zip(inner[again].tolist(), size[again].tolist(), strict=True):
            if i + q < seen.get(q, 0):
                continue
            k = int(np.searchsorted(first, i, side="right")) - 1
            lo, hi = int(first[k]), int(first[k] + sizes[k])
            stop = i + q + _common(flat[i:hi - q], flat[i + q:hi])
            seen[q] = stop
            start = i - _common(flat[lo:i][::-1], flat[lo + q:i + q][::-1])
            if stop - start >= max(LEAST, REPEATS * q):
                found.add((int(begin[k]) + start - lo, stop - start, q))
    return found


def runs(codes: np.ndarray, offsets: np.ndarray, batch: int = 1 << 16) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, in order; text i has the codes from offsets[i] to offsets[i + 1]."""
    begin, end = crowded(codes, offsets)
    found: list[list[tuple[int, int, int]]] = [[] for _ in offsets[1:]]
    ends = np.cumsum(end - begin)
    at = 0
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + batch)))
        every = sorted(_runs(codes, begin[at:stop], end[at:stop]))
        for (start, length, period), row in zip(every, np.searchsorted(offsets, [r[0] for r in every], side="right") - 1, strict=True):
            found[row].append((start - int(offsets[row]), length, period))
        at = stop
    return found


def summary(found: list[tuple[int, int, int]]) -> tuple:
    """(n_runs, start, length, period, exponent in thousandths, SHA-256 of all) of a text's runs; the run of most repetitions, then the first."""
    written = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = s, n, q
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(written.encode()).hexdigest())


# ---------------------------------------------------------------- documents


def folded(offsets: np.ndarray, ids: list[int | None]) -> np.ndarray:
    """The place each word is taken from, for texts whose id's CRC-32 says that their later words repeat."""
    at = np.arange(int(offsets[-1]))
    for row, doc_id in enumerate(ids):
        first, n = int(offsets[row]), int(offsets[row + 1] - offsets[row])
        number = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if number % 10 or not n:
            continue
        g = number // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[first + a:first + n] = first + a + np.arange(n - a) % p
    return at


RESULT = ("doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
          "n_dropped bigint, collapsed_sha256 string")


def periodic_runs(docs: DataFrame, fold: bool = True) -> DataFrame:
    """The runs of every row of docs (doc_id, text): their number, the one of most repetitions, digests of all of them and of the
    text without repeats. A word goes if a run holds it after that run's first period. With `fold`, texts are folded first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            offsets, codes, distinct = coded(batch.column("text"))
            if fold:
                codes = codes[folded(offsets, ids)]
            every = runs(codes, offsets)
            change = np.zeros(len(codes) + 1, np.int32)
            for first, found in zip(offsets.tolist(), every, strict=False):
                for s, n, q in found:
                    change[first + s + q] += 1
                    change[first + s + n] -= 1
            stay = np.cumsum(change[:-1]) == 0
            kept = np.concatenate(([0], np.cumsum(stay)))[offsets]
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(kept), distinct.take(pa.array(codes[stay]))), SPACE)
            digests = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in joined.cast(pa.large_binary())]
            columns = list(zip(*map(summary, every), strict=True))
            kinds = [pa.int64()] * 5 + [pa.string()]
            words = np.diff(offsets)
            yield pa.record_batch([batch.column("doc_id"), pa.array(words), *map(pa.array, columns, kinds), pa.array(words - np.diff(kept)), pa.array(digests)],
                                  names=[c.split()[0] for c in RESULT.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(rows, RESULT)
