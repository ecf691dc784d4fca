"""Quartile bucket digests of documents, and how alike two of them are.

Digest. Every window of five bytes gives six byte triplets that hold its newest byte. Each is hashed into one of 128
buckets and counted. A bucket is written as 0 to 3, by the quartile of all counts it is in; before the buckets
stands the logarithm of the length, and how far the lower quartiles lie below the upper one. So
one moved or changed passage changes few buckets, whatever its place. Shorter texts are filled up with
zero bytes to one window; the empty text has no triplets.

Difference score. Differing buckets add 1, 2 or, from end to end, 6; differing length codes and quartile ratios add
their distance, each at most `HEADER`. The sum is held within 0 and `WORST`; likeness is 1 less its share of `WORST`.

Defined results: a null text is the empty one. Next document: ascending doc_id, null ids first, rows
repeated with one id by their texts; the last one's is the first, the only one's itself. An empty table gives an empty
result. Work per row is bounded by the text; a long text is counted piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.llm.order import boundaries, parts, range_of

BUCKETS = 128
WINDOW = 5
PIECE = 1 << 20
HEADER = 24
WORST = 320
#: Triplets of a window by the distance of their bytes from its newest one, each with its own odd factors.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4), (0, 1, 4), (0, 3, 4))
FACTORS = np.array([[0x9E3779B1 + 2 * (31 * k + 7 * j) * 0x10001 for j in range(3)] for k in range(len(TRIPLETS))], np.uint64).astype(np.uint32)


def counts(data: bytes) -> np.ndarray:
    """Triplets in each bucket."""
    found = np.zeros(BUCKETS, np.int64)
    if not data:
        return found
    data = data.ljust(WINDOW, b"\0")
    for at in range(0, len(data) - WINDOW + 1, PIECE):
        raw = np.frombuffer(data, np.uint8, min(PIECE + WINDOW - 1, len(data) - at), at).astype(np.uint32)
        n = len(raw) - WINDOW + 1
        byte = [raw[WINDOW - 1 - back:WINDOW - 1 - back + n] for back in range(WINDOW)]
        for places, (x, y, z) in zip(TRIPLETS, FACTORS, strict=True):
            mixed = byte[places[0]] * x + byte[places[1]] * y + byte[places[2]] * z
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            found += np.bincount(mixed >> np.uint32(25), minlength=BUCKETS)
    return found


def digest(text: str) -> np.ndarray:
    """Length code, two quartile ratios and the buckets' quartiles, as small numbers."""
    data = text.encode()
    found = counts(data)
    q1, q2, q3 = np.sort(found)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    head = [min(255, int(8 * log(1 + len(data)))), 16 * q1 // max(q3, 1), 16 * q2 // max(q3, 1)]
    return np.concatenate((head, (found > q1).astype(np.int64) + (found > q2) + (found > q3))).astype(np.uint8)


def written(code: np.ndarray) -> str:
    """A digest as hex digits: the three numbers, then four buckets a byte."""
    four = code[3:].reshape(-1, 4)
    return (bytes(code[:3]) + (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()).hex()


def difference(a: np.ndarray, b: np.ndarray) -> int:
    apart = np.abs(a.astype(np.int64) - b)
    buckets = apart[3:]
    return min(WORST, int(buckets.sum() + 3 * (buckets == 3).sum() + np.minimum(apart[:3], HEADER).sum()))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1 - difference(a, b) / WORST


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, tail, doc_id, text); a part's tail row is only there to follow its last document."""
    before = None
    for batch in batches:
        out: list[tuple] = []
        for part, tail, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text")), strict=True):
            if tail and (before is None or before[0] != part):
                continue  # of several tail rows the first one follows
            code = digest(text)
            if before is not None and before[0] == part:
                _, last_id, last_text, last_code = before
                change = edited(last_text, text)
                change_code = digest(change)
                out.append((last_id, len(last_text), hashlib.sha256(change.encode()).hexdigest(), written(last_code),
                            written(change_code), likeness(last_code, change_code), likeness(last_code, code)))
            before = None if tail else (part, doc_id, text, code)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def digests(docs: DataFrame) -> DataFrame:
    """For every row of docs (doc_id, text): its digest, its edited text's, and their likeness; see SCHEMA.

    Texts are shuffled once, into ranges of doc_id. The first row of each range is also sent to the range before.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = slim.select("doc_id")
    bounds = boundaries(keys, "doc_id", parts(docs))
    first = keys.agg(F.min("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    part, last = range_of(F.col("doc_id"), bounds), len(bounds)
    is_first = F.col("doc_id").isNull() if first[1] else F.col("doc_id") == first[0]
    is_bound = F.col("doc_id").isin(bounds) if bounds else F.lit(False)
    place = F.struct(part.cast("int").alias("part"), F.lit(False).alias("tail"))
    before = F.when(is_bound, F.struct((part - 1).cast("int").alias("part"), F.lit(True).alias("tail")))
    around = F.when(is_first, F.struct(F.lit(last).alias("part"), F.lit(True).alias("tail")))
    rows = slim.select("doc_id", "text", F.explode(F.array_compact(F.array(place, before, around))).alias("at")).select("at.*", "doc_id", "text")
    return (rows.repartitionById(last + 1, F.col("part")).sortWithinPartitions("part", "tail", "doc_id", "text")
            .mapInArrow(_compared, SCHEMA))
