"""Words of many texts at once, as codes into a list of distinct words.

A word is a run of characters other than the six ASCII white-space characters. Work that
depends on the word alone is then done once per distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def coded(texts: pa.Array, ascii_lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, distinct): words of text i are distinct[codes[offsets[i]:offsets[i + 1]]].

    A null text has no words; neither has an empty one.
    """
    if ascii_lower:
        texts = pc.ascii_lower(texts)  # before the cast: on a slice that was cast it reads other rows' bytes
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    if not len(flat):
        return offsets, np.zeros(0, np.int64), pa.array([], pa.large_string())
    coding = flat.dictionary_encode()
    codes, distinct = np.asarray(coding.indices), coding.dictionary
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:
        # White space at either end of a text gives an empty word there.
        full = codes != empty
        offsets = np.concatenate(([0], np.cumsum(full)))[offsets]
        codes = codes[full]
    return offsets, codes, distinct


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The rows of batches in pieces of about `size` bytes of a text column, one row at least."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64) + 1)
        begin = 0
        while begin < batch.num_rows:
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + size, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop
