"""Removing passages that repeat anywhere: windows of `window` words that start at two places or more.

A word is a run of characters other than ASCII white space, taken unchanged. Every word under a
repeated window goes, the first copy's too. Windows are judged on the input.

The index is sharded by content, so that each passage is searched in one shard only:

1. Each window has a minimizer, the smallest hash among its runs of `gram` words. Neighbouring windows
   with one minimizer form a stretch. Equal windows have equal minimizers, so a window can only
   repeat if its minimizer occurs twice. Only hashes and places are shuffled for this.
2. Stretches whose minimizer repeats are counted by content (the two hashes of a stretch, 128 bits),
   with one place each as representative; equal ones are one row from here on, however many there are.
3. The representatives' words are cut out of their documents and dealt by minimizer. Shards of some
   hundred thousand words get an FM-index (`fm_index`), in which each stretch weighs as much as it has copies.
   The stretches are streamed against their shard's index: backward search gives matching
   statistics, and intervals whose windows count two or more are reported.
4. The intervals go back to every place of their stretch, and to the documents.

Defined results: a null or empty text has no words and keeps the empty text. Texts shorter than the window lose
nothing. Rows repeated with one doc_id and text count as often as they are there, as do rows
with a null doc_id. Very long texts are one row's work. An empty table gives an empty result. Further columns are
returned as they are by `without_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetrail.llm.fm_index import FMIndex, repeated_windows
from coursetrail.llm.order import free_name, parts
from coursetrail.llm.words import coded, pieces_of, ranges
from coursetrail.session import kept, stored

WINDOW = 35
GRAM = 8
STRETCH = 32  # windows; longer stretches are cut
SHARD_WORDS = 1 << 18
SPACE = pa.scalar(" ", pa.large_string())
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

STRETCHES = "doc_id bigint, text_hash bigint, first int, windows int, minimizer bigint, content bigint, places int"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if count else out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def stretches(texts: pa.Array, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The stretches of many texts: row, first, windows, minimizer, content, places.

    places: how often the minimizer occurs within the stretch, over 1 where a passage repeats itself.
    """
    offsets, codes, distinct = coded(texts)
    none = np.zeros(0, np.int64)
    empty = {"row": none, "first": none, "windows": none, "minimizer": none, "content": none, "places": none}
    if len(codes) < window:
        return empty
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))[codes]
    n = len(hashes)
    # Sums of hash * ODD^i up to each word; a piece's sum times ODD^-start depends on its words alone.
    up, back = _powers(ODD, n), _powers(ODD_BACK, n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)))
    grams = _mixed((sums[gram:] - sums[:-gram]) * back[:n - gram + 1])
    least = _sliding_min(grams, window - gram + 1)
    lengths = np.diff(offsets)
    whole = np.flatnonzero(lengths >= window)
    if not len(whole):
        return empty
    counts = lengths[whole] - window + 1
    at, row = ranges(offsets[whole], counts), np.repeat(whole, counts)
    least = least[at]
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])))
    begin = np.flatnonzero(new)
    size = np.diff(np.concatenate((begin, [len(at)])))
    # A minimizer lasts longer only where it recurs, in passages that repeat themselves.
    pieces = -(-size // STRETCH)
    begin = np.repeat(begin, pieces) + STRETCH * ranges(np.zeros(len(pieces), np.int64), pieces)
    size = np.minimum(np.diff(np.concatenate((begin, [len(at)]))), STRETCH)
    first, minimizer, words = at[begin], least[begin], size + window - 1
    content = _mixed((sums[first + words] - sums[first]) * back[first] + words.astype(np.uint64))
    spans = words - gram + 1
    same = grams[ranges(first, spans)] == np.repeat(minimizer, spans)
    places = np.add.reduceat(same, np.cumsum(spans) - spans)
    return {"row": row[begin], "first": first - offsets[row[begin]], "windows": size, "minimizer": minimizer.view(np.int64),
            "content": content.view(np.int64), "places": places}


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64("text"))


def _same_document(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def _stretch_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            found = stretches(batch.column("text"), window, gram)
            row = pa.array(found.pop("row"))
            out = {"doc_id": batch.column("doc_id").take(row), "text_hash": batch.column("text_hash").take(row)}
            out |= {k: pa.array(v, pa.int64() if k in ("minimizer", "content") else pa.int32()) for k, v in found.items()}
            yield pa.record_batch(out)

    return docs.select("doc_id", "text_hash", "text").mapInArrow(rows, STRETCHES)


def _cut_out(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(minimizer, content, copies, words): the words of each representative, joined by spaces."""
    wanted = places.groupBy("doc_id", "text_hash").agg(F.collect_list(
        F.struct("first", "windows", "minimizer", "content", "copies")).alias("wanted"))
    have = docs.select("doc_id", "text_hash", "text").alias("have").join(
        wanted.alias("w"), _same_document(docs, wanted)).select("text", "wanted")
    # Of rows repeated with one id and text, each would give the words; a stretch is kept once.

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            lists = batch.column("wanted")
            want = lists.flatten()
            row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            offsets, codes, distinct = coded(batch.column("text"))
            lengths = np.asarray(want.field("windows")).astype(np.int64) + window - 1
            places = ranges(offsets[row] + np.asarray(want.field("first")), lengths)
            cut = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths)))), distinct.take(pa.array(codes[places])))
            yield pa.record_batch({**{k: want.field(k) for k in ("minimizer", "content", "copies")},
                                   "words": pc.binary_join(cut, SPACE).cast(pa.string())})

    return have.mapInArrow(rows, "minimizer bigint, content bigint, copies bigint, words string")


def _searched(cut: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(minimizer, content, spans): word intervals of each stretch under repeated windows, by an FM-index per shard."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def shard(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, codes, _ = coded(batch.column("words"))
        lengths = np.diff(offsets)
        index = FMIndex(codes.astype(np.int64), lengths, np.asarray(batch.column("copies")))
        which, a, b = repeated_windows(index, codes, offsets[:-1], lengths, window)
        order = np.lexsort((a, which))
        which, a, b = which[order], a[order], b[order]
        rows, starts = np.unique(which, return_index=True)
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate((starts, [len(which)])), pa.int32()), pa.StructArray.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["a", "b"])).cast(kind)
        rows = pa.array(rows)
        return pa.record_batch({"minimizer": batch.column("minimizer").take(rows), "content": batch.column("content").take(rows), "spans": spans})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in sharded(batches, "minimizer", "words", shard_words * 6):
            yield shard(whole)

    # An aggregate keeps a stretch once, should repeated rows have given it twice.
    once = cut.groupBy("minimizer", "content").agg(F.first("copies").alias("copies"), F.first("words").alias("words"))
    return (once.repartition(parts(cut), "minimizer").sortWithinPartitions("minimizer")
            .mapInArrow(rows, "minimizer bigint, content bigint, spans array<struct<a:int,b:int>>"))


def sharded(batches: Iterator[pa.RecordBatch], key: str, sized: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by the key in shards of about `size` bytes that never part a key's rows."""
    rest: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        # Batches of Spark may be large; a piece has some thousand rows.
        for piece in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
            rest.append(piece)
            held += piece.num_rows * 12 + pc.sum(pc.binary_length(piece.column(sized))).as_py()
            if held < size:
                continue
            whole = pa.Table.from_batches(rest).combine_chunks()
            keys = np.asarray(whole.column(key))
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            if cut:
                yield whole.slice(0, cut).combine_chunks().to_batches()[0]
                rest = whole.slice(cut).to_batches()
                held = sum(b.num_rows * 12 + pc.sum(pc.binary_length(b.column(sized))).as_py() for b in rest)
    if held:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, text_hash, spans): for each document with repeated windows, the word intervals [a, b) to remove."""
    # Stored, so that both sides of the join come as they lie, and a minimizer with very many rows can be split. All
    # stretches go as soon as those that may repeat are written.
    with kept(_stretch_rows(docs, window, gram), "stretches") as every:
        repeated = every.groupBy("minimizer").agg(F.sum("places").alias("n")).where("n > 1").select("minimizer")
        with kept(repeated, "minimizers") as repeated:
            keep = stored(every.join(repeated, "minimizer", "left_semi"), "stretches")
    place = F.struct("doc_id", "text_hash", "first", "windows")
    chosen = keep.groupBy("minimizer", "content").agg(F.count("*").alias("copies"), F.min(place).alias("place")).select(
        "minimizer", "content", "copies", "place.*")
    spans = stored(_searched(_cut_out(docs, chosen, window), window, shard_words), "spans")
    found = keep.join(spans, ["minimizer", "content"]).select("doc_id", "text_hash", "first", F.explode("spans").alias("s"))
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set(
        F.struct((F.col("first") + F.col("s.a")).alias("a"), (F.col("first") + F.col("s.b")).alias("b"))).alias("spans"))


def _kept(texts: pa.Array, spans: pa.Array, text_out: bool) -> tuple[pa.Array, pa.Array, list]:
    """(words, removed words, kept words joined by a space or their SHA-256) of each text."""
    offsets, codes, distinct = coded(texts)
    change = np.zeros(len(codes) + 1, np.int32)
    want = spans.flatten()
    row = np.repeat(np.arange(len(spans)), np.diff(np.asarray(spans.offsets)))
    if len(want):
        np.add.at(change, offsets[row] + np.asarray(want.field("a")), 1)
        np.add.at(change, offsets[row] + np.asarray(want.field("b")), -1)
    stay = np.cumsum(change[:-1]) == 0
    at = np.concatenate(([0], np.cumsum(stay)))[offsets]
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), distinct.take(pa.array(codes[stay]))), SPACE)
    words = np.diff(offsets)
    if not text_out:
        joined = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in joined.cast(pa.large_binary())]
    return pa.array(words), pa.array(words - np.diff(at)), joined


def _no_spans() -> Column:
    return F.expr("array()").cast("array<struct<a:int,b:int>>")


def _with_spans(docs: DataFrame, spans: DataFrame, *columns: str) -> DataFrame:
    joined = docs.join(spans, _same_document(docs, spans), "left")
    return joined.select(*(docs[c] for c in columns), F.coalesce(spans["spans"], _no_spans()).alias("spans"))


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of docs (doc_id, text)."""
    docs = _keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    frame = _with_spans(docs, repeated_spans(docs, window), "doc_id", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            words, gone, digests = _kept(batch.column("text"), batch.column("spans"), text_out=False)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": words, "n_removed": gone, "kept_sha256": pa.array(digests, pa.string())})

    return frame.mapInArrow(rows, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with repeated passages removed from text, and n_chars, where there is such a column, counted anew.

    A text that loses nothing stays as it is; of others, the kept words are joined by a space. A document that
    loses all its words stays, with the empty text.
    """
    own, hidden = free_name(docs, "text_hash"), free_name(docs, "spans")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = repeated_spans(_keyed(slim), window).select(
        F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), F.col("spans").alias(hidden))
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = keyed["doc_id"].cast("bigint").eqNullSafe(found["of_doc"]) & (keyed[own] == found["of_text"])
    frame = keyed.join(found, same, "left").select(*(keyed[c] for c in docs.columns), F.coalesce(found[hidden], _no_spans()).alias(hidden))
    schema = docs.schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            texts = batch.column("text")
            _, gone, joined = _kept(texts, batch.column(hidden), text_out=True)
            changed = pc.greater(gone, 0)
            out = {c: batch.column(c) for c in schema.names}
            out["text"] = pc.if_else(changed, joined.cast(texts.type), texts)
            if "n_chars" in out:
                out["n_chars"] = pc.if_else(changed, pc.utf8_length(out["text"]).cast(out["n_chars"].type), out["n_chars"])
            yield pa.record_batch(out)

    return frame.mapInArrow(rows, schema)
