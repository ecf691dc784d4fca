"""Passages of benchmark items in documents: a prefix-filtered join of word windows with their documents.

Words are runs of digits, letters a-z (A-Z are lower-cased first) and all characters beyond ASCII. A window is `WINDOW` consecutive words of an item;
an item of fewer words is one window. A document is contaminated where a window's words stand in a row.

Tokens. A window's tokens are its shingles of `GRAM` words, a shorter window is one token. To hold a window a text must hold every one of
its tokens, so one is necessary and enough to find it: the rarest. Rarity is how often a token stands in all documents. A window with
a token that stands nowhere goes.

Join. 1. Tokens of documents that pass a filter made of all windows' tokens are counted. 2. Documents are read again; where the chosen
token of some window stands, its place and the words around it are handed on, once for each distinct text. 3. They meet the shapes of the token
(its place in the window, and the window's length), which bound what may lie before and behind; what stands at that place in that
length is compared with the windows word by word (an equi-join on the words). So a token that many windows and many texts
share costs as many rows as it has shapes, eight at most, not their product.

Filters are bitmaps of `FILTER_BITS` bits whatever the benchmark's size; what passes by chance is found out by the join. Nothing else is sent to all
tasks by this module.

Scale. Results belong to texts, not to documents, so copies cost one. The items of a document come from its set of windows, and each
distinct set is looked up once. Of a text, intervals and windows are gathered: at most one for each of its words and each length up to `WINDOW`.

Defined results. A null text or item has no words. A null item_id is written as the empty text. Rows of one item_id are one item, whose windows are those
of all its rows. Repeated documents get equal results. An empty benchmark hits nothing; no documents give no rows. Further columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.llm.words import coded, pieces_of, ranges
from coursetrail.session import stored

WINDOW = 10
GRAM = 3
FILTER_BITS = 1 << 24
SEED = 42
# Odd factors of the words of a token, one more for its length; from the fractional part of the golden ratio.
FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(GRAM + 1)], np.uint64)
SPACE = pa.scalar(" ", pa.large_string())

#: What each byte of a text becomes: a space, if it belongs to no word.
BYTES = np.full(256, ord(" "), np.uint8)
BYTES[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
BYTES[ord("a"):ord("z") + 1] = BYTES[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
BYTES[128:] = np.arange(128, 256)


def plain(texts: pa.Array) -> pa.Array:
    """Texts with a space for every character that belongs to no word, and a-z for A-Z."""
    joined = pc.fill_null(texts, "").cast(pa.large_binary())
    joined = pa.concat_arrays([joined])
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return pa.LargeStringArray.from_buffers(len(joined), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(BYTES[data]))


def tokens(codes: np.ndarray, offsets: np.ndarray, distinct: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the tokens of so many words of many texts; text i has the codes from offsets[i] to offsets[i + 1]."""
    digest = xxhash.xxh64_intdigest
    words = np.fromiter((digest(w, SEED) for w in distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(distinct))[codes]
    places = ranges(offsets[:-1], np.maximum(np.diff(offsets) - size + 1, 0))
    out = np.full(len(places), FACTORS[size], np.uint64)
    for i in range(size):
        out = (out ^ words[places + i]) * FACTORS[i]
        out ^= out >> np.uint64(29)
    return places, out.view(np.int64)


def windows_of(items: pa.Array) -> Iterator[tuple[int, str, int, list[int]]]:
    """(item, words, size, tokens) of every window; a token stands at its index in the window."""
    offsets, codes, distinct = coded(plain(items))
    hashed = {size: dict(zip(*(x.tolist() for x in tokens(codes, offsets, distinct, size)), strict=True)) for size in range(1, GRAM + 1)}
    words = distinct.take(pa.array(codes)).to_pylist()
    for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist(), strict=False)):
        size = min(WINDOW, b - a)
        gram = min(GRAM, size)
        for at in range(a, b - size + 1) if size else ():
            yield i, " ".join(words[at:at + size]), size, [hashed[gram][at + k] for k in range(size - gram + 1)]


def _windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, size, tokens) of all windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 1 << 18):
            found = list(zip(*windows_of(batch.column("text")), strict=True)) or [()] * 4
            yield pa.record_batch({"item_id": batch.column("item_id").take(pa.array(found[0], pa.int64())), "words": pa.array(found[1], pa.string()),
                                   "size": pa.array(found[2], pa.int32()), "tokens": pa.array(found[3], pa.list_(pa.int64()))})

    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").mapInArrow(
        rows, "item_id string, words string, size int, tokens array<bigint>")


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bitmap of hashes (column token), a byte for each bit; what comes to the driver has FILTER_BITS bits at most."""
    at = F.pmod("token", F.lit(FILTER_BITS)) + 1
    parts = (hashes.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    bits = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for part in parts:
        bits[part["bucket"] - 1] = np.frombuffer(part["bits"], np.uint8)
    return bits.ravel()


def _passed(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & (FILTER_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _counted(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(token, n): how often the tokens that pass the filter stand in the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            offsets, codes, distinct = coded(plain(batch.column("text")))
            for size in sizes:
                hashes = tokens(codes, offsets, distinct, size)[1]
                found, counts = np.unique(hashes[_passed(shared.value, hashes)], return_counts=True)
                yield pa.record_batch({"token": pa.array(found), "n": pa.array(counts)})

    return docs.select("text").mapInArrow(rows, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


PLACES = "doc_id bigint, text_key binary, n_words bigint, places array<struct<token: bigint, at: bigint, before: int, around: string>>"


def _placed(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """Every document with the places of tokens that pass the filter, each with the words that a window around it may reach."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            texts = batch.column("text")
            offsets, codes, distinct = coded(plain(texts))
            found: list[list[np.ndarray]] = []
            for size in sizes:
                at, hashes = tokens(codes, offsets, distinct, size)
                hit = _passed(shared.value, hashes)
                at, hashes = at[hit], hashes[hit]
                text = np.searchsorted(offsets, at, side="right") - 1
                begin = np.maximum(at - (WINDOW - GRAM), offsets[text]) if size == GRAM else at
                end = np.minimum(at + WINDOW, offsets[text + 1]) if size == GRAM else at + size
                found.append([text, hashes, at - offsets[text], at - begin, begin, end])
            text, hashes, at, before, begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
            by = np.argsort(text, kind="stable")
            text, hashes, at, before, begin, end = (x[by] for x in (text, hashes, at, before, begin, end))
            around = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(end - begin)))), distinct.take(pa.array(codes[ranges(begin, end - begin)])))
            place = pa.StructArray.from_arrays([pa.array(hashes), pa.array(at), pa.array(before, pa.int32()), pc.binary_join(around, SPACE).cast(pa.string())],
                                               names=["token", "at", "before", "around"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32()), place)
            keys = [xxhash.xxh3_128_digest(t or b"", SEED) for t in texts.cast(pa.large_binary()).to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(np.diff(offsets)), lists],
                                  names=["doc_id", "text_key", "n_words", "places"])

    return docs.mapInArrow(rows, PLACES)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of docs (doc_id, text) against a benchmark (item_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    windows = stored(_windows(benchmark), "windows")
    sizes = sorted(r[0] for r in windows.select(F.least("size", F.lit(GRAM))).distinct().collect()) or [GRAM]

    # The rarest token of each window, if all of its tokens are there.
    each = windows.groupBy("words").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens"))
    each = each.select("words", "size", F.posexplode("tokens").alias("place", "token"))
    counts = _counted(docs, _filter(each.select("token")), sizes)
    rarest = each.join(counts, "token", "left").groupBy("words", "size").agg(
        F.count_if(F.col("n").isNull()).alias("missing"), F.min(F.struct("n", "token", "place")).alias("rarest"))
    chosen = stored(rarest.where("missing = 0").select("words", "size", "rarest.token", "rarest.place"), "chosen")

    rows = stored(_placed(docs, _filter(chosen.select("token")), sizes), "places")
    places = (rows.where(F.size("places") > 0).groupBy("text_key").agg(F.first("places").alias("places"))
              .select("text_key", F.explode("places").alias("p")).select("text_key", "p.*"))
    shapes = chosen.select("token", "place", "size").distinct()
    around = F.split("around", " ")
    fits = (F.col("before") >= F.col("place")) & (F.size(around) >= F.col("before") - F.col("place") + F.col("size"))
    spans = places.join(shapes, "token").where(fits).select(
        "text_key", (F.col("at") - F.col("place")).alias("start"), "size",
        F.array_join(F.slice(around, F.col("before") - F.col("place") + 1, F.col("size")), " ").alias("words"))
    hits = stored(spans.join(chosen.select("words"), "words").select("text_key", "start", "size", F.md5("words").alias("window")), "hits")

    texts = hits.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans"),
                                         F.array_sort(F.collect_set("window")).alias("windows"))
    stop = lambda s: s["start"] + s["size"]
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
    n_hit = F.aggregate("spans", zero, lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), stop(s) - F.greatest(a["end"], s["start"]))).alias("n"),
                                                            F.greatest(a["end"], stop(s)).alias("end")), lambda a: a["n"])
    texts = stored(texts.select("text_key", n_hit.alias("n_hit"), F.md5(F.array_join("windows", ",")).alias("set"), "windows"), "texts")

    sets = texts.groupBy("set").agg(F.first("windows").alias("windows")).select("set", F.explode("windows").alias("window"))
    members = windows.select(F.md5("words").alias("window"), "item_id").distinct()
    items = sets.join(members, "window").select("set", "item_id").distinct().groupBy("set").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    items = items.select("set", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))

    found = rows.where(F.size("places") > 0).select("doc_id", "text_key", "n_words").join(
        texts.select("text_key", "n_hit", "set").join(items, "set"), "text_key", "left")
    rest = rows.where(F.size("places") == 0).select("doc_id", "n_words", F.lit(None).cast("bigint").alias("n_hit"), F.lit(None).cast("bigint").alias("n_items"),
                                                    F.lit(None).cast("string").alias("items_sha256"))
    none = F.lit(0).cast("bigint")
    return found.select(*rest.columns).unionByName(rest).select(
        "doc_id", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", none) > 0).alias("contaminated"))
