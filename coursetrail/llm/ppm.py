"""Language of documents by prediction by partial matching (PPM).

For each language, a tree of byte contexts of order 0 to `order` holds how often each byte followed. In a
context seen n times with q different next bytes, a byte seen c times has probability c / (n + q) and
the escape to the next shorter context q / (n + q); a context never seen costs nothing; below order 0 every byte has
probability 1/256. Statistics are frozen after learning, so code lengths are exact sums.

Texts are lower-cased first. A context starts at a word's leading space and never reaches over it. So a word, with the space
that ends it, has one code length per language, and a text's is the sum over its words: each distinct
word of a batch is scored once. The language with the shortest code is predicted; equal lengths go to the
language first in the alphabet.

Learning reads a bounded sample: per language the `rows_per_language` labelled rows of smallest hash, and of
those at most `sample_chars` characters each. The number of languages is taken to be small: there is a tree for each. Scoring reads whole texts.

Defined results: a null text or one without any letter is `und` with score 0; so is every text where no
label was learned. Rows with null doc_id or lang are predicted like others. Repeated rows get equal results. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coursetrail.llm.words import coded, pieces_of

ORDER = 4
UNKNOWN = "und"
LETTER = r"\p{L}"
SPACE = 0x20
PIECE = 1 << 21  # bytes of words scored at once


def _contexts(flat: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, context, context and byte) for each order from 0; flat starts with a space."""
    at = np.arange(len(flat))
    space = np.maximum.accumulate(np.where(flat == SPACE, at, 0))
    depth = np.concatenate(([0], at[1:] - space[:-1]))
    wide = flat.astype(np.uint64)
    context = np.zeros(len(flat), np.uint64)
    for k in range(order + 1):
        if k:
            context[k:] |= wide[:-k] << np.uint64(8 * (k - 1))
        where = np.flatnonzero(depth >= max(k, 1))
        yield where, context[where], context[where] << np.uint64(8) | wide[where]


def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted table, -1 where it is not there."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Model:
    """Per order: the known (context, byte) pairs with their full code length in every language, and the
    known contexts with the length of the escape out of them."""

    languages: list[str]
    pairs: list[np.ndarray]
    lengths: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def positions(self, flat: np.ndarray) -> np.ndarray:
        """Code length of every byte in every language; bytes are joined by single spaces, one first and last."""
        cost = np.zeros((len(flat), len(self.languages)))
        open_ = np.ones(len(flat), bool)
        for k, (where, context, pair) in reversed(list(enumerate(_contexts(flat, len(self.pairs) - 1)))):
            still = open_[where]
            where, context, pair = where[still], context[still], pair[still]
            at = _place(self.pairs[k], pair)
            hit = at >= 0
            cost[where[hit]] += self.lengths[k][at[hit]]
            open_[where[hit]] = False
            miss = where[~hit]
            out = _place(self.contexts[k], context[~hit])
            cost[miss[out >= 0]] += self.escapes[k][out[out >= 0]]
        open_[:1] = False
        cost[open_] += 8
        return cost

    def words(self, words: list[bytes]) -> np.ndarray:
        """Code length of each word in each language."""
        out = np.zeros((len(words), len(self.languages)))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        begin = 0
        while begin < len(words):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PIECE)))
            flat = np.frombuffer(b" " + b" ".join(words[begin:stop]) + b" ", np.uint8)
            starts = np.cumsum(lengths[begin:stop]) - lengths[begin:stop] + 1
            out[begin:stop] = np.add.reduceat(self.positions(flat), starts, axis=0)
            begin = stop
        return out


def learn(texts: dict[str, list[str]], order: int = ORDER) -> Model:
    """A model of the languages, from some texts of each."""
    languages = sorted(texts)
    grams: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(order + 1)]
    for language in languages:
        lower = pc.utf8_lower(pa.array(texts[language], pa.large_string())).to_pylist()
        flat = np.frombuffer(b" " + b" ".join(" ".join(lower).encode().split()) + b" ", np.uint8)
        for k, (_, _, pair) in enumerate(_contexts(flat, order)):
            grams[k].append(np.unique(pair, return_counts=True))
    model = Model(languages, [], [], [], [])
    for k in range(order + 1):
        pairs = np.unique(np.concatenate([p for p, _ in grams[k]])) if languages else np.zeros(0, np.uint64)
        contexts = np.unique(pairs >> np.uint64(8))
        lengths, escapes = np.zeros((len(pairs), len(languages))), np.zeros((len(contexts), len(languages)))
        # What a byte costs after an escape from order k: its length at order k - 1.
        shorter = np.full(len(pairs), -1)
        if k:
            mask = np.uint64((1 << (8 * (k - 1))) - 1)
            shorter = _place(model.pairs[k - 1], ((pairs >> np.uint64(8)) & mask) << np.uint64(8) | (pairs & np.uint64(255)))
        for i, (mine, count) in enumerate(grams[k]):
            in_context = _place(contexts, mine >> np.uint64(8))
            total = np.bincount(in_context, count, len(contexts))
            kinds = np.bincount(in_context, minlength=len(contexts))
            seen = kinds > 0
            escapes[seen, i] = np.log2((total + kinds)[seen] / kinds[seen])
            below = model.lengths[k - 1][shorter, i] if k else np.full(len(pairs), 8.0)
            lengths[:, i] = escapes[_place(contexts, pairs >> np.uint64(8)), i] + below
            lengths[_place(pairs, mine), i] = np.log2((total + kinds)[in_context] / count)
        for part, value in zip((model.pairs, model.lengths, model.contexts, model.escapes), (pairs, lengths, contexts, escapes), strict=True):
            part.append(value)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows kept out of learning: CRC-32 of the id's text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def sample(docs: DataFrame, rows_per_language: int = 300, sample_chars: int = 20_000) -> dict[str, list[str]]:
    """Texts to learn from; at most rows_per_language x sample_chars characters of each language."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # Hashes spread evenly: about twice the rows asked for pass the share that a language's count gives, so what
    # is ranked stays small however large the language is.
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return {}
    shares = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], 2.0 * rows_per_language / row["count"])])
    fraction = F.col("hash").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    passed = (labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("hash"), F.left("text", F.lit(sample_chars)).alias("text"))
              .where(fraction < shares[F.col("lang")]))
    order = W.partitionBy("lang").orderBy(fraction, "doc_id")
    picked = passed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows_per_language)
    found: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "rank").select("lang", "text").collect():
        found.setdefault(row["lang"], []).append(row["text"])
    return found


def scored(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, bits per byte) of each text."""
    names, size = np.array([*model.languages, UNKNOWN], object), len(model.languages)
    offsets, codes, distinct = coded(pc.utf8_lower(texts))
    letters = np.asarray(pc.fill_null(pc.match_substring_regex(texts, LETTER), False))
    if not size:
        return np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts))
    sums = np.zeros((len(codes) + 1, size))
    np.cumsum(model.words(distinct.cast(pa.large_binary()).to_pylist())[codes], axis=0, out=sums[1:])
    lengths = sums[offsets[1:]] - sums[offsets[:-1]]
    best = lengths.argmin(axis=1)
    least = lengths[np.arange(len(best)), best]
    score = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)
    n_bytes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)) + 1
    return names[np.where(letters, best, size)], np.where(letters, score, 0.0), least / n_bytes


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, held_out, text) as (doc_id, held_out, lang_pred, score, bits_per_byte)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            language, score, bits = scored(batch.column("text"), shared.value)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(language, pa.string()),
                                   "score": pa.array(score), "bits_per_byte": pa.array(bits)})

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        rows, "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_byte double")


def in_known_language(docs: DataFrame, rows_per_language: int = 300, sample_chars: int = 20_000, order: int = ORDER) -> DataFrame:
    """docs without the rows whose language is unknown: null texts, and those without a letter; columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(sample(docs, rows_per_language, sample_chars), order))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            language, _, _ = scored(batch.column("text"), shared.value)
            yield batch.filter(pa.array(language != UNKNOWN))

    return docs.mapInArrow(rows, docs.schema)


def identify(docs: DataFrame, rows_per_language: int = 300, sample_chars: int = 20_000, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for every row of docs (doc_id, text, lang).

    score: probability of the predicted language among the learned ones, all alike beforehand. bits_per_byte: its code
    length by the bytes of the text; 8 is what a text costs without any model.
    """
    model = learn(sample(docs, rows_per_language, sample_chars), order)
    return predicted(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"), model)
