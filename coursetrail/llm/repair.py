"""Token ids of documents in grammar-compressed shards, written in document order and read at random.

Encoding. The tokenizer's library encodes; its file is read by the driver and sent along. Lower-casing,
splitting at white space and merging never look across white space, so each distinct word of a batch is encoded once
and its ids are put together again; that equals encoding the whole text. A text that may hold one of
the tokenizer's special strings is encoded as a whole.

Order. Documents are dealt into ranges of doc_id and sorted within them; rows repeated with one id follow each
other by their ids, rows with a null id come first.

Shards. Some documents in a row, about `shard_tokens` tokens, make a shard. Re-Pair: the most frequent pairs of
neighbouring symbols become new symbols, round after round, until no pair is worth a rule; a pair never reaches over the end of a document. A
shard is a row of a Parquet table: its rules (left, right), the expansion length of every rule, the
symbols, and each document's first symbol. A token at a given place is found by adding up expansion lengths, without
expanding what lies before it (`tokens_at`).

Defined results: a null or empty text has the end id alone. A very long text is a shard of its own. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coursetrail.llm.order import boundaries, parts, range_of
from coursetrail.llm.words import coded, pieces_of, ranges
from coursetrail.session import durable_dir

SHARD_TOKENS = 1 << 20
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII, without the apostrophe, which may begin a token of letters
LEAST = 16  # occurrences that make a pair worth a rule: a rule takes twelve bytes and its share of a round, an occurrence saves two
BUCKETS = 18  # bits


# ---------------------------------------------------------------- encoding


class WordEncoder:
    """Ids of words by the tokenizer's library, remembered from batch to batch up to `most` words."""

    def __init__(self, spec: str, most: int = 1 << 20):
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_str(spec), most
        known = json.loads(spec)
        suffix = known["model"].get("end_of_word_suffix")
        # With a mark at the end of words, the ids of many letter-only words can be told apart in one text.
        self.ends = None
        if suffix:
            self.ends = np.zeros(self.library.get_vocab_size(), bool)
            self.ends[[i for token, i in known["model"]["vocab"].items() if token.endswith(suffix)]] = True
        # A special string in any case is looked for by its first two characters.
        self.special = sorted({t["content"][:2].lower() for t in known["added_tokens"]})
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add(self, words: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        first = len(self.size)
        self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(size) - size))
        self.flat, self.size = np.concatenate((self.flat, flat.astype(np.uint32))), np.concatenate((self.size, size))
        self.slots.update(zip(words, range(first, first + len(words)), strict=True))

    def _each(self, words: list[str]) -> None:
        ids = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        self._add(words, np.array([i for x in ids for i in x], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _letters(self, words: list[str]) -> None:
        told, flats, sizes, others = [], [], [], []
        for at in range(0, len(words), 1000):
            some = words[at:at + 1000]
            one, = self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)  # without places in the text
            flat = np.array(one.ids, np.uint32)
            ends = np.flatnonzero(self.ends[flat]) + 1
            if len(ends) == len(some) and (not len(flat) or ends[-1] == len(flat)):
                told += some
                flats.append(flat)
                sizes.append(np.diff(np.concatenate(([0], ends))))
            else:
                others += some
        if told:
            self._add(told, np.concatenate(flats), np.concatenate(sizes))
        if others:
            self._each(others)

    def learn(self, words: list[str]) -> np.ndarray:
        """The slot of each word."""
        if len(self.slots) > self.most:
            self.forget()
        slots = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(slots < 0)
        new = [words[i] for i in unknown.tolist()]
        if not new:
            return slots
        if self.ends is None:
            self._each(new)
        else:
            # Letters and a mark or several behind them never share a token, so each part is encoded on its own.
            cut = {w: p for w in new if (p := w.rstrip(MARKS)) is not w and p.isalpha()}
            units = dict.fromkeys([w for w in new if w.isalpha()] + list(cut.values()))
            self._letters([u for u in units if u not in self.slots])
            marks = [w[len(p):] for w, p in cut.items()]
            self._each([w for w in dict.fromkeys([w for w in new if w not in cut] + marks) if w not in self.slots])
            whole = [w for w in cut if w not in self.slots]
            if whole:
                two = np.array([[self.slots[cut[w]], self.slots[w[len(cut[w]):]]] for w in whole])
                size = self.size[two]
                self._add(whole, self.flat[ranges(self.begin[two].ravel(), size.ravel())], size.sum(axis=1))
        slots[unknown] = np.fromiter(map(self.slots.__getitem__, new), np.int64, len(new))
        return slots

    def encode(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]; `end` closes each of them."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        special = np.zeros(len(texts), bool)
        for mark in self.special:
            special |= np.asarray(pc.match_substring(texts, mark, ignore_case=True))
        texts_in_words = pc.if_else(pa.array(special), "", texts)
        offsets, codes, distinct = coded(texts_in_words if self.ends is None else spaced(texts_in_words), ascii_lower=True)
        slots = self.learn(distinct.to_pylist())
        # A table of this batch's words alone: the ids of a word are bytes, and Arrow puts them together.
        size = self.size[slots]
        flat = [self.flat[ranges(self.begin[slots], size)]]
        odd = np.flatnonzero(special)
        whole = [self.library.encode(texts[int(i)].as_py(), add_special_tokens=False).ids for i in odd]
        closing = [] if end is None else [[end]]
        flat += [np.array(x, np.uint32) for x in whole + closing]
        size = np.concatenate((size, np.fromiter(map(len, whole + closing), np.int64, len(whole) + len(closing))))
        # What goes in between the words: a whole text at its row's start, the end id at its row's end.
        row, at, value = odd, offsets[odd], len(slots) + np.arange(len(odd))
        if end is not None:
            row, at = np.concatenate((row, np.arange(len(texts)))), np.concatenate((at, offsets[1:]))
            value = np.concatenate((value, np.full(len(texts), len(size) - 1)))
        order = np.argsort(row, kind="stable")
        codes = np.insert(codes, at[order], value[order])
        words = np.diff(offsets) + special + (end is not None)
        if not len(codes):
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint32)
        table = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [
            None, pa.py_buffer(4 * np.concatenate(([0], np.cumsum(size)))), pa.py_buffer(np.concatenate(flat))])
        _, places, data = table.take(pa.array(codes)).buffers()
        places = np.frombuffer(places, np.int64, len(codes) + 1) // 4
        ids = np.frombuffer(data or b"", np.uint32, int(places[-1]))
        ends = places[np.concatenate(([0], np.cumsum(words)))]
        return ends, ids


# Bytes of letters, and of the marks that no token shares with a letter before them.
LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
MARK[list(MARKS.encode())] = True


def spaced(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """Texts with a space between an ASCII letter and a mark behind it: fewer distinct words, and the same ids, where white space parts words."""
    texts = pa.concat_arrays([texts])  # without an offset
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    at = np.flatnonzero(LETTER[data[:-1]] & MARK[data[1:]]) + 1
    offsets = offsets - offsets[0]
    moved = offsets + np.searchsorted(at, offsets)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(moved), pa.py_buffer(np.insert(data, at, ord(" "))))


_encoders: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    """The encoder of a file, one in a worker process: what a task has learned serves the next one."""
    key = zlib.crc32(spec.encode())
    if key not in _encoders:
        _encoders.clear()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _encoders[key] = WordEncoder(spec)
    return _encoders[key]


def narrow(count: int) -> np.dtype:
    """The smallest little-endian type that holds numbers below count."""
    return np.dtype("<u2") if count <= 1 << 16 else np.dtype("<u4")


# ---------------------------------------------------------------- Re-Pair


def compress(ids: np.ndarray, symbols: int, end: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, rules): rule k is the pair that symbol `symbols + k` stands for. No pair holds the symbol `end`.

    A round takes all pairs that are at least an eighth as frequent as the most frequent one. Where two of them overlap, the more frequent one
    is replaced. Rounds go on until no pair is found `least` times, below which a rule costs more than it saves, or symbols no longer fit two bytes.
    """
    seq, rules = ids.astype(np.uint32), []
    limit, full = np.inf, symbols
    room = (1 << 16) - symbols if symbols < 1 << 16 else (1 << 32) - symbols
    while len(seq) > 1 and room > 0:
        # Buckets of pairs are counted first; only pairs in well-filled buckets are told apart.
        bucket = (seq[:-1] * np.uint32(0x9E3779B1) + seq[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS)
        ends = seq == end
        bucket[ends[:-1] | ends[1:]] = 1 << BUCKETS
        filled = np.bincount(bucket, minlength=(1 << BUCKETS) + 1)
        filled[-1] = 0
        limit = max(least, min(limit, int(filled.max())) // 8)
        at = np.flatnonzero((filled >= limit)[bucket])
        bits = np.uint64(16 if full <= 1 << 16 else 32)
        keys = seq[at].astype(np.uint64) << bits | seq[at + 1]
        if bits == 16:  # a pair and its place in one number, which sorts several times faster than places by pairs
            ranked = np.sort(keys << np.uint64(32) | np.arange(len(at), dtype=np.uint64))
            order, ranked = (ranked & np.uint64(0xFFFFFFFF)).astype(np.int64), ranked >> np.uint64(32)
        else:
            order = np.argsort(keys, kind="stable")
            ranked = keys[order]
        new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(at) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(at)))
        chosen = np.flatnonzero(counts >= limit)
        chosen = chosen[np.argsort(-counts[chosen], kind="stable")][:room]
        rank = np.full(len(new), len(chosen))
        rank[chosen] = np.arange(len(chosen))
        mine = np.empty(len(at), np.int64)
        mine[order] = np.repeat(rank, counts)  # of each place: its pair, the most frequent one 0
        at, mine = at[mine < len(chosen)], mine[mine < len(chosen)]
        at, mine = _apart(at, mine)
        used = np.bincount(mine, minlength=len(chosen))
        good = used >= least
        if not good.any():
            if limit <= least:
                break
            continue
        number = np.cumsum(good) - 1 + full
        at, mine = at[good[mine]], mine[good[mine]]
        pairs = ranked[new[chosen[good]]]
        rules.append(np.stack((pairs >> bits, pairs & ((np.uint64(1) << bits) - np.uint64(1))), axis=1).astype(np.int64))
        full, room = full + len(pairs), room - len(pairs)
        seq[at] = number[mine]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
    return seq.astype(np.int64), np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def _apart(at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs without those that overlap a place of a more frequent pair; of a pair in a row with itself every other one stays."""
    follows = np.concatenate(([False], np.diff(at) == 1))
    same = follows & np.concatenate(([False], np.diff(rank) == 0))
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
    odd = (np.arange(len(at)) - begin) % 2 == 1
    before = np.concatenate(([np.iinfo(np.int64).max], rank[:-1]))
    after = np.concatenate((rank[1:], [np.iinfo(np.int64).max]))
    led = np.concatenate((follows[1:], [False]))
    stay = ~odd & ~(follows & (before < rank)) & ~(led & (after < rank))
    return at[stay], rank[stay]


def expansion_lengths(rules: np.ndarray, symbols: int) -> np.ndarray:
    lengths = np.ones(symbols + len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[symbols + k] = lengths[a] + lengths[b]
    return lengths


def expand(seq: np.ndarray, rules: np.ndarray, symbols: int, lengths: np.ndarray) -> np.ndarray:
    """The ids a sequence of symbols stands for."""
    full: dict[int, np.ndarray] = {}
    part = lambda s: full[s] if s >= symbols else np.array([s])
    for k, (a, b) in enumerate(rules.tolist()):
        full[symbols + k] = np.concatenate((part(a), part(b)))
    table = np.concatenate([np.arange(symbols), *full.values()]) if full else np.arange(symbols)
    begin = np.concatenate((np.arange(symbols), symbols + np.cumsum(lengths[symbols:]) - lengths[symbols:])).astype(np.int64)
    return table[ranges(begin[seq], lengths[seq])]


def tokens_at(seq: np.ndarray, rules: np.ndarray, symbols: int, lengths: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a sequence; only symbols that reach into them are expanded."""
    ends = np.cumsum(lengths[seq])
    a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop)) + 1
    before = int(ends[a - 1]) if a else 0
    return expand(seq[a:b], rules, symbols, lengths)[start - before:stop - before]


# ---------------------------------------------------------------- files

#: terminals: symbols that are no rules, the ids and one for the end of a document (end_id). Rules, lengths of the rules'
#: expansions and the sequence are little-endian unsigned numbers of 4 bytes; the sequence's have 2 if all symbols fit.
SHARD = ("part int, shard int, end_id int, terminals int, doc_ids array<bigint>, doc_symbols array<int>, n_tokens bigint, rules binary, "
         "lengths binary, sequence binary")


def _shard(part: int, number: int, doc_ids: list, ids: list[np.ndarray], symbols: int, end: int) -> pa.RecordBatch:
    # The end id may occur within a text, so each document's last id is a symbol of its own, the one after the ids.
    flat = np.concatenate(ids).astype(np.int64)
    flat[np.cumsum([len(x) for x in ids]) - 1] = symbols
    terminals = symbols + 1
    seq, rules = compress(flat, terminals, symbols)
    kind = narrow(terminals + len(rules))
    firsts = np.concatenate(([0], np.flatnonzero(seq == symbols) + 1))[:-1]
    lengths = expansion_lengths(rules, terminals)
    return pa.record_batch({
        "part": pa.array([part], pa.int32()), "shard": pa.array([number], pa.int32()), "end_id": pa.array([end], pa.int32()),
        "terminals": pa.array([terminals], pa.int32()), "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "doc_symbols": pa.array([firsts.tolist()], pa.list_(pa.int32())),
        "n_tokens": pa.array([sum(map(len, ids))], pa.int64()), "rules": [rules.astype("<u4").tobytes()],
        "lengths": [lengths[terminals:].astype("<u4").tobytes()], "sequence": [seq.astype(kind).tobytes()]})


def write(docs: DataFrame, tokenizer: str, end: int, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of docs (doc_id, text) as shards below the path, ascending in (part, shard)."""
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    from tokenizers import Tokenizer

    symbols = Tokenizer.from_str(spec).get_vocab_size()
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    kind = narrow(symbols)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in pieces_of(batches, "text", 1 << 23):
            offsets, ids = encoder.encode(batch.column("text"), end)
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
                None, pa.py_buffer(offsets * kind.itemsize), pa.py_buffer(ids.astype(kind))])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": binary.cast(pa.binary())})

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, doc_ids, ids, held = -1, 0, [], [], 0
        for batch in batches:
            for p, doc_id, data in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if doc_ids and (p != part or held >= shard_tokens):
                    yield _shard(part, number, doc_ids, ids, symbols, end)
                    number, doc_ids, ids, held = number + 1, [], [], 0
                if p != part:
                    part, number = p, 0
                doc_ids.append(doc_id)
                ids.append(np.frombuffer(data.as_buffer(), kind))
                held += len(ids[-1])
        if doc_ids:
            yield _shard(part, number, doc_ids, ids, symbols, end)

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    count = parts(docs)
    bounds = boundaries(slim.select("doc_id"), "doc_id", count)
    rows = slim.mapInArrow(encoded, "doc_id bigint, ids binary").withColumn("part", range_of(F.col("doc_id"), bounds))
    (rows.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "doc_id", "ids")
     .mapInArrow(shards, SHARD).write.parquet(path))


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    stored = spark.read.parquet(path)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                one = {c: row.column(c)[0] for c in row.schema.names}
                terminals, end = one["terminals"].as_py(), one["end_id"].as_py()
                rules = np.frombuffer(one["rules"].as_buffer(), "<u4").reshape(-1, 2).astype(np.int64)
                lengths = np.concatenate((np.ones(terminals, np.int64), np.frombuffer(one["lengths"].as_buffer(), "<u4").astype(np.int64)))
                seq = np.frombuffer(one["sequence"].as_buffer(), narrow(terminals + len(rules))).astype(np.int64)
                firsts = np.array(one["doc_symbols"].as_py(), np.int64)
                ends = np.concatenate(([0], np.cumsum(lengths[seq])))
                starts = np.append(ends[firsts], ends[-1])
                flat = expand(seq, rules, terminals, lengths)
                flat[starts[1:] - 1] = end
                ids = memoryview(flat.astype("<u4").tobytes())
                crcs = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                size = len(firsts)
                yield pa.record_batch({
                    "part": pa.array([one["part"].as_py()] * size, pa.int32()), "shard": pa.array([one["shard"].as_py()] * size, pa.int32()),
                    "doc_id": pa.array(one["doc_ids"].as_py(), pa.int64()), "inner": pa.array(starts[:-1]),
                    "n_tokens": pa.array(np.diff(starts)), "ids_crc32": pa.array(crcs, pa.int64())})

    # Ids before each shard: sums per part first, so that no window holds more than the parts or one part's shards.
    sizes = stored.select("part", "shard", "n_tokens")
    by_part = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn(
        "before_part", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    before = sizes.join(by_part, "part").select("part", "shard", (
        F.coalesce("before_part", F.lit(0)) + F.coalesce(F.sum("n_tokens").over(
            W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("before"))
    found = stored.mapInArrow(rows, "part int, shard int, doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(before, ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write the ids of docs to the durable folder and read them back from there."""
    path = durable_dir(docs.sparkSession, "token-shards")
    write(docs, tokenizer, end, path)
    return read(docs.sparkSession, path)
