"""Encoding and decoding by a SentencePiece vocabulary: an Aho-Corasick automaton drives a single-pass Viterbi search.

The segmentation of a text is the one whose pieces have the largest sum of scores, among equal ones that with the
longest last piece, then the longest one before, and so on. All pieces' UTF-8 bytes form one automaton with complete
transitions. It reads a text once; at each position the output links give every piece that ends
there, the longest first, and each of them relaxes the position's best score. A character that is no piece
scores `UNKNOWN_PENALTY` less than the worst piece and is written as byte pieces, or as the unknown piece where
the vocabulary has none.

The vocabulary's scores are used as they are. For a vocabulary that was made by merges these are merge ranks, so the
result is the best segmentation by these ranks, not the merges' own.

A space is the mark U+2581, and one goes in front of the text. In the usual vocabularies no piece has that mark
after another character, so a text can be cut before each run of marks: distinct cuts of a batch are searched once,
all at once, in step. With other vocabularies, whole texts are searched.

Defined results: a null or empty text has no pieces and decodes to the empty text. A text with U+2581 in it comes back
with a space there. Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursetrail.llm.words import pieces_of, ranges

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN = 400_000  # cuts kept from batch to batch
IN_STEP = 1024  # bytes; longer cuts are searched one by one
CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Vocabulary:
    """Pieces of a model file's bytes, their automaton, and the bytes that each id stands for."""

    def __init__(self, model: bytes):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size, self.unknown = library.vocab_size(), library.unk_id()
        names = [library.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (
            library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
        self.bytes = {int(names[i][3:5], 16): i for i in range(self.size) if library.is_byte(i)}
        self.by_byte = np.array([self.bytes.get(b, self.unknown) for b in range(256)])
        self.score = np.array([library.get_score(i) for i in range(self.size)])
        self.unknown_score = self.score[plain].min() - UNKNOWN_PENALTY
        self.cuttable = not any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain)
        # In decoding, a piece is its text with spaces, a byte piece its byte, and a control piece nothing.
        text = [b""] * self.size
        for i in plain:
            text[i] = names[i].replace(MARK, " ").encode()
        for b, i in self.bytes.items():
            text[i] = bytes([b])
        self.text_length = np.array(list(map(len, text)))
        self.text_begin = np.cumsum(self.text_length) - self.text_length
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self._automaton([(names[i].encode(), i) for i in plain])

    def _automaton(self, pieces: list[tuple[bytes, int]]) -> None:
        """next: state after a byte; piece: the piece that a state spells, or -1; link: the next shorter state that spells one."""
        children: list[dict[int, int]] = [{}]
        piece, length = [-1], [0]
        for name, i in pieces:
            state = 0
            for byte in name:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                    piece.append(-1)
                    length.append(length[state] + 1)
                state = children[state][byte]
            piece[state] = i
        count = len(children)
        self.next = np.zeros((count, 256), np.int32)
        self.piece, self.length = np.array(piece), np.array(length)
        self.link = np.zeros(count, np.int64)
        fail = np.zeros(count, np.int64)
        level = [0]
        while level:
            deeper = []
            for state in level:
                if state:
                    self.next[state] = self.next[fail[state]]
                for byte, child in children[state].items():
                    fail[child] = self.next[state][byte] if state else 0
                    self.next[state][byte] = child
                    shorter = fail[child]
                    self.link[child] = shorter if piece[shorter] >= 0 else self.link[shorter]
                    deeper.append(child)
            level = deeper
        # The first piece that ends in a state: its own, or that of its output link.
        self.output = np.where(self.piece >= 0, np.arange(count), self.link)

    # ------------------------------------------------------------ search

    def search(self, cuts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the best segmentation of each cut."""
        lengths = np.fromiter(map(len, cuts), np.int64, len(cuts))
        order = np.argsort(-lengths, kind="stable")
        long = int((lengths > IN_STEP).sum())
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in order[:long]:
            ids = self._one(cuts[at])
            found.append((np.array([at]), np.array([len(ids)]), ids))
        for begin in range(long, len(order), 1 << 16):
            some = order[begin:begin + (1 << 16)]
            sizes, ids = self._in_step([cuts[i] for i in some], lengths[some])
            found.append((some, sizes, ids))
        offsets = np.zeros(len(cuts) + 1, np.int64)
        if not found:
            return offsets, np.zeros(0, np.int64)
        rows, sizes, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        size = np.zeros(len(cuts), np.int64)
        size[rows] = sizes
        np.cumsum(size, out=offsets[1:])
        begin = np.zeros(len(cuts), np.int64)
        begin[rows] = np.cumsum(sizes) - sizes
        return offsets, ids[ranges(begin, size)]

    def _in_step(self, cuts: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for cuts sorted by falling length, all read byte by byte together."""
        flat = np.frombuffer(b"".join(cuts), np.uint8)
        start = np.cumsum(lengths) - lengths
        at0 = start + np.arange(len(cuts))  # position 0 of each cut among the best scores
        best = np.full(len(flat) + len(cuts), -np.inf)
        best[at0] = 0
        by = np.full(len(best), -1)  # the best last piece's state; 0: an unknown character
        state, char = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64)
        for j in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -j, side="left"))  # cuts longer than j
            byte = flat[start[:live] + j]
            lead = (byte & 0xC0) != 0x80
            char[:live] = np.where(lead, j, char[:live])
            state[:live] = self.next[state[:live], byte]
            end = at0[:live] + j + 1
            rows, out = np.arange(live), self.output[state[:live]]
            single = np.zeros(live, bool)
            while True:
                some = out > 0
                if not some.all():
                    rows, out = rows[some], out[some]
                if not len(rows):
                    break
                size = self.length[out]
                score = best[end[rows] - size] + self.score[self.piece[out]]
                better = score > best[end[rows]]
                best[end[rows[better]]] = score[better]
                by[end[rows[better]]] = out[better]
                single[rows[size == j + 1 - char[rows]]] = True
                out = self.link[out]
            # A character without a piece of its own; only where the next byte begins another one.
            last = np.ones(live, bool)
            more = lengths[:live] > j + 1
            last[more] = (flat[start[:live][more] + j + 1] & 0xC0) != 0x80
            odd = np.flatnonzero(last & ~single)
            if len(odd):
                score = best[at0[odd] + char[odd]] + self.unknown_score
                better = score > best[end[odd]]
                best[end[odd[better]]] = score[better]
                by[end[odd[better]]] = 0
        return self._back(flat, start, at0, lengths, by)

    def _back(self, flat: np.ndarray, start: np.ndarray, at0: np.ndarray, lengths: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, place = np.arange(len(lengths)), lengths.copy()
        rows, place = rows[place > 0], place[place > 0]
        steps = []
        while len(rows):
            how = by[at0[rows] + place]
            size = self.length[how]
            ids = self.piece[how]
            known = how > 0
            steps.append((rows[known], place[known], ids[known]))
            odd, end = rows[~known], place[~known].copy()
            size[~known] = 0
            while len(odd):  # an unknown character, byte by byte
                byte = flat[start[odd] + end - 1]
                begins = (byte & 0xC0) != 0x80
                write = np.ones(len(odd), bool) if self.bytes else begins
                steps.append((odd[write], end[write], self.by_byte[byte[write]]))
                end -= 1
                size[np.searchsorted(rows, odd)] += 1
                odd, end = odd[~begins], end[~begins]
            place = place - size
            rows, place = rows[place > 0], place[place > 0]
        if not steps:
            return np.zeros(len(lengths), np.int64), np.zeros(0, np.int64)
        row, place, ids = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.lexsort((place, row))
        return np.bincount(row, minlength=len(lengths)), ids[order]

    def _one(self, cut: bytes) -> np.ndarray:
        """The same for one long cut."""
        n = len(cut)
        best, by, state, char = [0.0] + [-np.inf] * n, [0] * (n + 1), 0, 0
        for j, byte in enumerate(cut):
            if byte & 0xC0 != 0x80:
                char = j
            state = int(self.next[state, byte])
            out, single = int(self.output[state]), False
            while out > 0:
                size = int(self.length[out])
                score = best[j + 1 - size] + float(self.score[self.piece[out]])
                if score > best[j + 1]:
                    best[j + 1], by[j + 1] = score, out
                single |= size == j + 1 - char
                out = int(self.link[out])
            if not single and (j + 1 == n or cut[j + 1] & 0xC0 != 0x80) and best[char] + self.unknown_score > best[j + 1]:
                best[j + 1], by[j + 1] = best[char] + self.unknown_score, 0
        ids, at = [], n
        while at:
            if by[at]:
                ids.append(int(self.piece[by[at]]))
                at -= int(self.length[by[at]])
                continue
            while True:
                at -= 1
                begins = cut[at] & 0xC0 != 0x80
                if self.bytes or begins:
                    ids.append(int(self.by_byte[cut[at]]))
                if begins:
                    break
        return np.array(ids[::-1], np.int64)

    # ------------------------------------------------------------ texts

    def encode(self, texts: pa.Array, known: dict[bytes, int], store: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of texts; known and store (flat ids, begins, sizes) keep cuts from batch to batch."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # Single spaces alone can be split at as they stand; other texts are cut one by one.
        simple = pc.invert(pc.match_substring_regex(texts, f"^ |  | $|{MARK}|^$")) if self.cuttable else pa.array([False] * len(texts), pa.bool_())
        lists = pc.split_pattern(pc.if_else(simple, texts, ""), " ")
        coding = lists.flatten().dictionary_encode()
        offsets = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
        cuts = [MARK.encode() + x for x in coding.dictionary.cast(pa.large_binary()).to_pylist()]
        codes, counts = np.asarray(coding.indices, np.int64), np.diff(offsets)
        rest = np.flatnonzero(~np.asarray(simple))
        if len(rest):
            place = {c: i for i, c in enumerate(cuts)}
            pieces = []
            for i in rest:
                text = texts[int(i)].as_py()
                marked = MARK + text.replace(" ", MARK) if text else ""
                pieces.append([place.setdefault(c.encode(), len(place)) for c in (CUT.findall(marked) if self.cuttable else [marked] if text else [])])
            cuts = list(place)
            # The rows split in vain have one empty cut each; it is replaced by their own.
            sizes = counts.copy()
            sizes[rest] = list(map(len, pieces))
            own = np.concatenate(([0], np.cumsum(sizes)))
            new = np.empty(int(own[-1]), np.int64)
            good = np.setdiff1d(np.arange(len(texts)), rest)
            new[ranges(own[good], sizes[good])] = codes[ranges(offsets[good], counts[good])]
            for i, p in zip(rest, pieces, strict=True):
                new[own[i]:own[i + 1]] = p
            codes, offsets = new, own
        if len(known) > KNOWN:
            known.clear()
            store.clear()
        if not store:
            store[:] = [np.zeros(0, np.int64)] * 3
        fresh = [c for c in cuts if c not in known]
        if fresh:
            at, ids = self.search(fresh)
            known.update(zip(fresh, range(len(store[1]), len(store[1]) + len(fresh)), strict=True))
            store[:] = [np.concatenate((store[0], ids)), np.concatenate((store[1], len(store[0]) + at[:-1])), np.concatenate((store[2], np.diff(at)))]
        slots = np.fromiter((known[c] for c in cuts), np.int64, len(cuts))[codes]
        ends = np.concatenate(([0], np.cumsum(store[2][slots])))[offsets]
        return ends, store[0][ranges(store[1][slots], store[2][slots])]

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of each list of ids; the space in front of the text is left out."""
        size = self.text_length[ids]
        flat = self.text[ranges(self.text_begin[ids], size)].tobytes()
        ends = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        return [flat[a:b].removeprefix(b" ") for a, b in zip(ends, ends[1:], strict=False)]


def _encoded(docs: DataFrame, model: str, columns: list[str], schema: str | T.StructType, row_of) -> DataFrame:
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known, store = Vocabulary(shared.value), {}, []
        for batch in pieces_of(batches, "text"):
            yield row_of(batch, vocabulary, *vocabulary.encode(batch.column("text"), known, store))

    return docs.select(*columns).mapInArrow(rows, schema)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """For every row of docs (doc_id, text): n_pieces, the CRC-32 of its ids as little-endian numbers of 4 bytes,
    the SHA-256 of the text decoded from them, and whether that is the text."""

    def row_of(batch: pa.RecordBatch, vocabulary: Vocabulary, offsets: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        raw, ends = memoryview(ids.astype("<u4").tobytes()), (4 * offsets).tolist()
        texts = vocabulary.decode(offsets, ids)
        given = pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_pieces": pa.array(np.diff(offsets)),
            "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.int64()),
            "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            "lossless": pa.array([a == b for a, b in zip(texts, given, strict=True)], pa.bool_())})

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _encoded(slim, model, ["doc_id", "text"],
                    "doc_id bigint, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, lossless boolean", row_of)


def encode(docs: DataFrame, model: str, output: str = "piece_ids") -> DataFrame:
    """docs without its text, and with an array of the text's ids, in a column whose name must be free."""
    if output in docs.columns:
        raise ValueError(f"there is a column {output}")
    columns = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(output, T.ArrayType(T.IntegerType()))])

    def row_of(batch: pa.RecordBatch, vocabulary: Vocabulary, offsets: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.record_batch([batch.column(c) for c in columns] + [lists], names=[*columns, output])

    return _encoded(docs, model, [*columns, "text"], schema, row_of)
