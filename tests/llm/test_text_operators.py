"""Operators on single texts against brute force, with empty, null, repeated and odd rows."""

import hashlib
import zlib
from collections import Counter, defaultdict
from math import log2
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from coursetrail.llm import digest, main_text, pieces, ppm, repair, substrings
from coursetrail.llm.words import coded, pieces_of

ODD = [None, "", " ", "a", "Hello, WORLD. it's  two\tspaces\n", "日本語 テキスト 😀", "É" * 40, "### # ##", "x" * 3000, "a b " * 700, " lead trail ",
       "<|endoftext|> in text", "aa$$$ é!? it's.'' b\u0301. x'll, don't! ab_c a_, ß-) ²!", "<|ENDOFTEXT|>", "\x00 \x01", "é combining", "İ Σ ς ﬁ ½ 12,5"]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


# ---------------------------------------------------------------- words


def test_words_of_texts():
    offsets, codes, distinct = coded(pa.array([None, "", " a  b\na ", "b\x0bc\x1cd", "é"]))
    words = [distinct[int(c)].as_py() for c in codes]
    assert [words[a:b] for a, b in zip(offsets, offsets[1:])] == [[], [], ["a", "b", "a"], ["b", "c\x1cd"], ["é"]]


def test_words_of_slices():
    texts = pa.array([f"Word{i} É Two{i % 3} " * (i % 5) for i in range(40)] + [None], pa.string())
    for lower in (False, True):
        for begin, size in ((0, 41), (3, 11), (17, 24), (40, 1)):
            for kind in (pa.string(), pa.large_string()):
                part = texts.cast(kind).slice(begin, size)
                offsets, codes, distinct = coded(part, ascii_lower=lower)
                found = [[distinct[int(c)].as_py() for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])]
                assert found == [(t or "").replace("W", "w" if lower else "W").replace("T", "t" if lower else "T").split() for t in part.to_pylist()]


def test_pieces_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (1, 50, 3, 200, 0)]), "n": pa.array(range(5))})
    found = list(pieces_of(iter([batch]), "text", 60))
    assert [x for b in found for x in b.column("n").to_pylist()] == list(range(5)) and len(found) > 2


# ---------------------------------------------------------------- op 1


def brute_digest(text):
    data = text.encode()
    counts = [0] * digest.BUCKETS
    if data:
        data = data.ljust(digest.WINDOW, b"\0")
        for i in range(digest.WINDOW - 1, len(data)):
            for places, factors in zip(digest.TRIPLETS, digest.FACTORS.tolist()):
                h = sum(data[i - p] * f for p, f in zip(places, factors)) & 0xFFFFFFFF
                h ^= h >> 15
                counts[(h * 0x2C1B3C6D & 0xFFFFFFFF) >> 25] += 1
    quartiles = [sorted(counts)[digest.BUCKETS * q // 4 - 1] for q in (1, 2, 3)]
    return [sum(c > q for q in quartiles) for c in counts]


def test_digests(spark):
    texts = [t for t in ODD] + ["the same text " * 9] * 3
    rows = [(i * 2, t) for i, t in enumerate(texts)] + [(4, "zz"), (4, "zz"), (None, "no id"), (None, None)]
    docs = frame(spark, rows, "doc_id bigint, text string").selectExpr("*", "1 AS part", "'x' AS tail")
    found = digest.digests(docs).collect()
    assert len(found) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    expected = Counter()
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        change = text[:len(text) - half] + following[:half]
        assert digest.digest(text)[3:].tolist() == brute_digest(text)
        a, b, c = digest.digest(text), digest.digest(change), digest.digest(following)
        expected[i, len(text), hashlib.sha256(change.encode()).hexdigest(), digest.written(a), digest.written(b),
                 digest.likeness(a, b), digest.likeness(a, c)] += 1
    assert Counter(tuple(r) for r in found) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_digests_of_one_and_of_no_row(spark):
    one = digest.digests(spark.createDataFrame([(7, "abcd")], "doc_id bigint, text string")).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert digest.digests(spark.createDataFrame([], "doc_id bigint, text string")).isEmpty()


def test_digests_lose_no_row_with_ids_that_doubles_cannot_hold(spark):
    ids = [sign * (1 << 62) + 1234567891 * i + 1 for sign in (-1, 1) for i in range(150)] + [(1 << 63) - 1, None]
    docs = frame(spark, [(i, f"text {i}") for i in ids], "doc_id bigint, text string")
    assert Counter(r.doc_id for r in digest.digests(docs).collect()) == Counter(ids)


# ---------------------------------------------------------------- op 4


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_are_those_of_the_library(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(model, "rb") as file:
        data = file.read()
    spec = proto.ModelProto()
    spec.ParseFromString(data)
    # The library searches for the best scores too if told so. It adds them up in single precision, so the
    # huge penalties of the file are made small here, for both.
    spec.trainer_spec.model_type = 1
    for piece in spec.pieces:
        piece.score = max(piece.score, -40_000.0)
    data = spec.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Vocabulary(data)
    words = [w for t in ODD + ["the quick brown fox thththe", "Élévation über señor"] if t for w in t.replace("▁", "").split(" ") if w and len(w) < 100]
    for word in words:
        offsets, ids = own.encode(pa.array([word]), {}, [])
        assert ids.tolist() == library.encode(word), word
        assert own._one((pieces.MARK + word).encode()).tolist() == ids.tolist()


def test_the_best_segmentation_by_brute_force(model):
    with open(model, "rb") as file:
        own = pieces.Vocabulary(file.read())
    score = {own.text[own.text_begin[i]:own.text_begin[i] + own.text_length[i]].tobytes(): own.score[i]
             for i in range(own.size) if i not in own.bytes.values() and own.text_length[i]}

    def best(cut):
        scores = [0.0] + [-np.inf] * len(cut)
        for j in range(1, len(cut) + 1):
            scores[j] = max((scores[i] + score[cut[i:j]] for i in range(j) if cut[i:j] in score), default=-np.inf)
        return scores[-1]

    for word in ("the", "ththe", "running", "unbelievable", "xqzxqz"):
        ids = own.search([(pieces.MARK + word).encode()])[1]
        assert own.score[ids].sum() == best(b" " + word.encode())


def test_pieces_round_trip(spark, model):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "no id"), (99, "with ▁ mark")]
    docs = frame(spark, rows, "doc_id bigint, text string").selectExpr("*", "5 AS n_pieces")
    found = pieces.round_trip(docs, model).collect()
    assert len(found) == len(rows) and sum(not r.lossless for r in found) == 1
    by = {r.doc_id: r for r in found}
    assert by[0].n_pieces == by[1].n_pieces == 0 and by[99].decoded_sha256 == hashlib.sha256(b"with   mark").hexdigest()
    assert by[9].decoded_sha256 == hashlib.sha256(ODD[9].encode()).hexdigest()
    assert pieces.round_trip(docs.limit(0), model).isEmpty()
    with pytest.raises(ValueError):
        pieces.encode(docs, model, "n_pieces")


# ---------------------------------------------------------------- op 5


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_words_encode_as_whole_texts(tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    with open(tokenizer, encoding="utf-8") as file:
        encoder = repair.WordEncoder(file.read(), most=20)
    for end in (2, None):
        for _ in range(2):
            offsets, ids = encoder.encode(pa.array(ODD + ODD), end)
            for i, text in enumerate(ODD + ODD):
                whole = library.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])
                assert ids[offsets[i]:offsets[i + 1]].tolist() == whole, text


def test_new_words_are_encoded_without_places_and_known_ones_not_at_all(tokenizer):
    class Counted:
        def __init__(self, library):
            self.library, self.calls = library, Counter()

        def __getattr__(self, name):
            self.calls[name] += name.startswith("encode")
            return getattr(self.library, name)

    with open(tokenizer, encoding="utf-8") as file:
        encoder = repair.WordEncoder(file.read())
    encoder.library = Counted(encoder.library)
    texts = pa.array([x for x in ODD if x and "<|" not in x])
    first = encoder.encode(texts, 2)
    calls = dict(encoder.library.calls)
    assert not calls.get("encode") and calls["encode_batch_fast"] > 0
    again = encoder.encode(texts, 2)
    assert dict(encoder.library.calls) == calls
    assert all((a == b).all() for a, b in zip(first, again))


def test_grammars_are_the_same_with_symbols_beyond_two_bytes():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 40, 50_000)
    few, many = repair.compress(ids, 41, 40), repair.compress(ids, 1 << 17, 40)
    moved = lambda x: np.where(x >= 41, x - 41 + (1 << 17), x)
    assert len(few[1]) and (moved(few[0]) == many[0]).all() and (moved(few[1]) == many[1]).all()


def test_grammar_and_random_access():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n = int(rng.integers(1, 300))
        ids = rng.integers(0, 4, n)
        ids[rng.random(n) < 0.1] = 5
        seq, rules = repair.compress(ids, 6, 5, least=int(rng.integers(2, 5)))
        lengths = repair.expansion_lengths(rules, 6)
        assert (repair.expand(seq, rules, 6, lengths) == ids).all() and (seq == 5).sum() == (ids == 5).sum()
        a = int(rng.integers(0, n))
        b = int(rng.integers(a, n + 1))
        assert (repair.tokens_at(seq, rules, 6, lengths, a, b) == ids[a:b]).all()
    # As the shards are written: no pair worth a rule is left, and copies shrink to a few symbols however long they are.
    for text in (np.tile(rng.integers(0, 9000, 700), 400), np.zeros(100_000, np.int64), rng.integers(0, 60, 200_000) ** 2):
        seq, rules = repair.compress(text, 9001, 9000)
        lengths = repair.expansion_lengths(rules, 9001)
        assert (repair.expand(seq, rules, 9001, lengths) == text).all()
        left = Counter(zip(seq[:-1].tolist(), seq[1:].tolist()))
        assert max((n for (a, b), n in left.items() if a != b), default=0) < 2 * repair.LEAST
    assert len(repair.compress(np.tile(rng.integers(0, 9000, 700), 400), 9001, 9000)[0]) < 50


def test_token_files(spark, tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(3, "twice"), (3, "twice"), (None, "no id")]
    docs = frame(spark, rows, "doc_id bigint, text string").selectExpr("*", "1 AS part", "2 AS ids")
    found = sorted(repair.round_trip(docs, tokenizer, 2).collect(), key=lambda r: r.start)
    assert len(found) == len(rows) and [r.doc_id is None for r in found[:2]] == [True, False]
    assert [r.doc_id for r in found[1:]] == sorted(r[0] for r in rows if r[0] is not None)
    start, left = 0, Counter()
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        left[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    for r in found:
        assert r.start == start
        start += r.n_tokens
        left[r.doc_id, r.n_tokens, r.ids_crc32] -= 1
    assert not +left
    assert repair.round_trip(docs.limit(0), tokenizer, 2).isEmpty()


# ---------------------------------------------------------------- op 7


def brute_length(texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for word in " ".join(texts).lower().encode().split():
        word = b" " + word + b" "
        for i in range(1, len(word)):
            for k in range(min(order, i) + 1):
                counts[k][word[i - k:i]][word[i]] += 1

    def length(text):
        total = 0.0
        for word in text.lower().encode().split():
            word = b" " + word + b" "
            for i in range(1, len(word)):
                for k in range(min(order, i), -1, -1):
                    seen = counts[k].get(word[i - k:i])
                    if seen is None:
                        continue
                    n, kinds = sum(seen.values()), len(seen)
                    if word[i] in seen:
                        total += log2((n + kinds) / seen[word[i]])
                        break
                    total += log2((n + kinds) / kinds)
                else:
                    total += 8
        return total
    return length


ENGLISH = ["the cat sat on the mat and then the dog ran away", "this is the way that we go to the house of the king"]
FRENCH = ["le chat est sur la table et puis le chien est parti", "c'est la vie de la maison que nous avons dans le village"]


def test_code_lengths_are_exact():
    model = ppm.learn({"en": ENGLISH, "fr": FRENCH}, order=3)
    lengths = [brute_length(ENGLISH, 3), brute_length(FRENCH, 3)]
    for text in ENGLISH + FRENCH + ["qqq zzz", "The House", "ça été là", "日本"]:
        assert np.allclose(model.words(text.lower().encode().split()).sum(axis=0), [f(text) for f in lengths])


def test_language_of_documents(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "en") for t in ENGLISH * 6] + [(t, "fr") for t in FRENCH * 6])]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 34 !!", None), (103, "the house of the king", None), (104, "la maison de la vie", None),
             (None, "the cat and the dog", "en"), (103, "the house of the king", None)]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string").selectExpr("*", "true AS held_out", "0.5D AS score")
    found = ppm.identify(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        i = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(i.encode()) % 3 == 1) and 0 <= r.score <= 1
    by = {r.doc_id: r.lang_pred for r in found}
    assert (by[100], by[101], by[102], by[103], by[104], by[None]) == ("und", "und", "und", "en", "fr", "en")
    assert all(by[i] == lang for i, _, lang in rows[:24])
    kept = ppm.in_known_language(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()}.isdisjoint({100, 101, 102}) and kept.count() == len(rows) - 3
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in ppm.identify(unlabelled).collect()} == {"und"}
    assert ppm.identify(docs.limit(0)).isEmpty()


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "wholly other words", "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else "en") for i in range(30)]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string")
    assert set(ppm.sample(docs)) == {"en"}


# ---------------------------------------------------------------- op 10

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar nav-open"><header class="site-header"><h1>Site</h1></header>
<nav><ul><li><a href=1>Home</a></ul></nav><div id="cookie-notice">We use cookies</div><main><h1>Title &amp; more</h1>
<p>First&nbsp;para <a href=x>link</a> text.<div class="ad-slot">Buy</div><p>Second <b>bo</b>ld.<!-- no --><ul><li>one<li>two</ul>
<p class="advert">advert<p>Ha.</p><script>if(a<b){x("</p>")}</script><aside>see also</aside>
<section class="comments"><p>nice!</p><article class="comment">me</article></section><form><label>Mail</label></form></main>
<footer>f &copy;</footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text.main_text(PAGE) == "Title & more First para link text. Second bold. one two Ha."


def test_main_text_without_an_article():
    body = "<div class=menu><a href=1>Home</a> <a href=2>News of the day and of the night and of the year</a></div><div><h2>Head</h2><p>" + "word " * 40
    body += "</p><p>Short.</p><p>" + "other " * 30 + "</p></div><div class=footer>(c)</div>" + "<ul>" + "<li><a href=1>aaaa bbbb</a></li>" * 9 + "</ul>"
    assert main_text.main_text(body) == " ".join(["Head"] + ["word"] * 40 + ["Short."] + ["other"] * 30)
    assert main_text.main_text("<p>tiny</p>") == "tiny"
    assert main_text.main_text("<div><h1>Short page</h1><p>Few words.</p></div>") == "Short page Few words."
    assert main_text.main_text("<div>x<div id='post-7'><div>a<p>b</div>c<div class='comment-list'>d</div></div>e</div>") == "a b c"


def test_main_text_keeps_short_parts_of_pages_without_an_article():
    long, links = "word " * 40, "<ul>" + "<li><a href=1>aaaa bbbb</a></li>" * 5 + "</ul>"
    body = f"<div><div><h1>Title</h1></div></div><div><div><p>{long}</p></div></div><div class=ad>Buy</div><div><div><p>Last.</p></div></div>"
    assert main_text.main_text(body) == " ".join(["Title"] + ["word"] * 40 + ["Last."])
    body = f"{links}<div><p>{long}</p></div>{links}<div><p>Bridge.</p></div>{links}<div><p>{long}</p></div>{links}<p>end"
    assert main_text.main_text(body) == " ".join(["word"] * 40 + ["Bridge."] + ["word"] * 40)
    assert main_text.main_text("".join(f"<div><div><p>short part {i} of the page</p></div></div>" for i in range(6))).count("short part") == 6
    teaser = "<article>Teaser</article>"
    assert main_text.main_text(f"{teaser}<div class=content><p>{long}</p></div>") == " ".join(["word"] * 40)
    assert main_text.main_text(f"<div class=content><article>{long}</article>x</div>") == " ".join(["word"] * 40)
    assert main_text.main_text(f"<div class=content><p>{long}</p>{teaser}</div>") == " ".join(["word"] * 40 + ["Teaser"])


def brute_stretches(weights):
    """Lines of each maximal row of positive windows, from the first weight to the last."""
    positive = [sum(weights[i:i + main_text.WINDOW]) > 0 for i in range(len(weights))]
    found, i = [], 0
    while i < len(weights):
        j = i
        while j < len(weights) and positive[j]:
            j += 1
        mine = [k for k in range(i, j) if weights[k]]
        found += [(mine[0], mine[-1] + 1)] if mine else []
        i = j + 1
    return found


def test_surges_and_dives_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        weights = (rng.integers(1, 90, int(rng.integers(0, 25))) * 1).tolist()
        weights = [w if rng.random() < rng.choice([0.2, 0.6, 0.9]) else 0 for w in weights]
        assert main_text.stretches(weights) == brute_stretches(weights), weights


@pytest.mark.parametrize("marked", [True, False])
def test_main_text_of_random_pages_equals_brute_force(marked):
    rng = np.random.default_rng(1 + marked)
    for _ in range(400):
        blocks = []  # (html, text, weight)
        for i in range(int(rng.integers(1, 25))):
            text = f"line {i} " + "x" * int(rng.integers(1, 120))
            kind = int(rng.integers(0, 6)) if i else 3 * int(rng.integers(0, 2))  # an article without any text marks nothing
            if kind < 3:
                blocks.append((f"<p>{text}</p>", text, len(text)))
            elif kind == 3:
                blocks.append((f"<ul><li><a href='/{i}'>{text}</a></li></ul>", text, 0))
            elif kind == 4:
                blocks.append((f"<nav>{text}</nav>", "", 0))
            else:
                blocks.append((f"<p class='reply-line'>{text}</p>", text, -(-len(text) // 4)))
        body = "".join(b[0] for b in blocks)
        found = brute_stretches([b[2] for b in blocks])
        if not marked and found:
            sums = [sum(b[2] for b in blocks[a:z]) for a, z in found]
            enough = [k for k, n in enumerate(sums) if 8 * n >= max(sums)]
            found = found[enough[0]:enough[-1] + 1]
        kept = [b for a, z in found for b in blocks[a:z] if b[1]]
        sure = [len(b[1]) for b in kept if b[2] == len(b[1]) or not b[2]]
        if not marked and sure:
            for end in (0, -1):
                while kept and 0 < kept[end][2] < len(kept[end][1]) < sum(sure) / len(sure):
                    del kept[end]
        if not found and marked:
            kept = [b for b in blocks if b[1]]
        page = f"<body><div>out</div><article>{body}</article><p>{'out ' * 90}</p>" if marked else f"<body>{body}"
        assert main_text.main_text(page) == " ".join(b[1] for b in kept), page


def test_class_names_weigh_less_than_text():
    long = "word " * 30
    for odd in ('<p class="search-tips">Tips</p>', '<h2 id="copyright">Tips</h2>', '<div class="menu-of-the-day">Tips</div>', 'a <span class="reply-time">Tips</span> b',
                '<p>Tips</p>', '<p><a href=1>Tips</a></p>'):
        assert "Tips" in main_text.main_text(f"<article><p>{long}</p>{odd}<p>{long}</p></article>"), odd
        assert "Tips" in main_text.main_text(f"<div><p>{long}</p>{odd}<p>{long}</p></div>"), odd
    for gone in ('<div class="ad">Tips</div>', '<div class="share">Tips</div>', '<div class="cookie-notice">Tips</div>', '<div id="comments">Tips</div>', '<aside>Tips</aside>',
                 '<div class="menu">Tips</div>', "<ul>" + "<li><a href=1>Tips</a></li>" * 3 + "</ul>"):
        assert "Tips" not in main_text.main_text(f"<article><p>{long}</p>{gone}<p>{long}</p></article>"), gone
    assert main_text.main_text("<article><p>Text.</p><ul><li><a href=1>Home</a><li><a href=2>Next story</a></ul></article>") == "Text."
    assert main_text.main_text(f"<div><p>{long}</p><div class='site-copyright'>(c) me</div></div>") == long.strip()
    assert main_text.main_text('<div class="share">all there is</div>') == "all there is"
    assert main_text.main_text("<article><a href=1>only a link</a></article>") == "only a link"


def test_main_text_with_elements_left_open():
    assert main_text.main_text("<html><head><title>T</title><meta x><body><article><p>one</p></article>") == "one"
    assert main_text.main_text("<html><head><title>T</title><script>x</script><article><p>one</p></article>") == "one"
    for name in ("button", "iframe", "select", "object", "svg", "video"):
        assert main_text.main_text(f"<article><p>a</p><p><{name} x=1>Share</p><p>b</p><div><{name}>no</{name}></div>c</article>") == "a b c", name
        assert main_text.main_text(f"<article><p>a <{name}>Share</{name}> b</p><{name}>Share<p>c</p></article>") == "a b c", name
    assert main_text.main_text("<article>a <math><mi>x</mi></math> b<script>c") == "a x b"
    assert main_text.main_text("<article>a <svg><svg></svg>no<p>no</p></svg> b</article>") == "a b"


def test_main_text_of_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<article>x < y &lt; z"), (4, "u", "<main><p>" + "long text " * 50_000),
            (5, "u", "<<<>>><p"), (6, "u", "<article><p>a<article><p>b</article>c</article>d")]
    pages = frame(spark, rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    found = main_text.extracted(pages).collect()
    assert Counter((r.page_id, r.url, r.n_chars, len(r.text)) for r in found) == Counter(
        (i, u, len(main_text.main_text(h)), len(main_text.main_text(h))) for i, u, h in rows)
    texts = {r.page_id: r.text for r in found}
    assert (texts[2], texts[3], texts[None], texts[6]) == ("", "", "x < y < z", "a b c") and len(texts[4]) == 50_000 * 10 - 1
    assert main_text.extracted(pages.limit(0)).isEmpty()


def test_stretches_go_once_those_that_may_repeat_are_written(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {f.name for f in root.glob("*")}
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a b {passage}"), (2, f"{passage} c d"), (3, "alone")], "doc_id bigint, text string")
    assert sorted(r["n_removed"] for r in substrings.removals(docs).collect()) == [0, 60, 60]
    assert sorted(f.name.partition("-")[0] for f in root.glob("*") if f.name not in before) == ["spans", "stretches"]
