"""Conversation repair, periodic runs and benchmark passages against brute force."""

import hashlib
import heapq
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from coursetrail.llm import contamination, conversations, runs

WS = " \t\n\v\f\r"


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


# ---------------------------------------------------------------- op 11


def brute_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        for _ in range((kind != 0) + (kind == 3)):
            yield conv, turn, "user" if kind == 4 else role, text


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of the rows (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append("blank" if not text.strip(WS) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(WS)[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        for role in ("user", "assistant"):
            if (state, role[0]) in step:
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], out + (f"{role}:",)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for new, extra, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if (state, new[:1]) in step:
                        heapq.heappush(heap, (cost + extra + more, audit + letter, i + 1, step[state, new[:1]], out + (f"{new}:{text}",)))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_conversations(rows):
    groups = {}
    for conv, *_ in rows:
        groups.setdefault(conv, [])
    for conv, *row in brute_damage(rows):
        groups[conv].append(row)
    return Counter((conv, *brute_repair(group)) for conv, group in groups.items())


def some_text(rng):
    return ["", " \n", "yes.", "no", "no!", "Why? ", "the end", "ça va.", "a.b", None][int(rng.integers(0, 10))]


def test_conversations_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u"]
    rows = []
    for conv in [*range(250), None]:
        for turn in range(int(rng.integers(1, 9))):
            rows.append((conv, [turn, turn, turn, None, 3, turn * 4][int(rng.integers(0, 6))], roles[int(rng.integers(0, 8 if rng.random() < .5 else 2))], some_text(rng)))
    rows += rows[:20] + [(5, 1, "user", "long " * 200_000 + ".")]
    data = frame(spark, rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS digest", "2 AS copies", "3 AS kind", "'x' AS blank")
    found = conversations.repairs(conversations.damaged(data))
    assert found.columns == conversations.COLUMNS
    assert Counter(tuple(r) for r in found.collect()) == brute_conversations(rows)
    assert conversations.repairs(conversations.damaged(data.limit(0))).isEmpty()


def test_a_conversation_over_many_tasks(spark):
    rng = np.random.default_rng(2)
    rows = [(7, t, ["user", "assistant"][int(rng.integers(0, 2))], f"{some_text(rng) or ''}{rng.integers(0, 900)}{'.' * int(rng.integers(0, 2))}") for t in range(3000)]
    rows += [(7, 1500, "user", "said often.")] * 1200 + [(8, None, "assistant", "said often.")] * 600 + [(i, 0, "user", "hello.") for i in range(9, 40)] + [(6, 1, "user", "a")]
    data = frame(spark, rows, "conv_id bigint, turn bigint, role string, text string")
    expected = brute_conversations(rows)
    assert Counter(tuple(r) for r in conversations.repairs(conversations.damaged(data)).collect()) == expected


def test_every_split_of_a_span_gives_the_same_cell():
    rng = np.random.default_rng(3)
    for _ in range(150):
        leaves = [conversations.GONE if rng.random() < .2 else conversations.KEPT["sua"[int(rng.integers(0, 3))] if rng.random() < .9 else "", bool(rng.random() < .3)]
                  for _ in range(int(rng.integers(1, 8)))]
        table = {(i, i + 1): cell for i, cell in enumerate(leaves)}
        for size in range(2, len(leaves) + 1):
            for i in range(len(leaves) - size + 1):
                cells = [conversations.product(table[i, k], table[k, i + size]) for k in range(i + 1, i + size)]
                assert all(cell == cells[0] for cell in cells)
                table[i, i + size] = cells[0]
        assert conversations.parsed(leaves) == table[0, len(leaves)]
    assert conversations.parsed([]) == conversations.NOTHING


# ---------------------------------------------------------------- op 12


def brute_lyndon(w):
    def is_lyndon(s):
        return all(s < s[k:] and s[:len(s) - k] != s[k:] for k in range(1, len(s)))
    return [max(j - i for j in range(i + 1, len(w) + 1) if is_lyndon(w[i:j])) for i in range(len(w))]


def brute_runs(w):
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            smallest = next(p for p in range(1, q + 1) if w[i:i + n - p] == w[i + p:i + n])
            if n >= max(6, 4 * q) and smallest == q:
                found.append((i, n, q))
            i = j
    return sorted(found)


def split_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c not in WS:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute_periodic(doc_id, text):
    w = split_words(text)
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    return (doc_id, n, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(), len(gone),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def repeating(rng, size, kinds=3):
    w = []
    while len(w) < size:
        w += rng.integers(0, kinds, int(rng.integers(1, 6))).tolist() * int(rng.integers(1, 8))
    return w[:size]


def test_lyndon_arrays():
    rng = np.random.default_rng(0)
    for _ in range(400):
        w = (rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 14)))).tolist()
        assert runs.lyndon(w) == brute_lyndon(w), w
    parts = [repeating(rng, 9) for _ in range(20)]
    flat = [x + 1 for part in parts for x in [*part, -1]]
    assert [x for x, c in zip(runs.lyndon(flat), flat) if c] == [x for part in parts for x in brute_lyndon(part)]


def test_runs_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(400):
        texts = [repeating(rng, int(rng.integers(0, 60)), int(rng.integers(1, 5))) for _ in range(int(rng.integers(1, 5)))]
        offsets = np.cumsum([0, *map(len, texts)])
        found = runs.runs(np.array([c for t in texts for c in t], np.int64), offsets, batch=int(rng.integers(1, 80)))
        assert found == [brute_runs(t) for t in texts]
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = [bin(i).count("1") % 2 for i in range(512)]
    for w in ([ord(c) for c in fibonacci[-1]], morse, [1] * 700, morse[:64] * 9):
        assert runs.runs(np.array(w), np.array([0, len(w)]))[0] == brute_runs(w)


def test_periodic_documents(spark):
    rng = np.random.default_rng(2)
    texts = [None, "", " \n", "a " * 6, "a " * 5, "Ha ha " * 9 + "x", "é\x0bé\té\né\x1cé é é é é é é"]
    texts += [" ".join(f"w{x}" for x in repeating(rng, int(rng.integers(0, 300)), int(rng.integers(1, 6)))) for _ in range(200)]
    texts += [" ".join(f"v{x}" for x in rng.integers(0, 900, 1200)) for _ in range(6)]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5]), (None, None), (-17, texts[9]), (None, "yes no " * 150_000)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) >= 15
    docs = frame(spark, rows, "doc_id bigint, text string").selectExpr("*", "1 AS start", "2 AS period")
    found = runs.periodic_runs(docs).collect()
    expected = Counter(brute_periodic(i, t) for i, t in rows if len(t or "") < 100_000)
    assert Counter(tuple(r) for r in found if r.n_words < 100_000) == expected
    longest = next(r for r in found if r.n_words == 300_000)
    assert (longest.n_runs, longest.start, longest.length, longest.period, longest.n_dropped) == (1, 0, 300_000, 2, 299_998)
    assert runs.periodic_runs(docs.limit(0)).isEmpty()


# ---------------------------------------------------------------- op 13


def bench_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute_contaminated(docs, items):
    windows = {}
    for item, text in items:
        w = bench_words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        w, hit, found = bench_words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        yield doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_plain_words_of_slices():
    texts = pa.array(["Ab-C d\tÉx1", None, "", "a_b\x00c", "日本 Go"], pa.string())
    for kind in (pa.string(), pa.large_string()):
        for a in range(5):
            for n in range(6 - a):
                assert [t.split() for t in contamination.plain(texts.cast(kind).slice(a, n)).to_pylist()] == [bench_words(t) for t in texts.to_pylist()[a:a + n]]


@pytest.mark.parametrize("short", [False, True])
def test_contamination_equals_brute_force(spark, short):
    rng = np.random.default_rng(4 + short)

    def some(n, kinds=40):
        return [f"W{x}" for x in rng.integers(0, kinds, n)]
    items = [(i, some(int(rng.integers(0 if short else 9, 40)))) for i in range(40)] + [(7, some(14)), (None, some(12)), (50, ["the"] * 25), (51, ["the"] * 12)]
    items += [(i, items[3][1]) for i in range(60, 90)] + ([(90, ["the"]), (91, ["of", "the"])] if short else [])
    texts = [some(int(rng.integers(0, 120))) for _ in range(60)]
    for k in range(60):  # a passage of an item, whole or in part, with other words around it
        words = items[int(rng.integers(0, len(items)))][1]
        a = int(rng.integers(0, 4))
        texts.append(some(int(rng.integers(0, 30))) + words[a:a + int(rng.integers(8, 60))] + some(int(rng.integers(0, 30))))
    texts += [["the"] * n for n in (9, 10, 11, 40)] + [["of", "the", "of"]] + [items[3][1] + ["x"]] * 40
    marks = [" ", ", ", "\n", "-", "... ", "\x00"]

    def written(words):
        return "".join(w + marks[int(rng.integers(0, len(marks)))] for w in words)
    items = [(i, written(w)) for i, w in items] + [(200, None), (201, ""), (202, "?!")]
    docs = [(i, written(w)) for i, w in enumerate(texts)] + [(5, None), (5, ""), (None, written(texts[70])), (None, None), (1000, written(texts[71]))]
    docs += [docs[70]] * 3 + [(2000, written(some(3000)) + items[3][1] + written(some(300_000)))]
    data = frame(spark, docs, "doc_id bigint, text string").selectExpr("*", "1 AS words", "2 AS token")
    benchmark = frame(spark, items, "item_id bigint, text string").selectExpr("*", "1 AS size", "2 AS place")
    found = Counter(tuple(r) for r in contamination.contaminated(data, benchmark).collect())
    assert found == Counter(brute_contaminated(docs, items))
    assert sum(r[-1] for r in found) > 40
    assert contamination.contaminated(data.limit(0), benchmark).isEmpty()
    assert Counter(r.contaminated for r in contamination.contaminated(data, benchmark.limit(0)).collect()) == {False: len(docs)}
