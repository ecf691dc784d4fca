"""Operators over whole tables against brute force, and the pipeline."""

import base64
import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from coursetrail.llm import fm_index, hnsw, mixing, queries, simhash, substrings, warc
from coursetrail.llm.components import connected
from coursetrail.session import stored

FOLDER = "/root/testdata/sf0.001"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def words(n, seed, kinds=400):
    rng = np.random.default_rng(seed)
    return [f"w{k}" for k in rng.integers(0, kinds, n)]


# ---------------------------------------------------------------- op 2


def test_mixing_equals_sql_on_unequal_sources(spark):
    rng = np.random.default_rng(3)
    rows = [(i, ["big", "big", "big", "big", "big", "mid", "mid", "small", None, ""][int(rng.integers(0, 10))], " ".join(words(int(rng.integers(0, 30)), i)))
            for i in range(600)] + [(1, "big", "again"), (None, "mid", None), (700, "tiny", "one")]
    docs = frame(spark, rows, "doc_id bigint, source string, text string").selectExpr("*", "1 AS n", "2 AS share", "3 AS key", "4 AS number")
    con = duckdb.connect()
    documents = docs.select("doc_id", "source", "text").toArrow()
    con.register("documents", documents)
    cursor = con.execute(queries.OP2_SQL)
    names = [d[0] for d in cursor.description]
    expected = Counter(tuple(r) for r in cursor.fetchall())
    found = mixing.mixture(docs)
    got = Counter(tuple(r) for r in found.select(*names).collect())
    assert got == expected
    assert max(r.epoch for r in found.collect()) >= 1
    assert mixing.mixture(docs.limit(0)).isEmpty()


def test_exponent_meets_its_targets(spark):
    sizes = [900, 50, 30, 20]
    sources = spark.createDataFrame([(n,) for n in sizes], "n bigint")

    def weights(a):
        raised = [(n / 1000) ** a for n in sizes]
        return [x / sum(raised) for x in raised]

    a = mixing.exponent(sources, 1000, 0.8, 1e9, 1000)
    entropy = -sum(w * math.log(w) for w in weights(a))
    assert entropy == pytest.approx(0.8 * math.log(4), abs=1e-4)
    a = mixing.exponent(sources, 1000, 1.0, 3.0, 1000)
    assert max(w * 1000 / n for w, n in zip(weights(a), sizes)) == pytest.approx(3.0, abs=1e-3)
    assert mixing.exponent(sources, 1000, 1.0, 0.5, 1000) == 1.0


def test_the_code_of_a_round_of_probes_does_not_depend_on_its_exponents(spark):
    sources = spark.createDataFrame([(900,), (100,)], "n bigint")

    def code(exponents):
        plan = mixing._probed(sources, exponents, 1000)._jdf.queryExecution()
        return [x for x in spark._jvm.PythonSQLUtils.explainString(plan, "codegen").split("\n") if x.startswith("/* ")]

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert code([0.0, 0.5]) and code([0.0, 0.5]) == code([0.25, 0.75]) and len(code([k / 32 for k in range(33)])) == len(code([0.0, 0.5]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert mixing._probes(sources, [0.0, 1.0], 1000, 1000) == [
        (pytest.approx(math.log(2)), pytest.approx(5.0)), (pytest.approx(-0.9 * math.log(0.9) - 0.1 * math.log(0.1)), pytest.approx(1.0))]


def test_sizes_of_blocks_fill_no_more_files_than_there_are_cores(spark, monkeypatch):
    files, stored = {}, mixing.stored

    def counted(df, purpose):
        found = stored(df, purpose)
        files[purpose] = len(found.inputFiles())
        return found

    monkeypatch.setattr(mixing, "stored", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "101")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = frame(spark, [(i, f"s{i % 3}", "word " * (i % 7)) for i in range(500)], "doc_id bigint, source string, text string")
        assert mixing.mixture(docs).count() > 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 0 < files["mixing-blocks"] <= spark.sparkContext.defaultParallelism


def test_whole_budget_holds_every_document_once_and_no_more_often_than_the_limit(spark):
    rows = [(i, "big" if i < 80 else f"s{i % 4}", "word " * (i % 7)) for i in range(100)]
    docs = frame(spark, rows, "doc_id bigint, source string, text string")
    often = Counter(r.doc_id for r in mixing.mixed(docs, entropy=1.0, repeat=2.0, budget="whole").collect())
    assert set(often) == set(range(100)) and max(often.values()) == 2
    assert all(often[i] == 1 for i in range(80))


# ---------------------------------------------------------------- op 3


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    vectors = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    vectors[::7] *= 3
    vectors[200:700] = vectors[200]  # one vector with a third of all rows
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(5000, None), (5020, [0.0] * 16), (5040, [1.0, None] + [0.0] * 14), (5060, [float("nan")] * 16), (5080, [float("inf")] * 16), (5100, []), (None, [1.0] * 16)]
    other = [(6000, [1.0, 2.0]), (6001, [2.0, 1.0])]
    data = frame(spark, rows + bad + other + [rows[20]], "vec_id bigint, embedding array<double>").selectExpr("*", "0 AS rank", "1 AS score", "2 AS shard")
    found = {}
    for r in hnsw.nearest(data, F.col("vec_id") % 20 == 0, shard_rows=300).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for i in range(0, 1500, 20):
        scores = (vectors * vectors[i]).sum(axis=1)
        scores[i] = -np.inf
        exact = np.lexsort((np.arange(1500), -scores))[:20]
        mine = sorted(found[i])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(s == pytest.approx(scores[v], abs=1e-12) for _, v, s in mine) and i not in {v for _, v, _ in mine}
        hits += len({v for _, v, _ in mine} & set(exact.tolist()))
    assert hits >= 0.9 * 20 * 75
    assert found[6000] == [(1, 6001, 4.0)]
    assert set(found) == set(range(0, 1500, 20)) | {6000}
    assert hnsw.nearest(data.limit(0), F.col("vec_id") % 20 == 0).isEmpty()


# ---------------------------------------------------------------- op 6


def test_matching_statistics_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(150):
        count, window = rng.integers(1, 8), int(rng.integers(1, 6))
        lengths, weights = rng.integers(1, 40, size=count), rng.integers(1, 3, size=count)
        text, starts = rng.integers(0, 3, size=lengths.sum()), np.cumsum(lengths) - lengths
        often = Counter()
        for s, n, w in zip(starts, lengths, weights):
            for a in range(n - window + 1):
                often[tuple(text[s + a:s + a + window])] += w
        index = fm_index.FMIndex(text, lengths, weights)
        got = {(q, z) for q, a, b in zip(*fm_index.repeated_windows(index, text, starts, lengths, window)) for z in range(a, b - window + 1)}
        assert got == {(q, z) for q, (s, n) in enumerate(zip(starts, lengths)) for z in range(n - window + 1) if often[tuple(text[s + z:s + z + window])] >= 2}


def brute_removals(texts, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    often = Counter(tuple(w[a:a + window]) for w in split for a in range(len(w) - window + 1))
    for w in split:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if often[tuple(w[a:a + window])] > 1:
                gone[a:a + window] = [True] * window
        yield w, [x for x, g in zip(w, gone) if not g]


def test_repeated_passages(spark):
    passage = words(60, 1)
    texts = [None, "", "   ", "short text", " ".join(words(200, 2)), " ".join(words(50, 3) + passage + words(40, 4)), "\n".join(passage + words(80, 5)),
             " ".join(words(10, 6) + passage[5:45]), " ".join(["again"] * 300), " ".join(words(34, 7)), " ".join(words(34, 7)), " ".join(words(35, 8)),
             " ".join(words(35, 8)), " ".join(words(90, 9) * 2), " ".join(words(4000, 10) + passage[20:58])]
    rows = list(enumerate(texts)) + [(4, texts[4]), (None, " ".join(words(70, 11))), (None, " ".join(words(70, 11)[:50])), (20, texts[9]), (20, "other " * 3)]
    docs = frame(spark, rows, "doc_id bigint, text string").selectExpr("*", "1 AS windows", "2 AS spans", "3 AS text_hash_")
    expected = Counter()
    for (i, _), (whole, rest) in zip(rows, brute_removals([t for _, t in rows], 35)):
        expected[i, len(whole), len(whole) - len(rest), hashlib.sha256(" ".join(rest).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in substrings.removals(docs).collect()) == expected
    assert sum(1 for (_, _, gone, _) in expected if gone) >= 8
    assert substrings.removals(docs.limit(0)).isEmpty()
    clashing = docs.selectExpr("doc_id", "text", "7 AS text_hash", "8 AS spans", "'x' AS text_hash_")
    rest = substrings.without_repeats(clashing)
    assert rest.columns == clashing.columns
    assert Counter((r.doc_id, r.text, r.text_hash, r.spans, r.text_hash_) for r in rest.collect()) == Counter(
        (i, t if len(w) == len(k) else " ".join(k), 7, 8, "x") for (i, t), (w, k) in zip(rows, brute_removals([t for _, t in rows], 35)))


# ---------------------------------------------------------------- op 8


def test_archives(spark, tmp_path):
    rows = [(5, "u5", "same"), (2, "u2", "same"), (9, "u9", "same"), (3, None, None), (4, "u\r\nx: y", ""), (6, "u6", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
            (7, "é", "ü" * 300_000), (8, "u8", "alone"), (2, "u2", "same"), (None, "u", "same")]
    pages = frame(spark, rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS digest", "2 AS first", "3 AS n")
    found = warc.round_trip(pages).collect()
    first = {"same": 2, "": 3}
    expected = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        visit = first.get(html or "", i) != i
        expected[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if visit else "response", first[html or ""] if visit else None] += 1
    assert Counter(tuple(r) for r in found) == expected
    assert {r.record_type for r in warc.round_trip(pages, least=5).where("payload_bytes < 5").collect()} == {"response"}
    assert warc.round_trip(pages.limit(0)).isEmpty()


def test_filters_are_settled_before_payloads_are_read(spark, tmp_path):
    path = str(tmp_path / "archive")
    pages = frame(spark, [(i, f"u{i % 3}", "x" * i) for i in range(30)], "page_id bigint, url string, html string")
    warc.archive(pages, path)
    frame_ = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'response' AND target_uri IN ('u1', 'u2')")
    assert frame_.count() == 20 and frame_.where("payload IS NOT NULL").isEmpty()
    plan = frame_._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan or "record_type" not in plan.split("Filter (")[1].split("\n")[0]

    class Counting:
        def __init__(self, data):
            self.data, self.at, self.got = data, 0, 0

        def read(self, n):
            out = self.data[self.at:self.at + n]
            self.at += len(out)
            self.got += len(out)
            return out

        def seek(self, n, _):
            self.at += n

    row = dict.fromkeys(warc.HEADERS) | {"record_type": "response", "payload": np.random.default_rng(0).bytes(1_000_000)}
    raw = Counting(warc.record(row) + warc.record(row | {"record_type": "metadata", "payload": b"m"}))
    kept = list(warc.records(warc.Buffered(raw, 512), lambda r: r["record_type"] == "metadata", True))
    assert [r["payload"] for r in kept] == [b"m"] and raw.got < 5_000


# ---------------------------------------------------------------- op 9


def brute_fingerprint(text, n=4):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i:i + n]), 42) for i in range(max(1, len(found) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, budget):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= budget:
                root[find(b)] = find(a)
    return {f: find(f) for f in fps}


def test_near_duplicates(spark):
    base = words(3000, 1)
    near = [base[:i] + ["changed"] + base[i + 1:] for i in range(100, 2500, 200)]
    texts = [None, "", " \t", "One", "one", "a b c", "A  b\nC"] + [" ".join(t) for t in near] + [" ".join(base)] * 3 + [" ".join(words(50, s)) for s in range(2, 9)]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(100, None), (None, "lonely text here"), (None, "A b c")]
    docs = frame(spark, rows, "doc_id bigint, text string").selectExpr("*", "0 AS fp", "1 AS root")
    fps = {t: brute_fingerprint(t) for _, t in rows}
    roots = brute_roots(set(fps.values()), 4)
    least = {}
    for i, t in rows:
        if i is not None:
            least[roots[fps[t]]] = min(i, least.get(roots[fps[t]], i))
    found = Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert found == Counter((i, f"{fps[t]:016x}", least.get(roots[fps[t]])) for i, t in rows)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots[f] for f in fps.values()))
    assert simhash.near_duplicates(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("hot", [4096, 7])
def test_trie_join_loses_no_link(spark, hot):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = set()
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.integers(0, 64, int(rng.integers(0, 5))):
                x ^= 1 << int(b)
            fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 300, dtype=np.uint64)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    data = spark.createDataFrame([(v,) for v in signed.values()], "fp bigint")
    links = simhash.linked(data, 4, hot=hot)
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 64 for r in links.collect())
    root = {r.node: r.root for r in connected(links).collect()}
    expected = brute_roots(fps, 4)
    groups = {}
    for f, r in expected.items():
        groups.setdefault(r, set()).add(signed[f])
    mine = {}
    for f in signed.values():
        mine.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_near_duplicate_stage_keeps_one_document_a_group(spark):
    rng = np.random.default_rng(7)
    texts = [None, "", "a b c", "A b\nC", "a b c d"]
    for k in range(40):  # copies with a word changed here and there
        base = words(int(rng.integers(200, 2500)), 100 + k, 5000)
        texts += [" ".join(base)] * 2
        for n in (1, 3):
            copy = list(base)
            for at in rng.integers(0, len(base), n):
                copy[at] = f"changed{at}"
            texts.append(" ".join(copy))
    texts += ["filler " * 300_000 + t for t in ("one", "two three four five six seven")]  # several pieces a batch
    fps = [brute_fingerprint(t) for t in texts]
    roots = brute_roots(set(fps), 4)
    first = {}
    for i, f in enumerate(fps):
        first.setdefault(roots[f], i)
    assert 40 < len(first) < len(set(fps))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).selectExpr("*", "1 AS fp", "2 AS text_hash")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), FOLDER).isEmpty()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7), (None, 3)] + [(300, i) for i in range(301, 350)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 200: 100} | {i: 300 for i in range(300, 350)}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).isEmpty()


# ---------------------------------------------------------------- registration and pipeline


def test_registered():
    import __spark_entry__ as entry_points

    assert len([n for n in entry_points.queries() if re.match(r"op\d+_", n)]) == 13 and "pipeline" in entry_points.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.all_queries()} == {str(i) for i in range(1, 14)}


def test_queries_equal_their_sql(spark):
    from compare import compare, connect

    con = connect(FOLDER)
    for name, sql in queries.all_sql().items():
        problem, rows = compare(spark, con, FOLDER, queries.all_queries()[name], sql)
        assert not problem and rows, (name, problem)


def test_pipeline(spark):
    copy, passage = words(300, 1), words(60, 2)
    texts = {1: " ".join(copy), 2: " ".join(copy), 3: " ".join(words(80, 3) + passage + words(80, 4)), 4: " ".join(words(90, 5) + passage + words(70, 6)),
             5: "123 456", 6: None, 7: "", 8: " ".join(words(120, 8)), 9: "a short clean text"}
    rows = [(i, t, "en", "big" if i < 9 else "small", len(t or "")) for i, t in texts.items()]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        kept.append(docs)
    first, second, third, fourth, last = kept
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for d in kept[:-1])
    assert {r.doc_id for r in first.collect()} == {1, 2, 3, 4, 8, 9}
    assert sorted(r.doc_id for r in second.collect()) == [1, 3, 4, 8, 9]
    rest = {r.doc_id: r for r in third.collect()}
    assert rest[3].text == " ".join(words(80, 3) + words(80, 4)) and rest[4].n_chars == len(rest[4].text) and rest[1].text == texts[1]
    often = Counter(r.doc_id for r in fourth.collect())
    assert set(often) == {1, 3, 4, 8, 9} and max(often.values()) <= 2 and often[9] == 2
    assert last.columns == ["doc_id", "lang", "source", "n_chars", "piece_ids"] and last.count() == fourth.count()
    from coursetrail.llm.pieces import Vocabulary

    with open(queries.tokenizer_file("piece_bpe_32k.model"), "rb") as file:
        vocabulary = Vocabulary(file.read())
    for r in last.collect():
        ids = np.array(r.piece_ids)
        assert vocabulary.decode(np.array([0, len(ids)]), ids)[0].decode() == rest[r.doc_id].text
