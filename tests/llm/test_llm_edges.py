"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, operator by operator."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import (
    bpe,
    catalog,
    chat,
    components,
    embedding_dedup,
    licenses,
    minhash_dedup,
    mix,
    quality,
    token_counts,
    topk,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS = "vec_id long, embedding array<float>, label int, block int, tile string, copies int"


@pytest.fixture(scope="module")
def tokens(spark):
    return catalog.tokenizer(spark)


# op1


def vector_rows(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in vectors], VECTORS)


def test_top_k_ties_nulls_and_lengths(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.0]), (2, [0.5, 0.25]), (1, [0.5, -0.75]), (4, None), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (3, [0.5, 0.0]), (9, []),
    ]
    got = topk.search_embeddings(vector_rows(spark, rows), k=4).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=tuple) if r["query_id"] == 0] == [
        (1, 20, 4096), (2, 1, 2048), (3, 2, 2048), (4, 3, 2048)]
    assert {r["query_id"] for r in got} == {0, 20}
    assert topk.search_embeddings(vector_rows(spark, [])).collect() == []


def test_top_k_is_exact_in_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    cells = rng.normal(0, 0.3, (300, 48)).astype(np.float32)
    cells[100:130] = cells[0]
    for name, value in (("CANDIDATES", 40), ("GROUP", 2), ("QUERY_BLOCK", 7)):
        monkeypatch.setattr(topk, name, value)
    got = topk.search_embeddings(vector_rows(spark, [(i, v.tolist()) for i, v in enumerate(cells)]), k=20).collect()
    whole = np.floor(64 * cells.astype(np.float64)).astype(np.int64)
    for q in range(0, 300, 20):
        scores = whole @ whole[q]
        want = sorted((-int(scores[i]), i) for i in range(300) if i != q)[:20]
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q) == [
            (n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_top_k_of_large_values(spark):
    rows = [(0, [3e18, 1.0]), (1, [1.0, 1.0]), (2, [-1.0, 2.0])]
    got = {r["vec_id"]: r["score"] for r in topk.search_embeddings(vector_rows(spark, rows)).collect()}
    assert got[1] > 0 > got[2]


# op2


def test_embedding_dedup_edges(spark):
    rows = [
        (5, [1.0, 0.0]), (4, [1.0, 0.0]), (6, [0.99, 0.1]), (7, [-1.0, 0.0]), (8, [0.0, 0.0]), (9, None), (10, [None, 1.0]),
        (11, [float("nan"), 0.0]), (12, [2.0, 0.0]), (None, [1.0, 0.0]), (13, [1.0]), (14, []), (4, [1.0, 0.0]),
    ]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(vector_rows(spark, rows)).collect()}
    for i in (4, 5, 6, 12):
        assert got[i] == (3, 4, i == 4)
    for i in (7, 8, 9, 10, 11, 13, 14):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, True) and len(got) == 12
    assert embedding_dedup.near_duplicates(vector_rows(spark, [])).collect() == []


def test_embedding_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 40))
    cells = (centres[rng.integers(0, 12, 400)] + rng.normal(0, 0.22, (400, 40)) * rng.integers(0, 4, (400, 1))).astype(np.float32)
    unit = embedding_dedup.unit(cells)
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(400)
    while True:
        new = np.array([min(label[i], label[link[i]].min(initial=400)) for i in range(400)])
        if (new == label).all():
            break
        label = new
    rows = vector_rows(spark, [(i, v.tolist()) for i, v in enumerate(cells)])
    got = embedding_dedup.near_duplicates(rows, tile=64, sub=16).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {
        i: (int(link[i].sum()), int(label[i])) for i in range(400)}
    assert 20 < len(set(label)) < 390


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (3, 2)]
    got = dict(tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


# op3


def test_chat_escapes_any_text():
    rng = random.Random(2)
    bits = [*chat.CONTROLS, "\\", "<", "[", "|", "\n", "a", "é", "<\\", "[\\", "</", "INST]", "s>"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        role = "".join(rng.choice(bits) for _ in range(rng.randint(0, 4)))
        assert chat.unescape(chat.escape(text)) == text
        made = chat.format_turn(role, [{"kind": "text", "text": text}])["formatted"]
        assert chat.read_turn(made) == (role, text)
        inside = made[len(chat.START) : -len(chat.END) - 1]
        assert not any(c in inside for c in chat.CONTROLS)


def test_chat_parts(spark):
    part = "array<struct<kind string, text string, ref string, width int, height int, seconds double, pages int>>"
    rows = spark.createDataFrame(
        [(1, 0, "assistant", [("text", "see ", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None),
                              ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 2)]),
         (1, 1, "user", None), (1, 2, "user", [])],
        f"conv_id long, turn long, role string, content {part}",
    )
    got = sorted(chat.format_chat(rows, parts="content").collect(), key=lambda r: r["turn"])
    first = got[0]
    assert first["formatted"] == "<|start|>assistant\nsee <|image|><|audio|><|document|><|end|>\n"
    assert [(a["ordinal"], a["kind"], a["ref"], a["tokens"]) for a in first["attachments"]] == [
        (0, "image", "a.png", 3), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 1200)]
    assert all(first["formatted"][a["at"] :].startswith(chat.PLACEHOLDERS[a["kind"]]) for a in first["attachments"])
    assert first["expanded_tokens"] == 1241 and got[1]["formatted"] == got[2]["formatted"] == "<|start|>user\n<|end|>\n"


def test_chat_edges(spark):
    rows = spark.createDataFrame(
        [(1, 0, None, None, "x"), (1, None, "assistant", "a" * 200_000, "x"), (1, 0, None, None, "x"), (None, 0, "user", "hi", "x")],
        "conv_id long, turn long, role string, text string, formatted string",
    )
    (got,) = chat.read_back(chat.format_chat(rows)).collect()
    assert (got["conv_id"], got["n_turns"], got["loss_chars"]) == (1, 3, 200_000)
    assert chat.read_back(chat.format_chat(rows.limit(0))).collect() == []


# op4


def near(spark, rows, **kwargs):
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, node string, chunk int")
    return {r["doc_id"]: (r["group_id"], r["kept"]) for r in minhash_dedup.near_duplicates(docs, **kwargs).collect()}


def test_near_dedup_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    got = near(spark, [
        (9, "a b c d e f g"), (3, "a  b c d\ne f g"), (4, None), (5, ""), (6, " \n"), (7, "a b"), (8, "a b"), (None, "a b"), (10, long),
        (11, long + " end"), (12, "b a"), (3, "a  b c d\ne f g"), (13, "x y"), (14, "x y"), (13, "a b"),
    ])
    assert got == {
        9: (3, False), 3: (3, True), 4: (4, True), 5: (5, True), 6: (6, True), 7: (7, True), 8: (7, False), None: (None, True),
        10: (10, True), 11: (10, False), 12: (12, True), 13: (7, False), 14: (7, False),
    }
    assert near(spark, []) == {}


@pytest.mark.parametrize("tiles", [("TILE", 16), ("TILE_BYTES", 20_000), ("TILE", 512)])
def test_near_dedup_of_one_large_group(spark, monkeypatch, tiles):
    """Copies with some words changed each, in a group of many tiles, and strangers that share its passages."""
    from llm_reference import near_duplicate_groups

    for name, value in (tiles, ("CHUNK_BYTES", 20_000), ("RANGE_BYTES", 9_000)):
        monkeypatch.setattr(minhash_dedup, name, value)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 5, 9])):
            words[rng.randrange(200)] = f"x{rng.randrange(10_000)}"
        rows.append((d, " ".join(words)))
    rows += [(200 + d, " ".join([f"y{d}-{i}" for i in range(60)] + base[:50])) for d in range(40)]
    got = {d: g for d, (g, _) in near(spark, rows).items()}
    assert got == near_duplicate_groups(rows)


def test_near_dedup_of_a_second_text_of_the_central_document(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TILE", 16)
    base = [f"w{i}" for i in range(200)]
    rows = [(50, " ".join(base))]
    for d in range(60, 100):
        rows.append((d, " ".join(base[: d + 40] + [f"x{d}"] + base[d + 41 :])))
    other = [f"y{i}" for i in range(200)]
    rows += [(50, " ".join(other)), (200, " ".join(other[:-1] + ["z"]))]
    got = near(spark, rows)
    assert {g for g, _ in got.values()} == {50} and len(got) == 42
    monkeypatch.setattr(minhash_dedup, "TILE", 512)
    assert near(spark, rows) == got


def test_near_dedup_of_a_doc_id_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "CHUNK_DOCS", 50)
    rows = [(7, " ".join(f"h{d}-{i}" for i in range(30))) for d in range(300)]
    rows += [(100 + d, " ".join([f"c{d}-{i}" for i in range(30)])) for d in range(300)]
    rows += [(500 + d, rows[d if d < 3 else 297 + d][1] + " end") for d in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = minhash_dedup.dealt(docs, 18).groupBy("chunk").count()
    assert chunks.count() == 18 and chunks.agg(F.max("count")).first()[0] < 100
    got = near(spark, rows)
    assert {d for d, (g, _) in got.items() if g == 7} == {7, 500, 501, 502}
    assert all(got[500 + d][0] == 100 + d - 3 for d in range(3, 300))
    repeated = minhash_dedup.repeated_texts(docs).collect()
    assert sorted(r["doc_id"] for r in repeated) == list(range(500, 800))


def test_weighted_samples_estimate_similarity():
    rng = np.random.default_rng(0)
    names = rng.integers(0, 1 << 48, 400).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    left = dict(zip(names[:300].tolist(), a, strict=True))
    right = dict(zip(names[100:].tolist(), np.r_[a[100:], b[:100]], strict=True))
    least = sum(min(left[s], right[s]) for s in left.keys() & right.keys())
    want = least / (sum(left.values()) + sum(right.values()) - least)
    hits = []
    for shift in range(20):
        x, y = (minhash_dedup.weighted_samples(np.array(list(z), np.uint64) + np.uint64(shift), np.array(list(z.values()))) for z in (left, right))
        hits.append((x == y).mean())
    assert np.mean(hits) == pytest.approx(want, abs=0.05)


# op5


def test_mix_targets_and_limits(spark):
    docs = [(i, "a " * (1 + i % 7), "en", ["hot", "b", "c", None][0 if i % 3 else i % 4], 0) for i in range(400)]
    docs += [(1000, None, "en", "empty", 0), (1001, "", "en", "empty", 0), (7, "again and again", "en", "b", 0), (None, "no id", "en", "c", 0)]
    frame = spark.createDataFrame([(*d, 1, 2.0, "k") for d in docs], DOCS + ", size int, target double, key string")
    rows = mix.positions(mix.plan_mix(frame)).collect()
    assert len(rows) == len(docs)
    per = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
        per.setdefault(r["doc"]["source"], []).append(r)
    for source, found in per.items():
        assert sum(r["taken"] for r in found) == int(found[0]["target"] + 0.5)
        assert sum(r["size"] for r in found) == found[0]["source_size"]
    assert sum(x[0]["target"] for x in per.values()) == pytest.approx(sum(r["size"] for r in rows))
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["size"], r["taken"], r["position"])
    again = mix.positions(mix.plan_mix(frame.repartition(7))).collect()
    assert sorted(map(str, map(key, rows))) == sorted(map(str, map(key, again)))
    assert mix.plan_mix(frame.limit(0)).collect() == []
    copies = mix.realise(mix.plan_mix(frame))
    assert copies.columns == frame.columns and copies.count() > 0


def test_schedule_inverts_its_integral(spark):
    for knots in mix.SCHEDULES:
        times = [0.0, 0.1, 0.3, 0.5, 0.77, 1.0]
        total = sum((t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:], strict=False))
        shares = []
        for t in times:
            area = 0.0
            for (t0, f0), (t1, f1) in zip(knots, knots[1:], strict=False):
                x = min(max(t - t0, 0), t1 - t0)
                area += f0 * x + (f1 - f0) / (t1 - t0) * x * x / 2
            shares.append(area / total)
        rows = spark.createDataFrame([(s,) for s in shares], "s double").select(mix.invert(F.col("s"), knots).alias("t")).collect()
        assert [r["t"] for r in rows] == pytest.approx(times, abs=1e-7)


# op6


def test_urls(spark):
    urls = [
        "https://A.Example.NET/en/1?x#y", "http://example.net/en", "http://net/x", "http://net", "http://fnet/", "x://a.org/fr/",
        "http://b.org/FR/", "http://example.com/de/1", "http://example.com/en/://org/fr/", "no scheme", None, "", "://", "http://é.net/?q",
        "http://example.net/en/1", "http://example.net/en/1",
    ]
    frame = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(frame, catalog.RULES).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[1][2:] == ("net/", "block") and got[2][2:] == ("net/", "block") and got[3] == ("net", "", None, "allow")
    assert got[4][2:] == (None, "allow") and got[5][2:] == ("org/fr/", "allow") and got[6][2:] == (None, "allow")
    assert got[7][2:] == ("example.com/de/", "block") and got[8][:3] == ("example.com", "/en/://org/fr/", None)
    for i in (9, 10, 11, 12):
        assert got[i] == ("", "", None, "allow")
    assert got[13] == ("é.net", "/", "net/", "block") and got[14] == got[15]
    assert url_filter.filter_urls(frame.limit(0), catalog.RULES).collect() == []
    assert {r["verdict"] for r in url_filter.filter_urls(frame, [], default="block").collect()} == {"block"}


def test_cascade_is_exact(spark):
    every = spark.range(6000).select(F.concat(F.lit("key"), F.col("id")).alias("key"))
    listed = every.where("substring(key, -1) in ('3', '7')")
    levels = url_filter.build_cascade(listed, every)
    got = every.where(url_filter.member(levels, F.col("key")))
    assert len(levels) > 2 and got.exceptAll(listed).isEmpty() and listed.exceptAll(got).isEmpty()


def test_one_doc_id_on_a_third_of_the_rows_is_dealt_out(spark):
    rows = [(7 if i % 3 == 0 else i, f"w{i} " * (i % 5), "en", "s", 1) for i in range(900)]
    frame = spark.createDataFrame(rows, DOCS)
    plan = mix.plan_mix(frame)
    hot = {r["start"] for r in plan.where("doc_id = 7 and size > 0").collect()}
    assert len(hot) == sum(1 for doc_id, text, *_ in rows if doc_id == 7 and text)
    key = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.md5(F.col("text").cast("binary"))))
    assert frame.where("doc_id = 7").select(F.substring(key, 1, 4)).distinct().count() > 200
    assert plan.exceptAll(mix.plan_mix(frame.repartition(5))).isEmpty()


# op7, op8


def test_bpe_equals_the_library_on_odd_texts(tokens):
    reference = tiktoken.Encoding(
        "own", pat_str=tokens.pattern, mergeable_ranks=tokens.merges.value.ranks, special_tokens={})
    machine = bpe.Transducer(tokens.merges.value, tokens.pattern)
    rng = random.Random(9)
    signs = "abcABC  \n\t\x1c\x85\xa0éöü中文😀12'sllt.,!?|%\u200b\u3000\u180e\ufeff\u0301ٱ²½<|endoftext|>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [c * n for c in ("a", "é", " ", "\n", "\x00", "A", "ab", "!") for n in (1, 2, 3, 7, 400, 5000)]
    for text in texts:
        ids = machine.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert "".join(bpe.decode_text(machine, ids)) == text


def test_pieces_read_together_equal_pieces_read_alone(tokens, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdeéß\x00.中") for _ in range(rng.randint(1, 30))) for _ in range(40)) for _ in range(60)]
    together = bpe.Transducer(tokens.merges.value, tokens.pattern).encode_many(texts)
    for limit, rounds in ((0, 40_000), (9, 7)):
        monkeypatch.setattr(bpe, "LONG", limit)
        monkeypatch.setattr(bpe, "ROUND", rounds)
        machine = bpe.Transducer(tokens.merges.value, tokens.pattern)
        assert [machine.encode(t) for t in texts] == together


def test_utf8_stream_by_single_bytes():
    text = "aé中😀" * 3
    stream = bpe.Utf8Stream()
    assert "".join(stream.feed(bytes((b,))) for b in text.encode()) + stream.end() == text
    stream = bpe.Utf8Stream()
    assert stream.feed("中".encode()[:2]) == "" and stream.end() == "\ufffd"


def test_state_tables_may_start_anew(tokens, monkeypatch):
    monkeypatch.setattr(bpe, "STATES", 5)
    monkeypatch.setattr(bpe, "KEPT", 3)
    reference = tiktoken.Encoding("own", pat_str=tokens.pattern, mergeable_ranks=tokens.merges.value.ranks, special_tokens={})
    monkeypatch.setattr(bpe, "PAIRS", 4)
    machine = bpe.Transducer(tokens.merges.value, tokens.pattern)
    text = "Thonst aonthrein thedtiou anon, Thonst aonthrein. Les eaux entrent"
    assert np.frombuffer(machine.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_token_edges(spark, tokens):
    rows = [(1, None, 5), (2, "", 5), (3, "a " * 50_000, 5), (None, "x", 5), (4, "x", 5), (4, "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.round_trip(docs, tokens).collect()
    assert sorted(r["decoded"] for r in got) == sorted(t or "" for _, t, _ in rows)
    assert bpe.round_trip(docs.limit(0), tokens).collect() == []
    there = bpe.encode_documents(docs, tokens, keep=("doc_id", "ids"))
    assert there.columns == ["row", "ids"]
    assert sorted(r["decoded"] for r in bpe.decode_documents(there, tokens).collect()) == sorted(t or "" for _, t, _ in rows)
    histogram = token_counts.length_histogram(docs, tokens)
    assert {r["n_tokens"]: r["docs"] for r in histogram.collect()} == {0: 2, 1: 3, 50_001: 1}
    assert {r["n_tokens"]: r["tokens_if_cut"] for r in token_counts.suffix_sums(histogram).collect()} == {0: 0, 1: 4, 50_001: 50_004}
    at = {r["context_limit"]: (r["tokens_if_cut"], r["docs_longer"]) for r in token_counts.totals_at(histogram, [0, 1000, 99_999]).collect()}
    assert at == {0: (0, 4), 1000: (1003, 1), 99_999: (50_004, 0)}
    assert token_counts.quantile(token_counts.suffix_sums(histogram), 0.5).first()["n_tokens"] == 1
    assert token_counts.suffix_sums(token_counts.length_histogram(docs.limit(0), tokens)).collect() == []


# op9


def test_quality_edges(spark):
    good, bad = "some plain words in a row, and more of them.", "LOUD!! WORDS!! EVERY!! WHERE!!"
    docs = spark.createDataFrame(
        [(i, good if i % 2 else bad, "en", "s", 0, 0.0) for i in range(400)]
        + [(1000, None, "en", "s", 0, 0.0), (1001, "", "en", "s", 0, 0.0), (None, good, None, None, None, None), (1, good, "en", "s", 0, 0.0),
           (1002, "word " * 100_000, "en", "s", 0, 0.0)],
        DOCS + ", score double",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(3, None), (None, 1), (5, 1), (5, 0), (5, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for r in rows:
        if r["row"]["doc_id"] is not None and r["row"]["doc_id"] < 400:
            assert (r["score"] >= 0.7) == (r["row"]["doc_id"] % 2 == 1)
    again = quality.train(docs.repartition(5), labels.repartition(3))
    assert (again.vectors == model.vectors).all() and (again.network.w1 == model.network.w1).all()
    assert quality.score(docs.limit(0), model).collect() == []
    none = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}


def test_quality_learns_nothing_held_out(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    ids = spark.range(50).select("id", quality.held_out(F.col("id")).alias("out")).where("out").collect()
    learned = {r["doc_id"] for r in quality.training_labels(labels).collect()}
    assert learned.isdisjoint({r["id"] for r in ids}) and len(learned) + len(ids) == 50
    assert quality.training_labels(labels, 7).count() == 7


def test_quality_learns_once_from_a_repeated_document(spark, monkeypatch):
    seen = []
    fit = quality.fit_network
    monkeypatch.setattr(quality, "fit_network", lambda x, y, calibrate: seen.append(x) or fit(x, y, calibrate))
    texts = [(i, f"one text of its own {i} " * (i + 1)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    first = spark.range(40).where(~quality.held_out(F.col("id"))).first()["id"]
    models = []
    for more in ([], [(first, f"other text {i % 7}") for i in range(300)] + [(first, "zzz")] * 9 + [(first, None)]):
        rows = [(d, "a text" if d == first else t) for d, t in texts] + more
        models.append(quality.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), labels))
    assert len(seen[0]) == len(seen[1]) <= 40 and np.array_equal(seen[0], seen[1])
    assert np.array_equal(models[0].vectors, models[1].vectors)


# op10


def test_licence_inheritance(spark):
    rows = [
        (1, "r/LICENSE", "MIT things\n\nReleased under the MIT License."), (2, "r/a/COPYING.txt", "Licensed under the Apache License,\nVersion 2.0."),
        (3, "r/a/b/c/x.py", "code"), (4, "r/a/y.py", "All rights reserved.\ncode"), (5, "r/z.py", None), (6, "q/z.py", ""), (7, None, "code"),
        (8, "top.py", "code"), (9, "r/z.py", None), (10, "r/LICENSE-2", "All rights reserved."), (11, "ra/x.py", "the MIT and the rest of it"),
    ]
    files = spark.createDataFrame([(*r, "k", "d") for r in rows], "doc_id long, path string, text string, own string, directory string")
    got = {r["row"]["doc_id"]: (r["own"], r["licence"], r["declared_in"]) for r in licenses.scan_licences(files).collect()}
    assert got[1] == ("MIT", "MIT", "r/LICENSE") and got[4] == ("Proprietary", "Proprietary", "r/a/y.py")
    assert got[2] == ("Apache-2.0", "Apache-2.0", "r/a/COPYING.txt") and got[3] == (None, "Apache-2.0", "r/a")
    assert got[5] == got[9] == (None, "MIT", "r") and got[10][0] == "Proprietary"
    for i in (6, 7, 8, 11):
        assert got[i] == (None, None, None)
    assert licenses.scan_licences(files.limit(0)).collect() == []


def test_licence_words_weigh_by_the_whole_corpus(spark):
    notice = licenses.TEMPLATES[0][1]
    rows = [f"lo mi so {i}\n{notice if i % 10 == 0 else ''}" for i in range(600)] + [f"lo mi {notice}"]
    files = spark.createDataFrame([(i, f"{i}.txt", t) for i, t in enumerate(rows)], "doc_id long, path string, text string")
    got = {r["row"]["doc_id"]: r for r in licenses.own_licences(files).collect()}
    assert got[600]["own"] == "Apache-2.0" and got[600]["similarity"] > 0.95
    assert all((r["own"] is not None) == (i % 10 == 0) for i, r in got.items())


def plain_licences(texts, threshold=licenses.THRESHOLD):
    """The best cosine of each file: every line, run of a template's length and, of all files, whole text, with weights from all words."""
    df = Counter(w for t in texts for w in set(licenses.words(t)))
    weigh = lambda bag: {w: n * math.log(1 + len(texts) / max(1, df[w])) for w, n in bag.items()}
    kinds = [(licenses.full_texts(), 0, True), (licenses.TEMPLATES + licenses.NOTICES, 1, True), (licenses.TITLES, 1, False)]
    out = []
    for text in texts:
        lines = [x for line in text.split("\n") if (x := licenses.words(licenses.MARKER.sub("", line)))]
        found, hits = [w for x in lines for w in x], []
        for templates, rank, runs in kinds:
            for name, template in templates:
                own = licenses.words(template)
                n = min(len(own), len(found))
                b = weigh(Counter(own))
                for part in [*lines, *([found[i : i + n] for i in range(len(found) - n + 1)] if runs else []), found]:
                    a = weigh(Counter(part))
                    dot = sum(x * b.get(w, 0) for w, x in a.items())
                    if dot and (c := dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))) >= threshold:
                        hits.append((2 if name == licenses.RESERVED else rank, -round(c, 9), name))
        out.append((min(hits)[2], -min(hits)[1]) if hits else (None, None))
    return out


def test_licences_weigh_all_words_of_the_corpus(spark):
    rng = random.Random(4)
    common, notices = ["lo", "mi", "so", "the", "of", "and"], [t for _, t in licenses.TEMPLATES]
    texts = [" ".join(rng.choices(common, k=12)) + f" rare{i}" for i in range(150)]
    texts += [f"lo mi {notices[0]}", f"rare1 x7 {notices[0]}", "lo mi so lo mi Licensed under Apache License, Version 2.0.", f"lo {notices[4]} mi"]
    for notice in notices:
        w = notice.split()
        for k in (1, 2, 3):
            extra = rng.choices([*common, "rare2", f"new{k}"], k=k)
            at = rng.randrange(len(w))
            texts.append("\n".join([" ".join(extra), " ".join(w[:at] + extra + w[at + (k > 1) :])]))
    files = spark.createDataFrame([(i, f"LICENSE-{i}", t) for i, t in enumerate(texts)], "doc_id long, path string, text string").repartition(3)
    got = {r["row"]["doc_id"]: r for r in licenses.own_licences(files).collect()}
    want = plain_licences(texts)
    assert [got[i]["own"] for i in range(len(texts))] == [w[0] for w in want]
    for i, (_, similarity) in enumerate(want):
        assert similarity is None or got[i]["similarity"] == pytest.approx(similarity, abs=1e-8)
    assert want[150][1] > 0.95 and sum(w[0] is not None for w in want) < len(texts) - 150


def test_licences_in_wrapped_headers_long_lines_and_full_texts(spark):
    fulls = dict(licenses.full_texts())
    texts = {
        "a.py": ("# Licensed under the Apache License,\n# Version 2.0.\nimport x", "Apache-2.0"),
        "b.bat": ("rem This work is licensed under the GNU General\nrem Public License, version 3.\necho on", "GPL-3.0"),
        "c.c": ("/* Some file. Released under the MIT License. See the notes of the project for all the rest of this. */", "MIT"),
        "d.rs": ("// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), "e.rs": ("// SPDX-License-Identifier: ISC", None),
        "LICENSE-f": ("MIT License", "MIT"), "g.txt": ("code\n" + fulls["MIT"] + "\nmore code of mine", "MIT"),
        "h.c": ("Copyright (c) 2020 Some One. All rights reserved.\n" + fulls["BSD-3-Clause"], "BSD-3-Clause"),
        **{f"{n}/LICENSE": (f"Copyright (c) 2020 Some One. All rights reserved.\n\n{t}", n) for n, t in fulls.items()},
        **{f"p{i}.txt": (f"prose of the house and of the sea {i}", None) for i in range(40)},
    }
    files = spark.createDataFrame([(p, t) for p, (t, _) in texts.items()], "path string, text string")
    got = {r["path"]: r["own"] for r in licenses.own_licences(files, keep=("path",)).collect()}
    assert got == {p: name for p, (_, name) in texts.items()}


# pipeline


def test_stages_on_odd_documents(spark, tmp_path):
    rows = [
        (1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "t", 1), (3, None, None, None, None),
        (None, "a b c d e f", "en", "s", 1), (4, "", "en", "s", 0), (5, "long " * 50_000, "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, str(tmp_path)).count() <= 3 * len(rows)
    alone = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or -1) for r in alone) == [-1, 1, 3, 4, 5]


def test_dedup_stage_judges_texts_of_one_doc_id_apart(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [
        (1, "one text of six words here", "en", "s", 1), (1, base, "en", "t", 2), (1, base + " end", "en", "s", 3), (2, "one text of six words here", "en", "s", 1),
        (0, base + " more", "de", "s", 4), (3, None, "en", "s", 1), (3, None, "de", "s", 1), (3, "of three", None, "s", 1), (4, "", "en", "b", 1), (4, "", "en", "a", 1),
        (None, base, "en", "s", 1), (None, base, "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"own": F.lit(1), "of": F.lit(2), "digest": F.lit("x"), "fate": F.lit("drop")})
    got = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    left = sorted([tuple(r)[:5] for r in got.collect()], key=str)
    assert left == sorted([rows[i] for i in (0, 4, 6, 7, 9, 10, 11)], key=str)


def test_token_stage_decodes_what_it_encodes(spark, tmp_path):
    texts = ["plain words", "éàü 漢字 🙂\n\ttabs", "", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.encode(spark, docs, str(tmp_path)).collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}


def whole_row_shuffles(frame, column):
    """How many shuffles that really ran carried ``column``: reused ones count once."""
    frame.collect()
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = frame._jdf.queryExecution().explainString(mode)
    final = plan.split("== Initial Plan ==")[0]
    ran = re.findall(r"\bExchange \((\d+)\)", final)
    assert "== Final Plan ==" in final and ran
    return sum(1 for i in ran if re.search(rf"^\({i}\) Exchange\s*\nInput \[\d+\]: \[.*\b{column}#", plan, re.M))


@pytest.fixture
def no_broadcast(spark):
    """Joins as of tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_of_sources(copies):
    rows = [(i, " ".join(f"w{i}-{j}" for j in range(20 + i % 9)), "en", ["hot", "b", "", None][0 if i % 3 else i % 4], 1) for i in range(120)]
    return rows + [(200 + i, rows[i][1], "en", "b", 1) for i in range(10)] + rows[50 : 50 + copies] + [(None, rows[3][1], "en", "b", 1)] * 2


def test_mix_shuffles_whole_rows_twice(spark, no_broadcast):
    docs = spark.createDataFrame(rows_of_sources(5), DOCS)
    plan = mix.plan_mix(docs)
    assert whole_row_shuffles(plan, "doc") == 1
    assert whole_row_shuffles(mix.realise(plan), "doc") == 2
    # Each source hands out its words without gaps, the unnamed one and the one named by an empty text apart.
    per = {}
    for r in plan.collect():
        per.setdefault(r["doc"]["source"], []).append(r)
    assert set(per) == {"hot", "b", "", None}
    for found in per.values():
        spans = sorted({(r["start"], r["size"]) for r in found})
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert len(spans) == len(found) and sum(n for _, n in spans) == found[0]["source_size"]


@pytest.mark.parametrize("copies", [0, 5])
def test_dedup_stage_shuffles_whole_rows_once(spark, tmp_path, no_broadcast, copies):
    rows = rows_of_sources(copies)
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCS), str(tmp_path))
    # The groups of repeated rows meet in a second shuffle, which holds those rows only and comes after their selection.
    assert whole_row_shuffles(got, "own") - bool(copies) == 1
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows[:120] + [(None, *rows[3][1:2], "en", "b", 1)] * 2, key=str)
