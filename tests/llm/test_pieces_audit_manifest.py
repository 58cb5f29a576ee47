"""Piece encoding, the audit of filters and the Merkle manifest against a library and plain versions."""

import hashlib
import random
import zlib
from itertools import permutations

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece

from lectern.llm import catalog, chat, filter_audit, merkle, piece_bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask string, n int, grp string, place long, ids string"
LABELS = "doc_id long, quality int, toxic int"
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "   a   ", "▁a▁▁b ▁ c", "</s>[INST] ok [/INST] <unk> <0x0A>", "a\n\tb\r\n", "日本語テキスト",
    "😀😀 \U0001F468‍", "\x00a\x00", "​ x　y", "=" * 70, "---- " * 30, "0123456789" * 30, *[" " * n + "the" for n in range(36)],
    *[" " * n + "日" for n in range(36)], *[" " * n for n in range(36)], "abcdefghij" * 900, "x" * 5000,
]


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source, n_chars), among columns with clashing names."""
    return spark.createDataFrame([(*r, "m", 1, "g", 7, "i") for r in rows], DOCS)


# op11


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=catalog.PIECES)


@pytest.fixture(scope="module")
def pieces(spark):
    return piece_bpe.PieceTokenizer(spark, catalog.PIECES)


def differences(encoder, library, texts):
    wanted = [library.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    got = encoder.encode(texts)
    return [t for t, g, w in zip(texts, got, wanted)
            if np.frombuffer(g, "<u4").tolist() != w or encoder.decode(g) != library.decode(w)]


def test_pieces_of_odd_texts_equal_the_library(pieces, library):
    assert differences(pieces.encoder(), library, ODD) == []


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz ", "ab ", "the in er on re ", "一二三人大 中的", "<>/[]{}()=-_*#\n\t ", "aeiouà̀😀 "])
def test_pieces_of_random_texts_equal_the_library(pieces, library, letters):
    rng = random.Random(letters)
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 400))) for _ in range(150)]
    texts += ["".join(rng.choices(letters.replace(" ", ""), k=rng.randint(65, 3000))) for _ in range(10)]
    assert differences(pieces.encoder(), library, texts) == []


def test_a_long_word_merged_by_windows_equals_rounds(pieces, monkeypatch):
    encoder = pieces.encoder()
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeinortst", k=rng.randint(65, 300))) for _ in range(60)]
    by_windows = list(encoder._values(words))
    monkeypatch.setattr(piece_bpe, "LONG", 1_000)
    assert list(encoder._values(words)) == by_windows


def test_decoding_any_ids_equals_the_library(pieces, library):
    encoder, rng = pieces.encoder(), random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 258), rng.randint(259, 31999), 28705, 2287]) for _ in range(rng.randint(0, 9))]
        assert encoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)
    with pytest.raises(IndexError):
        encoder.decode(np.array([40_000], "<u4").tobytes())


def test_known_words_are_forgotten_without_harm(pieces, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "KEPT", 20)
    rng = random.Random(4)
    encoder = piece_bpe.Encoder(pieces.vocabulary.value)
    for _ in range(6):
        texts = [" ".join("".join(rng.choices("aeinrst", k=rng.randint(1, 5))) for _ in range(20)) for _ in range(3)]
        assert differences(encoder, library, [*texts, "x" * 90 + " the"]) == []


def test_models_of_another_kind_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(catalog.PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="plain BPE"):
        piece_bpe.Vocabulary.compile(str(tmp_path / "other.model"))


def test_piece_rows_keep_their_columns(spark, pieces):
    docs = docs_of(spark, [(1, "a b", None, "s", 3), (1, "a b", None, "s", 3), (None, None, "x", None, None), (2, "", "en", "s", 0)])
    got = piece_bpe.round_trip(docs, pieces, keep=("doc_id", "ids", "text")).collect()
    assert sorted((r["row"]["doc_id"] or 0, r["row"]["ids"], r["row"]["text"], r["decoded"], len(r["ids"])) for r in got if r["row"]["text"] is not None) == [
        (1, "i", "a b", "a b", 16), (1, "i", "a b", "a b", 16), (2, "i", "", "", 8)]
    assert [(r["decoded"], len(r["ids"])) for r in got if r["row"]["text"] is None] == [("", 8)]
    apart = piece_bpe.decode_documents(piece_bpe.encode_documents(docs, pieces), pieces)
    assert sorted(r["decoded"] for r in apart.collect()) == sorted(r["decoded"] for r in got)
    assert piece_bpe.round_trip(docs.limit(0), pieces).collect() == []


def test_pieces_of_documents_equal_the_library(spark, sf_dir, library):
    documents = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    rows = {r["doc_id"]: r for r in catalog.queries()["op11_piece_round_trip"](spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for d in documents:
        ids = library.encode(d["text"] or "", add_bos=True, add_eos=True)
        row = rows[d["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# op12


def plain_audit(docs, labels):
    """Every filter applied in every order, document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))

    def fails(doc_id, text):
        text = text or ""
        words = text.encode().split()
        capitals = sum("A" <= c <= "Z" for c in text)
        return {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * capitals > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": doc_id is not None and least[text] < doc_id}

    out = {}
    for part in {d[2] or "" for d in docs}:
        mine = [(fails(d[0], d[1]), d[0] in good, d[0] in toxic) for d in docs if (d[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left, gone = mine, []
            for step, letter in enumerate(order, 1):
                removed = [d for d in left if d[0][letter]]
                out[part, order, step] = [
                    len(left) - len(removed), len(removed), sum(d[0][letter] for d in gone),
                    sum(d[0][letter] and sum(d[0].values()) == 1 for d in mine), sum(d[1] for d in removed), sum(d[2] for d in removed)]
                shapley[letter] += len(removed)
                left, gone = [d for d in left if not d[0][letter]], gone + removed
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, labels):
    counts = filter_audit.count_masks(docs_of(spark, docs), spark.createDataFrame(labels, LABELS))
    return {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(counts).collect()}


def test_audit_equals_plain_filters(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=4))
    texts = [None, "", "A B", "a|b", " ".join(word() for _ in range(150)), " ".join(word() for _ in range(99)), "same " * 200,
             "WORD " + " ".join(word() for _ in range(120)), "ÉÀ " * 3, "a b  c\t\x0bd", "A" * 30_000, " ".join(word().upper() for _ in range(120))]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "en", "fr"]), "s", 1) for _ in range(160)]
    docs += [(7, "hot", "en", "s", 1)] * 80 + [(None, "hot", "en", "s", 1)] * 5
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(30)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    got = audited(spark, docs, labels)
    assert len(got) == 600 * 3
    assert got == plain_audit(docs, labels)


def test_audit_of_no_rows(spark):
    assert audited(spark, [], []) == {}
    assert set(audited(spark, [(1, "x", None, None, None)], [])) == {("", o, s) for o in filter_audit.orders("ABCDE") for s in range(1, 6)}


def test_packed_counters_do_not_run_over():
    many = 2**62
    total = many * filter_audit.packed(31, True, True) + (many - 1) * filter_audit.packed(0, False, False)
    fields = filter_audit.unpack(total)
    assert set(fields[:, :, 0].ravel().tolist()) == {many - 1}
    assert fields[:, 0, 1].tolist() == fields[:, 0, 5].tolist() == [many] * 120
    assert (fields[:, 1:, 2] == many).all() and not fields[:, :, 3].any()


# op13


def plain_manifest(docs):
    """Trees from sorted lists."""
    h = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def leaf(doc_id, text, lang, source, n_chars):
        fields = [doc_id, source, lang, n_chars, text]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def climb(nodes):
        """The last node, and the runs above each node, from the bottom up, each with the node's slot."""
        paths = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
            for i, path in enumerate(paths):
                path.append((runs[at[i] // 8], at[i] % 8))
                at[i] //= 8
            nodes = [h("".join(run)) for run in runs]
        return nodes[0], paths

    groups = {}
    for d in docs:
        low = None if d[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1])
        changed = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0
        first = leaf(*d)
        groups.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, first, leaf(d[0], low, *d[2:]) if changed else first, d[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([r[2] for r in sorted(groups[g])]) for g in names}
    root, above = climb([trees[g][0] for g in names]) if names else (None, [])
    out = []
    for g, upper in zip(names, above):
        for row, path in zip(sorted(groups[g]), trees[g][1]):
            node, shown = row[3], ""
            for run, slot in path + upper:
                node = h("".join([*run[:slot], node, *run[slot + 1 :]]))
                shown += "".join(run[:slot] + run[slot + 1 :])
            out.append((row[4], row[2], trees[g][0], root, h(shown), node, node == root))
    return sorted(out, key=str)


def made(spark, docs):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, merkle.manifest(docs_of(spark, docs)).select(columns).collect()), key=str)


def some_docs(rng, n, ids, langs):
    return [(rng.choice(ids), rng.choice([None, "", "Abc", "é1", "x" * 40_000, f"T{i}"]), rng.choice(langs), rng.choice([None, "s", "ü"]),
             rng.choice([None, 3])) for i in range(n)]


@pytest.mark.parametrize("n, ids, langs", [
    (1, [5], ["en"]), (9, [None], [None]), (70, range(1000), ["en", None, ""]), (600, range(10**6), ["en"]), (40, range(90), [f"l{i}" for i in range(20)]),
    (200, [-(2**63), 2**63 - 1, -1, 0, 63, 64, 2**22, -(2**40), None, 2**54], ["en", "é", "z"]),
])
def test_manifest_equals_plain_trees(spark, n, ids, langs):
    docs = some_docs(random.Random(n), n, list(ids), langs)
    assert made(spark, docs) == plain_manifest(docs)


def test_manifest_of_one_id_on_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 16)
    rng = random.Random(3)
    docs = some_docs(rng, 150, range(400), ["en", "fr"]) + [(77, "same", "en", "s", 4)] * 50 + [(77, f"t{i}", "en", "s", 4) for i in range(50)]
    assert made(spark, docs) == plain_manifest(docs)


def test_manifest_of_no_rows(spark):
    assert made(spark, []) == []


# op3


def test_large_ids_beside_nulls_stay_exact(spark):
    big = 2**53 + 1
    rows = spark.createDataFrame(
        [(big, big + 1, "user", "a"), (big, big, "user", "b"), (None, 1, "user", "c"), (big, None, "user", "d")],
        "conv_id long, turn long, role string, text string").coalesce(1)
    made = chat.format_chat(rows)
    assert {(r.conv_id, r.turn) for r in made.collect()} == {(big, big + 1), (big, big), (None, 1), (big, None)}
    row = chat.read_back(made).first()
    assert row.conv_id == big and row.turns_sha256 == hashlib.sha256(b"user\nd\nuser\nb\nuser\na\n").hexdigest()
