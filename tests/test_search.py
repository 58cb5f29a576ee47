import math
import re
from collections import Counter

import pytest

from lectern.operators import search

DOCS = [
    ("1", "Alpha", "red", "Red fox, red den. RED!"), ("2", "Beta", "red", "A red bird on the fox hill"),
    ("3", "Gamma", "blue", "blue sea"), ("4", "Delta", "blue", None), ("5", "Eps", "blue", "fox fox fox"),
]
CORPUS = search.Corpus("id", "title", ("color",), "1 day")


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "id string, title string, color string, search_text string")


def ask(spark, *texts):
    return spark.createDataFrame([(t, t) for t in texts], "query_id string, query string")


def brute(query, rows=DOCS, k1=1.2, b=0.75):
    words = {r[0]: [w for w in re.split("[^a-z0-9]+", r[3].lower()) if w] for r in rows if r[3] is not None}
    avg = sum(map(len, words.values())) / len(words)
    scores = {}
    for term in set(w for w in re.split("[^a-z0-9]+", query.lower()) if w):
        df = sum(term in ws for ws in words.values())
        for d, ws in words.items():
            tf = Counter(ws)[term]
            if tf:
                idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                scores[d] = scores.get(d, 0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ws) / avg))
    return sorted(((round(s, 6), d) for d, s in scores.items()), key=lambda x: (-x[0], x[1]))


def test_scores_match_the_formula(spark):
    got = search.search(search.build_index(docs(spark), CORPUS), ask(spark, "red fox", "fox")).collect()
    for q in ("red fox", "fox"):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        want = brute(q)
        assert [r.doc_id for r in mine] == [d for _, d in want]
        assert [r.score for r in mine] == pytest.approx([s for s, _ in want], abs=2e-6)


def test_no_hits_null_text_and_unknown_attribute(spark):
    index = search.build_index(docs(spark), CORPUS)
    assert search.search(index, ask(spark, "zebra", "")).count() == 0
    assert index.docs.count() == 4
    with pytest.raises(KeyError):
        search.search(index, ask(spark, "fox"), where={"size": ["big"]})


def test_filter_keeps_corpus_statistics(spark):
    index = search.build_index(docs(spark), CORPUS)
    blue = search.search(index, ask(spark, "fox"), where={"color": ["blue"]}).collect()
    full = {r.doc_id: r.score for r in search.search(index, ask(spark, "fox")).collect()}
    assert [(r.doc_id, r.score) for r in blue] == [("5", full["5"])]


def test_refresh_replaces_documents(spark):
    rows = [("1", "Alpha", "red", "green"), ("6", "Zeta", "red", "fox")]
    index = search.refresh_index(search.build_index(docs(spark), CORPUS), search.build_index(docs(spark, rows), CORPUS))
    now = [r for r in DOCS if r[0] != "1"] + rows
    got = [r.doc_id for r in search.search(index, ask(spark, "fox")).orderBy("rank").collect()]
    assert got == [d for _, d in brute("fox", now)]


def test_ties_break_by_id_and_k_limits(spark):
    rows = [(f"{i:02d}", "t", "red", "same text") for i in range(30)]
    got = search.search(search.build_index(docs(spark, rows), CORPUS), ask(spark, "text"), k=4).orderBy("rank").collect()
    assert [r.doc_id for r in got] == ["00", "01", "02", "03"]


def test_stored_index_answers_alike(spark, tmp_path):
    index = search.build_index(docs(spark), CORPUS)
    search.save_index(index, str(tmp_path / "i"))
    stored = search.load_index(spark, str(tmp_path / "i"), CORPUS)
    assert {r.term: r.df for r in stored.terms.collect()}["fox"] == 3
    rows = lambda i: sorted(search.search(i, ask(spark, "red fox")).collect())
    assert rows(stored) == rows(index)
