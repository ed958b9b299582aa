import math
import re
from collections import Counter

import numpy as np
import pytest

from ridelake.llm import search as S

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    cut = [(d, Counter(terms(t))) for d, t in docs]
    cut = [(d, c, sum(c.values())) for d, c in cut if c]
    n_docs, n_terms = len(cut), sum(n for _, _, n in cut)
    df = Counter(t for _, c, _ in cut for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        found = []
        for d, c, n in cut:
            m = 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                found.append((-s, d is not None, d or 0, d))
        out += [(i, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(400)] + ["Été", "日本", "x"]
    odds = np.array([1 / (i + 1) for i in range(len(names))])
    text = lambda n: " ".join(rng.choice(names, n, p=odds / odds.sum()))     # noqa: E731
    docs = [(i, text(int(rng.integers(1, 80)))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)]                       # ties
    docs += [(9, docs[9][1]), (None, docs[3][1]), (None, docs[3][1]), (2000, None), (2001, ""), (2002, " .,;\n"), (2003, text(30_000))]
    items = [(i, text(int(rng.integers(1, 30)))) for i in range(25)] + [(30, docs[3][1]), (30, docs[4][1]), (None, docs[3][1].upper()),
                                                                         (31, None), (32, "nowhere"), (33, "--")]
    return docs, items


def test_against_brute_force(spark, corpus, monkeypatch):
    docs, items = corpus
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 50)
    assert rows(S.search(a, b)) == want
    # several blocks of items, few buckets: loose bounds, the same rows
    monkeypatch.setattr(S, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(S, "BUCKETS", 8)
    monkeypatch.setattr(S, "DOCS", 37)
    assert rows(S.search(a, b)) == want
    assert rows(S.search(a, b, k=3)) == brute(docs, items, 3)


def test_bound_stops_the_scoring(corpus, monkeypatch):
    """Exact scores are taken of a part of the documents only, once k good ones are known."""
    docs, _ = corpus
    batches = [S.pa.RecordBatch.from_arrays([S.pa.array([d for d, _ in docs]), S.pa.array([t and t.encode() for _, t in docs], S.pa.binary())], ["key", "text"])]
    done = []
    monkeypatch.setattr(S, "_score", lambda w, d, *a, f=S._score: done.append(len(d)) or f(w, d, *a))
    monkeypatch.setattr(S, "DOCS", 64)

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    cut = list(S._cut(iter(batches)))
    monkeypatch.setattr(S, "_frequencies", lambda *_: dict(enumerate([1] * 3)))
    words = np.unique(np.array([t for x in cut for t in x.column(2).flatten().to_pylist()]))
    out = list(S._block(Frame(), [words[:3]], 740, 60_000, 5, 0)(iter(cut)))
    assert out and sum(done) < 500


def test_clashing_names_and_text_ids(spark):
    docs = spark.createDataFrame([(1, "red fox", "a", 1), (2, "red red hen", "b", 2)], "doc_id long, text string, rank string, score int")
    items = spark.createDataFrame([("q", "RED hen", 5)], "item_id string, text string, doc_id int")
    assert [tuple(r)[:3] for r in S.search(docs, items).orderBy("rank").collect()] == [("q", 1, 2), ("q", 2, 1)]


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, None), (2, "..")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "red")], "item_id long, text string")
    for d, i in ((docs, items), (docs.limit(0), items), (docs, items.limit(0))):
        out = S.search(d, i)
        assert out.collect() == [] and [f.dataType.simpleString() for f in out.schema] == ["bigint", "int", "bigint", "bigint"]
