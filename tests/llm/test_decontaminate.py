import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.llm import decontaminate as D

WORDS = np.array([f"w{i}" for i in range(4000)] + ["the", "of", "and"] * 400)


def brute_distance(item, region):
    row = list(range(len(region) + 1)) and [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(region, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        at, kind = rng.integers(0, len(out)), rng.integers(0, 3)
        if kind == 0:
            out[at] = str(rng.choice(WORDS))
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, str(rng.choice(WORDS)))
    return out


def test_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        item, region = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(0, 25))
        got, end = D.edit_distance(item, region)
        assert got == brute_distance(item.tolist(), region.tolist())
        assert brute_distance(item.tolist(), region[:end].tolist()) == got


def test_recall_at_the_limit_and_no_false_finds(spark):
    rng = np.random.default_rng(3)
    items = [[str(w) for w in rng.choice(WORDS, rng.integers(13, 60))] for _ in range(60)]
    docs, planted = [], {}
    for k in range(400):
        body = [str(w) for w in rng.choice(WORDS, 120)]
        if k < 300:
            i = k % 60
            at = rng.integers(0, 120)
            edits = int(0.2 * len(items[i])) if k < 180 else 0
            body[at:at] = edited(rng, items[i], edits)
            planted[k] = i
        docs.append((k, " ".join(body).capitalize().replace(" ", "\n" if k % 2 else " ") + "."))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, ", ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(d, b).collect()}
    want = {(k, i) for k, i in planted.items()}
    assert len(got & want) >= 0.99 * len(want)
    # every find is one by the definition
    text = dict(docs)
    for k, i in got:
        region = [w.decode() for w in D.item_words(text[k])]
        assert brute_distance(items[i], region) <= int(0.2 * len(items[i]))
    clean = {r["doc_id"] for r in D.without_leaks(d, b).collect()}
    assert clean == set(range(400)) - {k for k, _ in got}


def test_places_and_borders(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, item), (2, item + " x " * 30 + item), (3, "alpha beta gamma delta"), (4, "epsilon zeta eta theta iota kappa"), (5, None), (6, ""),
            (7, "y " * 50 + item.upper().replace(" ", "!! ")), (None, item), (8, "alpha beta gamma delta epsilon q r zeta eta theta iota kappa")]
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"))
    found = sorted((str(r["doc_id"]), r["item_id"], r["distance"], r["first_word"], r["n_words"]) for r in got.collect())
    assert found == [("1", 9, 0, 0, 10), ("2", 9, 0, 0, 10), ("2", 9, 0, 40, 10), ("7", 9, 0, 50, 10), ("8", 9, 2, 0, 12), ("None", 9, 0, 0, 10)]


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (3, " !? "), (None, None)]])
def test_benchmark_without_words(spark, odd_docs, items):
    b = spark.createDataFrame(items, "item_id long, text string")
    assert D.leaks(odd_docs, b).collect() == []
    assert D.without_leaks(odd_docs, b).count() == odd_docs.count()


def test_odd_rows_short_items_and_clashing_names(spark, odd_docs):
    df = odd_docs.withColumns({"item_id": F.lit("i"), "distance": F.lit(0), "clean": F.lit(True)})
    b = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (None, "clean3 clean4 clean5 clean6 clean7 clean8"), (2, "hunter22")], "item_id long, text string")
    kept = D.without_leaks(df, b)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "1", "2", "3", "None", "4", "5", "6", "7"])
    found = sorted((str(r["doc_id"]), str(r["item_id"])) for r in D.leaks(df, b).collect())
    assert found == sorted([("None", "1")] * 4 + [("8", "None"), ("-9", "2")])


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, b = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, D.leaks(docs, b).collect()))
    kept = sorted(r["doc_id"] for r in D.without_leaks(docs, b).collect())
    for name, size in (("BLOCK_ITEMS", 11), ("BLOCK_WORDS", 300)):
        with monkeypatch.context() as m:
            m.setattr(D, name, size)
            assert sorted(map(tuple, D.leaks(docs, b).collect())) == whole and whole
            assert sorted(r["doc_id"] for r in D.without_leaks(docs, b).collect()) == kept


def test_blocks_are_bounded_by_items_and_words(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate([5, 90, 400, 3, 3, 3, 3, 80, 20])]
    monkeypatch.setattr(D, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(D, "BLOCK_WORDS", 100)
    got = [(i.ids, last) for i, last in D._blocks(spark.createDataFrame(rows, "item_id long, text string"), "item_id", "text", 0.2)]
    assert got == [([0, 1], False), ([2], False), ([3, 4, 5], False), ([6, 7], False), ([8], True)]


def test_words_of_unicode_texts():
    def words(t):
        return [w.decode() for w in D.item_words(t)]
    assert words("“Don’t – stop…”") == words('"Don\'t - stop..."') == ["don", "t", "stop"]
    assert words("ÄRGER Über Öl") == words("ärger über öl") == ["ärger", "über", "öl"]
    assert words("\uff21\uff22\uff23 ﬁne e\u0301") == ["abc", "fine", "é"]
    assert words("日本語です") == ["日", "本", "語", "で", "す"]
    assert words("plain ascii, no change") == ["plain", "ascii", "no", "change"]
    assert words(None) == words("") == words("…  ·") == []
    assert words("bad \ud800 end")[0] == "bad"


def test_unicode_items_are_found(spark):
    quoted = "“It’s the model’s answer – not the author’s – that counts here,” she said."
    japanese = "東京は日本の首都であり世界最大の都市圏です"
    items = [(1, quoted), (2, "Ärger Über Öl"), (3, japanese)]
    docs = [(1, "x y " + quoted.replace("“", '"').replace("”", '"').replace("’", "'").replace("–", "-") + " z"), (2, "viel ärger über öl heute"),
            (3, "これは前置きです。" + japanese + "という文が続きます。"), (4, "nothing of it, déjà vu 日本語"), (5, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in D.leaks(d, b).collect()) == [(1, 1, 0), (2, 2, 0), (3, 3, 0)]
    assert sorted(r["doc_id"] for r in D.without_leaks(d, b).collect()) == [4, 5]


def test_walks_follow_from_the_target():
    assert all(D.walks_for(n, 0) == 1 for n in (8, 20)) and D.walks_for(8, 1, 0.9) < D.walks_for(8, 1, 0.999)
    assert D.walks_for(60, 12) <= D.walks_for(20, 4) <= D.walks_for(10, 2)


@pytest.mark.parametrize("n", [8, 10, 12, 15, 20, 30, 60])
def test_recall_reaches_the_target_with_edits_spread_evenly(n):
    rng, e = np.random.default_rng(n), n // 5
    items = [(i, [b"w%d" % w for w in rng.choice(50_000, n, replace=False)]) for i in range(400)]
    index = D.ItemIndex(items)
    number = {w: k for k, w in enumerate(index.vocabulary, 1)}
    words, ends = [], []
    for i, ws in items:
        kept = np.array([number[w] for w in ws])
        kept[[((k + 1) * (n + 1)) // (e + 1) - 1 for k in range(e)]] = 0       # other words
        words += [0] * 5 + kept.tolist() + [0] * 5
        ends.append(len(words))
    found = {(t, k) for t, k, *_ in index.search(np.array(words, np.int32), np.array(ends))}
    assert sum((i, i) in found for i in range(400)) >= 398


def test_items_of_common_words_with_the_rare_one_replaced(spark):
    rng = np.random.default_rng(5)
    items, docs = [], []
    for i in range(120):      # every word but one stands in many items
        words = [f"common{k}" for k in rng.integers(0, 40, 30)]
        at = int(rng.integers(0, 30))
        items.append((i, " ".join([*words[:at], f"rare{i}", *words[at + 1:]])))
        docs.append((i, " ".join(["x"] * 20 + [*words[:at], "other", *words[at + 1:]] + ["y"] * 20)))
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in got.collect()}
    assert {k: found.get((k, k)) for k in range(120)} == {k: 1 for k in range(120)}


def test_pieces_of_proposals_give_the_same(spark, monkeypatch):
    docs, b = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, D.leaks(docs, b).collect()))
    monkeypatch.setattr(D, "PROPOSALS", 3)
    assert sorted(map(tuple, D.leaks(docs, b).collect())) == whole and whole


def test_short_items_are_found_wherever_the_edit_is(spark):
    items, docs = [], []
    for n in range(1, 10):
        words = [f"n{n}w{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for at in range(n if n >= 5 else 1):
            for kind in range(3 if n >= 5 else 1):      # under five words no edit is allowed
                text = [*words[:at], *([], ["other"], ["other", words[at]])[kind], *words[at + 1:]] if n >= 5 else words
                docs.append((n * 100 + at * 10 + kind, " ".join(["x"] * (at % 3) + text + ["y"] * kind)))
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect() if r["item_id"] >= 5 or r["distance"] == 0} >= {(d, d // 100) for d, _ in docs}
