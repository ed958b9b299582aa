import re
from collections import Counter

from pyspark.sql import functions as F

from ridelake.llm import host_quality as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside),
            n < 50 or 100 * len(inside) > 50 * n)


def test_measures(spark):
    texts = ["a b c a b c", "a a a a a", "x\nx\n \nx y\n", "a b c d e a b c", "one", "p q r s p q r s p q r", None, "", " \x0b\f ",
             "#1 *b $c %d &e |f <g >h", "é ü é ü 日本 😀" * 30, "u v w " * 400 + "x", "\n\n a\n a\r\n a", "a b c x a b y a b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out, got = H.measures(df)
    for r in out.collect():
        assert tuple(r[got[c]] for c in got) == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_host_verdict_rejects_a_bad_host_and_keeps_clean_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    noisy = " ".join(f"w{i}#*$" for i in range(60))
    rows = [(i, good, f"good{i % 5}") for i in range(100)] + [(1000 + i, noisy if i < 55 else good, "farm") for i in range(60)]
    rows += [(2000, noisy, "good1"), (2001, good, None), (2002, "too short", "good2")]
    out, got = H.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    res = {r["doc_id"]: r for r in out.collect()}
    assert all(res[i]["kept"] for i in range(100))
    assert not any(res[1000 + i]["kept"] for i in range(60)) and res[1000]["host_verdict"] == "block"
    assert res[2000]["kept"]                      # one bad page of a good host fails no base rule
    assert res[2001]["kept"] and res[2001]["host_verdict"] is None
    assert not res[2002]["kept"]


def test_shrinkage_spares_a_host_with_little_evidence(spark):
    rows = [(h, f"h{h}", f) for h in range(30) for f in [i < (20 if h % 10 == 0 else 2) for i in range(24)]]
    rows += [(99, "tiny", True)]
    df = spark.createDataFrame(rows, "k long, source string, failed boolean")
    v = {r["host"]: r for r in H.host_verdicts(df, "source", F.col("failed"), H.HostRules()).collect()}
    assert v["h0"]["verdict"] == "block" and v["h1"]["verdict"] == "ok"
    assert v["tiny"]["failures"] == 1 and v["tiny"]["rate"] < 0.8 and v["tiny"]["rate"] < v["h0"]["rate"]


def test_odd_rows_and_clashing_names(spark, odd_docs):
    df = odd_docs.withColumns({"kept": F.lit("mine"), "n_words": F.lit(-1), "host_verdict": F.lit("x"), "verdict": F.lit(0), "host": F.lit(1)})
    out, got = H.judge(df)
    res = out.collect()
    assert len(res) == odd_docs.count() and all(r["kept"] == "mine" and r["n_words"] == -1 for r in res)
    assert got["kept"] == "_kept"
    for r in res:
        assert r[got["base_failed"]] == brute(r["text"])[-1]
        assert r[got["kept"]] is not None


def corpus(spread=True):
    """Twenty hosts with every tenth document noisy, one with 39 of 100, one with 24, one with two documents."""
    good = " ".join(f"w{i}" for i in range(60))
    noisy = " ".join(f"w{i}#*$" for i in range(60))
    shares = {f"h{k:02d}": (100, 10) for k in range(20)} | ({"bad": (100, 39), "odd": (100, 24), "tiny": (2, 2)} if spread else {})
    rows = [(h, noisy if i < bad else good) for h, (n, bad) in shares.items() for i in range(n)] + [(None, noisy), ("h01", "too short"), ("h02", None)]
    return [(i, t, h) for i, (h, t) in enumerate(rows)]


def test_limits_are_relative_to_the_corpus(spark, tmp_path):
    """The method decides: documents that pass the base rule go by their host's verdict. Same rows as the SQL."""
    import duckdb
    for name, spread in (("a", True), ("b", False)):
        spark.createDataFrame(corpus(spread), "doc_id long, text string, source string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = H.op1_host_quality_rules(spark, f"{tmp_path}/{name}")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/{name}/documents.parquet/*.parquet')")
        want = con.sql(H.OP1_SQL)
        cols = want.columns
        got = sorted(tuple(r) for r in out.select(*cols).collect())
        assert got == sorted(want.fetchall())
        of = {r[0]: dict(zip(cols, r)) for r in got}
        verdicts = {h: of[i]["host_verdict"] for i, _, h in corpus(spread)}
        lost = {i for i, r in of.items() if not r["kept"] and not r["base_failed"]}
        if spread:
            assert (verdicts.pop("bad"), verdicts.pop("odd"), verdicts.pop("tiny"), verdicts.pop(None)) == ("block", "watch", "ok", None)
            assert lost == {i for i, t, h in corpus() if h == "bad" or (h == "odd" and "#" in t)}
        else:
            assert not lost and verdicts.pop(None) is None
        assert set(verdicts.values()) == {"ok"}
