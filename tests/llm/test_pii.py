import hashlib
import random
import re

import duckdb

from ridelake.llm import pii as P

IPV4 = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(P.BASE[0], text)]
    out += [(m.start(), 1, m.end()) for m in IPV4.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(P.BASE[2], text):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(P.BASE[3], text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, found = P.find(df)
    out = rows.join(found, ["k1", "k2"], "left").collect()
    return {r["doc_id"]: [tuple(s) for s in r["spans"] or []] for r in out}


ODD = ["a@b.c_x@d.e", "a@b.c@d.e.f", "x@y", "@a.b c@d.e..f %+-@-.-", "1.2.3.4.5.6.7.8", "1.2.3.400 001.02.0003.255 256.1.1.1", "4111 1111-1111 1111",
       "4111  1111 1111 1111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "4111111111111111" * 2, "79927398713 799273987130", "+1 (017) 555-7713.",
       "+15", "+1 5", "+49 30 123456789012345", "++33 1 23 45 67 89 )", "é😀 a.b%c@mail-1.example.com 日本 10.0.0.1", None, "", "@" * 5000,
       "z" * 60_000 + "@", "a." * 3000 + "@" + "b." * 3000 + "c", "1" * 40_000, "9." * 20_000 + "9", "+" + "(" * 20_000, "a@b.c " * 400, "5 " * 20_000]


def test_base_spans(spark):
    r = random.Random(3)
    texts = ODD + ["".join(r.choice(["1", "12", ".", "-", " ", "@", "a", "+", "(", ")", "9", "_"]) for _ in range(r.randint(5, 120))) for _ in range(400)]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        assert [s[:3] for s in got[i] if s[3]] == base(t), t and t[:100]


CASES = [("write to jane.doe (at) example (dot) org", "email"), ("call me, phone: 555 123 4567 today", "phone"), ("our tel (030) 555 123 45", "phone"),
         ("server address 2001:0db8:85a3:0000:0000:8a2e:0370:7334", "ip"), ("Sincerely, Anna Schmidt", "name"),
         ("credit card: 4111 1111 1111 1112", "card")]
PLAIN = ["order 4111111111111112 was sent", "the dates 2024 05 12 and 12 05 2024", "version 10 20 30 40", "meet me at noon dot", "x4111111111111112y",
         "The Mary rose", "a 16-digit number 9807915762804491"]


def corpus():
    filler = [f"row {i}: user{i}@mail.example.com from 10.1.{i % 250}.7 call +1 (201) 555-{1000 + i}" for i in range(60)]
    return [t for t, _ in CASES] * 3 + PLAIN * 3 + filler + ODD[:19] + [None, CASES[0][0]]


def test_added_spans(spark):
    texts = corpus()
    got = run(spark, texts)
    for i, t in enumerate(texts):
        added = [P.KINDS[s[1]] for s in got[i] if not s[3]]
        want = dict(CASES).get(t)
        assert added == ([want] if want else []), (t, got[i])


def test_sql_twin_where_the_method_decides(spark, tmp_path):
    rows = list(enumerate(corpus()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(P.OP11_SQL).df()
    got = P.op11_personal_data(spark, str(tmp_path)).toPandas()[list(want.columns)]
    assert sorted(map(repr, got.values.tolist())) == sorted(map(repr, want.values.tolist()))
    assert want["spans"].str.contains("name:").any()


def test_reliabilities_are_learned(spark):
    """A labeler that contradicts all others loses its weight: pattern counts move the likelihoods."""
    votes = ", ".join(f"v{j} int" for j in range(P.VOTES))
    agree, against = [2, 2, 2, 1, 1, 0, 1], [0, 0, 0, 1, 0, 1, 1]
    rows = [(0, *agree)] * 400 + [(0, *against)] * 400 + [(0, 2, 2, 2, 1, 1, 1, 1)]
    q = {tuple(r["votes"]): r["q"] for r in P.likelihoods(spark.createDataFrame(rows, "kind int, " + votes)).collect()}
    assert q[tuple(agree)] > 0.99 and q[tuple(against)] < 0.01 and q[(2, 2, 2, 1, 1, 1, 1)] > 0.5


def test_odd_rows(spark, odd_docs, tmp_path):
    odd_docs.selectExpr("*", "1 AS k1", "'x' AS spans").write.parquet(f"{tmp_path}/documents.parquet")
    out = P.op11_personal_data(spark, str(tmp_path)).collect()
    assert len(out) == odd_docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r["n_email"], r["base_sha256"], r["spans"]) for r in out} == {(0, empty, "")}
