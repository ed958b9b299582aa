import re

from pyspark.sql import functions as F

from ridelake.llm import secrets as S

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, found = S.find(df)
    out = rows.join(found, ["k1", "k2"], "left").collect()
    return {r["doc_id"]: [tuple(s) for s in r["spans"] or []] for r in out}


def test_base_spans(spark):
    key = "AKIA" + "Z9" * 8
    texts = ["password = hunter22", "PassWord:'abcdefg' token=abc secret=\"x.y/z+w=\"", "secret: token: abcdef", f"é😀 {key} and {key}X", "AKIA12", "f" * 24,
             "0123456789abcdef01234567 g deadbeef", "api_key==abcdefg apikey = a1b2c3 API_KEY: q", "tokentoken=abcdefg", None, "",
             "passwd=" + "0a" * 20, "token = abc", "日本 token = \"" + "ab12" * 10 + "\" x", "secret=a\nsecret=abcdef\ttoken : zzzzzz"]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[1] < 3] == base(t), t


def test_weak_parts_need_company(spark):
    opaque = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"
    both = f"login: admin_user\n{opaque}\nhttps://db.example.org/x"
    texts = [opaque, "login: admin_user", "https://db.example.org/x", both, f"login: admin {'x ' * 300} {opaque}", f"{opaque} https://a.example.org/b",
             "client_id=abcd1234 pass=letmein77", "AKIA" + "Q7" * 8 + " " + opaque]
    got = run(spark, texts)
    kinds = {i: [S.KINDS[s[1]] for s in got[i]] for i in got}
    assert kinds[0] == kinds[1] == kinds[2] == kinds[4] == kinds[5] == []
    assert kinds[3] == ["identifier", "secret", "endpoint"]
    assert kinds[6] == ["identifier", "secret"]
    assert kinds[7] == ["access", "secret"]
    s = got[3][1]
    assert both[s[0]:s[2]] == opaque


def test_a_text_of_many_parts(spark):
    text = "\n".join(f"login: user{i} pass=letmein{i:05d}" for i in range(1500))
    got = run(spark, [text, text])
    assert len(got[0]) == 3000 and got[0] == got[1]


def test_redact_and_odd_rows(spark, odd_docs):
    df = odd_docs.withColumns({"k1": F.lit("a"), "spans": F.lit("b"), "found": F.lit(1), "low": F.lit("c")})
    out = S.redact(df)
    assert out.columns == df.columns and out.count() == df.count()
    was, now = ({str((r["doc_id"], r["lang"])): r["text"] for r in d.collect()} for d in (df, out))
    assert now.pop("(-9, 'en')") == "[SECRET]"
    was.pop("(-9, 'en')")
    assert was == now
    one = spark.createDataFrame([(1, "a token = abcdefghij, é 0123456789abcdef01234567!")], "doc_id long, text string")
    assert S.redact(one).first()["text"] == "a [SECRET], é [SECRET]!"
