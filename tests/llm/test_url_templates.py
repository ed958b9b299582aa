import re

import pytest
from pyspark.sql import functions as F

from ridelake.llm import url_templates as U

CASES = [("https://A.B.org/es/1?x#y", "a.b.org", "/es/1"), ("http://example.org", "example.org", ""), ("ftp://u@H:80/p#f/g", "u@h:80", "/p"), (None, "", ""),
         ("no-scheme.org/x", "", ""), ("://h?q=/z", "h", ""), ("", "", ""), ("a://b://c/d", "b:", "//c/d"), ("x://ÄB.com/ß\n/d", "Äb.com", "/ß\n/d"), ("http://#", "", "")]


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], "page_id long, bad int")


def test_host_and_path(spark, none):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"]) for r in U.judge(df, none).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_rules(spark, none):
    urls = [f"https://{h}{p}" for h in ("example.org", "a.example.org", "notexample.org", "org", "x.com", "com", "xcom", "a.net", "example.org.net")
            for p in ("", "/", "/es/", "/es", "/en/1", "/en/12", "/en/2", "/fr/x", "/de/", "/de/q?es/")]
    out = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), none).collect()
    for r in out:
        assert (r["rule"], r["verdict"]) == ((lambda x: x if x[0] else (None, "allow"))(brute_rule(r["host"], r["path"]))), urls[r["page_id"]]


def test_tree(spark):
    urls, bad = [], {}
    for i in range(200):      # two branches alike, one bad, ids variable
        part = ("news", "blog", "casino")[i % 3]
        urls.append((i, f"https://site.net/{part}/{i}/view"))
        if i % 2:
            bad[i] = int(part == "casino" or i % 20 == 1)
    urls += [(500 + i, f"https://deep.net/{'/'.join(str(i + k) for k in range(9))}") for i in range(20)]
    urls += [(600, "https://tiny.net/a"), (601, None), (602, None), (None, "https://site.net/casino/x/view"), (0, "https://site.net/news/0/view")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({"bad": F.lit("b"), "segs": F.lit(1), "template": F.lit("t"), "n": F.lit(0)})
    labels = spark.createDataFrame([*bad.items(), (None, 1), (1, 0)], "page_id long, bad int")
    out = U.judge(pages, labels).collect()
    assert len(out) == len(urls)
    at = {r["page_id"]: r for r in out}
    # the bad branch stands alone, the other two are one
    assert at[2]["template"] == "/casino/*/view" and at[2]["verdict"] == "block" and at[None]["verdict"] == "block"
    assert at[0]["template"] == at[1]["template"] == "/{blog|news}/*/view" and at[0]["verdict"] == "allow"
    assert at[500]["template"] == "/*" * 9 and at[500]["verdict"] == "allow"
    assert at[600]["template"] == "/*" and at[601]["template"] == "" and at[601]["verdict"] == "allow"


def test_no_labels_reject_nothing(spark, none):
    df = spark.createDataFrame([(i, f"http://x.net/{i % 2}") for i in range(30)], "page_id long, url string")
    assert {r["verdict"] for r in U.judge(df, none).collect()} == {"allow"}


def test_number_of_a_path(spark):
    df = spark.createDataFrame([(p,) for p in ("/en/12.html", "/a9/b", "/x", "", "/" + "9" * 40, None)], "path string")
    want = [None if p is None or not (m := re.search(r"([0-9]+)[^0-9]*$", p)) or int(m[1]) >= 1 << 63 else int(m[1]) for p, in df.collect()]
    assert [r[0] for r in df.select(U._number(F.col("path"))).collect()] == want


def test_many_equal_sections_are_judged_apart(spark):
    urls, bad = [], {}
    for i in range(1200):     # 100 sections of 12 pages, every tenth wholly bad, 60 more without labels, and 7 of too few pages
        urls.append((i, f"https://wide.net/s{i % 100}/{i}"))
        bad[i] = int(i % 10 == 3)
    urls += [(2000 + i, f"https://wide.net/u{i % 60:02d}/{i}") for i in range(300)]
    urls += [(3000 + i, f"https://wide.net/few{i % 7}/{i}") for i in range(28)]
    pages, labels = spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame([*bad.items()], "page_id long, bad int")
    out = {r["page_id"]: r for r in U.judge(pages, labels).collect()}
    assert {i: out[i]["verdict"] for i in range(1200)} == {i: "block" if bad[i] else "allow" for i in range(1200)}
    assert out[3]["template"] == "/{s13|s23|s3|s33|s43|s53|s63|s73|s83|s93}/*"
    assert out[0]["template"].startswith("/{s0|s1|s10|") and out[0]["template"].endswith("|+40}/*")
    assert len({out[2000 + i]["template"] for i in range(300)}) == 1 and {out[3000 + i]["template"] for i in range(28)} == {"/*/*"}


def test_deep_paths_are_read_to_the_last_branch(spark):
    paths = [f"a.net/site/section/2024/05/12/news/{('good', 'casino')[i % 2]}" for i in range(40)]
    paths += [f"b.net/a/b/c/d/e/f/{i}/{('good', 'casino')[i % 2]}/{i}/{i}" for i in range(40)]
    paths += [f"c.net/1/2/3/4/5/6/7/8/9{'/x' * (i % 2)}" for i in range(10)] + ["c.net/1/2/3/4/5/6", "c.net/1", "c.net"]
    pages = spark.createDataFrame([(i, f"https://{p}") for i, p in enumerate(paths)], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "page_id long, bad int")
    out = {r["page_id"]: (r["template"], r["verdict"]) for r in U.judge(pages, labels).collect()}
    news, rest = "/site/section/2024/05/12/news/", "/a/b/c/d/e/f/*/"
    assert len(out) == len(paths)
    assert [out[i] for i in (0, 1, 40, 41)] == [(news + "good", "allow"), (news + "casino", "block"), (rest + "good/*/*", "allow"), (rest + "casino/*/*", "block")]
    assert {v for k, v in out.items() if k < 80} == {out[i] for i in (0, 1, 40, 41)}
    assert [out[i][0] for i in (80, 81, 90, 91, 92)] == ["/1/2/3/4/5/6/7/8/9", "/1/2/3/4/5/6/7/8/9/x", "/1/2/3/4/5/6", "/1", ""]


def judged(spark, paths, bad):
    pages = spark.createDataFrame([(i, f"https://{p}") for i, p in enumerate(paths)], "page_id long, url string")
    out = U.judge(pages, spark.createDataFrame([*bad.items()], "page_id long, bad int")).collect()
    return {r["page_id"]: (r["template"], r["verdict"]) for r in out}


def test_wildcards_keep_their_depth(spark):
    """Pages of one shape whose tails differ in length only: the short ones are clean."""
    for head in ("p/q", "p/q/r/s/t/u/v"):
        paths = [f"h.net/{head}/{i}" + f"/{i}x" * (i % 2) for i in range(80)]
        out = judged(spark, paths, {i: i % 2 for i in range(80)})
        assert {out[i] for i in range(0, 80, 2)} == {(f"/{head}/*", "allow")} and {out[i] for i in range(1, 80, 2)} == {(f"/{head}/*/*", "block")}


def test_a_ladder_of_rates_is_no_single_group(spark):
    """Eleven branches of 10 labels, 0 to 10 of them bad: the clean one is not judged with the bad one."""
    paths, bad = [], {}
    for k in range(11):
        for i in range(10):
            bad[len(paths)] = int(i < k)
            paths.append(f"h.net/s{k:02d}/{len(paths)}")
    paths += [f"rest.net/{i}" for i in range(300)]
    bad |= {110 + i: int(i % 10 == 0) for i in range(300)}
    out = judged(spark, paths, bad)
    first, last = out[0], out[100]
    assert first[0] != last[0] and first[1] == "allow" and last[1] == "block"
    groups = {out[i][0] for i in range(110)}
    assert 2 <= len(groups) <= 4


def test_literal_marks_are_no_wildcards_or_groups(spark):
    """Segments spelled like a wildcard, like a group and like the rest of a long group."""
    paths, bad = [], {}

    def pages(n, path, verdict):
        for i in range(n):
            bad[len(paths)] = verdict
            paths.append(path.format(i=i))

    pages(30, "a.net/*/{i}", 1)                     # a real star
    pages(30, "a.net/x{i}/{i}y", 0)                 # variable segments
    pages(30, "b.net/a/{i}", 0)
    pages(30, "b.net/b/{i}", 0)
    pages(30, "b.net/{{a|b}}/{i}", 1)
    pages(30, "c.net/|+\\/{i}", 1)
    pages(300, "d.net/{i}", 0)
    out = judged(spark, paths, bad)
    assert {i: out[i][1] for i in range(180)} == {i: "block" if bad[i] else "allow" for i in range(180)}
    assert out[0][0] == "/\\*/*" and out[30][0] == "/*/*" and out[60][0] == "/{a|b}/*" and out[120][0] == "/\\{a\\|b\\}/*"


def test_sql_twin_on_deep_paths_ladders_and_marks(spark, tmp_path):
    import random

    import duckdb
    r = random.Random(2)
    hosts, segs = ["a.net", "b.net", "www.c.net"], ["news", "blog", "*", "{a|b}", "x|y", "é+", "casino"]
    urls = []
    for i in range(1500):
        n = min(int(r.expovariate(0.3)), 11)
        urls.append((i, f"http://{r.choice(hosts)}/" + "/".join(r.choice(segs) if r.random() < 0.8 else f"v{i}" for _ in range(n)) + f"/{i}"))
    urls += [(2000 + i, f"http://many.net/s{i % 130}/{2000 + i}") for i in range(1300)]
    labels = [(i, int(r.random() > 0.3 + 0.5 * ("casino" not in u)), int("*" in u)) for i, u in urls if i < 2000 and r.random() < 0.7]
    spark.createDataFrame([*urls, (None, None), (5000, "")], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.sql(U.OP5_SQL)
    cols = want.columns
    got = [tuple(x) for x in U.op5_url_template_tree(spark, str(tmp_path)).select(*cols).collect()]
    want = want.fetchall()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    verdicts = {x[cols.index("verdict")] for x in got}
    assert verdicts == {"allow", "block"} and any("|+" in x[cols.index("template")] for x in got)
