import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ridelake.llm import components as C
from ridelake.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ["", "One two", "A b C d E f g", "a b c d", "x  y\tz\nw v", "É È é ß " * 9, "k" * 3000, "rep rep " * 50]:
        assert S.fingerprint(t.encode()) == brute_fp(t), t


@pytest.mark.parametrize("bits,count", [(4, 2), (4, 3), (4, 4), (3, 3), (7, 4), (2, 4)])
def test_pigeonhole(bits, count):
    parts = S.segments(bits, count)
    assert sum(r + 1 for *_, r in parts) == bits + 1
    rng = random.Random(bits * 10 + count)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, bits)):
            y ^= 1 << b
        assert any(((x ^ y) >> s & (1 << w) - 1).bit_count() <= r for s, w, r in parts)


@pytest.mark.parametrize("count,block", [(2, 4096), (3, 4096), (4, 4096), (3, 8)])
def test_links_give_the_components_of_all_pairs(spark, count, block):
    rng = random.Random(5)
    fps = [0, (1 << 64) - 1]
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            fps.append(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    fps = sorted(set(fps))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    trees = {r["node"]: r["root"] for r in C.components(S.near_links(df, 4, count, block)).collect()}
    want = brute_groups(fps)
    got = [trees.get(s, s) for s in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(7, 7), (900, 901), (901, 900), (None, 3), (3, None)]
    got = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 5 for i in range(6, 60)}, 901: 900}


def test_groups_and_survivors(spark, odd_docs):
    base = "The quick brown fox jumps over the lazy dog near the old river bank " * 12
    extra = spark.createDataFrame([(50, base + "end", "en", "s", 0), (40, base, "en", "s", 0), (41, base, "en", "s", 0)], odd_docs.schema)
    df = odd_docs.unionByName(extra).withColumns({"fp": F.lit(1), "kid": F.lit(2), "component_id": F.lit("c")})
    rows = df.collect()
    ids = [r["doc_id"] for r in rows]
    root = brute_groups([brute_fp(r["text"]) for r in rows])
    members = {}
    for i, g in enumerate(root):
        members.setdefault(g, []).append(ids[i])
    want = sorted((str(ids[i]), str(min((x for x in members[g] if x is not None), default=None))) for i, g in enumerate(root))
    got = S.groups(df).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == want
    kept = S.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(min((x for x in m if x is not None), default=None)) for m in members.values())


def test_probes_of_a_hot_value_are_split(spark):
    # few members in each bucket beside one hot value of the first segment: its 3,000 probes are many tasks' work
    parts, block = S.segments(4, 3), 64
    rng = random.Random(8)
    shift, width, radius = parts[0]
    assert radius == 1
    rest = [rng.getrandbits(64 - width) for _ in range(3000)]
    fps = {(r << width) | 5 for r in rest} | {(r << width) | 5 | 1 << 9 for r in rest[:3]} | {(rest[7] ^ 3) << width | 5 | 1 << 9}
    signed = [int(np.uint64(f).astype(np.int64)) for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    hot = {r["bucket"]: (r["members"], r["probes"]) for r in S.hot_buckets(df, parts, block).collect()}
    assert hot[5] == (47, 1) and hot[5 | 1 << 9] == (1, 48)
    got = {tuple(sorted((r["a"], r["b"]))) for r in S.near_links(df, 4, 3, block).collect()}
    trees = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(list(got), "a long, b long")).collect()}
    want = brute_groups(sorted(fps))
    labels = [trees.get(x, x) for x in signed]
    assert len(set(zip(labels, want))) == len(set(labels)) == len(set(want)) < len(fps)


def test_ties_are_broken_by_the_other_columns(spark):
    rows = [(1, "same text here", f"s{i}", {"k": i}) for i in range(40)]
    schema = "doc_id long, text string, source string, extra map<string,int>"
    kept = {S.one_per_group(spark.createDataFrame(r, schema).repartition(n)).collect()[0]["source"]
            for r, n in ((rows, 3), (rows[::-1], 5), (rows[20:] + rows[:20], 1))}
    assert len(kept) == 1
