import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ridelake.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def order(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, order(role or "", text or ""), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in turns.items()}
    members = defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not kids[p]
    first = {p: min(c for c, _ in m) for p, m in members.items()}
    return sorted(((first[p], len(p), first[p[:-1]] if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c, end in m if end))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def rows(df):
    assert df.columns == [c.split()[0] for c in P.NODE.split(", ")]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed, convs=150, longest=14):
    r = random.Random(seed)
    say = [("user", f"hi {'there ' * i}") for i in range(3)] + [("assistant", "déjà vu\n日本 😀"), (None, "x"), ("user", None), ("", "x")]
    out = []
    for c in list(range(convs)) + [-7, -40, -41, 100_000, 100_003]:
        out += [(c, t, *say[min(int(r.expovariate(0.9)), len(say) - 1)]) for t in range(r.randint(1, longest))]
    out += [(c, t, *say[0]) for c in range(300, 340) for t in range(6)]          # a group of copies
    out += [(20, None, "user", "first"), (20, None, "user", "first"), (20, 2, "user", "tie"), (None, 1, "user", "lost")]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("piece, shard", [(P.PIECE, P.SHARD), (5, 60), (P.PIECE, 25)])
def test_against_brute_force(spark, piece, shard):
    data = made(piece + shard)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    assert rows(P.trie(df, piece, shard)) == brute(data)


def test_pieces_of_long_conversations(spark):
    """Paths that end within, at and after the end of a piece; equal and unlike tails far down."""
    data = [(c, t, "user", f"{t % 3} {'tail' if c % 3 == 1 and t == n - 1 else ''}") for c, n in
            [(40, 5), (41, 10), (42, 10), (43, 11), (44, 23), (45, 23), (46, 24), (60, 15), (61, 1), (62, 2), (63, 40)] for t in range(n)]
    df = spark.createDataFrame(data, SCHEMA)
    for piece, shard in ((5, 1000), (5, 8), (10, 20)):
        assert rows(P.trie(df, piece, shard)) == brute(data)


def test_one_conversation_over_many_partitions(spark):
    """Positions hold when a conversation spans partitions of the sort."""
    data = [(7, t, "user", str(t % 5)) for t in range(900)] + [(c, t, "user", str(t % 5)) for c in (0, 3, 9) for t in range(4)]
    keep = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        at = P.numbered(P.elements(spark.createDataFrame(data, SCHEMA)))
        got = defaultdict(list)
        for r in at.collect():
            got[r["conv_id"]].append(r["pos"])
        assert {c: sorted(p) for c, p in got.items()} == {7: list(range(1, 901)), 0: [1, 2, 3, 4], 3: [1, 2, 3, 4], 9: [1, 2, 3, 4]}
        assert rows(P.trie(spark.createDataFrame(data, SCHEMA), 64, 100)) == brute(data)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_ids_in_chunks(spark):
    last = spark.createDataFrame([(b"a", i) for i in range(1000)] + [(b"b", -5), (b"b", 5)], "g binary, conv_id long").repartition(5)
    got = {bytes(r["g"]): r["sha"] for r in P.ends(last, chunk=70).collect()}
    assert got == {b"a": hashlib.sha256(",".join(map(str, range(1000))).encode()).hexdigest(), b"b": hashlib.sha256(b"-5,5").hexdigest()}


def test_other_columns_and_turnless(spark):
    data = [(21, 0, "user", "a"), (1, 0, "user", "b")]         # both lose their only turn
    df = spark.createDataFrame([(*d, "q", 1) for d in data], SCHEMA + ", path string, level int")
    assert rows(P.trie(df)) == brute(data)
    only = [d for d in data if zlib.crc32(str(d[0]).encode()) % 4]
    assert len(only) < 1 or rows(P.trie(spark.createDataFrame(only, SCHEMA))) == brute(only)
