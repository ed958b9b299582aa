"""Prefix trie of conversations by a splitter skeleton.

Every conversation is one path (an element per turn: digest of role and text, and
its words). Equal paths are merged first, the rest are sorted and cut into shards at
sampled paths, the splitters. All prefixes of the splitters form the skeleton, a small trie that
every task gets. A node that is no prefix of a splitter lies in one shard, which
finishes it alone: paths in order, one stack. A node of the skeleton may lie in several: each
shard gives its part of it, the parts are added up, and the skeleton is finished from the bottom.

Scale: what is sorted and shuffled are 20 bytes a turn, never texts. The position of a turn comes
from a range sort over (conversation, turn), so one conversation with a third of all turns
is spread over tasks; a path is cut into pieces of ``PIECE`` turns, each below the identifier
of its prefix, and the pieces' levels are solved from the deepest up (one level unless conversations are longer than
that). A shard holds about ``SHARD`` turns of unlike paths: copies are one row with a count. The
skeleton has at most (shards x PIECE) nodes and is what comes to the driver. The ids of conversations that
end at a node are joined in chunks in parallel, and chunk after chunk enters the digest.

Defined cases: rows without conv_id belong to no conversation and are left out; turns of equal number (null is one,
and first) are ordered by digest; repeated rows are turns of their own; null role or text is empty; conversations
may have any number of turns, also none after rebuilding; an empty table has no node.
"""
from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, words, written

ELEMENT = 20         # bytes of a turn: 16 of its digest, 4 of its number of words
ROOT = 16            # bytes of a piece's key before its first turn: the identifier of its prefix
PIECE = 4096         # turns of a piece (5 at least)
SHARD = 100_000      # turns of a shard, about
SAMPLE = 32          # sampled paths a shard, about
CHUNK = 50_000       # ids joined at once
SHARED, HEAD = 20, 4     # fixed values: conversations that share a first one, and the modulus of how many turns

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


def elements(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, element`` of every row with a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    n = F.unhex(F.lpad(F.hex(F.size(words(text)).cast("long")), 8, "0"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.concat(digest, n).alias("element"))


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each row among the rows of its conversation in this partition (sorted), from 1."""
    from pyspark import TaskContext

    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        rank = np.arange(len(conv)) - np.repeat(starts, np.diff(np.r_[starts, len(conv)])) + 1
        if conv[0] == last:
            rank[:starts[1] if len(starts) > 1 else None] += count
        last, count = conv[-1], rank[-1]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rank), batch.column(1), pa.array(np.full(len(conv), part))],
                                         ["conv_id", "pos", "element", "part"])


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, element``: place of each turn in its conversation, from 1. A conversation may
    span partitions: what comes to the driver is a row per partition."""
    order = ["conv_id", "turn", "element"]
    rows = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "element")
    rows = written(rows.mapInArrow(_ranks, "conv_id long, pos long, element binary, part long"), "trie-turns")
    before, last = [], (None, 0)
    for r in rows.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos")).alias("end")).orderBy("part").collect():
        ahead = last[1] if r["first"] == last[0] else 0
        if ahead:
            before.append((r["part"], r["first"], ahead))
        last = (r["end"][0], r["end"][1] + (ahead if r["end"][0] == r["first"] else 0))
    if before:
        ahead = turns.sparkSession.createDataFrame(before, "part long, conv_id long, ahead long")
        rows = rows.join(ahead, ["part", "conv_id"], "left").withColumn("pos", F.col("pos") + F.coalesce("ahead", F.lit(0)))
    return rows.select("conv_id", "pos", "element")


def _strung(parts: Column) -> Column:
    """The binary fields ``b`` of an array of structs in the structs' order, one after the other."""
    return F.unhex(F.array_join(F.transform(F.array_sort(parts), lambda x: F.hex(x["b"])), ""))


def _id(a: Column, b: Column) -> Column:
    return F.concat(*[F.unhex(F.lpad(F.hex(x), 16, "0")) for x in (a, b)])


def pieces(turns: DataFrame, piece: int) -> DataFrame:
    """``conv_id, level, path, seg, next``: the rebuilt conversations in pieces, the last of each shorter
    than ``piece`` turns; ``seg`` is the identifier of what stands before the piece, ``next`` of what its end stands for."""
    rows = written(numbered(turns), "trie-numbered")
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
    heads = rows.where((F.col("pos") < HEAD) & (F.col("conv_id") % SHARED == 0)).groupBy(F.col("conv_id").alias("base")).agg(
        _strung(F.collect_list(F.struct("pos", F.col("element").alias("b")))).alias("head"))
    convs = rows.where("pos = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base"))
    convs = convs.join(heads, "base", "left").select(
        "conv_id", F.coalesce(F.substring("head", F.lit(1), F.col("h") * ELEMENT), F.unhex(F.lit(""))).alias("head"))
    convs = written(convs, "trie-heads")
    own = rows.where(F.col("pos") > h).withColumn("at", F.col("pos") - h - 1)
    blocks = own.groupBy("conv_id", F.floor(F.col("at") / piece).alias("block")).agg(
        _strung(F.collect_list(F.struct("at", F.col("element").alias("b")))).alias("b")).join(convs, "conv_id")
    fit = F.lit(piece * ELEMENT) - F.length("head")        # what of a block fits behind the turns before it
    parts = convs.select("conv_id", F.lit(0).cast("long").alias("level"), F.lit(0).alias("k"), F.col("head").alias("b"))
    parts = parts.unionByName(blocks.select("conv_id", F.col("block").alias("level"), F.lit(1).alias("k"), F.substring("b", F.lit(1), fit).alias("b")))
    parts = parts.unionByName(blocks.where(F.length("b") > fit).select(
        "conv_id", (F.col("block") + 1).alias("level"), F.lit(0).alias("k"), F.substring("b", fit + 1, F.length("head")).alias("b")))
    out = written(parts.groupBy("conv_id", "level").agg(_strung(F.collect_list(F.struct("k", "b"))).alias("path")), "trie-pieces")
    full = out.where(F.length("path") == piece * ELEMENT)
    # a conversation that fills its last piece ends with an empty one
    bare = full.select("conv_id", (F.col("level") + 1).alias("level")).join(out.select("conv_id", "level"), ["conv_id", "level"], "left_anti")
    out = out.unionByName(bare.withColumn("path", F.unhex(F.lit(""))))
    if full.isEmpty():
        return out.withColumns({"seg": F.lit(bytes(ROOT)), "next": F.lit(bytes(ROOT))})
    before = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    marks = {"x": F.xxhash64("level", "path"), "y": F.xxhash64("path", "level", F.lit("y"))}
    out = out.withColumns(marks).withColumns({f"{c}0": F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")) for c in marks})
    return out.select("conv_id", "level", "path", _id(F.col("x0"), F.col("y0")).alias("seg"),
                      _id(F.col("x0").bitwiseXOR(F.col("x")), F.col("y0").bitwiseXOR(F.col("y"))).alias("next"))


def _joined(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (group, id) rows to chunks of ids, joined."""
        def row(group: bytes, ids: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([group], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], ["g", "first", "ids"])
        group, ids = None, []
        for batch in batches:
            for g, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if g != group or len(ids) >= chunk:
                    if ids:
                        yield row(group, ids)
                    group, ids = g, []
                ids.append(i)
        if ids:
            yield row(group, ids)
    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order (group, first id) to a digest a group; a chunk is held at a time."""
    group, sha, done = None, None, []
    for batch in batches:
        for g, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            if g != group:
                if sha:
                    done.append((group, sha.hexdigest()))
                group, sha = g, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["g", "sha"])
        done = []
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([group], pa.binary()), pa.array([sha.hexdigest()])], ["g", "sha"])


def ends(last: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``g, sha``: SHA-256 of each group's ascending ids, joined by commas; ``last`` has ``g, conv_id``."""
    chunks = written(last.repartitionByRange("g", "conv_id").sortWithinPartitions("g", "conv_id")
                     .select("g", "conv_id").mapInArrow(_joined(chunk), "g binary, first long, ids string"), "trie-ids")
    return chunks.repartition("g").sortWithinPartitions("g", "first").select("g", "ids").mapInArrow(_hashed, "g binary, sha string")


class Skeleton:
    """The trie of all prefixes of the splitters. ``ids`` maps (parent, element) to a node, a
    parent's number is below its children's; a root's parent is -1 and its element the segment."""

    def __init__(self, splitters: list[bytes]):
        self.splitters = splitters
        self.ids: dict[tuple[int, bytes], int] = {}
        for s in splitters:
            at = self.ids.setdefault((-1, s[:ROOT]), len(self.ids))
            for i in range(ROOT, len(s), ELEMENT):
                at = self.ids.setdefault((at, s[i:i + ELEMENT]), len(self.ids))

    def finished(self, parts: dict[int, dict], depth0: int) -> list[tuple]:
        """Rows of the skeleton's nodes from the sums of their parts, children before parents."""
        by_id = sorted(((i, up, e) for (up, e), i in self.ids.items()), reverse=True)
        depth = [0] * len(by_id)
        for i, up, _ in reversed(by_id):
            depth[i] = depth[up] + 1 if up >= 0 else 0
        out = []
        for i, up, element in by_id:
            p = parts[i]
            root = up < 0
            p["leaves"] = p["leaves"] if p["kids"] or (root and depth0) else 1
            p["saved"] += 0 if root else (p["n"] - 1) * int.from_bytes(element[16:], "big")
            if not root:
                parts[up]["kids"] += 1
                parts[up]["leaves"] += p["leaves"]
                parts[up]["saved"] += p["saved"]
            out.append((i, up, element if root else None, depth0 + depth[i]))
        return [(parts[i]["c"], d, parts[up]["c"] if up >= 0 else None, parts[i]["n"], parts[i]["kids"], parts[i]["leaves"], parts[i]["saved"],
                 parts[i]["sha"] or NOTHING, seg) for i, up, seg, d in out]


def _splitters(rows: DataFrame, shard: int) -> list[bytes]:
    """Paths that cut ``rows`` (key) into shards of about ``shard`` turns: quantiles of a sample by hash, bounded by
    the number of shards."""
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.length("key"))).first()
    shards = math.ceil((total or 0) / ELEMENT / shard)
    if shards < 2:
        return []
    every = max(1, n // (SAMPLE * shards))
    sample = sorted(bytes(r[0]) for r in rows.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(every)) == 0).select("key").collect())
    weight = np.cumsum([len(s) for s in sample]) if sample else np.zeros(0)
    at = {int(np.searchsorted(weight, weight[-1] * i / shards)) for i in range(1, shards)} if sample else set()
    return [sample[i] for i in sorted(at) if i < len(sample)]


OUT = f"{NODE}, seg binary, skeleton long, above long"
COLUMNS = [c.split()[0] for c in OUT.split(", ")]


def _finish(skeleton: Skeleton, depth0: int):
    """Finishes one shard after the other: rows in order of (shard, key)."""
    ids = skeleton.ids

    def close(rows: list[tuple]) -> pa.RecordBatch:
        up, depth, size, n, c, kids, leaves, saved, sha, seg, skel = ([] for _ in range(11))

        def node(parent: int, level: int, tag: int, tokens: int, segment: bytes | None) -> int:
            for x, v in zip((up, depth, size, n, c, kids, leaves, saved, sha, seg, skel),
                            (parent, level, tokens, 0, None, 0, 0, 0, None, segment, tag)):
                x.append(v)
            return len(up) - 1

        stack: list[int] = []
        was = b""
        for key, count, conv, digest, k, lv, sv in rows:
            if was[:ROOT] != key[:ROOT] or not stack:
                stack = [node(-1, 0, ids.get((-1, key[:ROOT]), -1), 0, key[:ROOT])]
                same = 0
            else:
                same, most = 0, min(len(was), len(key)) - ROOT
                while same < most and was[ROOT + same:ROOT + same + ELEMENT] == key[ROOT + same:ROOT + same + ELEMENT]:
                    same += ELEMENT
                del stack[1 + same // ELEMENT:]
            for i in range(ROOT + same, len(key), ELEMENT):
                top, element = stack[-1], key[i:i + ELEMENT]
                tag = ids.get((skel[top], element), -1) if skel[top] >= 0 else -1
                stack.append(node(top, depth[top] + 1, tag, int.from_bytes(element[16:], "big"), None))
            at = stack[-1]
            n[at], c[at], sha[at], kids[at], leaves[at], saved[at] = count, conv, digest, k, lv, sv
            was = key
        for i in range(len(up) - 1, -1, -1):
            p = up[i]
            if skel[i] < 0:
                if not kids[i]:
                    leaves[i] = 0 if p < 0 and depth0 else 1
                saved[i] += (n[i] - 1) * size[i]
                if p >= 0:
                    kids[p] += 1
                    leaves[p] += leaves[i]
                    saved[p] += saved[i]
            if p >= 0:
                n[p] += n[i]
                c[p] = c[i] if c[p] is None else min(c[p], c[i])
        parent = [c[p] if p >= 0 and skel[p] < 0 else None for p in up]
        above = [skel[p] if p >= 0 and skel[p] >= 0 else None for p in up]
        sha = [s or (NOTHING if t < 0 else None) for s, t in zip(sha, skel)]
        tags = [t if t >= 0 else None for t in skel]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()), pa.array([depth0 + d for d in depth], pa.int64()), pa.array(parent, pa.int64())]
            + [pa.array(x, pa.int64()) for x in (n, kids, leaves, saved)] + [pa.array(sha, pa.string()), pa.array(seg, pa.binary())]
            + [pa.array(x, pa.int64()) for x in (tags, above)], COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for s, *row in zip(*[col.to_pylist() for col in batch.columns]):
                if s != shard and rows:
                    yield close(rows)
                    rows = []
                shard = s
                rows.append(row)
        if rows:
            yield close(rows)
    return run


def _level(rows: DataFrame, depth0: int, shard: int) -> DataFrame:
    """``NODE`` and ``seg`` (roots only) of one level's distinct pieces: ``key, n, c, sha, kids, leaves, saved``."""
    spark = rows.sparkSession
    splitters = _splitters(rows, shard)
    skeleton = Skeleton(splitters)
    fields = ["key", "n", "c", "sha", "kids", "leaves", "saved"]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(splitters, key.as_py()) for key in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *batch.columns], ["shard", *fields])

    schema = "shard long, key binary, n long, c long, sha string, kids long, leaves long, saved long"
    sorted_rows = rows.select(*fields).mapInArrow(dealt, schema).repartition(len(splitters) + 1, "shard").sortWithinPartitions("shard", "key")
    done = written(sorted_rows.mapInArrow(_finish(skeleton, depth0), OUT), "trie-shards")
    if not splitters:
        return done.select(*COLUMNS[:9])
    parts = done.where("skeleton is not null").groupBy("skeleton").agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("c"), F.sum("n_children").alias("kids"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"), F.max("ends_sha256").alias("sha"))
    bones = {r["skeleton"]: r.asDict() for r in parts.collect()}      # at most the skeleton's nodes
    firsts = spark.createDataFrame([(i, p["c"]) for i, p in bones.items()], "above long, up long")
    top = spark.createDataFrame(skeleton.finished(bones, depth0), f"{NODE}, seg binary")
    rest = done.where("skeleton is null").join(firsts, "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up"))
    return rest.select(*COLUMNS[:9]).unionByName(top)


def trie(conversations: DataFrame, piece: int = PIECE, shard: int = SHARD) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node
    of the trie of the rebuilt conversations (columns ``conv_id, turn, role, text``; others are not read)."""
    spark = conversations.sparkSession
    cut = written(pieces(written(elements(conversations), "trie-elements"), piece), "trie-cut")
    top = cut.agg(F.max("level")).first()[0]
    if top is None:
        return spark.createDataFrame([], NODE)
    key = F.concat("seg", "path")
    group = F.unhex(F.md5(F.concat(F.col("level").cast("string").cast("binary"), key)))
    cut = cut.select("conv_id", "level", key.alias("key"), "next", group.alias("g"), (F.length("path") < piece * ELEMENT).alias("last"))
    unlike = cut.groupBy("level", "key", "g", "next", "last").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("c"))
    unlike = written(unlike.join(ends(cut.where("last").select("g", "conv_id")), "g", "left"), "trie-unlike")
    out, below = [], None
    for level in range(top, -1, -1):
        rows = unlike.where(F.col("level") == level)
        zero = F.lit(0).cast("long")
        if below is None:
            rows = rows.withColumns({"kids": zero, "leaves": zero, "saved": zero})
        else:
            roots = below.where("seg is not null").select(
                F.col("seg").alias("next"), F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"),
                F.col("saved_tokens").alias("saved"), F.nullif("ends_sha256", F.lit(NOTHING)).alias("below_sha"))
            rows = rows.withColumn("next", F.when(~F.col("last"), F.col("next"))).join(roots, "next", "left")
            rows = rows.withColumn("sha", F.coalesce("sha", "below_sha")).fillna(0, ["kids", "leaves", "saved"])
        rows = written(rows, "trie-level") if level < top else rows
        below = written(_level(rows, level * piece, shard), "trie-nodes")
        out.append(below if level == 0 else below.where("seg is null"))
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.unionByName(more)
    return nodes.select(*COLUMNS[:8])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(read(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH turns AS (
  SELECT conv_id, pos, e, w FROM (
    SELECT conv_id, e, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(e, 32), w) AS pos FROM (
      SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS e,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS w
      FROM conversations WHERE conv_id IS NOT NULL))),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(crc, 4294967295) % 4 AS h FROM (
    SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)) AS crc
    FROM (SELECT DISTINCT conv_id FROM turns))),
rebuilt AS (
  SELECT c.conv_id, 0 AS k, t.pos, t.e, t.w FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.e, t.w FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
steps AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k, pos) AS d, e, w FROM rebuilt),
paths AS (SELECT c.conv_id, coalesce(string_agg(e, '' ORDER BY d), '') AS path FROM convs c LEFT JOIN steps s ON s.conv_id = c.conv_id GROUP BY c.conv_id),
places AS (SELECT conv_id, unnest(range(length(path) // 64 + 1)) AS d, path FROM paths),
nodes AS (SELECT left(path, 64 * d) AS p, any_value(d) AS d, count(*) AS n, min(conv_id) AS c FROM places GROUP BY left(path, 64 * d)),
valued AS (SELECT nodes.*, coalesce(w, 0) AS w FROM nodes LEFT JOIN steps s ON s.conv_id = c AND s.d = nodes.d),
kids AS (SELECT left(p, 64 * (d - 1)) AS p, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT left(p, 64 * a) AS p, sum((n - 1) * w)::BIGINT AS saved, count(*) FILTER (kids IS NULL) AS leaves
  FROM (SELECT v.*, kids, unnest(range(v.d + 1)) AS a FROM valued v LEFT JOIN kids USING (p)) GROUP BY 1),
ends AS (SELECT path AS p, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha FROM paths GROUP BY path)
SELECT x.c AS conv_id, x.d::BIGINT AS depth, up.c AS parent_conv_id, x.n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves,
       saved AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM valued x JOIN below b ON b.p = x.p LEFT JOIN kids k ON k.p = x.p LEFT JOIN ends e ON e.p = x.p
LEFT JOIN nodes up ON x.d > 0 AND up.p = left(x.p, 64 * (x.d - 1))"""
