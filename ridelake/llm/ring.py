"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (built-in expressions only).

Keys hash to one of 2^RING_BITS places on a ring; every shard owns several
virtual nodes, and a key belongs to the first node clockwise. A shard takes no
more than its bound; keys that overflow go on clockwise to the next shard with
room. With the tightest bound (``load`` 1) shard counts differ by one at most;
a looser bound moves fewer keys when a shard is added.

Scale: only the number of rows per place is gathered (at most 2^RING_BITS
numbers, whatever the corpus); the plan that it yields says which ranks of a
place go to which shard. Equal rows are merged into one with a count first, and
the others of a place are dealt to ``LANES`` lanes by a hash of the whole row: a row's
rank is its lane's start plus a window within the lane, so neither repeated rows nor
one key with many texts pile up in a task; the copies of one row leave as ranges of
``PIECE`` ranks, which are dealt out before they become rows. Texts never leave the scan.
"""
from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, written

RING_BITS = 14
VNODES = 64
LANES = 32
PIECE = 1024      # ranks of one merged row that a task expands at once


def preferences(n_shards: int, vnodes: int = VNODES) -> list[list[int]]:
    """For each place of the ring, all shards in clockwise order of their first node."""
    nodes: dict[int, list[tuple[bytes, int]]] = {}
    for s in range(n_shards):
        for v in range(vnodes):
            h = hashlib.md5(f"shard {s} node {v}".encode()).digest()
            nodes.setdefault(int.from_bytes(h[:8], "big") >> (64 - RING_BITS), []).append((h, s))
    size, around = 1 << RING_BITS, [(p, s) for p in sorted(nodes) for _, s in sorted(nodes[p])]
    owners = [s for _, s in around]
    out, k = [], 0
    for place in range(size):
        while k < len(around) and around[k][0] < place:
            k += 1
        out.append(list(dict.fromkeys(owners[k:] + owners[:k])))
    return out


def plan(counts: dict[int, int], n_shards: int, vnodes: int = VNODES, load: float = 1.0) -> list[tuple[int, int, int, int, int]]:
    """(place, first rank, end rank, shard, slot of the first rank): where the rows of each place go.

    Round r offers what is left of every place, in ring order, to the place's r-th shard
    clockwise. Bounds: ``load`` times the mean, rounded up; for load 1 the rows divided as
    evenly as they can be, lower shards first."""
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) if load <= 1 else math.ceil(load * total / n_shards) for s in range(n_shards)]
    order, used = preferences(n_shards, vnodes), [0] * n_shards
    taken: dict[int, int] = {}
    out = []
    left = sorted(p for p, n in counts.items() if n)
    for r in range(n_shards):
        rest = []
        for p in left:
            s, at = order[p][r], taken.get(p, 0)
            n = min(counts[p] - at, room[s] - used[s])
            if n:
                out.append((p, at, at + n, s, used[s]))
                used[s] += n
                taken[p] = at + n
            if taken.get(p, 0) < counts[p]:
                rest.append(p)
        left = rest
    return out


def place_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - RING_BITS).cast("int")


def assign(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", load: float = 1.0, vnodes: int = VNODES) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per row of ``docs``; slots of a shard are 0, 1, ...

    size: UTF-8 bytes of the text (null: none) plus 1. Within a place rows rank by lane,
    doc_id (null first), checksum, size; repeated rows take neighbouring ranks."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    # equal rows become one with a count
    merged = written(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
                     .withColumns({"place": place_of(F.col("doc_id")), "lane": F.pmod(
                         F.xxhash64("doc_id", "size", "text_crc32"), F.lit(LANES)).cast("int")}), "ring-rows")
    counts = {r[0]: r[1] for r in merged.groupBy("place").agg(F.sum("copies")).collect()}     # at most 2^RING_BITS
    schema = "place int, first long, end long, shard int, slot long"
    parts = docs.sparkSession.createDataFrame(plan(counts, n_shards, vnodes, load), schema)
    # at most LANES rows per place
    before = Window.partitionBy("place").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = merged.groupBy("place", "lane").agg(F.sum("copies").alias("n")).select(
        "place", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    upto = Window.partitionBy("place", "lane").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("to", F.sum("copies").over(upto)).join(lanes, ["place", "lane"])
    ranked = ranked.withColumn("to", F.col("to") + F.col("start")).withColumn("from", F.col("to") - F.col("copies"))
    # a place has at most one part per shard, so the plan stays below places times shards
    met = ranked.join(F.broadcast(parts), "place").where((F.col("first") < F.col("to")) & (F.col("from") < F.col("end")))
    met = met.withColumns({"low": F.greatest("first", "from"), "high": F.least("end", "to")})
    pieces = met.withColumn("low", F.explode(F.sequence("low", F.col("high") - 1, F.lit(PIECE).cast("long"))))
    ranks = F.sequence("low", F.least("high", F.col("low") + PIECE) - 1)
    return pieces.repartition("place", "low").withColumn("rank", F.explode(ranks)).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"))


def op2_bounded_load_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(read(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
