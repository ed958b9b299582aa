"""SimHash near-duplicates by multi-index hashing.

Fingerprints are made in Arrow batches (no shuffle), equal fingerprints are
aggregated to one row first, and only distinct fingerprints are searched. A
fingerprint is cut into segments; two fingerprints within ``max_bits`` of each
other agree up to a small radius in at least one segment (pigeonhole), so each
one is filed under its segments' values and probes the small Hamming ball
around them. Meeting pairs are verified on all 64 bits.

Scale: the search is linear in the distinct fingerprints times the ball size;
segments get wider as the corpus grows (about log2 of the fingerprints), so
buckets stay small. Members and probes of a bucket are both counted, and where either
pass ``block`` the bucket is split into pairs of blocks over many tasks; inside a task a bucket's
links are reduced to a spanning star before they leave it, so groups of near copies never become
all pairs. Components come from star contractions on that forest; a root with
many fingerprints is salted.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, read, written
from .components import components

# Hash seed of the shingles, white space bytes turned into blanks.
SEED = 42
_TO_BLANK = bytes(32 if 9 <= i <= 13 else i for i in range(256))
_SHINGLES_AT_ONCE = 1 << 16
_SALTS = 16


def fingerprint(text: bytes, size: int = 4) -> int:
    """SimHash of the lower-cased (A-Z) text's word shingles, repeats included."""
    joined = b" ".join(text.translate(_TO_BLANK).lower().split(b" "))
    parts = [w for w in joined.split(b" ") if w]
    if not parts:
        return 0
    joined = b" ".join(parts)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(blanks + 1).tolist()]
    ends = [*blanks.tolist(), len(joined)]
    k = min(size, len(parts))
    n = len(parts) - k + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, _SHINGLES_AT_ONCE):
        b = min(n, a + _SHINGLES_AT_ONCE)
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a:b], ends[a + k - 1:b + k - 1])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text", others: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, row_key, text_hash, fp`` (fp as a signed 64-bit number) per row; null text is
    empty. The two hashes, of id, text and ``others`` and of the text, stand for the row in joins."""
    key, text_hash = _keys(id_col, text_col, others)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("row_key"), text_hash.alias("text_hash"),
                       F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_buffer().to_pybytes(), size) for x in batch.column(3)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], ["doc_id", "row_key", "text_hash", "fp"])

    return cols.mapInArrow(run, "doc_id long, row_key long, text_hash long, fp long")


def _keys(id_col: str, text_col: str, others: tuple[str, ...]) -> tuple[Column, Column]:
    return F.xxhash64(F.col(id_col), F.col(text_col), *[F.col(f"`{c}`") for c in others]), F.xxhash64(F.col(text_col))


def _hashable(docs: DataFrame, *without: str) -> tuple[str, ...]:
    """The other columns that Spark can hash (maps and variants can't be)."""
    return tuple(f.name for f in docs.schema if f.name not in without
                 and not any(t in f.dataType.simpleString() for t in ("map<", "variant")))


def segments(max_bits: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of ``count`` segments: fingerprints within ``max_bits``
    are within radius in at least one of them (the radii plus one add up to max_bits + 1)."""
    base, rest = divmod(max_bits + 1, count)
    widths = [64 // count + (i < 64 % count) for i in range(count)]
    return [(sum(widths[:i]), w, base - 1 + (i < rest)) for i, w in enumerate(widths) if base + (i < rest) > 0]


def _balls(fp: np.ndarray, part: tuple[int, int, int]) -> Iterator[np.ndarray]:
    """The segment's values around those of ``fp``, one array per flipped set of bits."""
    shift, width, radius = part
    value = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    for r in range(radius + 1):
        for bits in combinations(range(width), r):
            yield value ^ np.uint64(sum(1 << b for b in bits))


def _entries(fp: np.ndarray, parts: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, fingerprint and membership of all filings and probes. A pair that differs
    in a segment is found from its smaller value, so only probes above the own value go out."""
    buckets, fps, member = [], [], []
    for k, part in enumerate(parts):
        around = _balls(fp, part)
        value, name = next(around), np.uint64(k << 60)
        buckets.append(value | name)
        fps.append(fp)
        member.append(np.ones(len(fp), bool))
        for other in around:
            up = other > value
            buckets.append(other[up] | name)
            fps.append(fp[up])
            member.append(np.zeros(int(up.sum()), bool))
    return np.concatenate(buckets), np.concatenate(fps), np.concatenate(member)


def _reach(bucket: np.ndarray, n: np.ndarray, parts: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that get probes from the members of others, and how many, in any order."""
    buckets, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k, (_, width, radius) in enumerate(parts):
        here = (bucket >> np.uint64(60)) == k
        around = _balls(bucket[here], (0, width, radius))
        value, name = next(around), np.uint64(k << 60)
        for other in around:
            up = other > value
            buckets.append(other[up] | name)
            counts.append(n[here][up])
    return np.concatenate(buckets), np.concatenate(counts)


def hot_buckets(fps: DataFrame, parts: list[tuple[int, int, int]], block: int) -> DataFrame:
    """``bucket, members, probes``: the blocks of the members and of the probes of each bucket where
    either pass ``block``.

    Whole counts are kept of the values that matter: what others bring to a bucket is,
    over all of a ball, below one block, which the probes' blocks have room for."""
    own = F.explode(F.array(*[F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).bitwiseOR(F.lit(k << 60).cast("long"))
                              for k, (s, w, _) in enumerate(parts)]))
    ball = max(sum(comb(w, i) for i in range(r + 1)) for _, w, r in parts)
    counts = written(fps.select(own.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > max(1, block // ball)), "simhash-counts")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for a in range(0, len(n), 1024):
                b, m = _reach(bucket[a:a + 1024].view(np.uint64), n[a:a + 1024], parts)
                yield pa.RecordBatch.from_arrays([pa.array(b.view(np.int64)), pa.array(m)], ["bucket", "p"])

    probes = counts.mapInArrow(reach, "bucket long, p long").withColumn("n", F.lit(0).cast("long"))
    both = probes.unionByName(counts.withColumn("p", F.lit(0).cast("long"))).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    return written(both.where((F.col("n") > block) | (F.col("p") > block)).select(
        "bucket", F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("int").alias("members"),
        (F.ceil(F.col("p") / block) + F.when(F.col("p") > 0, 1).otherwise(0)).cast("int").alias("probes"))
        .withColumn("probes", F.greatest(F.lit(1), "probes")), "simhash-large")


class Forest:
    """Union-find over an array of values by vectorised label spreading."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.label[a], self.label[b]
            keep = la != lb
            if not keep.any():
                return
            a, b, la, lb = a[keep], b[keep], la[keep], lb[keep]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _links(bucket: np.ndarray, fp: np.ndarray, member: np.ndarray, max_bits: int, pairs_at_once: int = 1 << 21) -> pa.RecordBatch:
    """Spanning stars (fp, smaller fp) of the verified pairs that meet in a bucket; the
    arrays hold whole buckets, sorted by bucket with the members of each first."""
    values, place = np.unique(fp, return_inverse=True)
    forest = Forest(len(values))
    begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    sizes = np.diff(np.r_[begins, len(bucket)])
    ends = np.repeat(begins + sizes, sizes)
    rows = np.flatnonzero(member & (ends - np.arange(len(bucket)) > 1))    # each member against all after it
    partners = (ends - np.arange(len(bucket)) - 1)[rows]
    cuts = np.cumsum(partners)
    at = 0
    while at < len(rows):
        before = cuts[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(cuts, before + pairs_at_once, "right")))
        left = np.repeat(rows[at:to], partners[at:to])
        offset = np.arange(len(left)) - np.repeat(cuts[at:to] - partners[at:to] - before, partners[at:to])
        right = left + 1 + offset
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        forest.link(place[left[near]], place[right[near]])
        at = to
    moved = np.flatnonzero(forest.label != np.arange(len(values)))
    return pa.RecordBatch.from_arrays([pa.array(values[moved].view(np.int64)), pa.array(values[forest.label[moved]].view(np.int64))], ["a", "b"])


def near_links(fps: DataFrame, max_bits: int = 4, n_segments: int | None = None, block: int = 4096) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that have the same
    connected components as all pairs within ``max_bits`` differing bits."""
    if n_segments is None:
        bits = max(1, fps.count()).bit_length()
        n_segments = min(4, max(2, 64 // max(bits, 16)))
    parts = segments(max_bits, n_segments)

    def file_and_probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(fp), 8192):
                b, f, m = _entries(fp[a:a + 8192], parts)
                yield pa.RecordBatch.from_arrays([pa.array(b.view(np.int64)), pa.array(f.view(np.int64)), pa.array(m)], ["bucket", "fp", "member"])

    entries = fps.select("fp").mapInArrow(file_and_probe, "bucket long, fp long, member boolean")
    # a pair of member blocks is (lo, hi); a block of members with a block of probes is (lo, members + number)
    def mine(blocks: str) -> Column:
        return F.pmod(F.xxhash64("fp"), F.col(blocks)).cast("int")

    def numbers(blocks: str, place) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda x: F.struct(place(x)[0].alias("lo"), place(x)[1].alias("hi")))

    own, probe = mine("members"), mine("probes")
    places = (F.when(F.col("members").isNull(), F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi"))))
              .when(F.col("member"), F.concat(numbers("members", lambda x: (F.least(x, own), F.greatest(x, own))),
                                              numbers("probes", lambda x: (own, F.col("members") + x))))
              .otherwise(numbers("members", lambda x: (x, F.col("members") + probe))))
    keyed = (entries.join(hot_buckets(fps, parts, block), "bucket", "left").withColumn("at", F.explode(places))
             .select("bucket", "at.lo", "at.hi", (~F.col("member")).alias("probe"), "fp"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            b, lo, hi, probe, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            now = [b, lo, hi, probe, fp.view(np.uint64)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            # whole buckets are done, the last one may go on in the next batch
            same = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
            cut = int(np.argmax(same)) if same.any() else 0
            if cut:
                yield found([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield found(held)

    def found(x: list[np.ndarray]) -> pa.RecordBatch:
        b, lo, hi, probe, fp = x
        new = np.r_[True, (b[1:] != b[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
        return _links(np.cumsum(new), fp, ~probe, max_bits)

    return (keyed.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "probe", "fp")
            .mapInArrow(verify, "a long, b long"))


def _found(docs: DataFrame, size: int, max_bits: int, id_col: str, text_col: str, others: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The written marks of all rows, and ``fp, root, component_id`` of each distinct fingerprint."""
    marks = written(fingerprints(docs, size, id_col, text_col, others), "simhash-marks")
    distinct = written(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    trees = components(written(near_links(distinct, max_bits), "simhash-links"))
    # one row per fingerprint: its root (itself without links), then each root's smallest document
    rooted = written(distinct.join(trees.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    # rows of a root with others go by salt, each with a copy of the root's smallest
    salt = F.when(F.col("fp") == F.col("root"), 0).otherwise(F.pmod(F.xxhash64("fp"), F.lit(_SALTS))).cast("int")
    salts = F.when(F.col("n") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    least = (rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
             .select("root", "component_id", F.explode(salts).alias("salt")))
    final = rooted.withColumn("salt", salt).join(least, ["root", "salt"])
    return marks, written(final.select("fp", "root", "component_id"), "simhash-components")


def groups(docs: DataFrame, size: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` per row of ``docs``.

    component_id is the smallest doc_id among all documents reachable over links
    of at most ``max_bits`` bits (equal fingerprints link). Null text is empty:
    fingerprint zero. Null doc_id: takes part, but is never a component_id unless
    all of its component are null (then null). Repeated rows link to each other."""
    marks, final = _found(docs, size, max_bits, id_col, text_col)
    return marks.join(final, "fp").select("doc_id", "text_hash", "fp", "component_id")


def one_per_group(docs: DataFrame, size: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which each group keeps one: the smallest doc_id (null last),
    of equal ids the smallest text hash, of equal texts the smallest hash of all columns (but maps)."""
    others = _hashable(docs, id_col, text_col)
    marks, final = _found(docs, size, max_bits, id_col, text_col, others)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash", "row_key")
    # one winner per fingerprint first (map-side), then per component
    win = marks.groupBy("fp").agg(F.min(order).alias("w")).join(final, "fp")
    win = win.groupBy("root").agg(F.min("w").alias("w"))
    a, b = free_names(docs, "row_key", "text_hash")
    kept = written(win.select(F.col("w.row_key").alias(a), F.col("w.text_hash").alias(b)), "simhash-kept")
    key, text_hash = _keys(id_col, text_col, others)
    # one shuffle of the texts: repeated rows meet in the partition of the join
    rows = docs.withColumns({a: key, b: text_hash}).join(kept, [a, b])
    return rows.dropDuplicates([a, b]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = groups(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
