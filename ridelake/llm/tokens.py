"""Token ids as Parquet list columns.

Documents are range-partitioned and sorted by doc_id, encoded in Arrow batches
and written by Spark's Parquet writer: ids delta- or dictionary-encoded in row
groups and pages of a set size, with page indexes, so a reader can take the
metadata columns alone, or the ids of a doc_id range alone. Global positions
are never written: a shard stores positions from its own start, and the shards'
token totals (one row per shard) shift them when they are read.

Encoding a batch: texts are split at single blanks by Arrow, equal pieces are
found by dictionary encoding, and only distinct pre-tokens are encoded, by
``bpe.Merges`` on the tokenizer that the tokenizers library loads: the library's own
loop needs several times the CPU, and time that grows with the square of unsplit
text. Texts that spell a special token go through the library itself. Memory
is bounded by ``BATCH_BYTES`` of text, or one longer text.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from ..session import work_path
from .bpe import Merges, ranges
from .common import read

END_ID = 0
BATCH_BYTES = 2 << 20      # text bytes that a task works on at once
# Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# a blank beside other white space: such a text can't be cut at its blanks
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNCUT = f" {_SPACE}|{_SPACE} "


class Pieces:
    """Ids of the distinct pieces of a batch: ids in a row, and where each piece's begin and end."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        self.starts = np.cumsum(counts) - counts

    def of(self, which: np.ndarray) -> np.ndarray:
        return self.ids[ranges(self.starts[which], self.counts[which])]


class ByteEncoder:
    """Encodes batches of texts as the library's ``encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(self.tokenizer)
        self.pattern = regex.compile(PATTERN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def pre_tokens(self, pre: pa.Array) -> Pieces:
        """Ids of distinct pre-tokens."""
        return Pieces(*self.merges.encode_strings(pre))

    def chunks(self, chunks: pa.Array) -> Pieces:
        """Ids of distinct chunks: text between places where a pre-token surely begins."""
        letters = pc.utf8_is_alpha(pc.utf8_ltrim(chunks, " "))
        one = pc.and_(letters, pc.less_equal(pc.subtract(pc.binary_length(chunks), pc.binary_length(pc.utf8_ltrim(chunks, " "))), 1))
        one = one.to_numpy(zero_copy_only=False)
        found = list(map(self.pattern.findall, chunks.filter(pa.array(~one)).to_pylist()))
        sizes = np.ones(len(chunks), np.int64)
        sizes[~one] = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes)
        coded = pa.concat_arrays([chunks.filter(pa.array(one)), pa.array(list(chain.from_iterable(found)), pa.large_string())]).dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        which, n = np.empty(int(sizes.sum()), np.int64), int(one.sum())
        which[ends[one] - 1] = index[:n]
        which[ranges((ends - sizes)[~one], sizes[~one])] = index[n:]
        pieces = self.pre_tokens(coded.dictionary)
        total = np.r_[0, np.cumsum(pieces.counts[which])]
        return Pieces(pieces.of(which), total[ends] - total[ends - sizes])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of each text's."""
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        counts = np.zeros(len(texts), np.int64)
        marked = np.zeros(len(texts), bool)
        for s in self.special:
            marked |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        uncut = pc.match_substring_regex(texts, UNCUT).to_numpy(zero_copy_only=False) & ~marked
        plain = np.flatnonzero(~marked & ~uncut)
        split = pc.split_pattern(texts.take(pa.array(plain)), " ")
        flat = split.flatten()
        offsets = np.asarray(split.offsets)
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary
        # the first piece of a text has no blank before it: those are chunks of their own, after the others
        first = offsets[:-1][np.diff(offsets) > 0]
        heads, where = np.unique(index[first], return_inverse=True)
        index[first] = len(words) + where
        whole = np.flatnonzero(uncut)
        blank = pa.scalar(" ", pa.large_string())
        pieces = self.chunks(pa.concat_arrays([pc.binary_join_element_wise(blank, words, pa.scalar("", pa.large_string())),
                                               words.take(pa.array(heads)), texts.take(pa.array(whole))]))
        per = np.r_[0, np.cumsum(pieces.counts[index])]
        counts[plain] = per[offsets[1:]] - per[offsets[:-1]]
        own = len(words) + len(heads) + np.arange(len(whole))
        counts[whole] = pieces.counts[own]
        # texts that spell a special token are the library's alone
        special = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(
            texts.take(pa.array(np.flatnonzero(marked))).to_pylist(), add_special_tokens=False)]
        counts[marked] = [len(x) for x in special]
        if not len(whole) and not special:
            return pieces.of(index), counts
        out = np.empty(int(counts.sum()), np.uint32)
        starts = np.cumsum(counts) - counts
        out[ranges(starts[plain], counts[plain])] = pieces.of(index)
        out[ranges(starts[whole], counts[whole])] = pieces.of(own)
        for k, x in zip(np.flatnonzero(marked), special):
            out[starts[k]:starts[k] + len(x)] = x
        return out, counts


def batches_of(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of at most ``most`` bytes of text, a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    a, total = 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(a, k - a)
            a, total = k, 0
        total += int(n)
    if a < batch.num_rows:
        yield batch.slice(a)


SHARDS = "doc_id long, shard int, at long, n_tokens long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 encoding: str = "delta", row_group_bytes: int = 64 << 20, page_bytes: int = 256 << 10) -> None:
    """Token file of ``docs`` under ``path``: doc_id, shard, at (position in the shard), n_tokens, ids.

    Rows go in ascending doc_id (null first; rows of equal doc_id by a hash of their text, so that
    a heavy id is divided among shards, then by text). Each
    document's ids end with ``end_id``; a null or empty text has that one alone."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash")
    rows = rows.sortWithinPartitions("doc_id", "hash", "text").drop("hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, at = ByteEncoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in batches_of(batch, 1):
                ids, counts = encoder.encode(part.column(1))
                ends = np.cumsum(counts + 1)
                out = np.full(int(ends[-1]), end_id, np.int32)
                out[ranges(ends - counts - 1, counts)] = ids
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.full(len(counts), shard, np.int32)), pa.array(at + ends - counts - 1), pa.array(counts + 1),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(out))], ["doc_id", "shard", "at", "n_tokens", "ids"])
                at += int(ends[-1])

    writer = rows.mapInArrow(run, SHARDS).write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    writer = writer.option("parquet.page.write-checksum.enabled", "true")
    if encoding == "delta":
        writer = writer.option("parquet.enable.dictionary", "false").option("parquet.writer.version", "PARQUET_2_0")
    writer.parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``shard, begin``: ids before each shard. Reads two metadata columns; one row per shard is left."""
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("begin"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; start is the number of ids of all documents before."""
    table = spark.read.schema(SHARDS).parquet(path)
    return table.join(F.broadcast(shard_starts(spark, path)), "shard").select(
        "doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        flat, ends = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.asarray(ids.offsets)
        ends = ends - ends[0]
        crc = [zlib.crc32(flat[a:b].data) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = work_path(spark, "token-file")
    write_tokens(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path).mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
