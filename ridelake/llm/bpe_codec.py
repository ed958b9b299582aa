"""BPE encoding and decoding of documents with a word-end vocabulary.

Runs in Arrow batches, without a shuffle: texts are split at ASCII blanks, equal
pieces are found by dictionary encoding, and only distinct pre-tokens meet
``bpe.Merges``, which encodes long unsplit text by tree concatenation. Ids and
results equal the tokenizers library's; texts that spell a special token go
through the library itself.
"""
from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import Merges, ranges
from .common import read
from .tokens import Pieces, batches_of

# Fixed value: the pre-token pattern of the word-end vocabulary, on lower-case text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# letters whose composition and lower case need no context
PLAIN = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+$"


class WordEncoder:
    """Encodes and decodes batches as the library's ``encode(text, add_special_tokens=False)``
    and ``decode(ids, skip_special_tokens=False)`` do."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # a file may ask for truncation or padding; neither is part of the encoding
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Merges(self.tokenizer)
        self.pattern = regex.compile(PATTERN)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.names = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.large_string())
        self.decimals = pa.array([str(i) for i in range(max(names) + 1)], pa.large_string())

    def normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()    # sigma: no final form

    def chunks(self, chunks: pa.Array) -> Pieces:
        """Ids of distinct texts without ASCII blanks."""
        one = pc.match_substring_regex(chunks, PLAIN).to_numpy(zero_copy_only=False)
        found = [self.pattern.findall(self.normal(c)) for c in chunks.filter(pa.array(~one)).to_pylist()]
        sizes = np.ones(len(chunks), np.int64)
        sizes[~one] = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes)
        coded = pa.concat_arrays([pc.utf8_lower(chunks.filter(pa.array(one))),
                                  pa.array(list(chain.from_iterable(found)), pa.large_string())]).dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        which, n = np.empty(int(sizes.sum()), np.int64), int(one.sum())
        which[ends[one] - 1] = index[:n]
        which[ranges((ends - sizes)[~one], sizes[~one])] = index[n:]
        pieces = Pieces(*self.merges.encode_strings(coded.dictionary))
        total = np.r_[0, np.cumsum(pieces.counts[which])]
        return Pieces(pieces.of(which), total[ends] - total[ends - sizes])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of each text's."""
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        counts = np.zeros(len(texts), np.int64)
        marked = np.zeros(len(texts), bool)
        for s in self.special:
            marked |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~marked)
        split = pc.ascii_split_whitespace(texts.take(pa.array(plain)))
        offsets = np.asarray(split.offsets)
        offsets = offsets - offsets[0]
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pieces = self.chunks(coded.dictionary)
        per = np.r_[0, np.cumsum(pieces.counts[index])]
        counts[plain] = per[offsets[1:]] - per[offsets[:-1]]
        special = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(
            texts.take(pa.array(np.flatnonzero(marked))).to_pylist(), add_special_tokens=False)]
        if not special:
            return pieces.of(index), counts
        counts[marked] = [len(x) for x in special]
        out, starts = np.empty(int(counts.sum()), np.int32), np.cumsum(counts) - counts
        out[ranges(starts[plain], counts[plain])] = pieces.of(index)
        for k, x in zip(np.flatnonzero(marked), special):
            out[starts[k]:starts[k] + len(x)] = x
        return out, counts

    def joined(self, values: pa.Array, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Per text, the values of its ids with a blank between."""
        offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(pa.array(ids))), pa.scalar(" ", pa.large_string()))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The file has no decoder: tokens as they are, with a blank between."""
        return self.joined(self.names, ids, counts)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` per row of ``docs``. Null or empty text: no ids; null ids and
    repeated rows stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in batches:
            for part in batches_of(batch, 1):
                ids, counts = encoder.encode(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), lists], ["doc_id", "n_tokens", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id`` and ``ids``; null ids: empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), encoder.decode(ids, counts).cast(pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the encoding and its decoding in
    one pass, as digests (ids and texts don't leave the task)."""
    def sha(texts: pa.Array) -> list[str]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8).tolist()
        body = memoryview(texts.buffers()[2] or b"")
        return [hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in batches:
            for part in batches_of(batch, 1):
                ids, counts = encoder.encode(part.column(1))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(counts), pa.array(sha(encoder.joined(encoder.decimals, ids, counts))),
                    pa.array(sha(encoder.decode(ids, counts)))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe_tree_concatenation(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
