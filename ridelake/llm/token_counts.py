"""Token counts by count-only Viterbi over a unigram vocabulary.

Texts are cut where a word mark begins (a blank, kept as the mark), as the
tokenizers library's Metaspace pre-tokenizer does. An Aho-Corasick automaton
enumerates every vocabulary entry in a word in one pass; a forward program
carries the best score and its number of pieces only, no back pointers. Tie
rules are the library's: at each end the earliest start wins among equal
scores, and a character without an entry of its own may be unknown, at the
least score minus ten. With byte entries in the vocabulary an unknown
character counts as its UTF-8 bytes; without them a run of unknown characters
counts once.

Runs in Arrow batches without a shuffle. Equal words of a batch are counted
once; memory is bounded by ``BATCH_BYTES`` of text, or one longer text.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .tokens import batches_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def vocabulary(model_file: str) -> tuple[list[tuple[str, float]], int]:
    """Entries of a piece file with unigram scores, and the unknown entry's number. The
    file's scores are merge ranks; an entry's score is minus the logarithm of its rank
    plus one (Zipf's law), and the least of these for entries without a rank."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    ranked = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
    scores = {i: -math.log(1.0 - model.get_score(i) + 1.0) for i in range(size) if ranked[i]}
    least = min(scores.values())
    return [(model.id_to_piece(i), scores.get(i, least)) for i in range(size)], model.unk_id()


class Counter:
    def __init__(self, entries: list[tuple[str, float]], unknown: int):
        self.automaton = ahocorasick.Automaton()
        for text, score in entries:
            if text:
                self.automaton.add_word(text, (len(text), score))
        self.automaton.make_automaton()
        names = {text for text, _ in entries}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown_score = min(s for _, s in entries) - UNKNOWN_PENALTY
        self.unknown_name = entries[unknown][0]

    def count(self, word: str) -> int:
        """Pieces of the best segmentation of ``word``."""
        n = len(word)
        score, pieces, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        unknown, as_bytes = self.unknown_score, self.bytes
        hits = self.automaton.iter(word)
        nxt = next(hits, None)
        for end in range(1, n + 1):
            best, at, single = -math.inf, -1, False
            while nxt is not None and nxt[0] == end - 1:    # longest entry first: earliest start first
                size, s = nxt[1]
                s += score[end - size]
                if s > best:
                    best, at = s, end - size
                single |= size == 1
                nxt = next(hits, None)
            if not single and unknown + score[end - 1] > best:
                best, at = unknown + score[end - 1], end - 1
                run = fused[end - 1]
                pieces[end] = pieces[at] + (len(word[at].encode("utf-8", "replace")) if as_bytes else 0 if run else 1)
                fused[end] = not as_bytes
            else:
                pieces[end] = pieces[at] + 1
            score[end] = best
        return pieces[n]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and pieces of each text."""
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        marked = pc.replace_substring(texts, " ", MARK)
        # every text begins with a mark; one that does already gets no second
        begun = pc.starts_with(marked, MARK)
        marked = pc.if_else(begun, pc.utf8_slice_codeunits(marked, 1), marked)
        split = pc.split_pattern(marked, MARK)
        offsets = np.asarray(split.offsets)
        offsets = offsets - offsets[0]
        coded = split.flatten().dictionary_encode()
        each = np.array([self.count(MARK + w) for w in coded.dictionary.to_pylist()], np.int64)
        total = np.r_[0, np.cumsum(each[coded.indices.to_numpy(zero_copy_only=False)])]
        words = np.diff(offsets).astype(np.int64)
        pieces = total[offsets[1:]] - total[offsets[:-1]]
        none = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        return np.where(none, 0, words), np.where(none, 0, pieces)


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens`` per row of ``docs``: words of the cut and pieces of the
    best segmentation. Null or empty text: 0 and 0; null ids and repeated rows stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*vocabulary(model_file))
        for batch in batches:
            for part in batches_of(batch, 1):
                words, pieces = counter.counts(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(pieces)], ["doc_id", "n_words", "n_tokens"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op4_viterbi_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
