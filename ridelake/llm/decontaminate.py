"""Benchmark decontamination by random-walk embedding, bit sampling and exact edit distance.

Texts and items are compared as word sequences: compatibility forms unified (NFKC),
lower case, punctuation (of ASCII, symbols too) taken as blank, each character of a script
without blanks (Han, kana, Thai and so on) a word. The CGK walk reads a sequence by steps: step t emits the
current word and moves on when a random bit of (t, word) is set, so equal
stretches emit equal symbols after a few steps and edit distance becomes
Hamming distance. A window of an item's size is embedded as the walks
restarted at each of its words; an edit then only disturbs the walks that
read it. One bit sample is a restart plus a few steps of its walk. All
restarts of an item are indexed for as many independent walks as the target recall
asks for (``walks_for``: by the item's length and limit, for edits spread as badly as
they can be). Items of under ``SHORT`` words, too short for that, are looked up by one word more than
their limit, of which an allowed number of edits always leaves one.
Every proposed window is verified by exact word edit distance.

Scale: the benchmark is the stated query set. It is indexed in blocks of at most
``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words (one longer item alone), one block at a time: what a
block finds is written and its broadcast released before the next. A block is compared with all documents
in one pass without a shuffle. A batch's words become integers in Arrow, the
walks run over all positions at once and stop at the first step that no item
emits, so nearly all positions cost a few array operations.
"""
from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil, comb, log
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, read, written

MAX_EDIT_SHARE = 0.2      # an item is found in a window at most this share of its words away
RECALL = 0.999            # target: least chance that an item within its limit is proposed
STEPS = 7                 # steps of a walk
SAMPLED = ((0, 1, 3, 6), (0, 2, 4, 6), (0, 1, 4, 6), (0, 2, 5, 6))    # steps that a sample reads, by walk in turn
SHORT = 8                 # items of fewer words are found by single words
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 1 << 20
PROPOSALS = 1 << 19       # proposed windows that are tested at once
BATCH_BYTES = 2 << 20     # text bytes that a task works on at once (one longer text alone)

# A-Z lowered; other ASCII but a-z and 0-9 is a blank; bytes of other characters stay.
_WORD_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))
# Characters beyond ASCII that are no letter, digit, mark or symbol; scripts that are written without blanks.
_BLANK = r"[^\x00-\x7f\p{L}\p{N}\p{M}\p{S}]"
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"


def _folded(texts: pa.Array) -> pa.Array:
    """Texts (null: empty) whose words are what lies between the blanks of ``_WORD_BYTES``."""
    texts = pc.fill_null(pc.cast(texts, pa.large_binary()), b"")
    ascii_only = pc.string_is_ascii(pc.cast(texts, pa.large_string(), safe=False))
    if pc.all(ascii_only).as_py():
        return texts
    other = pc.invert(ascii_only)
    part = pa.array([normalize("NFKC", x.decode("utf-8", "replace")).lower() for x in texts.filter(other).to_pylist()], pa.large_string())
    part = pc.replace_substring_regex(part, _BLANK, " ")
    unspaced = pc.match_substring_regex(part, _UNSPACED)
    if pc.any(unspaced).as_py():
        part = pc.replace_with_mask(part, unspaced, pc.replace_substring_regex(part.filter(unspaced), _UNSPACED, r" \1 "))
    return pc.replace_with_mask(texts, other, pc.cast(part, pa.large_binary()))


def item_words(text: str | None) -> list[bytes]:
    folded = _folded(pa.array([(text or "").encode("utf-8", "replace")], pa.binary()))
    return folded[0].as_py().translate(_WORD_BYTES).split()


def walks_for(words: int, limit: int, recall: float = RECALL) -> int:
    """Walks after which an item of ``words`` words is proposed with chance ``recall``, when ``limit``
    edits part the other words into stretches as even, so as short, as can be.

    A walk that starts a stretch of g words stays in it, and so emits what the item's does, when at most
    g - 1 of its STEPS - 1 moves go on: a binomial chance. A walk is lost only if it leaves every stretch."""
    even, more = divmod(words - limit, limit + 1)

    def lost(g: int) -> float:
        return 1 - sum(comb(STEPS - 1, k) for k in range(min(g, STEPS))) / 2 ** (STEPS - 1)
    missed = lost(even) ** (limit + 1 - more) * lost(even + 1) ** more
    return 1 if missed <= 1 - recall else ceil(log(1 - recall) / log(missed))


def edit_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Least word edit distance of ``item`` to any stretch of ``region``, and where the first such stretch ends."""
    ramp = np.arange(len(region) + 1)
    row, step = np.zeros(len(region) + 1, np.int64), np.empty(len(region) + 1, np.int64)
    for i, w in enumerate(item, 1):
        step[0] = i
        np.minimum(row[:-1] + (region != w), row[1:] + 1, out=step[1:])
        step -= ramp
        np.minimum.accumulate(step, out=row)
        row += ramp
    end = int(row.argmin())
    return int(row[end]), end


_START_BITS, _HOLD_BITS = 20, 23


def _start(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.int32(7919) + b * np.int32(104729)) & np.int32((1 << _START_BITS) - 1)


def _hold(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (item * 2654435761 + word * 40503) & ((1 << _HOLD_BITS) - 1)


class ItemIndex:
    """Samples of a block of items: what a task needs to search a batch of texts."""

    def __init__(self, items: list[tuple[int, list[bytes]]], share: float = MAX_EDIT_SHARE, seed: int = 7):
        items = [(i, w) for i, w in items if w]
        self.vocabulary = sorted({w for _, ws in items for w in ws})
        number = {w: k for k, w in enumerate(self.vocabulary, 1)}      # 0: any other word
        self.ids = [i for i, _ in items]
        self.words = [np.array([number[w] for w in ws], np.int32) for _, ws in items]
        self.limit = [int(share * len(w) + 1e-9) for w in self.words]
        rng = np.random.default_rng(seed)
        need = [walks_for(len(w), e) if len(w) >= SHORT else 0 for w, e in zip(self.words, self.limit)]
        walks = max(need, default=0)
        self.moves = rng.integers(0, 2, (walks, STEPS, len(self.vocabulary) + 1)).astype(np.int64)
        short: dict[int, list[tuple[int, int]]] = defaultdict(list)
        seen = Counter(int(w) for ws in self.words for w in np.unique(ws))
        for k, ws in enumerate(self.words):
            if len(ws) < SHORT:
                for o in sorted(range(len(ws)), key=lambda o: seen[int(ws[o])])[:self.limit[k] + 1]:
                    short[int(ws[o])].append((k, o))
        self.short = {w: np.array(ks).T for w, ks in short.items()}
        self.sizes, self.limits = np.array([len(w) for w in self.words], np.int64), np.array(self.limit, np.int64)
        self.tables = [self._table(r, [k for k, n in enumerate(need) if n > r]) for r in range(walks)]
        # words by item, as marks that may also say yes to others (only the exact distance decides)
        self.holds = np.zeros(1 << _HOLD_BITS, bool)
        for k, ws in enumerate(self.words):
            self.holds[_hold(np.full(len(ws), k), ws)] = True

    def _table(self, r: int, items: list[int]) -> tuple[np.ndarray, ...]:
        """Samples of walk ``r`` at every restart of the items, by key, with marks of their first
        word and of their first two symbols."""
        parts = []
        for k in items:
            ws = self.words[k]
            at, emitted, inside = np.arange(len(ws)), [ws], np.ones(len(ws), bool)
            for t in range(1, STEPS):
                at = at + self.moves[r, t - 1][ws[np.minimum(at, len(ws) - 1)]]
                inside &= at < len(ws)
                emitted.append(ws[np.minimum(at, len(ws) - 1)])
            o = np.flatnonzero(inside)
            s = np.stack([emitted[j] for j in SAMPLED[r % len(SAMPLED)]], 1)[o]
            parts.append((self._mix(s), np.full(len(o), k), o, s[:, 0], s[:, 1]))
        keys, of, offset, one, two = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((offset, of, keys))
        first, starts = np.zeros(len(self.vocabulary) + 1, bool), np.zeros(1 << _START_BITS, bool)
        first[one] = True
        starts[_start(one, two)] = True
        return keys[order], of[order], offset[order], first, starts

    @staticmethod
    def _mix(symbols: np.ndarray) -> np.ndarray:
        h = np.zeros(len(symbols), np.uint64)
        for c in range(symbols.shape[1]):
            h = (h ^ symbols[:, c].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def proposals(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, start of the proposed window) over the word numbers of a batch, in pieces of about
        PROPOSALS; starts may lie before 0."""
        top = len(words) - 1
        known = np.flatnonzero(words > 0)
        for r, (keys, of, offset, first, start_marks) in enumerate(self.tables):
            begin = at = known[first[words[known]]]
            emitted = [words[at]]
            for t in range(1, STEPS):
                at = np.minimum(at + self.moves[r, t - 1][words[at]], top)
                if t in SAMPLED[r % len(SAMPLED)]:
                    emitted.append(words[at])
                    if len(emitted) == 2:    # most positions end here
                        ok = np.flatnonzero(start_marks[_start(*emitted)])
                        begin, at, emitted = begin[ok], at[ok], [e[ok] for e in emitted]
            h = self._mix(np.stack(emitted, 1))
            lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            hits = np.flatnonzero(hi > lo)
            for a, b in self._pieces((hi - lo)[hits]):
                part = hits[a:b]
                n = hi[part] - lo[part]
                row = np.repeat(lo[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield of[row], np.repeat(begin[part], n) - offset[row]
        for w, (ks, offset) in self.short.items():
            begin = np.flatnonzero(words == w)
            for a, b in self._pieces(np.full(len(begin), len(ks))):
                yield np.tile(ks, b - a), np.repeat(begin[a:b], len(ks)) - np.tile(offset, b - a)

    @staticmethod
    def _pieces(n: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of ``n`` with a sum of about PROPOSALS."""
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // PROPOSALS)) + 1
        yield from zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(n)].tolist())

    def _likely(self, item: np.ndarray, start: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Proposals whose window may be within the limit. A word that the item lacks costs an edit: the words
        that are inside the window wherever its ends lie hold at most limit of them, and the
        widest window three times as many (limit edits, and what lies outside)."""
        size, limit = self.sizes[item], self.limits[item]
        left = self._few_others(item, start + limit, size - 2 * limit, limit, words)
        wide = self._few_others(item[left], (start - limit)[left], (size + 2 * limit)[left], 3 * limit[left], words)
        return left[wide]

    def _few_others(self, item: np.ndarray, begin: np.ndarray, reach: np.ndarray, spare: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The stretches of ``reach`` words from ``begin`` with at most ``spare`` words that the item lacks."""
        left = np.arange(len(item))
        for d in range(int(reach.max(initial=0))):
            if d % 4 == 0:      # most proposals end early
                ok = spare >= 0
                left, spare, item, begin, reach = left[ok], spare[ok], item[ok], begin[ok], reach[ok]
            at = begin + d
            held = (at >= 0) & (at < len(words)) & self.holds[_hold(item, words[np.clip(at, 0, len(words) - 1)])]
            spare = spare - ((d < reach) & ~held)
        return left[spare >= 0]

    def search(self, words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item number, distance, first word, words) of the verified items in a batch of
        texts, given all its word numbers in a row and where each text's words end."""
        if not len(words) or not self.words:
            return []
        sizes, limits = self.sizes, self.limits
        span, kept = len(words) + int(sizes.max()), []    # a window as one number
        for item, start in self.proposals(words):
            one = np.sort(item * (2 * span) + start + span)
            one = one[np.r_[True, one[1:] != one[:-1]][:len(one)]]
            item, start = one // (2 * span), one % (2 * span) - span
            ok = self._likely(item, start, words)
            kept.append(np.stack([item[ok], start[ok]]))
        item, start = np.concatenate([np.zeros((2, 0), np.int64), *kept], 1)
        begins = np.r_[0, ends[:-1]]
        # a window over a border of texts may belong to any of them
        todo = np.unique(np.concatenate([np.stack([np.searchsorted(
            ends, np.clip(start + d, 0, len(words) - 1), "right"), item, start], 1) for d in (0, sizes[item] // 2, sizes[item] - 1)]), axis=0)
        out = []
        for (t, k), first, last in self._regions(todo, limits):
            a = max(int(begins[t]), first - self.limit[k])
            b = min(int(ends[t]), last + int(sizes[k]) + self.limit[k])
            if b - a < sizes[k] - self.limit[k]:
                continue
            region = words[a:b]
            own = self.words[k]
            distance, end = edit_distance(own, region)
            if distance <= self.limit[k]:
                _, back = edit_distance(own[::-1], region[:end][::-1])
                out.append((int(t), int(k), distance, int(a + end - back - begins[t]), int(back)))
        return out

    @staticmethod
    def _regions(todo: np.ndarray, limits: np.ndarray) -> Iterator[tuple[tuple[int, int], int, int]]:
        """Starts of one (text, item) that are close to each other, as (text, item), first, last."""
        if not len(todo):
            return
        new = np.r_[True, (todo[1:, 0] != todo[:-1, 0]) | (todo[1:, 1] != todo[:-1, 1])
                    | (todo[1:, 2] - todo[:-1, 2] > 2 * limits[todo[1:, 1]] + 1)]
        at = np.flatnonzero(new)
        for a, b in zip(at, np.r_[at[1:], len(todo)]):
            yield (int(todo[a, 0]), int(todo[a, 1])), int(todo[a, 2]), int(todo[b - 1, 2])


def _numbers(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, and where each text's words end."""
    texts = pa.concat_arrays([_folded(texts)])       # offsets from 0
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    body = texts.buffers()[2].to_pybytes().translate(_WORD_BYTES) if texts.buffers()[2] else b""
    # a blank per text keeps the words of neighbours apart
    clean = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)])
    parts = pc.ascii_split_whitespace(clean)
    flat = parts.flatten()
    numbers = pc.fill_null(pc.add(pc.index_in(flat, value_set=vocabulary), 1), 0).to_numpy(zero_copy_only=False).astype(np.int32)
    # splitting leaves empty strings at blanks on either end
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    counts = np.r_[0, np.cumsum(real)]
    return numbers[real], counts[np.asarray(parts.offsets)[1:] - int(parts.offsets[0].as_py())]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of at most BATCH_BYTES of text, a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    a, total = 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > BATCH_BYTES:
            yield batch.slice(a, k - a)
            a, total = k, 0
        total += int(n)
    if a < batch.num_rows:
        yield batch.slice(a)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, share: float) -> Iterator[tuple[ItemIndex, bool]]:
    """The index of each block, and whether it is the last one. The driver holds one block's
    items, and those read on to see whether more follow."""
    rows = benchmark.select(F.col(id_col).cast("long"), text_col).orderBy(*benchmark.select(id_col, text_col).columns).toLocalIterator()
    block: list[tuple[int, list[bytes]]] = []
    held = 0
    for r in rows:
        words = item_words(r[1])
        if block and (len(block) == BLOCK_ITEMS or held + len(words) > BLOCK_WORDS):
            yield ItemIndex(block, share), False
            block, held = [], 0
        block.append((r[0], words))
        held += len(words)
    if block:
        yield ItemIndex(block, share), True


FOUND = "doc_id long, item_id long, distance long, first_word long, n_words long"


def _searched(docs: DataFrame, sent, at: int, schema: str, row) -> DataFrame:
    """``row(batch, finds, index)`` for each run of ``docs``; column number ``at`` holds the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        vocabulary = pa.array([w.decode("utf-8", "replace") for w in index.vocabulary], pa.large_string())
        for batch in batches:
            for part in _slices(batch, at):
                yield row(part, index.search(*_numbers(part.column(at), vocabulary)), index)

    return docs.mapInArrow(run, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", share: float = MAX_EDIT_SHARE) -> DataFrame:
    """``doc_id, item_id, distance, first_word, n_words``: the items found in each row of ``docs``.

    One row per text, item and separate place. Null or empty texts hold nothing; null
    or empty items are found nowhere; repeated rows of either side each give their rows;
    a null id stays null. An item of under five words allows no edit. Of several blocks all but the
    last are searched, and their finds written, when this is called."""
    spark, out = docs.sparkSession, None
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def row(batch: pa.RecordBatch, found: list, index: ItemIndex) -> pa.RecordBatch:
        ids = batch.column(0).take(pa.array([x[0] for x in found], pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array([index.ids[x[1]] for x in found], pa.int64()),
                                           *[pa.array([x[c] for x in found], pa.int64()) for c in (2, 3, 4)]],
                                          ["doc_id", "item_id", "distance", "first_word", "n_words"])

    for index, last in _blocks(benchmark, item_col, item_text_col, share):
        sent = spark.sparkContext.broadcast(index)
        part = _searched(cols, sent, 1, FOUND, row)
        if not last:
            part = written(part, "leaks-block")
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], FOUND)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", share: float = MAX_EDIT_SHARE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item (null and empty texts stay).

    A leak depends on the text alone: blocks before the last write 128-bit hashes of the texts with an
    item, and rows of such texts are left out by an anti join."""
    at, schema, text = docs.columns.index(text_col), docs.schema, F.col(f"`{text_col}`")
    one, two = free_names(docs, "text_hash", "text_hash2")
    keys = docs.select(F.xxhash64(text).alias(one), F.xxhash64(F.lit(1), text).alias(two), text.alias("text"))
    gone = None

    def hashes(batch: pa.RecordBatch, found: list, index: ItemIndex) -> pa.RecordBatch:
        return batch.take(pa.array(sorted({x[0] for x in found}), pa.int64())).select([one, two])

    def clean(batch: pa.RecordBatch, found: list, index: ItemIndex) -> pa.RecordBatch:
        keep = np.ones(batch.num_rows, bool)
        keep[[x[0] for x in found]] = False
        return batch.filter(pa.array(keep))

    for index, last in _blocks(benchmark, item_col, item_text_col, share):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        if last:
            docs = _searched(docs, sent, at, schema, clean)
        else:
            part = written(_searched(keys, sent, 2, f"`{one}` long, `{two}` long", hashes).distinct(), "leaks-texts")
            sent.destroy()
            gone = part if gone is None else gone.unionByName(part)
    if gone is not None:
        hashed = docs.withColumns({one: F.xxhash64(text), two: F.xxhash64(F.lit(1), text)})
        docs = hashed.join(gone, [one, two], "left_anti").select(*[F.col(f"`{c}`") for c in schema.names])
    return docs


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
