"""Byte-pair merges over many words at once, and tree concatenation of long ones.

``Merges`` takes its symbols and ranks from a tokenizer file read by the
tokenizers library and applies the merges of all given words together: every
step merges each word's lowest-ranked pair, as arrays. Long unsplit text is
cut into leaves of ``LEAF`` symbols that are encoded together, then joined as
a tree: around each join a window of tokens is encoded again, and grows until
its outermost tokens are those that both sides had. All joins of a level are
one array step. A sequence of tokens is the encoding of its text exactly when
every pair of neighbours is, so agreement at both ends settles the rest.
"""
from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

LEAF = 48         # symbols per leaf of long text
AT_ONCE = 1 << 17  # symbols that are merged together, a bound on the memory of a step
WINDOW = 4        # tokens on either side of a join at first


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them) of each range in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Merges:
    """Vocabulary and merges of a byte-level tokenizer file."""

    def __init__(self, tokenizer: Tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + self.suffix] for s in symbols], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.uint64)
        # open addressing: slots at least eight times the merges, so probes are short
        self.bits = max(10, int(np.ceil(np.log2(8 * max(1, len(keys))))))
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.ranks = np.full(1 << self.bits, np.iinfo(np.int32).max, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] == np.iinfo(np.uint64).max
            take, where = np.unique(slot[left[free]], return_index=True)
            rows = left[free][where]
            self.keys[take], self.ranks[take] = keys[rows], rows
            left = np.setdiff1d(left, rows)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, the largest int32 if there is none."""
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.ranks[slot], np.iinfo(np.int32).max).astype(np.int32)
        again = np.flatnonzero((held != keys) & (held != np.iinfo(np.uint64).max))
        while len(again):
            slot[again] = (slot[again] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[again]]
            hit = held == keys[again]
            out[again[hit]] = self.ranks[slot[again[hit]]]
            again = again[~hit & (held != np.iinfo(np.uint64).max)]
        return out

    def symbols(self, body: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Start symbols of words given as bytes in a row and their sizes."""
        out = self.first[body]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        out[ends] = self.last[body[ends]]
        return out

    def merge(self, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of short words (symbols in a row, sizes) and the number of tokens of each."""
        if len(sym) > AT_ONCE and len(sizes) > 1:
            ends = np.cumsum(sizes)
            cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(AT_ONCE, len(sym), AT_ONCE)), len(sizes)])
            starts = ends - sizes
            parts = [self._merge(sym[starts[a]:ends[b - 1]], sizes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        return self._merge(sym, sizes)

    def _merge(self, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        none = np.iinfo(np.int32).max
        counts = sizes.copy()
        done_word, done_tok = [], []
        word = np.flatnonzero(sizes > 0)
        sizes = sizes[word]
        while len(word):
            starts = np.cumsum(sizes) - sizes
            r = np.full(len(sym), none, np.int32)
            r[:-1] = self.rank(sym[:-1], sym[1:])
            r[starts + sizes - 1] = none
            least = np.minimum.reduceat(r, starts)
            open_ = least < none
            if not open_.all():
                # words without a pair to merge leave
                out = np.repeat(~open_, sizes)
                done_word.append(np.repeat(word[~open_], sizes[~open_]))
                done_tok.append(sym[out])
                sym, r, word, sizes, least = sym[~out], r[~out], word[open_], sizes[open_], least[open_]
                if not len(word):
                    break
            hit = r == np.repeat(least, sizes)
            at = np.flatnonzero(hit)
            # of equal pairs that overlap (aaa), every second one from the left
            if len(at) > 1 and (np.diff(at) == 1).any():
                run = np.cumsum(np.r_[True, np.diff(at) != 1])
                begin = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
                at = at[(np.arange(len(at)) - begin[run - 1]) % 2 == 0]
            sym = sym.copy()
            sym[at] = self.made[r[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            owner = np.repeat(np.arange(len(word)), sizes)
            sizes = sizes - np.bincount(owner[at], minlength=len(word))
            sym = sym[keep]
        if not done_word:
            return np.zeros(0, np.int32), counts
        owner, tok = np.concatenate(done_word), np.concatenate(done_tok)
        order = np.argsort(owner, kind="stable")
        return tok[order], np.bincount(owner, minlength=len(counts))

    def encode(self, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and token counts of words of any length."""
        long = np.flatnonzero(sizes > 2 * LEAF)
        if not len(long):
            return self.merge(sym, sizes)
        starts = np.cumsum(sizes) - sizes
        short = np.flatnonzero(sizes <= 2 * LEAF)
        tok, counts = self.merge(sym[ranges(starts[short], sizes[short])], sizes[short])
        pieces: list[np.ndarray] = [None] * len(sizes)     # type: ignore[list-item]
        for k, p in zip(short, np.split(tok, np.cumsum(counts)[:-1])):
            pieces[k] = p
        for k in long:
            pieces[k] = self.tree(sym[starts[k]:starts[k] + sizes[k]])
        return np.concatenate(pieces), np.array([len(p) for p in pieces])

    def encode_strings(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and token counts of an Arrow array of strings, each one word (pre-token)."""
        texts = pa.concat_arrays([texts.cast(pa.large_binary())])
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        sizes = np.diff(offsets)
        if not len(sizes) or not sizes.sum():
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        body = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        return self.encode(self.symbols(body, sizes), sizes)

    def tree(self, sym: np.ndarray) -> np.ndarray:
        """Tokens of one long word, by encoding leaves together and joining them pairwise."""
        cuts = np.arange(0, len(sym), LEAF)
        sizes = np.diff(np.r_[cuts, len(sym)])
        tok, counts = self.merge(sym, sizes)
        width = self._width(tok)
        parts = [(p, w) for p, w in zip(np.split(tok, np.cumsum(counts)[:-1]), np.split(width, np.cumsum(counts)[:-1]))]
        spans = list(zip(cuts, np.r_[cuts[1:], len(sym)]))
        while len(parts) > 1:
            pairs = [(parts[i], parts[i + 1], spans[i][0], spans[i][1], spans[i + 1][1]) for i in range(0, len(parts) - 1, 2)]
            rest = parts[-1:] if len(parts) % 2 else []
            last = spans[-1:] if len(parts) % 2 else []
            parts = self._join(sym, pairs) + rest
            spans = [(a, c) for _, _, a, _, c in pairs] + last
        return parts[0][0]

    def _width(self, tok: np.ndarray) -> np.ndarray:
        return self.widths()[tok]

    def widths(self) -> np.ndarray:
        """Number of start symbols that each token covers."""
        if not hasattr(self, "_widths"):
            size = int(max(self.first.max(), self.last.max(), self.made.max(initial=0))) + 1
            out = np.ones(size, np.int64)
            held = self.keys != np.iinfo(np.uint64).max
            order = np.argsort(self.ranks[held])
            keys = self.keys[held][order]
            for key, made in zip(keys.tolist(), self.made.tolist()):
                out[made] = out[key >> 32] + out[key & 0xFFFFFFFF]
            self._widths = out
        return self._widths

    def _join(self, sym: np.ndarray, pairs: list) -> list[tuple[np.ndarray, np.ndarray]]:
        out: list = [None] * len(pairs)
        todo, reach = list(range(len(pairs))), WINDOW
        while todo:
            cut, texts = [], []
            for k in todo:
                (_, wa), (_, wb), a, mid, c = pairs[k]
                i, j = max(0, len(wa) - reach), min(len(wb), reach)
                begin, end = mid - int(wa[i:].sum()), mid + int(wb[:j].sum())
                cut.append((i, j))
                texts.append(sym[begin:end])
            tok, counts = self.merge(np.concatenate(texts), np.array([len(t) for t in texts]))
            again = []
            for k, (i, j), w in zip(todo, cut, np.split(tok, np.cumsum(counts)[:-1])):
                (ta, wa), (tb, wb), *_ = pairs[k]
                if (i == 0 or w[0] == ta[i]) and (j == len(tb) or w[-1] == tb[j - 1]) and len(w) >= (i > 0) + (j < len(tb)):
                    out[k] = (np.r_[ta[:i], w, tb[j:]], np.r_[wa[:i], self._width(w), wb[j:]])
                else:
                    again.append(k)
            todo, reach = again, 2 * reach
        return out
