"""Ranked lexical search by hashed max-sketches.

``index`` cuts every text into terms once and writes a forward table (per document
its distinct terms as 64-bit hashes, and how often each occurs). ``search`` reads it
in blocks of documents: each document's impacts fold into ``BUCKETS`` coordinatewise
maxima (its sketch), one product of sketches and weights gives an upper bound for
every document and item of the block, and documents are scored exactly in falling
order of the bound until the bound is below the item's k-th best score so far.
A task gives its k best documents an item; one window joins the tasks' lists.

Scale: no join on terms, so a common word is no hot key; texts never leave the scan
that cuts them. Items are the stated query set; they are taken in blocks of bounded
size, and one block's terms and weights are all that travels. A document and an item meet
only as one number of a block's product. What a task holds is a block of
``DOCS`` documents and k rows an item.

Scores are 64-bit integers: with ``w`` a term's weight, ``tf`` its occurrences and ``m`` the
document's length factor, the sum of ``w * (1000000000 * tf div (1000 * tf + 20 * m))``. Bounds are
whole numbers below 2^53 in doubles, so they are exact as well.

Null text: no term, never found. Null doc_id: found like any other, before all numbers among equal scores.
Repeated rows: each is a document. Rows of one item_id (null is one too) are one item with the
terms of all its texts. Items or documents without terms give no rows.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, written

BUCKETS = 4096           # coordinates of a sketch (a power of two)
DOCS = 256               # documents of a block
BLOCK_ITEMS = 1024       # items of a block of queries
BLOCK_TERMS = 200_000    # their terms, all together (one item may have more)
KNOWN = 500_000          # terms whose hash a task remembers

# Bytes that are no part of a term (ASCII without digits and letters).
BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"      # the same as a pattern


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, n, terms, tfs`` of rows ``key, text`` (text as UTF-8 bytes)."""
    from collections import Counter

    import xxhash

    def fits(s: str) -> int:        # unsigned to signed
        h = xxhash.xxh3_64_intdigest(s)
        return h - (1 << 64) if h >> 63 else h

    table = bytes.maketrans(BREAKS, b" " * len(BREAKS))
    known: dict[bytes, int] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            part = batch.slice(at, DOCS)
            n, terms, tfs, ends = [], [], [], [0]
            for text in part.column(1):
                found = text.as_buffer().to_pybytes().lower().translate(table).split() if text.is_valid else []
                n.append(len(found))
                for term, tf in Counter(found).items():
                    h = known.get(term)
                    if h is None:
                        if len(known) >= KNOWN:
                            known.clear()
                        h = known[term] = fits(term)
                    terms.append(h)
                    tfs.append(tf)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int64())),
                                              pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], ["key", "n", "terms", "tfs"])


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, n, terms, tfs`` of every row, written: n counts terms with repeats."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("binary").alias("text"))
    return written(rows.mapInArrow(_cut, "key long, n long, terms array<long>, tfs array<int>"), "search-index")


def _lists(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, ...]:
    """Keys, whether they are there, n, offsets, terms and tfs of a block of documents."""
    part = batch.slice(at, DOCS)
    keys, terms, tfs = part.column(0), part.column(2), part.column(3)
    ends = np.asarray(terms.offsets)
    return (keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_valid().to_numpy(zero_copy_only=False),
            part.column(1).to_numpy(zero_copy_only=False), ends - ends[0],
            terms.flatten().to_numpy(zero_copy_only=False), tfs.flatten().to_numpy(zero_copy_only=False))


def _places(vocabulary: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``terms`` stand in the sorted ``vocabulary``, and where."""
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    return at, vocabulary[at] == terms


def _frequencies(indexed: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """How many documents hold each term of a block's vocabulary: one row a task and term, summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                place, there = _places(vocabulary, _lists(batch, at)[4])
                counts += np.bincount(place[there], minlength=len(vocabulary))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["term", "df"])

    rows = indexed.select("key", "n", "terms", "tfs").mapInArrow(run, "term long, df long")
    return {r["term"]: r["df"] for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


class Best:
    """The k best (score, key) of each item so far: higher score, then null key, then smaller key."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)] * items
        self.least = np.ones(items, np.int64)      # what a document must reach

    def add(self, item: int, scores: np.ndarray, keys: np.ndarray, there: np.ndarray) -> None:
        ok = scores >= self.least[item]
        s, i, t = (np.concatenate([a, b[ok]]) for a, b in zip(self.rows[item], (scores, keys, there)))
        order = np.lexsort((i, t, -s))[:self.k]
        self.rows[item] = (s[order], i[order], t[order])
        if len(order) == self.k:
            self.least[item] = s[order[-1]]


def _score(weights: np.ndarray, docs: np.ndarray, ends: np.ndarray, places: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """Exact scores of some documents of a block for one item (``weights`` by term of the vocabulary)."""
    sizes = ends[docs + 1] - ends[docs]
    which = np.repeat(np.arange(len(docs)), sizes)
    at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(ends[docs], sizes)
    out = np.zeros(len(docs), np.int64)
    np.add.at(out, which, weights[places[at]] * impacts[at])
    return out


def _block(indexed: DataFrame, items: list[np.ndarray], n_docs: int, n_terms: int, k: int, first: int) -> DataFrame:
    """``item, score, key``: each task's k best documents for each item of a block."""
    vocabulary = np.unique(np.concatenate(items))
    df = _frequencies(indexed, vocabulary)
    weight = np.zeros(len(vocabulary), np.int64)
    for place, held in df.items():
        weight[place] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))
    places = [np.searchsorted(vocabulary, terms) for terms in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(places), k)
        lookup = np.zeros((BUCKETS, len(places)))
        for item, p in enumerate(places):
            np.add.at(lookup[:, item], vocabulary[p] & (BUCKETS - 1), weight[p])
        scratch = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                keys, there, n, ends, terms, tfs = _lists(batch, at)
                if not len(terms):
                    continue
                doc = np.repeat(np.arange(len(keys)), np.diff(ends))
                m = 50 + (50 * n * n_docs) // n_terms
                tfs = tfs.astype(np.int64)
                impacts = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[doc])
                sketch = np.zeros((len(keys), BUCKETS))
                np.maximum.at(sketch, (doc, terms & (BUCKETS - 1)), impacts)
                bounds = sketch @ lookup
                place, held = _places(vocabulary, terms)
                ends = np.r_[0, np.cumsum(held)][ends]      # from here on only terms that an item asks for
                place, impacts = place[held], impacts[held]
                for item in np.flatnonzero((bounds >= best.least).any(0)):
                    some = np.flatnonzero(bounds[:, item] >= best.least[item])
                    some = some[np.argsort(-bounds[some, item], kind="stable")]
                    scratch[places[item]] = weight[places[item]]
                    step = 0
                    while step < len(some) and bounds[some[step], item] >= best.least[item]:
                        d = some[step:step + k]
                        best.add(item, _score(scratch, d, ends, place, impacts), keys[d], there[d])
                        step += k
                    scratch[places[item]] = 0
        for item, (s, i, t) in enumerate(best.rows):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), first + item)), pa.array(s), pa.array(i, mask=~t)], ["item", "score", "key"])

    return indexed.select("key", "n", "terms", "tfs").mapInArrow(run, "item long, score long, key long")


def _blocks(terms: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The items in order, block by block: their ids, and their distinct terms. The rows come to
    the driver a partition at a time; it holds one block."""
    ids: list = []
    items: list[list[int]] = []
    size = 0
    for r in terms.toLocalIterator():
        if not ids or ids[-1] != r["item"]:
            if len(ids) >= BLOCK_ITEMS or size >= BLOCK_TERMS:
                yield ids, [np.array(x, np.int64) for x in items]
                ids, items, size = [], [], 0
            ids.append(r["item"])
            items.append([])
        items[-1].append(r["term"])
        size += 1
    if ids:
        yield ids, [np.array(x, np.int64) for x in items]


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0
    (names of the result as given in ``item_col`` and ``id_col``)."""
    spark = docs.sparkSession
    indexed = index(docs, id_col, text_col)
    n_docs, n_terms = indexed.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    asked = items.select(F.col(item_col).alias("key"), F.col(item_text_col).cast("binary").alias("text"))
    kind = asked.schema["key"].dataType
    asked = asked.mapInArrow(_cut, f"key {kind.simpleString()}, n long, terms array<long>, tfs array<int>")
    terms = asked.select(F.col("key").alias("item"), F.explode("terms").alias("term")).distinct().orderBy("item", "term")
    found, names = [], []
    for ids, block in (_blocks(written(terms, "search-items")) if n_docs else ()):
        found.append(written(_block(indexed, block, n_docs, n_terms, k, len(names)), "search-found"))
        names += ids
    schema = f"{item_col} {kind.simpleString()}, item long"
    named = spark.createDataFrame([(x, i) for i, x in enumerate(names)], schema)
    if not found:
        return named.select(item_col, F.lit(0).alias("rank"), F.col("item").alias(id_col), F.col("item").alias("score")).limit(0)
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_first())
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(named, "item").select(item_col, "rank", F.col("key").alias(id_col), "score"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{TERM}') AS ts FROM documents),
lengths AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM docs WHERE len(ts) > 0),
corpus AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nl FROM lengths),
post AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM docs) GROUP BY r, term),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{TERM}')) AS term FROM benchmark)),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, corpus GROUP BY term),
scores AS (
  SELECT item_id, p.r, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nl))))::BIGINT AS score
  FROM asked JOIN post p USING (term) JOIN weights USING (term) JOIN lengths l ON l.r = p.r, corpus GROUP BY item_id, p.r)
SELECT item_id, "rank"::INTEGER AS "rank", doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS FIRST) AS "rank" FROM scores WHERE score > 0)
WHERE "rank" <= 50"""
