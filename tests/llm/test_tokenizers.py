import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from ridelake.llm import bpe, bpe_codec, token_counts, tokens

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ODD = ["", None, " ", "  ", "a  b", " a", "a ", "a   b", "\n \n b", "<|endoftext|> hi <|startoftext|>", "é è ÀÉ", "İstanbul ΑΣ ΣΑΣ", "don't 've  's I'LL",
       "12 ab12 \t z", "日本 語　漢", "a" * 700, "-" * 300 + " " + "=" * 500, "\x1c a\x1fb \x85c ​ ᠎ x", "😀 😀😀", " " * 50 + "x",
       "\r\n\r\n a\n b", " \n", "ǅ ŉ ſ K ﬁ", "가 한", "Ǆ ª º ① ² Ⅷ", "▁x ▁", "<s> <unk> <0x41>", "xy" * 3000]


def texts():
    rng = random.Random(3)
    alphabet = list("aB'sS \n\t.,1éÉΣİ<|x \x0b\x85　é漢😀▁the ")
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    return docs[:150] + ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]


@pytest.mark.parametrize("encoder,name", [(tokens.ByteEncoder, FILES[0]), (bpe_codec.WordEncoder, FILES[1])])
def test_encoders_equal_the_library(encoder, name):
    ts, mine, lib = texts(), encoder(P.path(name)), Tokenizer.from_file(P.path(name))
    ids, counts = mine.encode(pa.array(ts))
    want = [e.ids for e in lib.encode_batch([t or "" for t in ts], add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    if encoder is bpe_codec.WordEncoder:
        assert mine.decode(ids, counts).to_pylist() == [lib.decode(w, skip_special_tokens=False) for w in want]


@pytest.mark.parametrize("name", FILES)
def test_tree_concatenation_equals_one_pass(name):
    lib = Tokenizer.from_file(P.path(name))
    mine, model, symbols, rng = bpe.Merges(lib), lib.model, bpe.byte_symbols(), random.Random(1)
    words = []
    for _ in range(700):
        alphabet = rng.choice([b"a", b"ab", b"theandio", b"0123456789abcdef", bytes(range(256)), b"antherion", b"=-_"])
        words.append(bytes(rng.choice(alphabet) for _ in range(rng.choice([1, 2, 5, 9, 20, 60, 130, 400, 1500] if rng.random() < .3 else [1, 4, 9]))))
    body, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    ids, counts = mine.encode(mine.symbols(body, sizes), sizes)
    for w, got in zip(words, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == [t.id for t in model.tokenize("".join(symbols[b] for b in w))], w


def test_very_long_unsplit_text():
    lib = Tokenizer.from_file(P.path(FILES[1]))
    mine, rng = bpe.Merges(lib), random.Random(2)
    word = "".join(rng.choice(["the", "an", "ing", "q", "er", "x", "tion"]) for _ in range(100_000)).encode()
    sizes = np.array([len(word)])
    ids, counts = mine.encode(mine.symbols(np.frombuffer(word, np.uint8), sizes), sizes)
    names = {i: t for t, i in lib.get_vocab().items()}
    assert "".join(names[i] for i in ids).removesuffix("</w>") == word.decode() and counts[0] == len(ids)
    # every pair of neighbours is the encoding of its text
    pairs = {(int(a), int(b)) for a, b in zip(ids[:-2], ids[1:-1])}
    plain = models.BPE({t: i for t, i in lib.get_vocab(with_added_tokens=False).items()}, [])
    assert plain is not None
    ranks = mine.rank(np.array([a for a, _ in pairs], np.int32), np.array([b for _, b in pairs], np.int32))
    assert (ranks == np.iinfo(np.int32).max).mean() > 0.5


def test_codec_query_columns_on_odd_rows(spark, odd_docs):
    path = P.path(FILES[1])
    lib = Tokenizer.from_file(path)
    df = odd_docs.withColumns({"ids": F.lit(1), "n_tokens": F.lit("n")})
    want = []
    for r in df.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in bpe_codec.digests(df, path).collect()) == sorted(want)
    encoded = bpe_codec.encode(df, path)
    assert sorted((str(r["doc_id"]), len(r["ids"])) for r in encoded.collect()) == sorted(w[:2] for w in want)
    decoded = sorted((str(r["doc_id"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in bpe_codec.decode(encoded, path).collect())
    assert decoded == sorted((w[0], w[3]) for w in want)


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_file(spark, odd_docs, tmp_path, encoding):
    path = P.path(FILES[0])
    lib, where = Tokenizer.from_file(path), f"{tmp_path}/t"
    df = odd_docs.withColumns({"shard": F.lit(1), "at": F.lit("n"), "ids": F.lit(2)})
    tokens.write_tokens(df, where, path, encoding=encoding, row_group_bytes=1 << 16, page_bytes=1 << 12)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    at, want = 0, []
    for i, t in rows:
        ids = [*lib.encode(t, add_special_tokens=False).ids, 0]
        want.append((str(i), at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    got = tokens.read_tokens(spark, where).mapInArrow(tokens._crc, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    import glob
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(f"{where}/*.parquet")]
    column = [m.row_group(0).column(k) for m in meta if m.num_rows for k in range(m.num_columns) if m.row_group(0).column(k).path_in_schema.startswith("ids")]
    assert all(("DELTA_BINARY_PACKED" in c.encodings) == (encoding == "delta") for c in column) and column
    assert all(c.has_offset_index for c in column)


def test_rows_of_one_id_are_divided(spark, tmp_path):
    docs = spark.createDataFrame([(None if i % 2 else 7, f"text {i} " * 5) for i in range(4000)] + [(9, "last")], "doc_id long, text string")
    name = "spark.sql.adaptive.coalescePartitions.enabled"      # such small partitions would be joined
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        tokens.write_tokens(docs, f"{tmp_path}/t", P.path(FILES[0]))
    finally:
        spark.conf.set(name, old)
    rows = spark.read.parquet(f"{tmp_path}/t").groupBy("shard").count().collect()
    assert len(rows) >= 4 and max(r["count"] for r in rows) <= 1200
    got = sorted(tokens.read_tokens(spark, f"{tmp_path}/t").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 2000 + [7] * 2000 + [9]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))


def test_metadata_is_read_without_the_ids(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokens.write_tokens(docs, f"{tmp_path}/t", P.path(FILES[0]))
    plan = tokens.shard_starts(spark, f"{tmp_path}/t")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("with_bytes", [True, False])
def test_viterbi_counts_equal_the_library(with_bytes):
    entries, unknown = token_counts.vocabulary(P.path("piece_bpe_32k.model"))
    if not with_bytes:
        entries = [(t, s) for t, s in entries if not t.startswith("<0x")][:4000]
    lib = Tokenizer(models.Unigram(entries, unk_id=unknown, byte_fallback=with_bytes))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    ts = texts()
    _, got = token_counts.Counter(entries, unknown).counts(pa.array(ts))
    assert got.tolist() == [len(e.ids) for e in lib.encode_batch([t or "" for t in ts], add_special_tokens=False)]


def test_viterbi_ties():
    entries = [("<unk>", -9.0), ("▁a", -1.0), ("b", -1.0), ("▁ab", -2.0), ("c", -1.0), ("bc", -2.0), ("▁", -5.0), ("a", -1.0)]
    lib = Tokenizer(models.Unigram(entries, unk_id=0))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    ts = ["ab", "abc", "abcabc bcb", "xay", "xxaxx", "a x", "cab"]
    _, got = token_counts.Counter(entries, 0).counts(pa.array(ts))
    assert got.tolist() == [len(e.ids) for e in lib.encode_batch(ts, add_special_tokens=False)]


def test_token_counts_on_odd_rows(spark, odd_docs):
    df = odd_docs.withColumns({"n_words": F.lit(1), "n_tokens": F.lit("n")})
    got = token_counts.token_counts(df, P.path("piece_bpe_32k.model")).collect()
    assert len(got) == df.count()
    assert {(r["n_words"], r["n_tokens"]) for r in got if r["doc_id"] in (2, 3)} == {(0, 0)}
