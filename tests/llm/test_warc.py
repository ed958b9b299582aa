import glob
import os

import pytest
from pyspark.sql import functions as F

from ridelake.llm import warc as W


def brute(pages):
    """Per payload: the first row with the smallest id is the response (null last)."""
    first = {}
    for p, _, h in pages:
        d = W.base32_sha1((h or "").encode())
        first[d] = min((x for x in (first.get(d), p) if x is not None), default=None)
    used, out = set(), []
    for p, _, h in sorted(pages, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (h or "").encode()
        d = W.base32_sha1(body)
        new = p == first[d] and d not in used
        used |= {d} if new else set()
        out.append((str(p), len(body), d, "response" if new else "revisit", None if new else str(first[d])))
    return sorted(out, key=str)


def got(spark, path):
    return sorted([(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
                    None if r["record_type"] == "response" else str(r["refers_to"])) for r in W.read_warc(spark, path).collect()], key=str)


PAGES = [(5, "http://a.org/x", "<p>same</p>"), (3, "http://a.org/y\r\nX: 1", "<p>same</p>"), (3, "http://a.org/z", "<p>same</p>"), (9, None, None),
         (1, "u", ""), (2, "u", "é" * 5000), (None, "u", "<p>same</p>"), (None, "u", "own"), (None, "u", "own"), (7, "u", "a\r\n\r\nb WARC/1.1\r\n"),
         (-(1 << 63), "u", "low"), ((1 << 63) - 1, "u", "high")] + [(100 + i, f"http://b.org/{i}", f"page {i % 40} " * (i % 9 + 1)) for i in range(300)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_round_trip(spark, pages, tmp_path):
    df = pages.withColumns({"id": F.lit(1), "kind": F.lit("k"), "shard": F.lit(9), "digest": F.lit("d"), "payload": F.lit("p"), "first": F.lit(3)})
    W.write_warc(df, f"{tmp_path}/w", 5, roll_bytes=4000)
    assert got(spark, f"{tmp_path}/w") == brute(PAGES)
    names = [os.path.basename(f) for f in glob.glob(f"{tmp_path}/w/*.gz")]
    assert len(names) > 5 and not [f for f in os.listdir(f"{tmp_path}/w") if f.endswith(".tmp")]
    rows = W.read_warc(spark, f"{tmp_path}/w").where("record_type = 'response' and page_id is not null").collect()
    text = {p: h or "" for p, _, h in reversed(PAGES)}
    assert all(bytes(r["payload"]).decode() in [h or "" for p, _, h in PAGES if p == r["page_id"]] for r in rows) and text


def test_same_bytes_every_time_and_rolled_by_size(spark, pages, tmp_path):
    W.write_warc(pages, f"{tmp_path}/a", 4, roll_bytes=6000)
    W.write_warc(pages.repartition(7), f"{tmp_path}/b", 4, roll_bytes=6000)
    a, b = ({os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{tmp_path}/{x}/*.gz")} for x in "ab")
    assert a == b
    records = spark.read.parquet(f"{tmp_path}/a/_manifest").collect()
    assert all(r["bytes"] == len(a[r["name"]]) and (r["bytes"] <= 6000 or r["records"] == 2) for r in records)


def test_files_outside_the_manifest_do_not_count_and_damage_is_found(spark, pages, tmp_path):
    W.write_warc(pages, f"{tmp_path}/w", 2)
    name = sorted(glob.glob(f"{tmp_path}/w/*.gz"))[0]
    data = open(name, "rb").read()
    open(f"{tmp_path}/w/part-999999-00000.warc.gz", "wb").write(data)
    assert len(got(spark, f"{tmp_path}/w")) == len(PAGES)
    open(name, "wb").write(data[:len(data) // 2])
    with pytest.raises(Exception):
        W.read_warc(spark, f"{tmp_path}/w").collect()


def test_shards_are_even_ranges(spark):
    rows = [(i * i, 10) for i in range(2000)] + [(10 ** 15, 7000)]
    df = spark.createDataFrame(rows, "id long, size long")
    out = W.with_shard(df, df, "id", 8).orderBy("id").collect()
    shards = [r["shard"] for r in out]
    assert shards == sorted(shards) and set(shards) <= set(range(8))
    weight = {s: sum(r["size"] for r in out if r["shard"] == s) for s in set(shards)}
    # an id is never divided: only the shard of the large one is over
    assert sorted(weight.values())[-2] <= 1.1 * 27000 / 8 and max(weight.values()) == 7000


def test_records_are_standard(pages):
    import zlib
    data = W.page_record(4, "http://x.org/", b"<p>", False, None, 0)
    head = zlib.decompress(data, 31).split(b"\r\n\r\n")[0].decode()
    for name in ("WARC-Type: response", "WARC-Record-ID: <urn:uuid:", "WARC-Date: ", "WARC-Target-URI: http://x.org/", "WARC-Payload-Digest: sha1:", "WARC-Block-Digest: sha1:", "Content-Length: "):
        assert name in head
    assert data[4:8] == b"\0\0\0\0"      # no time stamp


@pytest.mark.parametrize("n", [1, 2, 14, 51])
def test_every_shard_has_a_task_of_its_own(spark, n):
    df = spark.range(n * 10).withColumn("shard", (F.col("id") % n).cast("int"))
    parts = W.one_task_each(df, n).select("shard", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(parts) == len({r["p"] for r in parts}) == n


def test_rows_without_id_and_of_one_id_are_divided(spark, tmp_path):
    rows = [(None, "u", f"none {i} " * 20) for i in range(400)] + [(5, "u", f"five {i} " * 20) for i in range(400)] + [(i, "u", "x") for i in range(10, 60)]
    W.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w", 8)
    assert got(spark, f"{tmp_path}/w") == brute(rows)
    files = {r["shard"]: r["records"] for r in spark.read.parquet(f"{tmp_path}/w/_manifest").collect()}
    assert len(files) == 8 and max(files.values()) <= 200
    # shards stay ranges of (page_id, digest), null first
    order = spark.createDataFrame([(p, W.base32_sha1(h.encode()), h) for p, _, h in rows], "id long, d string, h string").withColumn("digest", F.sha1("h"))
    sizes = order.select("id", F.lit(100).cast("long").alias("size"))
    tie = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") / float(1 << 32)
    shards = [r["shard"] for r in W.with_shard(order, sizes, "id", 8, tie).orderBy("id", "digest").collect()]
    assert shards == sorted(shards) and set(shards) == set(range(8))


def test_all_rows_without_id(spark, tmp_path):
    rows = [(None, "u", f"none {i}") for i in range(100)]
    W.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w", 4)
    assert got(spark, f"{tmp_path}/w") == brute(rows)
    assert spark.read.parquet(f"{tmp_path}/w/_manifest").select("shard").distinct().count() == 4


def test_s3a_is_read_as_s3(monkeypatch):
    asked = []
    monkeypatch.setattr(W.pafs, "FileSystem", type("Fake", (), {"from_uri": staticmethod(lambda p: asked.append(p) or (None, p))}))
    W._local("s3a://lake/warc")
    W._local("hdfs://n/warc")
    assert asked == ["s3://lake/warc", "hdfs://n/warc"]
