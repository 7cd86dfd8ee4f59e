"""WARC data source and page archives: round trips, revisits, pushdown, commits."""
import base64
import gzip
import hashlib
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc as W
from tidemark.session import scratch_path

LONG = "<p>" + "lorem ipsum " * 100 + "</p>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (7, "http://a/7", LONG), (3, None, "short"), (4, "http://a/4", "short"),
         (5, "http://a/5", None), (6, "http://a b\r\nX: y/ü", "café 日本\r\n\r\nWARC/1.1\r\n\r\n"),
         (None, "http://a/n", LONG), (8, "http://a/8", "x" * 999), (9, "http://a/9", "x" * 999), (10, "http://a/10", "y" * 1000),
         (11, "http://a/11", "y" * 1000), (11, "http://a/11", "y" * 1000), (None, "u", "z" * 1500), (None, "u", "z" * 1500),
         (12, "http://a/12", "very long " * 300_000), (13, "", "é" * 500), (14, "e", "é" * 500)]


def brute(data, min_bytes=1000):
    out, groups = [], {}
    for page_id, _, html in data:
        groups.setdefault((html or "").encode(), []).append(page_id)
    for body, ids in groups.items():
        digest = hashlib.sha1(body).hexdigest()
        top = max((i for i in ids if i is not None), default=None)
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        out += [(i, len(body), digest, "revisit" if k and len(body) >= min_bytes else "response",
                 top if k and len(body) >= min_bytes else None) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES],
                                 "page_id long, url string, html string, payload string, n int").repartition(3)


@pytest.fixture()
def folder(spark):
    return scratch_path(spark, "test", f"warc-{uuid.uuid4().hex}")


def test_op12_edge_rows(pages):
    assert rows_of(W.round_trip(pages)) == brute(PAGES)
    assert W.round_trip(pages.where("1 = 0")).count() == 0


def test_op12_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    data = [(r.page_id, r.url, r.html) for r in df.collect()]
    copies = df.union(df.withColumn("page_id", F.col("page_id") + 1000).where("page_id % 3 = 0"))
    data += [(i + 1000, u, h) for i, u, h in data if (i + 1000) % 3 == 0]
    assert rows_of(W.round_trip(copies)) == brute(data)


@pytest.mark.parametrize("most_groups", [1, 2])
def test_op12_many_groups_go_by_a_join(pages, most_groups):
    rec = W.page_records(pages, most_groups=most_groups)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(rec.select(*columns)) == brute(PAGES)
    assert {(r.record_type, r.payload is None) for r in rec.collect()} == {("response", False), ("revisit", True)}


@pytest.mark.parametrize("zipped", ["true", "false"])
def test_archive_holds_whole_records(spark, pages, folder, zipped):
    W.write_pages(pages, folder, gzip=zipped, fileBytes=4096, date="2026-01-02T03:04:05Z")
    got = W.read_archive(spark, folder, partitionBytes=10_000)
    assert got.rdd.getNumPartitions() > 1
    back = got.collect()
    assert sum(r.record_type == "warcinfo" for r in back) == len({r.file for r in back})
    texts = {(r.page_id, r.payload.decode()) for r in back if r.record_type == "response"}
    assert texts <= {(i, h or "") for i, _, h in PAGES}
    assert {t for _, t in texts} == {h or "" for _, _, h in PAGES}
    ids = {r.record_id: r for r in back}
    assert len(ids) == len(back)
    for r in back:
        if r.record_type == "revisit":
            first = ids[r.refers_to_id]
            assert (first.record_type, first.payload_digest, first.page_id) == ("response", r.payload_digest, r.refers_to)
        elif r.record_type == "response":
            assert r.payload_bytes == len(r.payload) and hashlib.sha1(r.payload).hexdigest() == r.payload_digest
        assert r.date == "2026-01-02T03:04:05Z"
    assert {r.target_uri for r in back if r.page_id in (3, 6)} == {"urn:page", "http://a%20b%0D%0AX:%20y/ü"}


def test_files_are_plain_gzip_members(spark, pages, folder):
    """Any WARC tool reads the files: whole-file inflation gives the records one after another."""
    W.write_pages(pages.where("page_id = 4"), folder)
    system, path = W.file_system(folder)
    from pyarrow import fs
    name = next(i.path for i in system.get_file_info(fs.FileSelector(path)) if i.path.endswith(".gz"))
    with system.open_input_stream(name, compression=None) as s:
        text = gzip.decompress(s.read())
    record = text[text.index(b"WARC/1.1", 5):]
    digest = base64.b32encode(hashlib.sha1(b"short").digest())
    assert b"WARC-Payload-Digest: sha1:" + digest in record and record.endswith(b"\r\n\r\nshort\r\n\r\n")


class Counting:
    """A file that counts the bytes read."""

    def __init__(self, data):
        self.data, self.at, self.read_bytes = data, 0, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        out = self.data[self.at:self.at + n]
        self.at += len(out)
        self.read_bytes += len(out)
        return out


def _records():
    out = []
    for k in range(20):
        body = random.Random(k).randbytes(200_000)
        row = {"record_type": "response", "page_id": k, "url": f"http://a/{k}", "payload_bytes": len(body),
               "payload_digest": hashlib.sha1(body).hexdigest(), "refers_to": None, "payload": body}
        out.append(W._record(row, "2026-01-01T00:00:00Z", 1000))
    return out


@pytest.mark.parametrize("form", ["plain", "skip", "members"])
def test_unwanted_payloads_are_not_fetched(form):
    pack = {"plain": bytes, "skip": W._compressed, "members": gzip.compress}[form]
    data = b"".join(map(pack, _records()))
    name = "x.warc" if form == "plain" else "x.warc.gz"
    for payload, wanted in ((True, {3, 17}), (False, set(range(20)))):
        file = Counting(data)
        got = list(W.read_records(file, name, len(data), lambda r: r["page_id"] in wanted, payload))
        assert [r["page_id"] for r in got] == sorted(wanted)
        assert all((r["payload"] is not None) == payload for r in got)
        if form != "members":
            assert file.read_bytes < len(data) / 2
    whole = list(W.read_records(Counting(data), name, len(data), lambda r: True, True))
    assert [hashlib.sha1(r["payload"]).hexdigest() for r in whole] == [r["payload_digest"] for r in whole]


def test_long_headers_foreign_records_and_damage():
    block = b"GET / HTTP/1.1\r\n\r\n"
    record = b"WARC/1.0\r\nWARC-Type: request\r\nX-Long: " + b"a" * 9000 + b"\r\n folded\r\nwarc-payload-digest: SHA1:" \
        + hashlib.sha1(b"").hexdigest().upper().encode() + b"\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(block) \
        + block + b"\r\n\r\n"
    for name, data in (("a.warc", record * 3), ("a.warc.gz", gzip.compress(record) * 3)):
        got = list(W.read_records(Counting(data), name, len(data), lambda r: True, True))
        assert [r["record_type"] for r in got] == ["request"] * 3 and got[0]["payload"] == b""
        assert got[0]["payload_digest"] == hashlib.sha1(b"").hexdigest()
        with pytest.raises(ValueError):
            list(W.read_records(Counting(data[:-40] + b"junk"), name, len(data) - 36, lambda r: True, True))
            list(W.read_records(Counting(b"junk"), name, 4, lambda r: True, True))
    assert list(W.read_records(Counting(b""), "a.warc", 0, lambda r: True, True)) == []


def test_predicates_and_pushed_filters(spark, pages, folder):
    W.write_pages(pages, folder)
    df = W.read_archive(spark, folder, payload=False)
    cases = [("record_type = 'revisit'", [("record_type", "=", "revisit")]),
             ("page_id in (1, 4, 12)", [("page_id", "in", [1, 4, 12])]),
             ("payload_bytes >= 1000 and refers_to is null", [("payload_bytes", ">=", 1000), ("refers_to", "is null", None)]),
             ("target_uri like 'http://a/1%'", [("target_uri", "starts with", "http://a/1")]),
             ("page_id is null", [("page_id", "is null", None)]), ("page_id <=> 3", [("page_id", "<=>", 3)]),
             ("record_type = 'response' and page_id < 5", [("record_type", "=", "response"), ("page_id", "<", 5)]),
             ("page_id > 11", [("page_id", ">", 11)]), ("payload_bytes < 0", [("payload_bytes", "<", 0)]),
             ("page_id <= 2 and refers_to is not null", [("page_id", "<=", 2), ("refers_to", "is not null", None)])]
    for text, where in cases:
        want = rows_of(df.where(text))  # Spark's own filter
        assert rows_of(W.read_archive(spark, folder, payload=False, where=where)) == want, text
    assert rows_of(df.where("page_id > 11")) != rows_of(df.where("page_id < 3")) and df.count() == len(rows_of(df))
    with pytest.raises(Exception, match="no header predicate"):
        W.read_archive(spark, folder, where=[("payload", "=", "x")]).count()
    flag = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(flag, "true")
    try:
        for text, _ in cases:
            pushed = W.read_archive(spark, folder, payload=False, filterPushdown="true").where(text)
            plan = pushed._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
            assert pushed.count() == df.where(text).count() and "Filter" not in plan, text
        # without the option one frame may be filtered in several ways
        assert df.where("page_id = 3").union(df.where("page_id = 4")).count() == 2
    finally:
        spark.conf.unset(flag)


def test_lost_attempts_are_not_read(spark, pages, folder):
    W.write_pages(pages, folder)
    n = W.read_archive(spark, folder).count()
    system, path = W.file_system(folder)
    with system.open_output_stream(f"{path}/part-lost-attempt.warc") as s:
        s.write(b"half a record")
    assert W.read_archive(spark, folder).count() == n
    W.write_pages(pages.where("page_id = 4"), folder)
    assert W.read_archive(spark, folder, where=[("page_id", "=", 4)]).count() == 2
    with pytest.raises(Exception, match="appended"):
        W.page_records(pages).write.format("warc").mode("overwrite").save(folder)
