import gzip
import hashlib
import io
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from stridebase.llm import warc
from stridebase.llm.tables import cut_lineage

LONG = "é" * 80  # 160 bytes
PAGES = [
    (3, "http://a/x", LONG),
    (1, "http://a/y\r\nWARC-Type: evil", LONG),
    (1, "http://a/y2", LONG),
    (None, "http://a/z", LONG),
    (4, None, None),
    (5, "", ""),
    (6, "u", "short"),
    (7, "v", "short"),
    (8, "w", "WARC/1.1\r\n\r\n" * 30),
    (None, None, "n" * 200),
    (9, "big", "<p>" + "x" * 3_000_000),
]


def write(spark, pages, folder, **options):
    warc.register(spark)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    writer = warc.page_records(frame, lambda df: cut_lineage(df, "repeated")).repartition(3).write.format("warc").mode("append")
    writer.options(**options).save(folder)


@pytest.fixture(params=["false", "true"])
def archive(spark, shared, request):
    folder = f"{shared}/{uuid.uuid4().hex}"
    write(spark, PAGES, folder, compress=request.param)
    return folder


def test_round_trip(spark, archive):
    rows = spark.read.format("warc").load(archive).collect()
    assert len(rows) == len(PAGES)
    responses = sorted((r["page_id"] or -1, bytes(r["payload"])) for r in rows if r["record_type"] == "response")
    wanted = [(p if p is not None else -1, (h or "").encode()) for p, _, h in PAGES if h != LONG or p == 1]
    assert responses == sorted(wanted)
    revisits = [r for r in rows if r["record_type"] == "revisit"]
    assert sorted(r["page_id"] or -1 for r in revisits) == [-1, 3]
    for r in revisits:
        assert r["payload"] is None and r["refers_to"] == warc.page_record_id(1)
        assert r["payload_digest"] == hashlib.sha256(LONG.encode()).hexdigest() and r["payload_length"] == 160
    assert all("\n" not in (r["target_uri"] or "") for r in rows)


def test_filters_reach_the_reader_and_agree_with_spark(spark, archive):
    source = spark.read.format("warc").load(archive)
    conditions = [
        F.col("record_type") == "revisit",
        F.col("page_id").isin(4, 8, 9),
        F.col("page_id").isNull(),
        F.col("page_id").eqNullSafe(8),
        F.col("page_id") > 5,
        ~(F.col("page_id") == 6),
        F.col("target_uri").startswith("http://a") & (F.col("payload_length") >= 100),
        F.col("target_uri").contains("y"),
        F.octet_length("payload") == 5,
    ]
    everything = spark.createDataFrame(source.collect(), source.schema)
    for condition in conditions:
        got = sorted(map(str, source.where(condition).select("record_id", "page_id").collect()))
        assert got == sorted(map(str, everything.where(condition).select("record_id", "page_id").collect()))


def test_unwanted_payloads_are_not_read():
    class Counting(io.BytesIO):
        seen = 0

        def read(self, n=-1):
            data = super().read(n)
            self.seen += len(data)
            return data

    big = warc.encode_record({"WARC-Type": "response"}, b"x" * 5_000_000, False)
    small = warc.encode_record({"WARC-Type": "warcinfo", "X-Page-Id": "5"}, b"hello", False)
    data = big + small + big
    file = Counting(data)
    found = list(warc.plain_records(warc._Source(file, len(data)), lambda row: row["record_type"] == "warcinfo"))
    assert [(row["page_id"], payload) for row, payload in found] == [(5, b"hello")]
    assert file.seen < 500_000

    rng = os.urandom(5_000_000)
    data = b"".join(warc.encode_record({"WARC-Type": t}, rng, True) for t in ("response", "warcinfo", "response"))
    file = Counting(data)
    found = list(warc.gzip_records(warc._Source(file, len(data)), lambda row: row["record_type"] == "warcinfo"))
    assert [payload == rng for _, payload in found] == [True]
    assert file.seen < 5_500_000


def test_gzip_members_are_standard_and_may_lack_the_length():
    record = warc.encode_record({"WARC-Type": "response"}, b"payload", True)
    raw = gzip.decompress(record)
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"payload\r\n\r\n")
    foreign = gzip.compress(raw) * 3
    for wanted in (True, False):
        found = list(warc.gzip_records(warc._Source(io.BytesIO(foreign), len(foreign)), lambda row: wanted))
        assert len(found) == (3 if wanted else 0)


def test_broken_archives_are_errors():
    for data in (b"not a record\r\n\r\n", b"WARC/1.1\r\nno end"):
        with pytest.raises(ValueError):
            list(warc.plain_records(warc._Source(io.BytesIO(data), len(data)), lambda row: True))


@pytest.mark.parametrize("wanted", [True, False])
def test_cut_records_are_errors(wanted):
    record = warc.encode_record({"WARC-Type": "response"}, b"x" * 1000, False)
    for data in (record[:-500], record + record[:-500], record[: record.index(b"\r\n\r\n") + 4]):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.plain_records(warc._Source(io.BytesIO(data), len(data)), lambda row: wanted))
    for length in (b"", b"Content-Length: -5\r\n", b"Content-Length: many\r\n"):
        data = b"WARC/1.1\r\nWARC-Type: response\r\n" + length + b"\r\nhello\r\n\r\n"
        for read, bytes_ in ((warc.plain_records, data), (warc.gzip_records, gzip.compress(data))):
            with pytest.raises(ValueError, match="how long"):
                list(read(warc._Source(io.BytesIO(bytes_), len(bytes_)), lambda row: wanted))


def test_files_of_failed_attempts_are_not_read(spark, archive):
    count = spark.read.format("warc").load(archive).count()
    with open(f"{archive}/part-failed.warc", "wb") as out:
        out.write(warc.encode_record({"WARC-Type": "response"}, b"x", False))
    assert spark.read.format("warc").load(archive).count() == count
    write(spark, [(1, "u", "h")], archive)
    assert spark.read.format("warc").load(archive).count() == count + 1


def test_no_payload_option_rolling_and_partitions(spark, shared):
    folder = f"{shared}/{uuid.uuid4().hex}"
    write(spark, [(i, "u", f"{i}" * 50) for i in range(40)], folder, roll="1000")
    source = spark.read.format("warc").option("split", "3000").load(folder)
    assert source.rdd.getNumPartitions() > 3
    assert sorted(r["page_id"] for r in source.collect()) == list(range(40))
    bare = spark.read.format("warc").option("payload", "false").load(folder).collect()
    assert len(bare) == 40 and all(r["payload"] is None for r in bare)


def test_empty_table(spark, shared):
    folder = f"{shared}/{uuid.uuid4().hex}"
    write(spark, [], folder)
    assert spark.read.format("warc").load(folder).collect() == []


def test_ids_of_the_whole_range_of_a_long(spark, shared):
    folder = f"{shared}/{uuid.uuid4().hex}"
    ids = [10**18 - 1, 10**18, -(10**18), (1 << 63) - 1, -(1 << 63)]
    write(spark, [(i, "u", f"page {i} " * 20) for i in ids], folder)
    source = spark.read.format("warc").load(folder)
    assert sorted(r["page_id"] for r in source.collect()) == sorted(ids)
    for i in ids:
        assert [bytes(r["payload"]) for r in source.where(F.col("page_id") == i).collect()] == [(f"page {i} " * 20).encode()]
    assert warc.header_row({"x-page-id": str(1 << 63)})["page_id"] is None


def test_groups_of_files():
    files = [("c", 5), ("a", 4), ("b", 4), ("d", 50), ("e", 1)]
    assert warc.group_files(files, 10) == [[("a", 4), ("b", 4)], [("c", 5)], [("d", 50)], [("e", 1)]]
    assert warc.group_files([], 10) == []


def records(number, seed=1):
    rng = random.Random(seed)
    head = lambda i: {"WARC-Type": "response", "X-Page-Id": str(i), "WARC-Record-ID": f"<urn:x-page:{i}>"}
    return [warc.encode_record(head(i), rng.randbytes(rng.choice([0, 1, 30, 400, 3000])), False) for i in range(number)]


def test_large_archives_are_read_in_parts(spark, shared):
    folder = f"{shared}/{uuid.uuid4().hex}"
    os.makedirs(folder)
    data = records(200)
    with open(f"{folder}/large.warc", "wb") as out:
        out.write(b"".join(data) + b"\r\n")
    with open(f"{folder}/small.warc", "wb") as out:
        out.write(warc.encode_record({"WARC-Type": "response", "X-Page-Id": "200"}, b"x", False))
    whole = spark.read.format("warc").option("cut", "0").load(folder)
    rows = sorted((r["page_id"], bytes(r["payload"])) for r in whole.collect())
    assert [i for i, _ in rows] == list(range(201))
    for split in (150, 1000, 50_000):
        cut = spark.read.format("warc").options(cut="1000", split=str(split)).load(folder)
        assert cut.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
        assert sorted((r["page_id"], bytes(r["payload"])) for r in cut.collect()) == rows
        assert cut.where("page_id > 150").count() == 50


def test_every_cut_of_an_archive(tmp_path):
    data = records(12, 2)
    path = tmp_path / "a.warc"
    path.write_bytes(b"".join(data))
    size, reader = path.stat().st_size, warc.WarcReader({"path": str(tmp_path), "payload": "false"})
    system, _ = warc.fs.FileSystem.from_uri(str(tmp_path))
    for at in range(1, size):
        parts = [warc.ArchivePart(str(path), size, 0, at), warc.ArchivePart(str(path), size, at, size)]
        assert [row["page_id"] for part in parts for row, _ in reader._part(system, part)] == list(range(12))


def test_records_that_hold_records_are_never_read_as_such(tmp_path):
    inner = b"\r\n\r\n" + b"".join(records(3, 3)) + b"WARC/1.1 and more"
    data = [*records(2), warc.encode_record({"WARC-Type": "resource", "X-Page-Id": "2"}, inner, False), *records(2)]
    path = tmp_path / "a.warc"
    path.write_bytes(b"".join(data))
    size, reader = path.stat().st_size, warc.WarcReader({"path": str(tmp_path)})
    system, _ = warc.fs.FileSystem.from_uri(str(tmp_path))
    refused = 0
    for at in range(1, size):
        parts = [warc.ArchivePart(str(path), size, 0, at), warc.ArchivePart(str(path), size, at, size)]
        try:
            assert [row["page_id"] for part in parts for row, _ in reader._part(system, part)] == [0, 1, 2, 0, 1]
        except ValueError as error:
            assert "cut = 0" in str(error)
            refused += 1
    assert 0 < refused <= len(data[2])
