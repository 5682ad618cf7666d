import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ticklake.llm.warc import archived, read_warc, warc_records, write_warc
from ticklake.session import scratch_dir

DATE = "2024-01-01T00:00:00Z"
ROWS = [
    (1, "http://a/1", "<p>same</p>", "x"), (2, "http://a/2", "<p>same</p>", "x"), (3, "http://a/é ü", "<p>same</p>", "x"),
    (4, None, None, "x"), (5, "u\r\nWARC-Type: bad", "", "x"), (6, "u", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\né", "x"),
    (7, "u", "y" * 300_000, "x"), (8, "u", "z", "x"), (8, "u", "z", "x"), (-9, "u", "z", "x"), (None, "u", "z", "x"), (None, "u", "only", "x"),
]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)


def expected(rows, least=0):
    out = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        same = [j for j, _, h, _ in rows if (h or "").encode() == data and j is not None]
        revisit = len(data) >= least and bool(same) and i != max(same)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_read_back(pages, least):
    got = sorted(map(tuple, archived(pages(ROWS), least_bytes=least).collect()), key=str)
    assert got == expected(ROWS, least)
    assert archived(pages([])).count() == 0


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_predicates_and_payloads_are_pushed_down(spark, pages, compression):
    path = scratch_dir(spark, "warc_test")
    write_warc(warc_records(pages(ROWS), DATE), path, compression)
    heads = read_warc(spark, path, "record_type string, record_id string, target_uri string, payload_bytes long")
    some = heads.where("record_type = 'revisit' and record_id like '<urn:page:1%'")
    assert "Filter (" not in some._jdf.queryExecution().executedPlan().toString()  # none is left to Spark
    assert [(r.record_id, r.payload_bytes) for r in some.collect()] == [("<urn:page:1>", 11)]
    assert heads.where(F.col("target_uri").isin("http://a/2", "nowhere")).count() == 1
    assert heads.where("payload_bytes > 1000").count() == 1  # left to Spark
    assert heads.where("target_uri is not null").count() == len(ROWS) - 1
    whole = {r.record_id: r for r in read_warc(spark, path).collect()}
    assert whole["<urn:page:6>"].payload.decode() == ROWS[5][2] and whole["<urn:page:1>"].payload is None
    assert whole["<urn:page:5>"].target_uri == "u%0D%0AWARC-Type: bad"


def test_records_are_well_formed(spark, pages):
    path = scratch_dir(spark, "warc_test")
    write_warc(warc_records(pages(ROWS[:4]), DATE), path, "gzip")
    folder = Path(path.removeprefix("file:").replace("//", "/"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(folder.glob("part-*.gz")))
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and rest[size : size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4 :], n + 1
    assert n == 4


def test_damaged_archives_are_errors(spark, tmp_path):
    (tmp_path / "cut.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="cut off"):
        read_warc(spark, str(tmp_path / "cut.warc")).collect()
    (tmp_path / "bad.warc").write_bytes(b"no archive")
    with pytest.raises(Exception, match="no WARC record"):
        read_warc(spark, f"file://{tmp_path}/bad.warc").collect()
