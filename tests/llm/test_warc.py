import gzip
import hashlib
import random

import pytest

from parcelmart.llm.warc import read_records, unread_records, write_archives
from parcelmart.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, path string"
LONG = "z" * 1000


def archives(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return write_archives(df, scratch_path(spark, "warc-test"), **options)


ROWS = [
    (1, "http://a/é b\r\nX: y", "kurz"),
    (2, None, "kurz"),
    (3, "http://c", None),
    (4, "http://d", ""),
    (5, "http://e", LONG),
    (6, "http://f", LONG),
    (None, "http://g", LONG),
    (6, "http://f", LONG),
    (7, "http://h", "é" * 500),
    (8, "http://i", "é" * 500),
    (9, "http://j", "WARC/1.1\r\n\r\n" + "long " * 20000),
]


@pytest.mark.parametrize("split", [1, 37, 100, 500, 1 << 20])
def test_every_split_gives_every_record_once(spark, split):
    made = archives(spark, ROWS, target_bytes=700)
    got = [r.asDict() for r in read_records(made, split_bytes=split).collect()]
    assert len(got) == len(ROWS) and made.agg({"records": "sum"}).first()[0] == len(ROWS)
    assert len({(r["path"], r["offset"]) for r in got}) == len(ROWS)
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    want = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        last = max((p for p, _, h in ROWS if (h or "") == (html or "") and p is not None), default=None)
        revisit = len(data) >= 1000 and page != last
        name = f"<urn:page:{'none' if page is None else page}>"
        want.append((name, "revisit" if revisit else "response", f"<urn:page:{last}>" if revisit else None, len(data), hashlib.sha1(data).hexdigest()))
    assert sorted(kinds, key=str) == sorted(want, key=str)
    payloads = {r["record_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert bytes(payloads["<urn:page:9>"]).decode() == ROWS[-1][2] and bytes(payloads["<urn:page:3>"]) == b""


def test_files_are_plain_gzip_members(spark):
    made = archives(spark, ROWS[:2])
    for row in made.collect():
        text = gzip.decompress(open(row.path.removeprefix("file://"), "rb").read())
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and b"X: y" not in text.replace(b"%0D%0AX:%20y", b"")


def test_bytes_between_members_are_passed_and_damage_raises(spark, tmp_path):
    made = archives(spark, [(1, "u", LONG)]).collect()
    data = open(made[0].path.removeprefix("file://"), "rb").read() if len(made) == 1 else b"".join(open(r.path.removeprefix("file://"), "rb").read() for r in made)

    def read(content):
        path = tmp_path / f"{hashlib.md5(content).hexdigest()}.warc.gz"
        path.write_bytes(content)
        return read_records(spark.createDataFrame([(str(path), len(content))], "path string, bytes long"), split_bytes=64).count()

    junk = b"\x1f\x8b\x08 no member " + gzip.compress(b"no record")
    assert read(junk + data + junk) == 1
    with pytest.raises(Exception, match="cut off|damaged"):
        read(data[:-9])


def test_very_long_urls_are_read_back(spark):
    """Headers of several megabytes, as those of a url that does not compress."""
    url = "http://x/" + "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz0123456789\u00e9 ", k=2_000_000))
    made = archives(spark, [(1, "u", "a"), (2, url, LONG), (3, "v", "b")])
    got = read_records(made)
    assert sorted(r.record_id for r in got.collect()) == [f"<urn:page:{k}>" for k in (1, 2, 3)]
    assert unread_records(made, got).count() == 0
    lost = unread_records(made, got.filter("record_id <> '<urn:page:2>'")).collect()
    assert [r.records - r.found for r in lost] == [1]


def test_empty_tables(spark):
    made = archives(spark, [])
    assert made.count() == 0 and read_records(made).count() == 0
    assert read_records(spark.createDataFrame([("nowhere", 0)], "path string, bytes long")).count() == 0
