"""WARC archives: exact round trips, magic inside payloads, records over many splits."""

import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martlet.llm import warc_chain as wc

KIND = "page_id long, url string, html string, record_type string, file string, offset int"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(payload: str, page: int = 7, end: str = "\r\n\r\n") -> str:
    """A whole record as text, to be planted in a payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n"
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{page}>\r\nContent-Type: application/http; msgtype=response\r\n"
            f"Content-Length: {len(head) + len(payload)}\r\n\r\n{head}{payload}{end}")


PLAIN = [(i, f"http://h{i % 3}.com/a/{i}", f"<p>{'text ' * (i % 9)}{i // 2}</p>") for i in range(40)]
TRAPS = [
    (100, "http://a.com/\r\nWARC/1.1\r\nWARC-Type: response", "one"),
    (101, "http://a.com/", "before\r\n\r\n" + record("fake") + "behind"),
    (102, "http://a.com/", "\r\n\r\n" + record("fake") * 5),
    (103, "http://a.com/", record("at the very start")),
    (104, "http://a.com/", "\nWARC/1.1\r\n" * 30),
    (105, "http://a.com/", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 999999\r\n\r\n"),  # reaches far
    (106, "http://a.com/", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"),
    (107, "http://a.com/", "\r\n" * 40),
    (108, "http://a.com/", "\r\n\r\n\r\n"),
    (109, "http://a.com/", "ends with a mark\r\n\r\nWARC/1."),
    (110, "http://a.com/", "\nWARC/1.1\r\nContent-Length: -4\r\nWARC-Type: x\r\n\r\n \nWARC/1.1\r\nContent-Length: ²\r\nWARC-Type: x\r\n\r\n"),
    (111, None, "no url"), (112, "", ""), (113, "u", None), (None, "u", "no id"), (114, "é", "日本語 𝄞 ñ"),
    (115, "u", "long " * 1500 + "\r\n\r\n" + record("fake") + " long" * 1500),
    (116, "u", record("y" * 200, end="") * 12),
]


def brute(rows, least=0):
    same = {}
    for n, (page, _, html) in enumerate(rows):
        same.setdefault((html or "").encode(), []).append((page is not None, page or 0, n))
    out = []
    for n, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        first = max(same[body])
        revisit = len(body) >= least and first != (page is not None, page or 0, n)
        out.append((page, len(body), digest(body), "revisit" if revisit else "response",
                    (first[1] if first[0] else None) if revisit else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def back(spark, path, **options):
    out = wc.read_archives(spark, path, **options)
    return out.withColumns({"page_id": wc.page_of(F.col("record_id")), "refers_to": wc.page_of(F.col("refers_to"))})


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", "f", 1) for r in rows], KIND)


@pytest.fixture
def splits(spark):
    """Sets how many bytes a split has."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield size
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size,files", [(1 << 20, 3), (1499, 1)])
def test_round_trip(spark, tmp_path, splits, size, files):
    rows = PLAIN + TRAPS
    wc.write_archives(frame(spark, rows).repartition(files), f"{tmp_path}/a")
    splits(size)
    out = back(spark, f"{tmp_path}/a", payloads=True)
    got = out.select(*COLUMNS, "complete", "payload", "stated_digest").collect()
    assert order(tuple(r[c] for c in COLUMNS) for r in got) == order(brute(rows))
    assert all(r.complete and r.payload_digest == r.stated_digest for r in got)
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(h or "").encode() for _, _, h in rows}


@pytest.mark.parametrize("size", [61, 87])
def test_every_alignment_of_splits(spark, tmp_path, splits, size):
    rows = [(i, "u", "\r\n\r\n" * (i % 5) + record("z" * i) * (i % 3)) for i in range(4)]
    wc.write_archives(frame(spark, rows).coalesce(1), f"{tmp_path}/a")
    splits(size)
    assert order(tuple(r) for r in back(spark, f"{tmp_path}/a").select(*COLUMNS).collect()) == order(brute(rows))


def test_payloads_below_the_least_size_do_not_revisit(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    wc.write_archives(frame(spark, rows), f"{tmp_path}/a", least=3)
    assert order(tuple(r) for r in back(spark, f"{tmp_path}/a").select(*COLUMNS).collect()) == order(brute(rows, least=3))


def test_repeated_rows_have_one_response(spark, tmp_path):
    rows = [(5, "u", "same")] * 4 + [(3, "u", "same"), (None, "u", "alone"), (None, "u", "alone")]
    wc.write_archives(frame(spark, rows).repartition(3), f"{tmp_path}/a")
    got = [tuple(r) for r in back(spark, f"{tmp_path}/a").select(*COLUMNS).collect()]
    assert order(got) == order(brute(rows))


def test_archives_are_warc_files(spark, tmp_path):
    """Read by a plain parser that trusts the lengths."""
    wc.write_archives(frame(spark, PLAIN).coalesce(1), f"{tmp_path}/a")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "a").glob("part-*")))
    at, seen = 0, 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode()
        assert head.startswith("WARC/1.1\r\n") and "WARC-Date: " in head and "WARC-Target-URI: http://h" in head
        at = end + 4 + int(re.search("Content-Length: ([0-9]+)", head)[1])
        assert data[at:at + 4] == b"\r\n\r\n"
        at, seen = at + 4, seen + 1
    assert seen == len(PLAIN)


def test_broken_archives(spark, tmp_path):
    whole = record("one", 1) + record("two", 2)
    for name, text in {"cut": whole[:-10], "gap": record("one", 1) + "junk\r\n" + record("two", 2), "late": "x" + whole, "none": ""}.items():
        (tmp_path / f"{name}.warc").write_bytes(text.encode())
    got = back(spark, str(tmp_path)).select(F.element_at(F.split("file", "/"), -1).alias("name"), "page_id", "complete").collect()
    assert sorted(tuple(r) for r in got) == [("cut.warc", 1, True), ("cut.warc", 2, False), ("gap.warc", 1, True)]


def test_no_pages(spark, tmp_path):
    wc.write_archives(spark.createDataFrame([], KIND), f"{tmp_path}/a")
    assert back(spark, f"{tmp_path}/a").collect() == []


def test_pointers_jump_along_a_long_chain(spark):
    """A chain over 300 blocks, and candidates that no chain reaches."""
    rows = [("f", 10 * i, 10 * (i + 1)) for i in range(300)] + [("f", 10 * i + 5, 10 * i + 15) for i in range(50)] + [("g", 7, 10)]
    got = wc.reached(spark.createDataFrame(rows, "file string, start long, exit long")).collect()
    assert sorted(r.start for r in got) == [10 * i for i in range(300)]
