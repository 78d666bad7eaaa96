import hashlib

from widetab.llm import warc as A
from widetab.llm.common import shared_path

from shared_fixtures import ready  # noqa: F401


def expected(rows):
    out = []
    for pid, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        top = max(same) if len(raw) >= 1000 and len(same) > 1 else pid
        out.append((pid, len(raw), hashlib.sha1(raw).hexdigest(), *(("response", None) if pid == top else ("revisit", top))))
    return sorted(out, key=repr)


FORGED = ("x" * 60 + "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
          "WARC/1.1\r\nbroken é")
ROWS = [(1, "http://a/1", FORGED), (2, "http://a/2", FORGED), (3, None, None), (4, "é x\r\ny", "A" * 1500), (9, "b", "A" * 1500),
        (6, "c", "WARC/1.1\r\n"), (7, "z", "\r\n\r\nWARC/1.1\r\n\r\n\r\n"), (8, "q", "ü" * 900), (10, "q", "ü" * 900), (11, "", "")]


def test_round_trip_with_version_lines_inside_payloads(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")       # many splits, some inside records
    try:
        docs = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").coalesce(2)
        path = shared_path(spark, "t-warc")
        A.write_archive(docs, path)
        got = A.read_archive(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.verified for r in got)
    assert sorted([tuple(r)[:5] for r in got], key=repr) == expected(ROWS)


def test_files_are_plain_warc(spark):
    path = shared_path(spark, "t-warc")
    A.write_archive(spark.createDataFrame(ROWS, "page_id bigint, url string, html string").coalesce(1), path)
    data = b"".join(r.content for r in spark.read.format("binaryFile").load(path).collect())
    at, ids = 0, []
    while at < len(data):                                            # a plain sequential reader
        assert data[at:at + 10] == b"WARC/1.1\r\n"
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        ids.append(fields[b"WARC-Record-ID"])
        at += len(head) + 4 + int(fields[b"Content-Length"])
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert len(ids) == len(ROWS)


def test_pointer_jumping_follows_long_chains(spark):
    links = [("f", 10 * i, 10 * i + 10) for i in range(300)] + [("f", 10 * i + 5, 10 * i + 15) for i in range(300)] + [("g", 5, 0), ("g", 0, None)]
    got = {tuple(r) for r in A.reachable(spark.createDataFrame(links, "file string, start bigint, next bigint")).collect()}
    assert got == {("f", 10 * i) for i in range(300)} | {("g", 0)}


def test_odd_rows(spark):
    rows = [(None, None, "n"), (5, "b", "A" * 1200), (5, "b", "A" * 1200), (4, "b", "A" * 1200), (1, "u", "long " * 60000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, payload string, bytes int")
    path = shared_path(spark, "t-warc")
    A.write_archive(docs, path)
    got = sorted([tuple(r)[:5] for r in A.read_archive(spark, path).collect()], key=repr)
    assert got == expected(rows)
    path = shared_path(spark, "t-warc")
    A.write_archive(docs.limit(0), path)
    assert A.read_archive(spark, path).count() == 0


def test_hostile_lengths(spark):
    """Payloads that declare lengths that are no numbers, negative, lead back to
    themselves, overflow, or are longer than anything."""
    lengths = ["abc", "-1", "", " 5", "5 5", "0x10", "99999999999999999999999", "9223372036854775807", "2147483647", "2147483648",
               *(str(-n) for n in range(60, 140))]
    rows = [(i, f"http://a/{i}", "y" * (i % 7) + f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
             f"Content-Length: {n}\r\n\r\nhello\r\n\r\nWARC/1.1\r\n" + "z" * (i % 50)) for i, n in enumerate(lengths)]
    rows += [(500, "u", "WARC/1.1\r\nContent-Length: 3"), (501, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\nWARC/1.1\r\n")]
    for most in ("300", "4000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            path = shared_path(spark, "t-warc")
            A.write_archive(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3), path)
            got = A.read_archive(spark, path).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert all(r.verified for r in got)
        assert sorted([tuple(r)[:5] for r in got], key=repr) == expected(rows)


def test_the_second_read_may_cut_files_elsewhere(spark, monkeypatch):
    rows = ROWS + [(100 + i, "u", FORGED + str(i)) for i in range(40)]
    path = shared_path(spark, "t-warc")
    A.write_archive(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2), path)
    read, sizes = A._pieces, iter(["400", "1700", "900"])

    def elsewhere(spark, path):
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
        return read(spark, path)
    monkeypatch.setattr(A, "_pieces", elsewhere)
    try:
        got = A.read_archive(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r.verified for r in got) and sorted([tuple(r)[:5] for r in got], key=repr) == expected(rows)
