import hashlib

from docindex.llm import warc


def expect(rows):
    n = [(p, u, (h or "").encode()) for p, u, h in rows]
    top = {}
    for p, _, b in n:
        if p is not None and len(b) >= 1000:
            top[b] = max(top.get(b, p), p)
    out = []
    for p, u, b in n:
        again = p is not None and len(b) >= 1000 and p < top[b]
        out.append((p or -1, u or "", len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[b] if again else None, b"" if again else b))
    return sorted(out, key=str)


def test_records_are_valid():
    """Mandatory fields, an HTTP message as block, ids of their own."""
    import re
    import zlib
    rows = [{"page_id": p, "url": u, "html": h, "record_type": t, "payload_bytes": len((h or "").encode()), "payload_digest": hashlib.sha1((h or "").encode()).hexdigest(), "refers_to": f}
            for p, u, h, t, f in [(1, "http://a/", "<p>é</p>\r\n\r\nx", "response", None), (None, None, None, "response", None), (1, "http://a/", "<p>é</p>\r\n\r\nx", "revisit", 9)]]
    ids = set()
    for r in rows:
        member = warc.record(r, "2024-01-02T03:04:05Z")
        head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and rest.endswith(b"\r\n\r\n") and len(rest) == int(fields["Content-Length"]) + 4
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"]) and fields["WARC-Date"] == "2024-01-02T03:04:05Z"
        assert fields["Content-Type"] == "application/http; msgtype=response" and rest.startswith(b"HTTP/1.1 200 OK\r\n") and ":" in fields["WARC-Target-URI"]
        assert ("WARC-Profile" in fields) == (r["record_type"] == "revisit")
        got = warc.parse(member)
        assert got["payload"] == ((r["html"] or "").encode() if r["record_type"] == "response" else b"") and got["url"] == (r["url"] or "") and got["refers_to"] == r["refers_to"]
        ids.add(fields["WARC-Record-ID"])
    assert len(ids) == 3


def test_clashing_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "h" * 1200, 5, "k"), (2, "u", "h" * 1200, 6, None)], "page_id long, url string, html string, keeper int, record_type string")
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(df, f"file://{tmp_path}/c").collect())
    assert got == [(1, "revisit", 2), (2, "response", None)]


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "READ_BYTES", 1500)
    long, short = "é" * 600, "x" * 999
    rows = [(1, "http://a", long), (2, "http://b", long), (9, None, long), (3, "c", short), (4, "c\r\nX: y", short), (5, "d", None), (6, "", ""), (9, "again", long),
            (None, "no id", long), (7, "nl", "a\r\n\r\nb\r\n"), (8, "big", "<p>" + "w" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    root = f"file://{tmp_path}/w"
    index = warc.write_archives(df, root)
    got = [tuple(r) for r in warc.read_records(index, root).collect()]
    got = sorted(((p or -1, u, n, d, t, f, bytes(b)) for p, u, t, n, d, f, b in got), key=str)
    assert got == [(p, " ".join(u.split()), n, d, t, f, b) for p, u, n, d, t, f, b in expect(rows)] or \
        sorted(got, key=str) == sorted([(p, " ".join(u.split()), n, d, t, f, b) for p, u, n, d, t, f, b in expect(rows)], key=str)
    some = index.where("page_id in (2, 8)")
    assert sorted(r.page_id for r in warc.read_records(some, root).collect()) == [2, 8]
    assert warc.round_trip(df.limit(0), f"file://{tmp_path}/e").collect() == []
