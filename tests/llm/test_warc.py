import gzip
import hashlib

from quorumlake.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def brute(rows):
    first = {}
    for i, _, h, _ in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        f = first.get(b, i)
        out.append((f"urn:page:{i}", "response" if f == i else "revisit", len(b), hashlib.sha256(b).hexdigest(), None if f == i else f"urn:page:{f}"))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    long = "é" * 80
    rows = [(5, "http://a/x", long, "c"), (3, "http://a/y\r\nX: 1", long, "c"), (4, None, "WARC/1.1\r\n\r\n" * 30, "c"), (6, "u", None, "c"), (7, "u", "", "c"), (8, "u", "short", "c"), (9, "u", "short", "c"), (1, "u", "x" * 200_000, "c")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for kind in ("gzip", "none"):
        path = f"file://{tmp_path}/{kind}"
        warc.write(warc.deduplicated(docs), path, compression=kind, max_file_bytes="1000")
        back = warc.read(spark, path).collect()
        got = sorted(((r.record_id, r.warc_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in back), key=str)
        assert got == brute(rows)
        for r in back:
            if r.warc_type == "response":
                assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        assert {r.target_uri for r in back if r.record_id == "urn:page:3"} == {"http://a/y%0D%0AX: 1"}


def test_predicates_are_pushed_and_unwanted_payloads_skipped(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}/", f"{i % 4} " * 100, "") for i in range(40)]
    path = str(tmp_path / "w")
    warc.write(warc.deduplicated(spark.createDataFrame(rows, SCHEMA)), path)
    d = warc.read(spark, path).where("warc_type = 'revisit' and target_uri like 'http://h1%'")
    assert d.count() == sum(1 for r in rows if r[0] > 3 and r[0] % 3 == 1)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "isnotnull" not in plan
    assert warc.read(spark, path, payload=False).where("payload is null").count() == 40


def test_reader_steps_over_members_without_inflating():
    import io

    from quorumlake.llm.warc import member, read_records, record

    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    base = {"target_uri": None, "payload_digest": None, "refers_to": None}
    parts = [b"".join(record({**base, "warc_type": t, "record_id": str(i), "payload": b"z" * 10**6}) ) + b"\r\n\r\n" for i, t in enumerate(["response", "resource", "response"])]
    broken = bytearray(member(parts[1]))
    broken[len(broken) // 2] ^= 255  # inflating this payload would fail
    data = member(parts[0]) + bytes(broken) + gzip.compress(parts[2])
    got = [h["WARC-Record-ID"] for h, _ in read_records(File(data), lambda h: h["WARC-Type"] == "response", True)]
    assert got == ["<0>", "<2>"]


def test_empty(spark, tmp_path):
    path = str(tmp_path / "e")
    warc.write(warc.deduplicated(spark.createDataFrame([], SCHEMA)), path)
    assert warc.read(spark, path).count() == 0


def test_beyond_the_broadcast_bound(spark):
    """The same records by the bitmap, of which only repeated digests go to a join."""
    rows = [(i, None if i % 5 else "http://a/", f"{i % 40} " * 60 if i % 3 else f"own {i} " * 30, "c") for i in range(300)] + [(7, "u", "7 " * 60, "c"), (8, "u", None, "c"), (9, "u", "short", "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    key = ["warc_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload"]
    few, many = (sorted((tuple(r) for r in warc.deduplicated(docs, most_broadcast=n).select(key).collect()), key=str) for n in (1000, 0))
    assert few == many and sum(r[0] == "revisit" for r in few) > 100
    held = warc._marked(docs.selectExpr("sha2(html, 256) payload_digest"), docs.limit(30).selectExpr("sha2(html, 256) payload_digest")).where("_maybe").count()
    assert 30 <= held < 150
    assert warc.deduplicated(docs.limit(0), most_broadcast=0).count() == 0
