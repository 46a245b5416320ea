import gzip
import hashlib
import random

from corpusprep.llm import warc
from oracle import compare, duck


def record(payload, n=0):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    return (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Block-Digest: sha256:%s\r\nContent-Length: %d\r\n\r\n"
            % (n, hashlib.sha256(block).hexdigest().encode(), len(block)) + block + b"\r\n\r\n")


def ids(items):
    items = list(items)
    return [x[1]["warc-record-id"] for x in items if x[0] == "record"], [(x[1], x[2]) for x in items if x[0] == "gap"]


def test_damage_in_plain_archives():
    parts = [record(b"p%d WARC/1.1\r\n" % i * 20, i) for i in range(5)]
    data = b"".join(parts)
    at = [sum(map(len, parts[:i])) for i in range(6)]
    names = [f"<urn:page:{i}>" for i in range(5)]
    assert ids(warc.salvage(data)) == (names, [])
    flipped = bytearray(data)
    flipped[at[2] + len(parts[2]) - 10] ^= 1
    assert ids(warc.salvage(bytes(flipped))) == (names[:2] + names[3:], [(at[2], at[3])])
    cut = data[:at[1] + 50] + data[at[3]:]
    assert ids(warc.salvage(cut)) == ([names[0], *names[3:]], [(at[1], at[1] + 50)])
    assert ids(warc.salvage(data[:-3])) == (names[:4], [(at[4], at[5] - 3)])
    assert ids(warc.salvage(b"junk" + data)) == (names, [(0, 4)])
    assert ids(warc.salvage(b"only junk")) == ([], [(0, 9)]) and list(warc.salvage(b"")) == []
    header = data.replace(b"Content-Length: ", b"Content-Length: x", 1)
    assert ids(warc.salvage(header))[0] == names[1:]


def test_damage_in_gzip_members():
    parts = [gzip.compress(record(random.Random(i).randbytes(500), i)) for i in range(4)]
    data, names = b"".join(parts), [f"<urn:page:{i}>" for i in range(4)]
    at = [sum(map(len, parts[:i])) for i in range(5)]
    assert ids(warc.salvage(data)) == (names, [])
    flipped = bytearray(data)
    flipped[at[1] + 100] ^= 4
    assert ids(warc.salvage(bytes(flipped))) == ([names[0], *names[2:]], [(at[1], at[2])])
    assert ids(warc.salvage(data[:at[1]] + b"\x1f\x8b\x08 no member " + data[at[1]:]))[0] == names
    assert ids(warc.salvage(data[:-5])) == (names[:3], [(at[3], at[4] - 5)])


def test_random_damage_never_invents_records():
    rng = random.Random(2)
    good = [record(rng.randbytes(rng.randrange(0, 300)), i) for i in range(8)]
    blocks = {x[2] for x in warc.salvage(b"".join(good))}
    for _ in range(300):
        data = bytearray(b"".join(good))
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(len(data))
            data[a:a + rng.randrange(0, 40)] = rng.randbytes(rng.randrange(0, 40))
        items = list(warc.salvage(bytes(data), strict=True))
        assert {x[2] for x in items if x[0] == "record"} <= blocks
        gaps = [x for x in items if x[0] == "gap"]
        assert all(0 <= g[1] < g[2] <= len(data) for g in gaps) and sum(x[0] == "record" for x in items) >= 4


def test_plain_records_and_gzip_members_in_one_file():
    plain = [record(b"plain %d " % i * 30, i) for i in range(3)]
    packed = [gzip.compress(record(random.Random(i).randbytes(300), i)) for i in range(3, 6)]
    names = [f"<urn:page:{i}>" for i in range(6)]
    assert ids(warc.salvage(b"".join(plain + packed))) == (names, [])
    assert ids(warc.salvage(b"".join(packed + plain))) == (names[3:] + names[:3], [])
    assert ids(warc.salvage(b"".join([plain[0], packed[0], b"junk", plain[1], packed[1][:40], plain[2]])))[0] == [names[0], names[3], names[1], names[2]]


def test_damaged_first_record_with_a_gzip_body():
    parts = [record(gzip.compress(b"<p>page</p>" * 40), 0), *[record(b"p%d" % i * 40, i) for i in range(1, 4)]]
    data = b"XXXX" + b"".join(parts)[4:]
    assert ids(warc.salvage(data)) == ([f"<urn:page:{i}>" for i in range(1, 4)], [(0, len(parts[0]))])


def test_records_before_the_damage_in_one_member():
    parts = [record(random.Random(i).randbytes(3000), i) for i in range(6)]
    names = [f"<urn:page:{i}>" for i in range(6)]
    for level in (0, 6):
        data = gzip.compress(b"".join(parts), level)
        for at in (len(data) * 2 // 3, len(data) - 5):
            got, gaps = ids(warc.salvage(data[:at]))
            assert got == names[:len(got)] and len(got) >= 3 and gaps and gaps[-1][1] == at
        flipped = bytearray(data)
        flipped[-3] ^= 1  # only the checksum is wrong
        assert ids(warc.salvage(bytes(flipped)))[0] == names
        flipped = bytearray(data)
        flipped[len(data) // 2] ^= 1
        got = ids(warc.salvage(bytes(flipped) + parts[0]))[0]
        assert got[:2] == names[:2] and got[-1] == names[0] and len(set(got)) == len(got) - 1


def test_pages_round_trip(spark):
    big = "<p>é😀</p>" * 30
    rows = [(3, "http://a", big), (1, "http://b\r\nX: y", big), (2, None, big), (2, "http://c", big), (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
            (9, "u", "WARC/1.1\r\n\r\n" * 50), (None, "u", big), (10, "u", "x" * 500_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.store_and_read(df).collect()
    assert all(r["reason"] is None for r in got) and len(got) == len(rows)
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    want = []
    for rid, _, html in rows:
        data = (html or "").encode()
        lead = len(data) >= 100 and html == big and rid != 1
        want.append((f"<urn:page:{'null' if rid is None else rid}>", "revisit" if lead else "response", "<urn:page:1>" if lead else None, len(data), hashlib.sha256(data).hexdigest()))
    assert kinds == sorted(want)
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert texts["<urn:page:9>"] == "WARC/1.1\r\n\r\n" * 50 and texts["<urn:page:10>"] == "x" * 500_000 and texts["<urn:page:5>"] == ""
    assert warc.store_and_read(df.limit(0)).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    big = [(i, "http://a", f"{i} " * 30_000) for i in range(40)] + [(100, "u" * 5000, "z" * 900_000)]
    rows = big + [(1000 + i, "u", "small") for i in range(300)] + [(2000, "http://a", big[3][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write_archives(df, path, per_archive=100, archive_bytes=400_000)
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert sum(n > 400_000 for n in sizes) == 1 and len(sizes) < 40
    got = {r["record_id"]: r for r in warc.read_archives(spark, path, strict=True).collect()}
    assert len(got) == len(rows) and all(bytes(got[f"<urn:page:{i}>"]["payload"]).decode() == h for i, _, h in rows if i != 2000)
    assert got["<urn:page:2000>"]["refers_to"] == "<urn:page:3>"


def test_gaps_are_logged(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(b"one", 1) + b"garbage" + record(b"two", 2))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    size = len(record(b"one", 1))
    assert [(r["gap_start"], r["gap_end"]) for r in rows if r["reason"]] == [(size, size + 7)]
    assert sorted(r["record_id"] for r in rows if r["record_id"]) == ["<urn:page:1>", "<urn:page:2>"]


def test_query_matches_sql(spark):
    from corpusprep.llm.registry import OP10_SQL, op10_warc

    sf = "/root/testdata/sf0.001"
    assert compare(spark, sf, op10_warc, OP10_SQL, duck(sf))["hash_match"]


def test_many_marks_are_searched_once():
    """After damage every mark is a place to go on; the time stays in proportion to the file."""
    import time

    marks = [b"WARC/1.", b"WARC/1.1\r\n", b"WARC/1.1\r\nContent-Length: 5\r\n", b"WARC/1.1\r\nContent-Length: 10\r\n\r\nxxxx", b"\x1f\x8b\x08", b"\x1f\x8b\x08" + bytes(7)]
    for mark in marks:
        took = []
        for size in (1 << 18, 1 << 20):
            data = record(b"x" * 200, 1) + mark * (size // len(mark)) + record(b"y" * 200, 2)
            start = time.process_time()
            got, gaps = ids(warc.salvage(data))
            took.append(time.process_time() - start)
            assert got == ["<urn:page:1>", "<urn:page:2>"] and len(gaps) == 1
        assert took[1] < 8 * took[0] + 1, (mark, took)


def test_gzip_headers_with_names():
    import struct
    import zlib

    body = record(b"named" * 50, 3)
    deflated = zlib.compressobj(9, zlib.DEFLATED, -15)
    packed = deflated.compress(body) + deflated.flush()
    tail = struct.pack("<II", zlib.crc32(body), len(body))
    for flags, head in ((8, b"name.warc\0"), (24, b"name\0comment\0"), (4, b"\x03\0abc"), (30, b"\x02\0xyname\0c\0\x12\x34")):
        member = b"\x1f\x8b\x08" + bytes([flags]) + b"\0\0\0\0\0\3" + head + packed + tail
        assert ids(warc.salvage(member + gzip.compress(record(b"z", 4)))) == (["<urn:page:3>", "<urn:page:4>"], [])
        assert ids(warc.salvage(member[:-6] + b"!!" + gzip.compress(record(b"z" * 300, 4))))[0][-1] == "<urn:page:4>"
