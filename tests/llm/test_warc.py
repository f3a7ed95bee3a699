import hashlib
import random
import zlib

import pytest

from examloom.llm.queries import QUERIES
from examloom.llm.warc import NOTHING, read_archives, record_bytes, resolved, salvage, with_revisits, write_archives
from examloom.session import fresh_path

SF = "/root/testdata/sf0.001"
DATE = "2024-01-01T00:00:00Z"


def plain(k, payload=b"x" * 50):
    return record_bytes(f"urn:r:{k}", f"http://h/{k}", payload, None, DATE, "text/html")


def packed(raw):
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def seen(data):
    out = list(salvage(data))
    ids = [f["warc-record-id"][7:-1] for _, _, why, f, _ in out if not why]
    gaps = [(place, length) for place, length, why, _, _ in out if why]
    assert sum(length for _, length in gaps) <= len(data)
    return ids, gaps


@pytest.mark.parametrize("form", [plain, lambda k: packed(plain(k))])
def test_salvage_of_damaged_archives(form):
    parts = [form(k) for k in range(6)]
    whole = b"".join(parts)
    assert seen(whole) == (list("012345"), [])
    starts = [sum(map(len, parts[:k])) for k in range(7)]
    for k in range(6):
        broken = bytearray(whole)
        middle = (starts[k] + starts[k + 1]) // 2
        broken[middle] ^= 0xFF
        ids, gaps = seen(bytes(broken))
        assert ids == [str(i) for i in range(6) if i != k] and gaps == [(starts[k], len(parts[k]))]
        cut = whole[: starts[k] + 5] + whole[starts[k + 1] :]
        ids, gaps = seen(cut)
        assert ids == [str(i) for i in range(6) if i != k] and gaps == [(starts[k], 5)]
    assert seen(b"junk" + whole + b"tail") == (list("012345"), [(0, 4), (4 + len(whole), 4)])
    assert seen(whole[:-3])[0] == list("01234")
    assert seen(b"") == ([], []) and seen(NOTHING) == ([], [])


def test_salvage_inside_a_member():
    records = [plain(k, b"%d" % k * 3000) for k in range(5)]
    raw = bytearray(b"".join(records))
    bad = sum(map(len, records[:2])) + len(records[2]) - 100
    raw[bad] ^= 0xFF
    out = list(salvage(packed(bytes(raw))))
    assert [f["warc-record-id"][7:-1] for _, _, why, f, _ in out if not why] == list("0134")
    begin = sum(map(len, records[:2]))
    assert [(p, n, why) for p, n, why, _, _ in out if why] == [
        (0, len(records[2]), f"block digest differs, at {begin} of the member's content")
    ]


def test_records_of_a_member_cut_short():
    rng = random.Random(1)
    records = [plain(k, bytes(rng.randrange(256) for _ in range(3000))) for k in range(5)]
    member = packed(b"".join(records))
    broken = bytearray(member)
    broken[len(member) - 4000] ^= 0xFF
    for data in (member[:-4000], bytes(broken)):
        out = list(salvage(data + packed(plain("next"))))
        told = [f["warc-record-id"][7:-1] for _, _, why, f, _ in out if why and f]
        assert told[:3] == list("012") and set(told) <= set("01234") and len(told) < 5
        assert [f["warc-record-id"][7:-1] for _, _, why, f, _ in out if not why] == ["next"]
        assert [(p, n) for p, n, why, f, _ in out if not f] == [(0, len(data))]


def test_salvage_of_noise():
    rng = random.Random(5)
    for _ in range(30):
        data = bytes(rng.randrange(256) for _ in range(200)) + packed(plain("z")) + b"WARC/1.1\r\nx"
        ids, gaps = seen(data)
        assert ids == ["z"] and gaps


def test_round_trip_with_damage(spark):
    rows = [(f"urn:p:{k}", f"http://x/{k}\r\ny", ("<p>é</p>\r\n\r\n" * k).encode() if k else None, None) for k in range(40)]
    rows += [("urn:p:r", None, rows[39][2], "urn:p:39"), (None, "u", b"\x00\xff\x1f\x8b\x08", None)]
    df = spark.createDataFrame(rows, "record_id string, uri string, payload binary, refers_to string").coalesce(1)
    path = fresh_path(spark, "warc")
    write_archives(df, path, DATE, per_file=15)
    got = {r.record_id: r for r in read_archives(spark, path).collect()}
    assert len(got) == 42 and all(r.problem is None for r in got.values())
    assert all(bytes(got[i].payload) == (p or b"") for i, _, p, t in rows if i and not t)
    assert got["urn:p:r"].record_type == "revisit" and got["urn:p:r"].payload is None
    assert got["urn:p:r"].payload_digest == hashlib.sha1(rows[39][2]).hexdigest()
    assert bytes(got["urn:none"].payload) == b"\x00\xff\x1f\x8b\x08"
    sizes = {r.record_id: r.payload_bytes for r in resolved(read_archives(spark, path)).collect()}
    assert sizes["urn:p:r"] == len(rows[39][2])
    assert spark.read.format("binaryFile").load(path).count() >= 3
    write_archives(df.limit(0), path + "-none")
    assert read_archives(spark, path + "-none").count() == 0


def test_revisits_of_ties_and_nulls(spark):
    big, small = b"a" * 1000, b"a" * 999
    rows = [(1, big), (3, big), (2, big), (None, big), (5, small), (6, small), (7, None), (8, b""), (9, b"b" * 1000), (9, b"b" * 1000)]
    df = spark.createDataFrame([(i, p, "d") for i, p in rows], "id long, payload binary, uri string")
    got = sorted((r.id or 0, r.refers_to or 0) for r in with_revisits(df).collect())
    assert got == [(0, 3), (1, 3), (2, 3), (3, 0), (5, 0), (6, 0), (7, 0), (8, 0), (9, 0), (9, 0)]


def test_reading_is_linear_in_the_file():
    """Bytes handed to the unpacker a record, at two sizes of one file."""
    fed = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def decompress(self, piece):
            fed.append(len(piece))
            return self.inner.decompress(piece)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    made = zlib.decompressobj
    one = packed(plain("x", bytes(range(256)) * 10))
    shares = []
    for n in (100, 1600):
        fed.clear()
        zlib.decompressobj = lambda bits: Counting(made(bits))
        try:
            assert sum(1 for _ in salvage(one * n)) == n
        finally:
            zlib.decompressobj = made
        shares.append(sum(fed) / n)
    assert abs(shares[0] - shares[1]) < 0.05 * shares[0] and shares[1] < 3 * 4096


def test_null_and_repeated_page_ids(spark, tmp_path):
    big, other = "a" * 1500, "b" * 1200
    rows = [(1, big), (2, big), (2, other), (2, "s"), (None, big), (None, "t"), (None, None), (3, other)]
    df = spark.createDataFrame([(i, "u", h, "x", "y") for i, h in rows], "page_id long, url string, html string, digest string, first_id string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in QUERIES["op3_warc"](spark, str(tmp_path)).collect()]
    want = [
        (1, 1500, "revisit", 2), (2, 1500, "response", None), (2, 1200, "revisit", 3), (2, 1, "response", None),
        (None, 1500, "revisit", 2), (None, 1, "response", None), (None, 0, "response", None), (3, 1200, "response", None),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_revisits_keep_other_columns(spark):
    df = spark.createDataFrame([(1, b"z" * 1000, "d", "f", 5), (2, b"z" * 1000, "e", "g", 6)], "id long, payload binary, digest string, first_id string, c int")
    got = sorted((r.id, r.refers_to, r.digest, r.first_id, r.c) for r in with_revisits(df).collect())
    assert got == [(1, 2, "d", "f", 5), (2, None, "e", "g", 6)]


def test_pages_on_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    groups = {}
    for r in pages:
        groups.setdefault((r.html or "").encode(), []).append(r.page_id)
    want = {}
    for raw, ids in groups.items():
        for i in ids:
            first = max(ids) if len(raw) >= 1000 else i
            kind = "response" if i == first else "revisit"
            want[i] = (len(raw), hashlib.sha1(raw).hexdigest(), kind, None if i == first else first)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op3_warc"](spark, SF).collect()}
    assert got == want
