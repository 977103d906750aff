"""WARC round trip, revisits and salvage."""

import hashlib
import io
import random
import re

import pytest
from pyarrow import fs

from tripspot.llm.warc import Gap, Record, member, read_archives, record, salvage, write_archives

DATE = "2024-01-01T00:00:00Z"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def raw(i, payload, refers=None):
    return record(i, f"http://x/{i}", payload, sha(payload), refers, DATE)


def pieces(packed):
    rng = random.Random(2)
    payloads = [bytes(rng.choices(b"abcdefgh <>\r\n", k=n)) for n in (0, 10, 300, 5000, 200_000, 70)]
    return payloads, [member(raw(i, p)) if packed else raw(i, p) for i, p in enumerate(payloads)]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archive(packed):
    payloads, parts = pieces(packed)
    found = list(salvage(io.BytesIO(b"".join(parts))))
    assert [f.payload for f in found] == payloads
    assert found[0].start == 0 and all(a.stop == b.start for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "noise", "front", "missing"])
def test_records_after_damage_are_recovered(packed, damage):
    payloads, parts = pieces(packed)
    parts = [bytearray(p) for p in parts]
    lost = {3}
    if damage == "flip":
        parts[3][len(parts[3]) // 2] ^= 0x55
    elif damage == "cut":
        parts[5] = parts[5][:-9]
        lost = {5}
    elif damage == "noise":
        parts.insert(3, bytearray(b"noise WARC/1.1 \x1f\x8b\x08 more\nWARC/1.1\r\nfalse start"))
        lost = set()
    elif damage == "front":
        parts[0] = bytearray(b"junk") + parts[0]
        lost = set()
    else:
        parts[3] = parts[3][:100]
    data = bytes(b"".join(parts))
    found = list(salvage(io.BytesIO(data)))
    assert [f.payload for f in found if isinstance(f, Record)] == [p for i, p in enumerate(payloads) if i not in lost]
    gaps = [f for f in found if isinstance(f, Gap)]
    assert len(gaps) == 1 and gaps[0].problem
    # Records and gaps cover every byte once.
    ends = [(f.start, f.stop) for f in found]
    assert ends[0][0] == 0 and ends[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def several(damage):
    """An archive of three members of five records each, with one kind of damage in the second."""
    payloads = [bytes(random.Random(i).choices(b"abcdefgh <>\r\n", k=20_000 + i)) for i in range(15)]
    texts = [bytearray(raw(i, p)) for i, p in enumerate(payloads)]
    if damage == "content":  # inside the third record of the member, before it was packed
        texts[7][len(texts[7]) // 2] ^= 1
    elif damage == "length":
        texts[5] = texts[5].replace(b"Content-Length: 2", b"Content-Length: 1", 2)
    elif damage == "first":
        texts[5][0] ^= 1
    members = [bytearray(member(b"".join(texts[i : i + 5]))) for i in (0, 5, 10)]
    if damage == "cut":
        members[1] = members[1][:-9]
    elif damage == "half":
        members[1] = members[1][: len(members[1]) // 2]
    elif damage == "flip":
        members[1][len(members[1]) * 7 // 10] ^= 0x55
    elif damage == "checksum":
        members[1][-6] ^= 0x55
    return payloads, b"".join(members)


@pytest.mark.parametrize(
    "damage, lost, gaps",
    [("none", set(), 0), ("content", {7}, 1), ("length", {5}, 1), ("first", {5}, 1), ("checksum", set(), 1), ("cut", {9}, 1)],
)
def test_sound_records_of_a_damaged_member(damage, lost, gaps):
    payloads, data = several(damage)
    found = list(salvage(io.BytesIO(data)))
    got = [f.payload for f in found if isinstance(f, Record)]
    want = [p for i, p in enumerate(payloads) if i not in lost]
    assert got == want or damage == "cut" and got == payloads  # the bytes cut may be the checksum's alone
    assert sum(isinstance(f, Gap) for f in found) == gaps
    ends = [(f.start, f.stop) for f in found]
    assert ends[0][0] == 0 and ends[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("damage", ["half", "flip"])
def test_records_before_the_break_of_a_member(damage):
    payloads, data = several(damage)
    found = list(salvage(io.BytesIO(data)))
    got = [payloads.index(f.payload) for f in found if isinstance(f, Record)]
    assert got[:5] == [0, 1, 2, 3, 4] and got[-5:] == [10, 11, 12, 13, 14] and set(got[5:-5]) >= {5, 6} and got == sorted(set(got))
    assert [f for f in found if isinstance(f, Gap)]


def test_records_without_a_digest_need_their_member():
    bare = [re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", raw(i, b"x" * 50)) for i in range(3)]
    sound = member(b"".join(bare))
    assert [f.payload for f in salvage(io.BytesIO(sound))] == [b"x" * 50] * 3
    broken = bytearray(sound)
    broken[-6] ^= 1
    assert [type(f) for f in salvage(io.BytesIO(bytes(broken)))] == [Gap]


def test_a_member_is_unpacked_bit_by_bit():
    import tracemalloc

    texts = [raw(i, bytes([97 + i % 26]) * 1_000_000) for i in range(60)]
    data = member(b"".join(texts))
    tracemalloc.start()
    assert sum(isinstance(f, Record) for f in salvage(io.BytesIO(data))) == 60
    assert tracemalloc.get_traced_memory()[1] < 12_000_000
    tracemalloc.stop()


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("url", ["data:," + "é" * 100_000, "http://x/WARC/1.1", "http://x/WARC/1.0", "data:," + "y" * 300_000 + "WARC/1.1"])
def test_long_and_version_like_urls(packed, url):
    parts = [record(i, u, b"page", sha(b"page"), None, DATE) for i, u in enumerate(["http://x", url, "http://x"])]
    whole = [member(p) if packed else p for p in parts]
    found = list(salvage(io.BytesIO(b"".join(whole))))
    assert [f.headers["warc-target-uri"] for f in found] == ["http://x", url, "http://x"]
    if not packed:  # cut after its url: the next record must not be taken for the rest of it
        data = parts[1][: parts[1].index(url.encode()) + len(url.encode())] + parts[2]
        assert [type(f) for f in salvage(io.BytesIO(data))] == [Gap, Record]


def test_version_like_url_needs_a_digest():
    data = b"WARC/1.1\r\nWARC-Target-URI: http://xWARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert [type(f) for f in salvage(io.BytesIO(data))] == [Gap, Record]


def test_empty_and_hopeless_files():
    assert list(salvage(io.BytesIO(b""))) == []
    assert list(salvage(io.BytesIO(b"x" * 3_000_000))) == [Gap(0, 3_000_000, "no record begins here")]


PAGES = "page_id long, url string, html string, file string, digest string, first string"


def rows():
    long = "é" * 80
    return [(3, "http://a", long), (5, "http://b\r\nX: y", long), (2, None, long), (9, "c", "short"), (10, "c", "short"),
            (11, "d", None), (12, "d", ""), (None, "e", long), (4, "f", "x" * 300_000), (2, None, long)]


def test_round_trip(spark, scratch):
    pages = spark.createDataFrame([(*r, r[1], r[2], None) for r in rows()], PAGES).repartition(3)
    files = write_archives(pages, scratch, scratch.path("archives"))
    records, gaps = read_archives(files, scratch)
    got = sorted((tuple(r) for r in records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    expected = []
    for i, _, html in rows():
        data = (html or "").encode()
        revisit = len(data) == 160 and i != 2
        expected.append((i, len(data), sha(data), "revisit" if revisit else "response", 2 if revisit else None))
    assert got == sorted(expected, key=str)
    assert gaps.count() == 0


def test_long_urls_round_trip(spark, scratch):
    html = "page " * 50
    urls = ["data:," + "x" * 200_000, "http://x/WARC/1.1", "http://x"]
    pages = spark.createDataFrame([(i, u, html, "", "", "") for i, u in enumerate(urls)], PAGES).coalesce(1)
    records, gaps = read_archives(write_archives(pages, scratch, scratch.path("archives")), scratch)
    got = sorted(tuple(r) for r in records.select("page_id", "payload_bytes", "record_type").collect())
    assert got == [(0, 250, "response"), (1, 250, "revisit"), (2, 250, "revisit")] and gaps.count() == 0


def test_damaged_files_are_logged(spark, scratch):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50, "", "", "") for i in range(20)], PAGES).coalesce(1)
    files = write_archives(pages, scratch, scratch.path("archives"))
    path = files.first().file
    system, base = fs.FileSystem.from_uri(path)
    with system.open_input_file(base) as stream:
        data = bytearray(stream.read())
    data[len(data) // 2] ^= 0xFF
    with system.open_output_stream(base, compression=None) as stream:
        stream.write(bytes(data))
    records, gaps = read_archives(files, scratch)
    assert records.count() == 19 and gaps.count() == 1


def test_empty(spark, scratch):
    files = write_archives(spark.createDataFrame([], PAGES), scratch, scratch.path("archives"))
    records, gaps = read_archives(files, scratch)
    assert records.count() == 0 and gaps.count() == 0
