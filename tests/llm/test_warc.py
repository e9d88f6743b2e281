"""Archives: round trip, dictionary frames, damage."""

import hashlib
import base64
import io

import pytest
import zstandard

from storelens.llm import warc

ROWS = [(1, "http://a/ x\n", b"<p>one</p>"), (2, None, b"<p>one</p>"), (3, "http://b", None), (4, "http://c", b""),
        (5, "http://d", "ünïcödé 漢字".encode() * 5000), (None, "http://e", b"<p>one</p>"), (7, "http://f", b"only"),
        (None, "g", b"lonely"), (None, "g", b"lonely"), (1, "http://a/ x\n", b"<p>one</p>")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, payload binary").selectExpr(
        "page_id", "url", "coalesce(payload, binary('')) AS payload")


def expected(rows):
    first = {}
    for i, _, p in rows:
        if i is not None:
            first[p or b""] = min(i, first.get(p or b"", i))
    out = []
    for i, _, p in rows:
        p = p or b""
        ref = first.get(p)
        revisit = ref is not None and ref != i
        out.append((i, "revisit" if revisit else "response", len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    ref if revisit else None))
    return sorted(out, key=repr)


def archived(spark, frame, **args):
    return warc.write_archives(frame, warc.archive_folder(spark), **args)


def test_round_trip(spark):
    rows = warc.read_archives(archived(spark, pages(spark))).collect()
    found = sorted(((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in rows), key=repr)
    assert found == expected(ROWS)
    bodies = sorted(bytes(r.payload) for r in rows if r.record_type == "response")
    assert "ünïcödé 漢字".encode() * 5000 in bodies and b"" in bodies
    assert {r.url for r in rows if r.page_id == 1} == {"http://a/%20x%0A"} and {r.url for r in rows if r.page_id == 2} == {None}


def test_empty_table_and_least_payload(spark):
    assert warc.read_archives(archived(spark, pages(spark, ROWS[:0]))).count() == 0
    rows = warc.read_archives(archived(spark, pages(spark), least=100)).collect()
    assert {r.record_type for r in rows} == {"response"}


def test_files_begin_with_a_dictionary_and_hold_a_frame_per_record(spark):
    row = archived(spark, pages(spark, [(i, "u", f"<p>text {i}</p>".encode() * 50) for i in range(500)]).coalesce(1)).first()
    data = open(row.path.removeprefix("file://"), "rb").read()
    assert data[:4] == warc.DICTIONARY_MAGIC
    assert sum(1 for _ in warc.frames(io.BytesIO(data), "x")) == row.records == 500
    plain = zstandard.ZstdCompressor(level=3)
    undressed = b"".join(plain.compress(warc.record(i, "u", b"body")) for i in range(3))
    assert [warc.parse_record(d, "x")["page_id"] for d in warc.frames(io.BytesIO(undressed), "x")] == ["0", "1", "2"]
    raw = zstandard.ZstdCompressionDict(b"WARC/1.1 raw dictionary text " * 9, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    body = zstandard.ZstdCompressor(dict_data=raw).compress(warc.record(9, "u", b"body"))
    head = warc.DICTIONARY_MAGIC + len(raw.as_bytes()).to_bytes(4, "little") + raw.as_bytes()
    assert [warc.parse_record(d, "x")["payload"] for d in warc.frames(io.BytesIO(head + body), "x")] == [b"body"]


@pytest.mark.parametrize("damage", [
    lambda d: d.replace(b"Content-Length: 86", b"Content-Length: 87"), lambda d: d[:-4], lambda d: d + b"x",
    lambda d: d.replace(b"body", b"bodi"), lambda d: d.replace(b"WARC/1.1", b"WARC/9.9"),
    lambda d: d.replace(b"WARC-Date", b"WARC-Late"), lambda d: d.replace(b"WARC-Type: response", b"WARC-Type: revisit")])
def test_damaged_records_are_refused(damage):
    good = warc.record(1, "u", b"body")
    assert warc.parse_record(good, "x")["payload"] == b"body"
    bad = damage(good)
    if bad != good:
        with pytest.raises(ValueError):
            warc.parse_record(bad, "x")


def test_cut_off_archive_is_refused():
    data = zstandard.ZstdCompressor().compress(warc.record(1, "u", b"body" * 1000))
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(data[:-5]), "x"))
