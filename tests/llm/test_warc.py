import hashlib
import io
import random
from collections import Counter

import pytest

from threadlens.llm import warc

SCHEMA = "page_id bigint, url string, html string, kind string, refers_to string, file string"


def pages(spark):
    rows = [(i, f"http://a/{i}", ("x" * 60 + "é") * (i % 3 + 1) * (1 if i % 4 else 0)) for i in range(24)]
    rows += [(90, None, None), (91, "u\r\nX: y", "tiny"), (92, "u", "tiny"), (5, "again", rows[5][2]), (None, "n", "q" * 200), (None, "n", rows[1][2])]
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA), rows


def brute(rows):
    out = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        first = min(same) if same else None
        revisit = len(body) >= 100 and first is not None and page != first
        out[page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    return out


def test_round_trip(spark):
    table, rows = pages(spark)
    found = warc.archive_round_trip(table.repartition(3))
    assert Counter(tuple(r) for r in found.collect()) == brute(rows)


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_payloads_and_urls_come_back(spark, tmp_path):
    table, _ = pages(spark)
    manifest = warc.write_archives(table, str(tmp_path / "w"))
    found = {(r["page_id"], r["record_type"]): r for r in warc.read_archives(manifest, with_payload=True).collect()}
    assert found[91, "response"]["url"] == "u%0D%0AX:%20y" and found[91, "response"]["payload"] == b"tiny"
    assert found[90, "response"]["url"] is None


RECORDS = [warc.record_bytes(i, f"http://h/{i}", bytes(random.Random(i).randbytes(50 + 400 * i)), None) for i in range(8)]


def read(data):
    return list(warc.salvage(io.BytesIO(data)))


def covered(found, size):
    """Records and gaps follow each other without holes over the whole file."""
    spans = sorted({(a, b) for a, b, _, _ in found})
    assert spans[0][0] == 0 and spans[-1][1] == size
    assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("pack", [warc.member, lambda r: r])
@pytest.mark.parametrize("victim", [0, 3, 7])
def test_damage_costs_one_record(pack, victim):
    parts = [pack(r) for r in RECORDS]
    start = sum(map(len, parts[:victim]))
    data = bytearray(b"".join(parts))
    data[start + len(parts[victim]) - 30] ^= 255
    found = read(bytes(data))
    ids = [r.headers["warc-record-id"] for _, _, r, _ in found if r]
    assert ids == [f"<urn:page:{i}>" for i in range(8) if i != victim]
    gaps = [(a, b) for a, b, r, _ in found if r is None]
    assert gaps == [(start, start + len(parts[victim]))]
    covered(found, len(data))


@pytest.mark.parametrize("pack", [warc.member, lambda r: r])
def test_cut_junk_and_lost_bytes(pack):
    parts = [pack(r) for r in RECORDS]
    cut = b"".join(parts)[:-20]
    found = read(cut)
    assert sum(r is not None for _, _, r, _ in found) == 7 and found[-1][2] is None
    junk = b"\x1f\x8b\x08junk WARC/1.1 junk" * 3
    data = junk + parts[0] + parts[1][:-9] + parts[2] + junk + parts[3]
    found = read(data)
    assert [r.headers["warc-record-id"] for _, _, r, _ in found if r] == [f"<urn:page:{i}>" for i in (0, 2, 3)]
    covered(found, len(data))


def test_whole_file_member_and_empty_file():
    found = read(warc.member(b"".join(RECORDS)))
    assert len(found) == 8
    assert read(b"") == []
    assert [f[2] for f in read(b"no archive at all")] == [None]


def test_gap_rows(spark, tmp_path):
    path = tmp_path / "d.warc.gz"
    parts = [warc.member(r) for r in RECORDS]
    path.write_bytes(parts[0] + parts[1][5:] + parts[2])
    files = spark.createDataFrame([(str(path),)], "file string")
    found = sorted(warc.read_archives(files).collect(), key=lambda r: r["begins"])
    assert [r["kind"] for r in found] == ["record", "gap", "record"]
    assert (found[1]["begins"], found[1]["ends"]) == (len(parts[0]), len(parts[0]) + len(parts[1]) - 5)
    assert found[1]["reason"]
