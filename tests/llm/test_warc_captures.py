"""Archives written, read back and assembled."""

import hashlib

import pytest

from promoscope.llm import warc_captures as wc

BIG = "<html>" + "é" * 100 + "\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n</html>"
PAGES = [(5, "http://a/x", BIG), (3, "http://b/y\r\nEvil: 1", BIG), (9, None, BIG), (1, "u", None), (2, "u", ""),
         (4, "u", "short"), (6, "u", "short"), (7, "u", "z" * 100_000), (3, "again", BIG),
         (None, "null id", BIG), (None, "n", "q" * 200), (None, "n", "q" * 200)]


def plain(pages):
    least = {}
    for p, _, h in pages:
        if h and len(h.encode()) >= 100 and p is not None:
            least[h] = min(p, least.get(h, p))
    out = []
    for p, _, h in pages:
        b = (h or "").encode()
        first = least.get(h)
        again = first is not None and p != first
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=str)


def test_captures_match_plain_version(spark, monkeypatch):
    monkeypatch.setattr(wc, "ARCHIVE_BYTES", 20_000)
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    got = sorted((tuple(r) for r in wc.page_captures(df).collect()), key=str)
    assert got == plain(PAGES)


def test_nested_captures(spark, tmp_out):
    df = spark.createDataFrame(PAGES[:2], "page_id long, url string, html string")
    wc.write_archives(df, f"{tmp_out}/w", tmp_out)
    rows = wc.assemble(wc.read_records(spark, f"{tmp_out}/w")).collect()
    assert len(rows) == 2
    for r in rows:
        assert r["request"]["target_uri"] == r["response"]["target_uri"]
        assert "page_id" in r["metadata"]["fields"] and r["response"]["date"] == wc.DATE
    kinds = {r["response"]["type"]: r for r in rows}
    assert bytes(kinds["response"]["response"]["payload"]).decode() == BIG
    assert kinds["revisit"]["response"]["refers_to"] == "urn:page:3"


def test_lone_records_and_empty_table(spark):
    rec = ("request", "q1", "gone", "u", "d", *[None] * 7)
    one = wc.assemble(spark.createDataFrame([rec], wc.RECORD)).collect()[0]
    assert one["response"] is None and one["request"]["record_id"] == "q1"
    empty = spark.createDataFrame([], "page_id long, url string, html string, extra int")
    assert wc.page_captures(empty).collect() == []


def test_broken_archives_are_errors():
    good = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in wc.parse_archive(good * 2)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(wc.parse_archive(good + b"junk\r\n\r\n"))
    with pytest.raises(ValueError):
        list(wc.parse_archive(good[:-6]))


def test_files_are_cut_by_bytes(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(wc, "ARCHIVE_BYTES", 50_000)
    # Small pages first, then a run of large ones, and one beyond the limit.
    pages = [(i, "u", "s" * 150 + str(i)) for i in range(200)] + [
        (200 + i, "u", "l" * 20_000 + str(i)) for i in range(20)] + [(300, "u", "h" * 90_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    wc.write_archives(df, f"{tmp_out}/w", tmp_out)
    files = spark.read.format("binaryFile").load(f"{tmp_out}/w").select("content").collect()
    sizes, most = [], 0
    for f in files:
        data = wc._inflated(bytes(f["content"]))
        sizes.append(len(data))
        kinds = [h["warc-type"] for h, _ in wc.parse_archive(data)]
        assert kinds == ["request", "response", "metadata"] * (len(kinds) // 3)
        most = max(most, len(kinds))
    assert sum(x > 50_010 for x in sizes) == 1 and max(sizes) < 95_000
    assert 10 < len(sizes) < 20 and most > 100
    got = sorted((tuple(r) for r in wc.page_captures(df).collect()), key=str)
    assert got == plain(pages)
