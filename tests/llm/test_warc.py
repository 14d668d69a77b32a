"""WARC bundles: seek table, random access, revisits."""

import zstandard

from citystream.llm import warc
from citystream.session import scratch_path


def test_bundle_frames_are_independent(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 700)
    w = warc.BundleWriter(f"file://{tmp_path}")
    payloads = [b"", b"x" * 5000, "é\r\n\r\nWARC/1.1\r\n".encode(), *(b"y%d" % i for i in range(20))]
    records = [warc.record(i, f"http://a/{i} \n", p, None, False, "2020-01-01T00:00:00Z") for i, p in enumerate(payloads)]
    places = [w.add(r) for r in records]
    w.close()
    reader = warc.BundleReader(f"file://{tmp_path}/{w.name}")
    assert len(reader.frames) > 3
    for i in reversed(range(len(records))):
        data = reader.record(*places[i])
        assert data == records[i]
        head, http, payload, end = warc.parse(data)
        assert payload == payloads[i] and end == len(data) and head["WARC-Record-ID"] == f"<urn:page:{i}>"
    # Any Zstandard reader can read the whole file: the seek table is skippable.
    with open(tmp_path / w.name, "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(records)


def test_round_trip_and_revisits(spark):
    big = "<p>" + "z" * 400_000
    rows = [(1, "u1", "same", 0), (2, "u2", "same", 0), (7, None, "same", 0), (3, "u3", None, 0), (4, "u4", "", 0), (5, "u5", big, 0),
            (None, "u6", "same", 0), (2 ** 60 + 1, "u7", "alone é", 0), (6, "u8", "twice", 0), (6, "u8", "twice", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes int")
    sha = lambda s: warc.digest((s or "").encode())
    out = sorted(map(tuple, warc.archive_round_trip(df).collect()), key=str)
    assert out == sorted([
        (1, 4, sha("same"), "revisit", 7), (2, 4, sha("same"), "revisit", 7), (7, 4, sha("same"), "response", None),
        (3, 0, sha(""), "revisit", 4), (4, 0, sha(""), "response", None), (5, len(big), sha(big), "response", None),
        (None, 4, sha("same"), "revisit", 7), (2 ** 60 + 1, 8, sha("alone é"), "response", None),
        (6, 5, sha("twice"), "response", None), (6, 5, sha("twice"), "response", None)], key=str)
    kept = sorted(map(tuple, warc.archive_round_trip(df, min_bytes=5).collect()), key=str)
    assert [r[3] for r in kept if r[1] < 5] == ["response"] * 6
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_read_one_record(spark):
    df = spark.createDataFrame([(i, f"u{i}", f"text {i}") for i in range(50)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(df, folder)
    (data,) = warc.read_record(spark, index, folder, 33)
    assert warc.parse(data)[2] == b"text 33"


def test_large_ids_beside_nulls_stay_exact(spark):
    """Ids over 2^53, equal payloads and rows without an id in one frame."""
    big = 2 ** 60
    rows = [(big + 1, "u", "same"), (big + 3, "u", "same"), (None, "u", "same"), (big + 5, "u", "own"), (None, "u", "lone"), (7, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    out = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.archive_round_trip(df).collect()), key=str)
    assert out == sorted([(big + 1, "revisit", big + 3), (big + 3, "response", None), (None, "revisit", big + 3), (big + 5, "response", None),
                          (None, "response", None), (7, "response", None)], key=str)
