import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from amberline.llm import warc
from amberline.llm.warc import read_archives, write_archives


def frame(spark, rows):
    # columns with names that the operator uses itself
    return spark.createDataFrame([(p, u, h, "x", 1, "y") for p, u, h in rows], "page_id long, url string, html string, digest string, part int, kind string")


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain_version(rows, min_bytes=0):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for page, _, html in order:
        payload = (html or "").encode()
        facts = (page, len(payload), digest(payload))
        if len(payload) < min_bytes or payload not in first:
            first.setdefault(payload, page)
            out.append((*facts, "response", None))
        else:
            out.append((*facts, "revisit", first[payload]))
    return sorted(out, key=str)


def result(read):
    return sorted((tuple(r) for r in read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ODD = ([(i, f"http://a.b/{i}", f"<p>{i % 9} ü</p>\r\n\r\nWARC/1.1\r\n" * (i % 9)) for i in range(60)]
       + [(70, None, "x"), (71, "", "x"), (72, "http://c.d/ e\r\nX-Page-ID: 5", "x" * 2000), (73, "http://é/", None), (74, "u", ""), (75, "u", "\r\n\r\n"),
          (76, "long", "word " * 400_000), (77, "long too", "word " * 400_000)]
       + [(None, "n", "only without id"), (None, "n", "only without id"), (None, "m", "only without id"), (None, "n", "x"), (78, "r", "same row"), (78, "r", "same row")])


def archives(folder):
    """Every record of every file by a parser of its own: (fields, block)."""
    out = []
    for path in sorted(folder.glob("part-*")):
        data = gzip.decompress(path.read_bytes()) if path.suffix == ".gz" else path.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            assert len(fields) == len(lines) - 1
            size = int(fields["Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            out.append((fields, rest[:size]))
            data = rest[size + 4:]
    return out


@pytest.mark.parametrize("min_bytes,compress", [(0, True), (0, False), (2, True), (10_000_000, True)])
def test_equals_plain_version(spark, tmp_path, min_bytes, compress):
    folder = str(tmp_path / "w")
    write_archives(frame(spark, ODD).repartition(5), folder, min_bytes=min_bytes, compress=compress)
    assert result(read_archives(spark, folder)) == plain_version(ODD, min_bytes)


def test_archives_are_whole(spark, tmp_path):
    write_archives(frame(spark, ODD).repartition(5), str(tmp_path / "w"), date="2020-01-02T03:04:05Z")
    found = archives(tmp_path / "w")
    assert len(found) == len(ODD)
    ids = [f["WARC-Record-ID"] for f, _ in found]
    assert len(set(ids)) == len(ids)
    kept = {}
    for fields, block in found:
        head, _, body = block.partition(b"\r\n\r\n")
        assert fields["WARC-Date"] == "2020-01-02T03:04:05Z"
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == f"sha1:{digest(body)}" and f"Content-Length: {len(body)}".encode() in head
            kept[fields["WARC-Record-ID"]] = fields
        else:
            assert not body and fields["WARC-Profile"] == warc.PROFILE
    assert len({f["WARC-Payload-Digest"] for f in kept.values()}) == len(kept) == len({(h or "") for _, _, h in ODD})
    for fields, _ in found:
        if fields["WARC-Type"] == "revisit":
            original = kept[fields["WARC-Refers-To"]]
            assert original["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert original.get("X-Page-ID") == fields.get("X-Refers-To-Page-ID")
            assert original.get("WARC-Target-URI") == fields.get("WARC-Refers-To-Target-URI")
    assert "http://c.d/%20e%0D%0AX-Page-ID:%205" in [f.get("WARC-Target-URI") for f, _ in found]


def test_payloads_come_back(spark, tmp_path):
    folder = str(tmp_path / "w")
    write_archives(frame(spark, ODD), folder)
    rows = read_archives(spark, folder, payloads=True).collect()
    by_digest = {r.payload_digest: bytes(r.payload) for r in rows if r.record_type == "response"}
    html = sorted(((r.page_id, by_digest[r.payload_digest].decode()) for r in rows), key=str)
    assert html == sorted(((p, h or "") for p, _, h in ODD), key=str)


def test_files_are_bounded(spark, tmp_path):
    rows = [(i, "u", f"{i} " * 2_000) for i in range(400)]
    write_archives(frame(spark, rows).coalesce(1), str(tmp_path / "w"), compress=False, segment_bytes=20_000, file_segments=2)
    sizes = [p.stat().st_size for p in (tmp_path / "w").glob("part-*")]
    assert max(sizes) < 2 * (20_000 + 12_000) and sum(sizes) > sum(len(h) for _, _, h in rows)
    assert result(read_archives(spark, str(tmp_path / "w"))) == plain_version(rows)


def test_hot_payload_and_hot_row(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", "the same") for i in range(5, 500)] + [(None, "n", "the same too")] * 300 + [(i, "v", f"other {i}") for i in range(500, 700)]
    monkeypatch.setattr(warc, "HOT_ROWS", 20)  # the broadcast side as well
    for n, df in enumerate((frame(spark, rows).repartition(8), frame(spark, rows).coalesce(1))):
        write_archives(df, str(tmp_path / f"w{n}"))
        assert result(read_archives(spark, str(tmp_path / f"w{n}"))) == plain_version(rows)


def test_payloads_of_revisits_are_not_shuffled(spark):
    df = frame(spark, ODD)
    plan = warc.page_headers(df)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.split("Exchange")[0]
    assert "html" not in exchange and "payload" not in exchange


def test_empty_table_and_broken_archives(spark, tmp_path):
    write_archives(frame(spark, []), str(tmp_path / "w"))
    assert read_archives(spark, str(tmp_path / "w")).collect() == []
    good = warc.record("response", 1, "u", hashlib.sha1(b"ab").digest(), 2, "", None, None, b"ab", "d")
    assert len(list(warc.parse(io.BytesIO(good + b"\r\n\r\n")))) == 1
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(good)))
    packed = gzip.compress(good + b"\r\n\r\n")
    assert len(list(warc.parse(warc._open(packed + packed)))) == 2
    with pytest.raises(ValueError):
        list(warc.parse(warc._open(packed[:-12])))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/part-1").write_bytes(good[:-1] + b"x\r\n\r\n")
    with pytest.raises(Exception, match="digest"):
        read_archives(spark, str(tmp_path / "bad")).collect()


def test_query_leaves_no_archives(spark, small):
    from amberline.llm import queries

    out = queries.QUERIES["op13_warc_revisits"](spark, small)
    pages = [(r.page_id, None, r.html) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", F.col("html")).collect()]
    assert result(out) == plain_version(pages)
