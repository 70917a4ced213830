import base64
import hashlib
import gzip
import io

import pytest

from corpusflow.llm import warc as W
from corpusflow.llm.common import new_path

PAGES = "page_id long, url string, html string, headers string"


def rows():
    out = [(k, f"http://h{k % 3}.org/p{k}", f"<p>page {k % 7}</p>", "c") for k in range(30)]
    return out + [(100, None, None, None), (101, "http://x.org/ä b\r\nInjected: yes", "", "c"), (102, "u", "ü" * 50_000, "c"), (103, "u", "WARC/1.1\r\n\r\n\r\nWARC-Type: response", "c"), (-5, "u", "<p>page 1</p>", "c"), (None, "u", "<p>page 2</p>", "c"), (29, "again", "<p>page 1</p>", "c")]


def plain(data, least):
    top, out = {}, []
    for page, _, text, _ in data:
        if page is not None and len((text or "").encode()) >= least:
            top[text or ""] = max(top.get(text or "", page), page)
    for page, _, text, _ in data:
        raw = (text or "").encode()
        first = top.get(text or "")
        again = first is not None and page != first and len(raw) >= least
        out.append((str(page), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", str(first) if again else "None"))
    return sorted(out)


def test_round_trip(spark):
    for least, options in ((0, {}), (13, {"compression": "gzip"})):
        path = new_path(spark, "warc")
        W.write_warc(spark.createDataFrame(rows(), PAGES).repartition(5), path, least, **options)
        got = W.read_warc(spark, path).where("record_type <> 'warcinfo'")
        got = got.select(W.page_of(W.F.col("record_id")).alias("p"), "payload_bytes", "payload_digest", "record_type", W.page_of(W.F.col("refers_to")).alias("r"), "payload", "target_uri").collect()
        assert sorted((str(r.p), r.payload_bytes, r.payload_digest, r.record_type, str(r.r)) for r in got) == plain(rows(), least)
        by = {(r.p, r.target_uri): r for r in got}
        assert bytes(by[102, "u"].payload).decode() == "ü" * 50_000 and by[100, None].payload_bytes == 0
        assert by[101, "http://x.org/ä b%0D%0AInjected: yes"].record_type in ("response", "revisit")


def test_predicates_are_pushed_down(spark):
    path = new_path(spark, "warc")
    W.write_warc(spark.createDataFrame(rows(), PAGES), path)
    kept = W.read_warc(spark, path).where("record_type = 'revisit' AND target_uri LIKE 'http://h1%' AND payload_bytes > 1")
    plan = kept._sc._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
    pushed = plan.split("PushedFilters")[1].split("\n")[0]
    assert "record_type" in pushed and "target_uri" in pushed and "payload_bytes" not in pushed
    assert {r.target_uri[:9] for r in kept.collect()} == {"http://h1"} and {r.record_type for r in kept.collect()} == {"revisit"}
    assert all(r.payload is None for r in W.read_warc(spark, path, payload="false").collect())
    assert W.read_warc(spark, path).where("record_type IN ('warcinfo')").count() >= 1


def test_skips_unwanted_blocks():
    raw = W.record([("WARC-Type", "response"), ("Content-Type", "text/plain")], b"x" * 1000) + W.record([("WARC-Type", "metadata")], b"keep") + b""

    class Source(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            self.taken += n
            return super().read(n)

    source = Source(raw)
    got = list(W.records(source, lambda h: h.first("warc-type") == "metadata", True))
    assert [(h.first("WARC-TYPE"), n, b) for h, n, b in got] == [("metadata", 4, b"keep")] and source.taken == 4


def test_partitions_and_empty(spark, tmp_path):
    path = new_path(spark, "warc")
    W.write_warc(spark.createDataFrame(rows(), PAGES).repartition(6), path)
    assert W.read_warc(spark, path, partitionBytes="1").rdd.getNumPartitions() == 6
    assert W.read_warc(spark, path).rdd.getNumPartitions() == 1
    assert W.read_warc(spark, str(tmp_path)).collect() == []
    W.write_warc(spark.createDataFrame([], PAGES), path)
    assert W.read_warc(spark, path).where("record_type <> 'warcinfo'").count() == len(rows())
    assert not [p for p in tmp_path.iterdir()]


HTTP = ("Content-Type", "application/http;msgtype=response")
WHOLE = {
    "resource": W.record([("WARC-Type", "resource"), ("Content-Type", "text/plain")], b"x" * 1000),
    "response": W.record([("WARC-Type", "response"), HTTP], b"HTTP/1.1 200 OK\r\nContent-Length: 900\r\n\r\n" + b"y" * 900),
    "revisit": W.record([("WARC-Type", "revisit"), HTTP], b"HTTP/1.1 200 OK\r\nContent-Length: 900\r\n\r\n"),
}


@pytest.mark.parametrize("kind", sorted(WHOLE))
@pytest.mark.parametrize("payloads", [True, False])
def test_truncated_archives_are_errors(kind, payloads):
    raw = W.record([("WARC-Type", "metadata")], b"first") + WHOLE[kind]
    begin = len(raw) - len(WHOLE[kind])
    everything, nothing = lambda h: True, lambda h: h.first("WARC-Type") == "metadata"
    assert len(list(W.records(io.BytesIO(raw), everything, payloads))) == 2
    assert len(list(W.records(io.BytesIO(raw), nothing, payloads))) == 1
    # In the headers, in the block's first line, within the payload, before and within the trailer.
    for cut in sorted({begin + 12, raw.index(b"\r\n\r\n", begin) + 6, len(raw) - 504, len(raw) - 5, len(raw) - 4, len(raw) - 3, len(raw) - 1}):
        if cut <= begin:
            continue
        for wanted in (everything, nothing):
            with pytest.raises(ValueError, match="archive ends"):
                list(W.records(io.BytesIO(raw[:cut]), wanted, payloads))
            with pytest.raises((ValueError, EOFError)):
                list(W.records(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(raw[:cut]))), wanted, payloads))
    with pytest.raises(EOFError):
        list(W.records(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(raw)[:-20])), nothing, payloads))


def test_truncated_archive_fails_the_query(spark, tmp_path):
    (tmp_path / "cut.warc").write_bytes(WHOLE["resource"][:-500])
    for options in ({}, {"payload": "false"}):
        with pytest.raises(Exception, match="archive ends within"):
            W.read_warc(spark, str(tmp_path), **options).collect()
