import hashlib
import io
import zipfile

import pytest

from transferlake.llm import warc

BIG = "<html>" + "é😀 text " * 40 + "</html>"
PAGES = [
    (5, "http://a/\r\nX: y", BIG), (3, "http://b", BIG), (9, None, BIG), (9, None, BIG),
    (1, "http://c", "small"), (2, "http://d", "small"), (4, "http://e", None), (6, "http://f", ""),
    (None, "http://g", BIG), (None, "http://h", "<p>" * 60), (None, "http://h", "<p>" * 60), (7, "http://i", "<i>\r\n\r\n" * 30), (8, "http://j", "x" * 300_000),
]


def brute(pages):
    first = {}
    for p, _, html in pages:
        if html and len(html.encode()) >= 100 and p is not None:
            first[html] = min(p, first.get(html, p))
    out = []
    for p, _, html in pages:
        raw, f = (html or "").encode(), first.get(html)
        out.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "response" if f is None or f == p else "revisit", None if f is None or f == p else f))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, digest string, first string")


def back(spark, rows, dest):
    manifest = warc.write(pages(spark, rows), dest)
    df = warc.pages_of(warc.records(warc.listed(manifest)))
    return manifest, sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def test_round_trip_with_awkward_rows(spark, tmp_dir):
    manifest, got = back(spark, PAGES, tmp_dir)
    assert got == brute(PAGES)
    assert sum(r["records"] for r in manifest.collect()) == len(PAGES)


def test_many_packages_and_a_hot_payload(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 4000)
    rows = [(i, f"http://h/{i}", BIG if i % 3 == 0 else f"<b>{i}</b>" * 30) for i in range(200)]
    manifest, got = back(spark, rows, tmp_dir)
    assert got == brute(rows) and manifest.count() > 5


def test_empty_table(spark, tmp_dir):
    manifest, got = back(spark, [], tmp_dir)
    assert got == [] and manifest.count() == 0


def test_a_file_outside_the_manifest_is_not_read(spark, tmp_dir):
    lost = warc.write(pages(spark, PAGES[:2]), tmp_dir)
    manifest, got = back(spark, PAGES, tmp_dir)
    assert lost.count() and got == brute(PAGES)


def zipped(monkeypatch, zip64, method=zipfile.ZIP_STORED, members=3, comment=b""):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for i in range(members):
            z.writestr(zipfile.ZipInfo(f"dir/mémber-{i}"), bytes([i]) * (40 + i), method)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"a note PK\x05\x06 " * 3])
def test_directories(monkeypatch, zip64, comment):
    if comment and not zip64:
        comment = b"a plain note"
    elif comment:
        comment = b""
    raw = zipped(monkeypatch, zip64, comment=comment)
    assert (b"PK\x06\x06" in raw) == zip64
    asked = []

    def read_at(n, at):
        asked.append((n, at))
        return raw[at:at + n]
    package = warc.Package(read_at, len(raw))
    for i in range(3):
        start, length = package.located(f"dir/mémber-{i}")
        assert raw[start:start + length] == bytes([i]) * (40 + i)


def test_compressed_members_are_refused(monkeypatch):
    raw = zipped(monkeypatch, False, zipfile.ZIP_DEFLATED)
    package = warc.Package(lambda n, at: raw[at:at + n], len(raw))
    with pytest.raises(ValueError):
        package.located("dir/mémber-0")
    with pytest.raises(ValueError):
        warc.Package(lambda n, at: b"x" * n, 30)


def test_members_are_found_without_an_index():
    import gzip
    parts = [gzip.compress(bytes([65 + i]) * (1 + 5000 * i)) for i in range(5)]
    raw = b"##" + b"".join(parts)
    places = list(warc._walk(lambda n, at: raw[at:at + n], 2, len(raw) - 2, 16))
    assert [raw[2 + o:2 + o + n] for o, n in places] == parts


def test_indexes_of_other_writers(spark, tmp_dir):
    """Hand-made package: two archive members, a plain and a gzipped CDXJ with numbers as text, and a member without one."""
    import gzip
    import json
    from pyarrow import fs
    texts = {f"data-{a}.warc.gz": [f"<p>{a} {i}</p>" * 20 for i in range(4)] for a in "abc"}
    out, n = io.BytesIO(), 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        lines = {}
        for name, payloads in texts.items():
            body = io.BytesIO()
            for p in payloads:
                digest = hashlib.sha256(p.encode()).hexdigest()
                packed = gzip.compress(warc.record(n, f"http://www.Example.org:80/{n}?q={{1}}", p.encode(), digest, None, "2024-05-06T07:08:09Z"))
                lines.setdefault(name, []).append("org,example)/%d 20240506070809 " % n + json.dumps(
                    {"url": "x", "mime": "text/html", "status": "200", "length": str(len(packed)), "offset": str(body.tell()), "filename": name}))
                body.write(packed)
                n += 1
            z.writestr(f"archive/{name}", body.getvalue())
        z.writestr("indexes/index.cdxj", "!meta 0 {\"format\": \"cdxj\"}\n" + "\n".join(lines["data-a.warc.gz"]) + "\n\n")
        z.writestr("indexes/more.cdx.gz", gzip.compress("\n".join(lines["data-b.warc.gz"]).encode()))
    store, base = fs.FileSystem.from_uri(f"file://{tmp_dir}") if "://" not in tmp_dir else fs.FileSystem.from_uri(tmp_dir)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/p.zip") as f:
        f.write(out.getvalue())
    places = warc.listed(spark.createDataFrame([(f"{tmp_dir}/p.zip",)], "package string"))
    rows = {r["page_id"]: r for r in warc.pages_of(warc.records(places)).collect()}
    every = [p for own in texts.values() for p in own]
    assert len(rows) == 12
    for i, p in enumerate(every):
        assert (rows[i]["payload_bytes"], rows[i]["payload_digest"]) == (len(p), hashlib.sha256(p.encode()).hexdigest())


def test_index_lines():
    text = warc.index_lines([("http://www.Example.org:80/A b?x={1}", "2024-05-06T07:08:09Z", 7, 9, "sha256:0"), ("", "2024", 0, 7, "sha256:1"), ("[bad", "2024", 16, 1, "s")])
    assert "org,example)/a%20b?x={1} 20240506070809 {" in text and text.split("\n")[:-1] == sorted(text.split("\n")[:-1])
    told = [x for x in text.split("\n") if x]
    assert len(told) == 3


def test_a_hot_payload_is_split(spark, tmp_dir):
    """A third of the pages share a payload: the join that marks them is split, not broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.files.maxPartitionBytes": "20k"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    rows = [(i, f"http://h/{i}", BIG if i % 3 == 0 else f"<b>{i}</b>" * 30 if i % 3 == 1 else "") for i in range(6000)]
    pages(spark, rows).repartition(12).write.parquet(f"{tmp_dir}/in")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = warc.marked(spark.read.parquet(f"{tmp_dir}/in"))
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 6000 and sum(r["refers_to"] == 0 for r in got) == 1999
    assert "skew=true" in plan
