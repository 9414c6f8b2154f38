"""WARC in ZIP packages (3): write records, then range-read them through the ZIP directories.

Every task writes the records it has as packages: one ZIP whose members are stored, not
deflated: ``archive/data.warc.gz`` (one gzip member a record), ``indexes/index.cdxj`` (a line of sort
key, time and JSON for every record, sorted) and ``datapackage.json``. A package has a name of its own for each
attempt, and only those in the manifest, which is stored when all tasks are done, are read: a
retried or lost task leaves a file that nothing reads.

The reader never extracts: from a package's end it finds the (ZIP64) end record and central
directory, from a member's local header where its bytes start, reads the indexes by range, and
then every record by its own range. Indexes are lines of CDXJ (sort key, time, JSON; gzipped too;
several of them, of several archive members, numbers as text or not) or bare JSON; archive members
that no index names are walked through. Members that are not stored are refused.

Records with equal payloads of at least 100 bytes: that of the smallest page_id is the response,
others revisit it (rows that share this page_id are all responses). Null html is an empty
payload; null page ids come last in a group and may head it only where there is no other; null
urls are empty targets. The payload is read back from the response; a revisit has the digest in
its header, and its size is that of the response it refers to.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import struct
import time
import uuid
import zipfile
import zlib
from urllib.parse import SplitResult, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import read, stored, take
from transferlake.session import ensure_checkpoint_dir, shared_dir

LEAST_PAYLOAD = 100
PACKAGE_BYTES = 32 << 20        # payload bytes after which a task begins a new package
READ_BYTES = 8 << 20            # records of so many archive bytes are read by one key
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def _open(path: str):
    """(filesystem, path in it) of a shared folder's path."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


# --- records ---------------------------------------------------------------------------------

def record(page_id, url, payload: bytes, digest: str, refers_to, when: str) -> bytes:
    """One WARC/1.1 record. ``refers_to`` None: a response with the payload, else a revisit."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {when}", "WARC-Target-URI: " + (url or "").replace("\r", "").replace("\n", ""), f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict, bytes]:
    """(headers by lower-case name, payload) of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict((k.lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block


# --- indexes ---------------------------------------------------------------------------------

def sort_key(url: str) -> str:
    """Sort-friendly form of a URL: host labels reversed, then the path, without blanks."""
    at = urlsplit(url) if "[" not in url and "]" not in url else SplitResult("", "", url, "", "")
    host = (at.netloc.rpartition("@")[2].lower().removeprefix("www.")).split(":")[0]
    rest = at.path + ("?" + at.query if at.query else "")
    return re.sub(r"\s", "%20", f"{','.join(reversed(host.split('.')))}){rest or '/'}".lower())


def index_lines(entries: list[tuple]) -> str:
    """CDXJ of (url, WARC-Date, offset, length, digest) of the member ``MEMBER``."""
    lines = [f"{sort_key(url)} {re.sub('[^0-9]', '', when)[:14]} " + json.dumps(
        {"url": url, "digest": digest, "length": str(length), "offset": str(offset), "filename": MEMBER.rpartition("/")[2]})
        for url, when, offset, length, digest in entries]
    return "".join(f"{x}\n" for x in sorted(lines))


def index_entries(raw: bytes):
    """(file name or '', offset, length) of every entry of an index."""
    for line in (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace").split("\n"):
        told = line if line.startswith("{") else line.partition(" ")[2].partition(" ")[2]
        if told.startswith("{") and not line.startswith("!"):
            x = json.loads(told)
            if "offset" in x and "length" in x:
                yield str(x.get("filename") or "").rpartition("/")[2], int(x["offset"]), int(x["length"])


# --- ZIP directories -------------------------------------------------------------------------

class Package:
    """A ZIP file behind ``read_at(length, offset)``: its directory and its stored members."""

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        tail_at = max(0, size - 65557)                      # end record, longest comment
        tail = read_at(size - tail_at, tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack("<HII", tail[end + 10:end + 20])
        locator = tail_at + end - 20
        if locator >= 0 and (head := read_at(20, locator))[:4] == b"PK\x06\x07":
            at = struct.unpack("<Q", head[8:16])[0]
            count, length, start = struct.unpack("<QQQ", read_at(56, at)[32:56])
        self.members = dict(self._directory(read_at(length, start), count))

    @staticmethod
    def _directory(raw: bytes, count: int):
        at = 0
        for _ in range(count):
            if raw[at:at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            flags, method = struct.unpack("<HH", raw[at + 8:at + 12])
            packed, full, name_n, extra_n, note_n = struct.unpack("<IIHHH", raw[at + 20:at + 34])
            place = struct.unpack("<I", raw[at + 42:at + 46])[0]
            name = raw[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
            extra, p = raw[at + 46 + name_n:at + 46 + name_n + extra_n], 0
            while p + 4 <= len(extra):
                kind, n = struct.unpack("<HH", extra[p:p + 4])
                if kind == 1:                                # ZIP64: the fields that did not fit, in order
                    wide = iter(struct.unpack(f"<{n // 8}Q", extra[p + 4:p + 4 + n // 8 * 8]))
                    full = next(wide) if full == 0xFFFFFFFF else full
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    place = next(wide) if place == 0xFFFFFFFF else place
                p += 4 + n
            yield name, (method, place, packed)
            at += 46 + name_n + extra_n + note_n

    def located(self, name: str) -> tuple[int, int]:
        """(offset, length) of a stored member's bytes in the package."""
        method, place, length = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed: it can't be read by range")
        local = self.read_at(30, place)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        return place + 30 + sum(struct.unpack("<HH", local[26:30])), length


def _walk(read_at, start: int, length: int, step: int = 1 << 20):
    """(offset, length) of every gzip member of a range, for packages without an index."""
    at, end = start, start + length
    while at < end:
        unpack, here = zlib.decompressobj(31), at
        while not unpack.eof and here < end:
            chunk = read_at(min(step, end - here), here)
            unpack.decompress(chunk)
            here += len(chunk)
        stop = here - len(unpack.unused_data)
        yield at - start, stop - at
        at = stop


# --- jobs ------------------------------------------------------------------------------------

def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to of every page (null: a response)."""
    rows = take(pages, page_id="bigint", url="string", html="string").select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    first = (rows.where(F.octet_length("html") >= LEAST_PAYLOAD).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"))
    # Stored, so that the join of a payload with a third of the pages can be split; small payloads,
    # which have no partner, get keys of their own and are spread.
    first = stored(first, "warc-first").withColumnRenamed("digest", "_key")
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    rows = rows.withColumn("_digest", F.when(F.octet_length("html") >= LEAST_PAYLOAD, F.col("digest")).otherwise(own))
    return rows.join(first, rows["_digest"] == first["_key"], "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write(pages: DataFrame, dest: str, when: str | None = None) -> DataFrame:
    """Writes packages under ``dest``; returns their manifest (package, records), stored."""
    when = when or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def package(body: io.BytesIO, index: list) -> tuple[str, int]:
        store, base = _open(dest)
        store.create_dir(base, recursive=True)
        name, out = f"pages-{uuid.uuid4().hex}.zip", io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.writestr(MEMBER, body.getvalue())
            z.writestr(INDEX, index_lines(index))
            z.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [{"path": MEMBER}, {"path": INDEX}]}))
        with store.open_output_stream(f"{base}/{name}") as f:
            f.write(out.getbuffer())
        return f"{dest}/{name}", len(index)

    def run(parts):
        body, index, held = io.BytesIO(), [], 0
        for pdf in parts:
            made = []
            for page_id, url, html, digest, refers_to in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["digest"], pdf["refers_to"]):
                page_id, refers_to = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                payload = html.encode("utf-8", "surrogatepass")
                packed = gzip.compress(record(page_id, url, payload, digest, refers_to, when), 6, mtime=0)
                index.append(((url or "").replace("\r", "").replace("\n", ""), when, body.tell(), len(packed), f"sha256:{digest}"))
                body.write(packed)
                held += len(payload)
                if held >= PACKAGE_BYTES:
                    made.append(package(body, index))
                    body, index, held = io.BytesIO(), [], 0
            if made:
                yield pd.DataFrame(made, columns=["package", "records"])
        if index:
            yield pd.DataFrame([package(body, index)], columns=["package", "records"])

    # page ids as text: a column of longs with nulls would come to pandas as floats.
    texts = marked(pages).withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    return stored(texts.mapInPandas(run, "package string, records bigint"), "warc-manifest")


def listed(manifest: DataFrame) -> DataFrame:
    """(package, offset, length) of every record, from the packages' directories and indexes."""
    def run(parts):
        for pdf in parts:
            for path in pdf["package"]:
                store, name = _open(path)
                with store.open_input_file(name) as f:
                    def read_at(n, at, f=f):
                        f.seek(at)
                        return f.read(n)
                    zipped = Package(read_at, f.size())
                    places, indexed = [], {}
                    for index in (m for m in zipped.members if re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", m)):
                        at, n = zipped.located(index)
                        for named, offset, size in index_entries(read_at(n, at)):
                            indexed.setdefault(named, set()).add((offset, size))
                    archives = [m for m in zipped.members if m.endswith(".warc.gz")]
                    for member in archives:
                        start, length = zipped.located(member)
                        told = indexed.get(member.rpartition("/")[2]) or (indexed.get("") if len(archives) == 1 else None)
                        if told:
                            places += [(path, start + o, n) for o, n in sorted(told)]
                        else:
                            places += [(path, start + o, n) for o, n in _walk(read_at, start, length)]
                yield pd.DataFrame(places, columns=["package", "offset", "length"])
    return manifest.select("package").repartition("package").mapInPandas(run, "package string, offset bigint, length bigint")


def records(places: DataFrame) -> DataFrame:
    """Range-reads the records: page_id, record_type, refers_to, url, digest (header), payload
    digest and size as read (null for revisits, which carry no payload)."""
    def run(parts):
        opened, path_now = None, None
        try:
            for pdf in parts:
                out = []
                for path, offset, length in zip(pdf["package"], pdf["offset"], pdf["length"]):
                    if path != path_now:
                        if opened is not None:
                            opened.close()
                        store, name = _open(path)
                        opened, path_now = store.open_input_file(name), path
                    opened.seek(offset)
                    fields, payload = parse(gzip.decompress(opened.read(length)))
                    whole = fields["warc-type"] == "response"
                    out.append((fields["warc-record-id"][10:-1] or None, fields["warc-type"], fields.get("warc-refers-to", "")[10:-1] or None,
                                fields["warc-target-uri"], fields["warc-payload-digest"].partition(":")[2],
                                hashlib.sha256(payload).hexdigest() if whole else None, str(len(payload)) if whole else None))
                yield pd.DataFrame(out, columns=["page_id", "record_type", "refers_to", "url", "digest", "read_digest", "read_bytes"], dtype=object)
        finally:
            if opened is not None:
                opened.close()
    near = places.repartition("package", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("package", "offset")
    read_ = near.mapInPandas(run, "page_id string, record_type string, refers_to string, url string, digest string, read_digest string, read_bytes string")
    return read_.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to", "read_bytes")})


def pages_of(rows: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url; a revisit takes size
    and digest from the response it refers to."""
    responses = (rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("_of"), F.col("digest").alias("_digest"))
                 .agg(F.max("read_bytes").alias("_bytes"), F.max("read_digest").alias("_read")))
    responses = stored(responses, "warc-responses")
    joined = rows.join(responses, (rows["refers_to"] == responses["_of"]) & (rows["digest"] == responses["_digest"]), "left")
    return joined.select("page_id", F.coalesce("read_bytes", "_bytes").alias("payload_bytes"), F.coalesce("read_digest", "_read").alias("payload_digest"),
                         "record_type", "refers_to", "url")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    manifest = write(read(spark, sf_dir, "pages"), shared_dir(spark, "llm", "warc", unique=True))
    rows = stored(records(listed(manifest)), "warc-records")
    return pages_of(rows).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
     f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {LEAST_PAYLOAD} GROUP BY d HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first IS DISTINCT FROM page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
