"""WARC archives with a two-level capture index.

Archives: one gzip member per record, so that a record is read by its offset
and length.  Of records with equal payloads the one with the smallest page id
holds the payload, the others are revisits of it.

Index, first level: capture lines sorted by reversed-host URL key, cut into
compressed blocks of a fixed number of lines.  Second level: a sparse directory
with the first key and the place of each block.  A lookup goes to the part of
the index that may hold its key, binary-searches that part's directory, reads
one block by range, binary-searches the block, and then reads the records by
range.

Tasks write files through pyarrow's file systems into a folder that all
executors share.  File names hold a random part; the tables of what was written
are committed by Spark, so files of lost or repeated attempts are never looked
at.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir, stage
from .common import read, schema, small_batches

LEAST_REVISIT = 100             # bytes of payload from which copies are revisits
ARCHIVE_BYTES = 256 << 20       # an archive is closed beyond this
BLOCK_LINES = 2_000             # capture lines of an index block
BROADCAST_ROWS = 500_000        # rows (about 100 bytes) of a side that is broadcast
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n"


def open_folder(uri: str):
    """(file system, path) of a shared folder, by its URI."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def url_key(url: str | None) -> str:
    """Reversed-host key: com,example,www)/path?query, lower-case host and
    scheme dropped; anything that isn't a URL with a host is its own key."""
    if not url:
        return ")"
    try:
        p = urlsplit(url.strip())
        host, port = p.hostname, p.port
    except ValueError:
        return quote(url, safe="/?&=,:;@!$()*+~'-._%#")
    if not host:
        return quote(url, safe="/?&=,:;@!$()*+~'-._%#")
    rest = (p.path or "/") + (f"?{p.query}" if p.query else "")
    key = ",".join(reversed(host.lower().split("."))) + (f":{port}" if port else "") + ")" + rest
    return quote(key, safe="/?&=,:;@!$()*+~'-._%#")


def record_id(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def make_record(page, url: str | None, payload: bytes, digest: str, first) -> bytes:
    """A gzip member with one record; a revisit if ``first`` names a page."""
    revisit = first is not None
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page)), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page is not None:
        head.append(("WARC-Page-ID", str(page)))
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="/?&=,:;@!$()*+~'-._%#[]")))
    if revisit:
        head += [("WARC-Refers-To", record_id(first)), ("WARC-Refers-To-Page-ID", str(first)),
                 ("WARC-Profile",
                  "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    http = _HTTP % len(payload)
    body = http if revisit else http + payload
    head += [("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(body)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + body + b"\r\n\r\n", 1, mtime=0)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a record."""
    raw = gzip.decompress(data)
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields, body.split(b"\r\n\r\n", 1)[1]


def first_copies(pages: DataFrame, page_id: str, payload: str) -> DataFrame:
    """(digest, first): payloads that several records share."""
    return stage(pages.select(F.col(page_id).alias("p"), _digest(payload).alias("digest"),
                              _size(payload).alias("n"))
                 .where(F.col("n") >= LEAST_REVISIT).groupBy("digest")
                 .agg(F.min("p").alias("first"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1").select("digest", "first"), "first-copies")


def _digest(payload: str):
    return F.sha2(F.coalesce(F.col(payload), F.lit("")).cast("binary"), 256)


def _size(payload: str):
    return F.coalesce(F.octet_length(payload), F.lit(0))


def bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   payload: str = "html") -> DataFrame:
    """Writes the archives; (key, page, file, at, size) of each record, staged.

    Of equal payloads of at least LEAST_REVISIT bytes the one with the
    smallest page id is the response (every row that has that id); a null
    payload is empty, a null id is never the smallest.
    """
    kind = pages.schema[page_id].dataType.simpleString()
    marked = (pages.select(F.col(page_id).alias("page"), F.col(url).alias("url"),
                           F.coalesce(F.col(payload), F.lit("")).alias("payload"),
                           _digest(payload).alias("digest"))
              .join(bounded(first_copies(pages, page_id, payload)), "digest", "left")
              .select("page", "url", "payload", "digest",
                      F.when(F.col("page").eqNullSafe(F.col("first")), None)
                      .otherwise(F.col("first")).alias("first")))

    def write(batches):
        disk, path = open_folder(folder)
        out, name, at = None, "", 0
        for b in batches:
            keys, files, ats, sizes = [], [], [], []
            for page, u, body, digest, first in zip(*(b.column(c).to_pylist() for c in (
                    "page", "url", "payload", "digest", "first"))):
                if out is None:
                    name, at = f"archive-{uuid.uuid4().hex}.warc.gz", 0
                    out = disk.open_output_stream(f"{path}/{name}", compression=None)
                data = make_record(page, u, body.encode(), digest, first)
                out.write(data)
                keys.append(url_key(u))
                files.append(name)
                ats.append(at)
                sizes.append(len(data))
                at += len(data)
                if at > ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), b.column("page"), pa.array(files, pa.string()),
                 pa.array(ats, pa.int64()), pa.array(sizes, pa.int64())],
                names=["key", "page", "file", "at", "size"])
        if out is not None:
            out.close()

    disk, path = open_folder(folder)
    disk.create_dir(path, recursive=True)
    return stage(marked.mapInArrow(write, schema(
        f"key string, page {kind}, file string, at long, size long")), "captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the blocks and directories; (part, low, file, directory), staged:
    the first key of each part of the index and its two files."""
    def write(batches):
        disk, path = open_folder(folder)
        name = f"index-{uuid.uuid4().hex}"
        lines: list[str] = []
        entries: list[list] = []
        out, at, low = None, 0, None

        def close_block():
            nonlocal at
            data = zlib.compress("\n".join(lines).encode(), 6)
            out.write(data)
            entries.append([lines[0].split(" ", 1)[0], at, len(data)])
            at += len(data)
            lines.clear()

        for b in batches:
            for key, page, file, where, size in zip(*(b.column(c).to_pylist() for c in (
                    "key", "page", "file", "at", "size"))):
                if out is None:
                    out, low = disk.open_output_stream(f"{path}/{name}.blocks"), key
                lines.append(f"{key} {json.dumps([page, file, where, size])}")
                if len(lines) >= BLOCK_LINES:
                    close_block()
        if out is not None:
            if lines:
                close_block()
            out.close()
            with disk.open_output_stream(f"{path}/{name}.directory") as d:
                d.write(json.dumps(entries).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([low], pa.string()), pa.array([name], pa.string())],
                names=["low", "name"])

    disk, path = open_folder(folder)
    disk.create_dir(path, recursive=True)
    # the record's place is in the order, so that one frequent key is cut too
    return stage(captures.repartitionByRange("key", "file", "at")
                 .sortWithinPartitions("key", "file", "at")
                 .mapInArrow(write, schema("low string, name string")), "index-parts")


def look_up(keys: DataFrame, parts: DataFrame, folder: str, page_kind: str = "bigint") -> DataFrame:
    """(key, page, file, at, size) of all captures of the distinct ``key``s."""
    table = sorted((r["low"], r["name"]) for r in parts.collect())   # one row per range partition
    lows = [low for low, _ in table]

    @F.pandas_udf("array<int>")
    def parts_of(key):
        import pandas as pd
        # a key that begins a part may have begun in the parts before it
        return pd.Series([list(range(max(0, bisect_left(lows, k) - 1), bisect_right(lows, k)))
                          for k in key])

    def find(batches):
        disk, path = open_folder(folder)
        part = starts = entries = blocks = None
        held: tuple = (-1, [], [])

        def block(i):
            nonlocal held
            if held[0] != i:
                _, at, size = entries[i]
                lines = zlib.decompress(blocks.read_at(size, at)).decode().split("\n")
                held = (i, [x.split(" ", 1)[0] for x in lines], lines)
            return held

        for b in batches:
            out = []
            for key, p in zip(b.column("key").to_pylist(), b.column("part").to_pylist()):
                if p != part:
                    part, held = p, (-1, [], [])
                    name = table[p][1]
                    with disk.open_input_stream(f"{path}/{name}.directory") as d:
                        entries = json.loads(d.read())
                    starts = [e[0] for e in entries]
                    blocks = disk.open_input_file(f"{path}/{name}.blocks")
                i = max(0, bisect_left(starts, key) - 1)
                while i < len(entries) and starts[i] <= key:
                    _, names, lines = block(i)
                    for j in range(bisect_left(names, key), bisect_right(names, key)):
                        out.append((key, *json.loads(lines[j].split(" ", 1)[1])))
                    i += 1
            cols = list(zip(*out)) if out else [[]] * 5
            page = pa.int64() if page_kind == "bigint" else pa.string()
            kinds = [pa.string(), page, pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["key", "page", "file", "at", "size"])

    dealt = (keys.select("key").distinct().withColumn("part", F.explode(parts_of("key")))
             .repartition("part").sortWithinPartitions("part", "key"))
    return dealt.mapInArrow(find, schema(
        f"key string, page {page_kind}, file string, at long, size long"))


def fetch(places: DataFrame, folder: str) -> DataFrame:
    """The records at ``places``: (page, record_type, refers_to, payload_bytes,
    payload_digest, given_digest), the last as the header says."""
    def run(batches):
        disk, path = open_folder(folder)
        name, file = None, None
        for b in batches:
            out = []
            for f, at, size in zip(*(b.column(c).to_pylist() for c in ("file", "at", "size"))):
                if f != name:
                    name, file = f, disk.open_input_file(f"{path}/{f}")
                head, payload = parse_record(file.read_at(size, at))
                kind = head["WARC-Type"]
                out.append((head.get("WARC-Page-ID"), kind, head.get("WARC-Refers-To-Page-ID"),
                            len(payload), hashlib.sha256(payload).hexdigest(),
                            head["WARC-Payload-Digest"].split(":")[1]))
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["page", "record_type", "refers_to",
                                                    "payload_bytes", "payload_digest",
                                                    "given_digest"])

    # neighbouring records of an archive are read by one task
    return (places.repartitionByRange("file", "at").sortWithinPartitions("file", "at")
            .mapInArrow(run, schema("page string, record_type string, refers_to string, "
                                    "payload_bytes long, payload_digest string, "
                                    "given_digest string")))


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                       payload: str = "html", folder: str | None = None) -> DataFrame:
    """Writes archives and index, looks every page up, and reads its record.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to);
    a revisit shows the payload of the record that it refers to.  A null
    payload is empty; null or repeated urls and ids keep a record per row; an
    empty table gives no rows.
    """
    spark = small_batches(pages).sparkSession
    folder = folder or scratch_dir(spark, "warc")
    kind = pages.schema[page_id].dataType.simpleString()
    captures = write_archives(pages, f"{folder}/archives", page_id, url, payload)
    parts = build_index(captures, f"{folder}/index")

    @F.pandas_udf("string")
    def key_of(u):
        return u.map(lambda x: url_key(x if isinstance(x, str) else None))

    keys = pages.select(key_of(F.col(url)).alias("key"))
    got = stage(fetch(look_up(keys, parts, f"{folder}/index", kind), f"{folder}/archives"),
                "records")
    revisits = got.where("record_type = 'revisit'")
    # a page id may stand for several rows, so the digest tells which one is meant
    target = (got.where("record_type = 'response'")
              .join(bounded(stage(revisits.select(F.col("refers_to").alias("page")).distinct(),
                                  "revisited")), "page", "left_semi")
              .groupBy(F.col("page").alias("refers_to"), F.col("payload_digest").alias("given_digest"))
              .agg(F.max("payload_bytes").alias("b")))
    # a revisit whose response is not there has no digest, and raises below
    full = (revisits.join(bounded(stage(target, "revisit-targets")), ["refers_to", "given_digest"],
                          "left")
            .select("page", F.col("b").alias("payload_bytes"),
                    F.when(F.col("b").isNotNull(), F.col("given_digest")).alias("payload_digest"),
                    "record_type", "refers_to", "given_digest"))
    out = got.where("record_type = 'response'").select(*full.columns).unionByName(full)
    sound = F.when(F.col("payload_digest") == F.col("given_digest"), F.col("payload_digest")) \
        .otherwise(F.raise_error(F.lit("a payload does not match its digest")))
    return out.select(F.col("page").cast(kind).alias(page_id), "payload_bytes",
                      sound.alias("payload_digest"), "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))


def op7_warc_capture_index(spark, sf_dir):
    return archive_round_trip(read(spark, sf_dir, "pages"))
