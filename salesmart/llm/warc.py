"""WARC archives: deterministic sharded writer and reader.

Writer: records are sorted by (page_id, payload digest, url) and dealt to
shards whose number and bounds depend on the data alone (total size; byte
quantiles of a hash sample of the records), not on any session setting; each
shard is written as a sequence of ``.warc.gz`` files, one gzip member per
record after a warcinfo record, and a new file begins when the compressed size
reaches ``roll_bytes``.  Record ids, dates, digests and lengths are regenerated from
the content, so the same rows give the same bytes whatever the partitioning.
A task writes under a name of its own attempt; the returned manifest names the
attempt that succeeded, and committing renames those files, in file order, and
stores the manifest last; what failed attempts left is removed.  A file that
no manifest names is not part of the archive.

Of records with equal payloads (at least ``min_bytes``) the one with the
largest page_id is a response, the others are revisits that refer to it.

Null html is an empty payload; a null url an empty target.  Rows with a null
page_id are written (without a page number) and never referred to while
another row has the payload.  Rows that repeat in full are written once each,
the largest id's first copy being the response.  An empty table gives an empty
manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.tables import only
from salesmart.llm.textops import freed, row_blocks, text_buffer

DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: str, url: str, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {digest} {copy}')}>"


def header_value(text: str) -> str:
    """A url on one header line: line ends are percent-encoded."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str, payload: bytes, digest: str, copy: int, refers: tuple | None) -> bytes:
    """One record as its own gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: {record_id(str(page_id), url, digest, copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {header_value(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if refers:
        page, target = refers
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(str(page), target, digest, 0)}",
                 f"WARC-Refers-To-Target-URI: {header_value(target)}", f"WARC-Refers-To-Date: {DATE}",
                 f"Refers-To-Page: {'' if page is None else page}", f"Payload-Length: {len(payload)}"]
    return member(head, block)


def file_head(name: str) -> bytes:
    """The warcinfo record that opens the file ``name``."""
    block = b"software: salesmart\r\nformat: WARC File Format 1.1\r\n"
    return member([
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        f"WARC-Date: {DATE}", f"WARC-Filename: {name}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"], block)


def member(head: list[str], block: bytes) -> bytes:
    raw = ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=6, mtime=0, filename="") as f:
        f.write(raw)
    return out.getvalue()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; a bare path is local or mounted."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_warc(pages: DataFrame, target: str, *, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = 0, shard_bytes: int = 32 << 20,
               roll_bytes: int = 32 << 20, max_shards: int = 1 << 14) -> DataFrame:
    """Writes the archive under ``target`` and returns its manifest (file,
    shard, part, records, bytes, sha256), which is also stored there."""
    spark = pages.sparkSession
    rows = only(pages, id_col, url_col, html_col).select(
        F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    total = rows.agg(F.sum(F.length("payload") + 512)).first()[0] or 0
    n = int(min(max(1, -(-total // shard_bytes)), max_shards))
    # Shard bounds: byte quantiles of the 32 n records with the smallest
    # hashes, a sample that depends on the records only.  Null ids come first
    # and are told apart by their digests.
    known = rows.select(F.col("page_id").isNotNull().alias("known"), F.coalesce("page_id", F.lit(0)).alias("page"), "digest",
                        F.length("payload").alias("size")).distinct()
    sample = sorted((r.known, r.page, r.digest, r.size) for r in known.orderBy(
        F.xxhash64("page", "digest"), "page", "digest", "known").limit(32 * n).collect()) if n > 1 else []
    bounds, seen, whole = [], 0, sum(r[3] + 512 for r in sample)
    for *key, size in sample:
        seen += size + 512
        if len(bounds) < n - 1 and seen * n >= whole * (len(bounds) + 1):
            bounds.append(tuple(key))

    # The response of every payload that more than one record has.  Digest
    # and id alone are shuffled for it; the payload is shuffled once, to its shard.
    lead = rows.where(F.length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("first_page"), F.count("*").alias("n"),
        F.min_by("url", F.struct(F.col("page_id").isNull(), -F.col("page_id"), F.col("url"))).alias("first_url"),
    ).where("n > 1").drop("n")
    marks = rows.select("page_id", "url", "digest").join(lead, "digest").select(
        "page_id", "url", "digest", "first_page", "first_url").distinct()
    both = rows.withColumn("mark", F.lit(1)).unionByName(
        marks.withColumn("mark", F.lit(0)), allowMissingColumns=True)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [bisect_left(bounds, (p is not None, p or 0, d)) for p, d in zip(b["page_id"].to_pylist(), b["digest"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *b.columns], names=["shard", *b.schema.names])

    kinds = ", ".join(f"{c} {t}" for c, t in both.dtypes)
    dealt = both.mapInArrow(freed(deal), f"shard int, {kinds}").repartitionById(n, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "digest", "url", "mark")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(target)
        attempt = uuid.uuid4().hex
        fs.create_dir(f"{base}/_attempts", recursive=True)
        shard = part = stream = None
        size = count = copy = 0
        mark = last = leader = None
        sha, done = hashlib.sha256(), []

        def close():
            nonlocal stream
            if stream is not None:
                stream.close()
                done.append((f"{attempt}-{shard:06d}-{part:05d}", shard, part, count, size, sha.hexdigest()))
                stream = None

        for b in blocks(batches):
            for s, page, url, payload, digest, is_row, first, first_url in zip(*(b[c].to_pylist() for c in (
                    "shard", "page_id", "url", "payload", "digest", "mark", "first_page", "first_url"))):
                key = (page, url, digest)
                if not is_row:
                    mark = (key, first, first_url)
                    continue
                if s != shard:
                    close()
                    shard, part = s, 0
                copy = copy + 1 if key == last else 0
                last = key
                refers = None
                if mark is not None and mark[0] == key:
                    # The largest id responds; of its own copies (they stand
                    # together) the first.
                    if page != mark[1] or leader == (page, digest):
                        refers = mark[1:]
                    else:
                        leader = (page, digest)
                raw = record(page, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), copy, refers)
                if stream is not None and size + len(raw) > roll_bytes:
                    close()
                    part += 1
                if stream is None:
                    stream = fs.open_output_stream(f"{base}/_attempts/{attempt}-{shard:06d}-{part:05d}")
                    count, sha, first_bytes = 0, hashlib.sha256(), file_head(file_name(shard, part))
                    stream.write(first_bytes)
                    sha.update(first_bytes)
                    size = len(first_bytes)
                stream.write(raw)
                sha.update(raw)
                size += len(raw)
                count += 1
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate(
                (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            names=["temporary", "shard", "part", "records", "bytes", "sha256"])

    return commit(spark, dealt.mapInArrow(
        freed(write), "temporary string, shard int, part int, records bigint, bytes bigint, sha256 string"), target)


def file_name(shard: int, part: int) -> str:
    return f"part-{shard:06d}-{part:05d}.warc.gz"


def blocks(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``size`` payload bytes (one row at least)."""
    for b in batches:
        for lo, hi in row_blocks(text_buffer(b["payload"])[1], size):
            yield b.slice(lo, hi - lo)


def commit(spark: SparkSession, written: DataFrame, target: str) -> DataFrame:
    """Renames the files of successful attempts to their final names, one row
    per file, then stores the manifest.  Run again after a failure it finds
    the files that are already in place."""
    fs, base = file_system(target)
    if fs.get_file_info(f"{base}/manifest").type != pafs.FileType.NotFound:
        raise FileExistsError(f"{target} holds an archive already")
    staged = f"{target}/_staged"
    written.write.mode("overwrite").parquet(staged)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(target)
        for b in batches:
            names = [file_name(s, p) for s, p in zip(b["shard"].to_pylist(), b["part"].to_pylist())]
            for temporary, name in zip(b["temporary"].to_pylist(), names):
                if fs.get_file_info(f"{base}/_attempts/{temporary}").type == pafs.FileType.File:
                    fs.move(f"{base}/_attempts/{temporary}", f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *b.columns[1:]], names=["file", *b.schema.names[1:]])

    spark.read.parquet(staged).mapInArrow(
        freed(rename), "file string, shard int, part int, records bigint, bytes bigint, sha256 string"
    ).write.mode("errorifexists").parquet(f"{target}/manifest")
    if fs.get_file_info(f"{base}/_attempts").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_attempts")
    return spark.read.parquet(f"{target}/manifest")


def parse_member(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def members(raw: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of a file, one after another; what a member leaves of
    a slice is read again, so the rest of the file is not copied each time."""
    at = 0
    while at < len(raw):
        d, out = zlib.decompressobj(31), []
        while not d.eof:
            part = raw[at: at + step]
            if not part:
                raise ValueError("a member is cut short")
            out.append(d.decompress(part))
            at += len(part) - len(d.unused_data)
        yield b"".join(out)


def read_warc(spark: SparkSession, target: str) -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest,
    refers_to, record_id) of every record of the manifest's files.

    Payload digests of responses and all block digests are checked; files are
    at most a roll size, so one is read at a time."""
    listed = spark.read.parquet(f"{target}/manifest").select("file", "sha256")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(target)
        for b in batches:
            for name, sha in zip(b["file"].to_pylist(), b["sha256"].to_pylist()):
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    raw = f.read()
                if hashlib.sha256(raw).hexdigest() != sha:
                    raise ValueError(f"{name} differs from the manifest")
                rows = []
                for one in members(raw):
                    h, block = parse_member(one)
                    if f"sha1:{base32_sha1(block)}" != h["WARC-Block-Digest"]:
                        raise ValueError(f"{name}: block digest of {h['WARC-Record-ID']}")
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload = None
                    if h["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if base32_sha1(payload) != digest:
                            raise ValueError(f"{name}: payload digest of {h['WARC-Record-ID']}")
                    size = len(payload) if payload is not None else int(h["Payload-Length"])
                    page, ref = h["Page-ID"], h.get("Refers-To-Page", "")
                    rows.append((int(page) if page else None, h["WARC-Target-URI"], h["WARC-Type"], payload, size,
                                 digest, int(ref) if ref else None, h["WARC-Record-ID"]))
                    if len(rows) >= 512:
                        yield as_batch(rows)
                        rows = []
                yield as_batch(rows)

    names = ("page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "record_id")
    types = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string())

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))

    # One task per file: a set number, as adaptive execution would put all of
    # the manifest's small rows, and so all files, into one task.
    return listed.repartition(max(1, listed.count())).mapInArrow(
        freed(read), "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
              "payload_digest string, refers_to bigint, record_id string")
