"""Web archives (WARC 1.1) under zstandard: dictionary in a leading skippable frame, one frame a record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, raw or itself compressed; each record is one
frame under that dictionary. Reading finds each frame's end from its block headers and decodes it alone; other skippable frames are passed over. Each record is validated:
version line, the four required headers, Content-Length against the block, the blank lines after it, and, where the record carries them, its digests
and for HTTP responses the payload's length (chunked bodies are joined). Records of other types come out with their whole block as payload.

Records with equal payloads of at least ``least_bytes``: that of the largest page_id is a response with the payload, the others are revisits that refer to
it, with the HTTP header only. Archives are rows (archive, content) in Parquet below the shared folder, written by Spark tasks; ``read_archives``
takes such rows or those of Spark's binaryFile reader over real .warc.zst files.

The dictionary is trained on the ``sample_pages`` pages whose ids hash lowest (empty, so no dictionary, where they are too few).

Defined results: a null html is an empty payload; a null url leaves its header out, line ends in urls are percent-encoded; a null
page_id is never referred to, and is a response unless another page has its payload; pages that share a page_id and payload are all responses;
an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlweave.session import scratch_path


SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
ARCHIVE_BYTES = 4 << 20
SAMPLE_PAGES = 256
DICT_BYTES = 32 << 10
_LINE_ENDS = str.maketrans({"\r": "%0D", "\n": "%0A"})


def record_id(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record; a revisit where ``refers_to`` is a page_id."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", *([f"WARC-Target-URI: {url.translate(_LINE_ENDS)}"] if url is not None else []),
            f"WARC-Payload-Digest: sha1:{digest}",
            *([f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_head(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def frame_end(data: memoryview, at: int) -> int:
    """End of the zstandard frame that starts at ``at``, from its block headers."""
    params = zstandard.get_frame_parameters(data[at:at + 18])
    end = at + zstandard.frame_header_size(data[at:at + 18])
    last = False
    while not last:
        if end + 3 > len(data):
            raise ValueError("cut off in a frame")
        head = data[end] | data[end + 1] << 8 | data[end + 2] << 16
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)
    return end + (4 if params.has_checksum else 0)


def _unchunked(body: bytes) -> bytes:
    """The body that chunks carry; raises ValueError where they aren't whole."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size
        if body[at - 2:at] != b"\r\n":
            raise ValueError("a chunk is cut off")


def _fits(stated: str, *contents: bytes) -> bool:
    """Whether a stated digest (hex or base32) is that of one of the contents; one of an unknown algorithm can't be checked."""
    algorithm, _, value = stated.partition(":")
    try:
        digests = [hashlib.new(algorithm.lower().replace("-", ""), c).digest() for c in contents]
    except (ValueError, TypeError):
        return True
    return any(value.lower() == d.hex() or value.upper().rstrip("=") == base64.b32encode(d).decode().rstrip("=") for d in digests)


def _sha1_hex(stated: str) -> str | None:
    algorithm, _, value = stated.partition(":")
    if algorithm.lower().replace("-", "") != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def _record_end(raw: bytes) -> tuple[dict, int, int] | None:
    """(header fields, start, end of the block) of the record in front of ``raw``; None where more bytes are needed."""
    at = raw.find(b"\r\n\r\n")
    if at < 0:
        return None
    lines = raw[:at].decode(errors="replace").replace("\r\n ", " ").replace("\r\n\t", " ").split("\r\n")
    if not lines[0].startswith("WARC/1.") or not all(":" in x for x in lines[1:]):
        raise ValueError("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ValueError(f"missing {missing}")
    end = at + 4 + int(fields["content-length"])
    if len(raw) < end + 4:
        return None
    if raw[end:end + 4] != b"\r\n\r\n":
        raise ValueError("wrong Content-Length")
    return fields, at + 4, end


def _record(fields: dict, block: bytes) -> dict:
    kind, stated = fields["warc-type"], fields.get("warc-payload-digest", "")
    if not _fits(fields.get("warc-block-digest", ""), block):
        raise ValueError("the block doesn't fit its digest")
    payload, size = block, len(block)
    if kind in ("response", "revisit") and (fields.get("content-type", "").lower().startswith("application/http") or block.startswith(b"HTTP/")):
        http, _, body = block.partition(b"\r\n\r\n")
        lines = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
        size = int(lines[b"content-length"]) if lines.get(b"content-length", b"").isdigit() else None
        payload = body
        if b"chunked" in lines.get(b"transfer-encoding", b"").lower():
            size = None
            try:
                payload = _unchunked(body)
            except ValueError:  # stored joined already, under the header it came with, or cut off
                pass
        if kind == "response":
            if size not in (None, len(body)) and "warc-truncated" not in fields:
                raise ValueError("the payload doesn't fit its length")
            if not _fits(stated, payload, body):
                raise ValueError("the payload doesn't fit its digest")
            size = len(payload)
    elif kind == "revisit":
        size = None
    digest = _sha1_hex(stated)
    if kind == "response" and digest is None:
        digest = hashlib.sha1(payload).hexdigest()
    return {"id": fields["warc-record-id"], "type": kind, "digest": digest, "bytes": size,
            "refers_to": fields.get("warc-refers-to"), "url": fields.get("warc-target-uri"), "payload": payload}


def parse_record(raw: bytes) -> dict:
    """Fields of a record; raises ValueError where it isn't valid."""
    got = _record_end(raw)
    if got is None or got[2] + 4 != len(raw):
        raise ValueError("wrong Content-Length" if b"\r\n\r\n" in raw else "no WARC header")
    return _record(got[0], raw[got[1]:got[2]])


def archive_records(content: bytes):
    """Records of an archive, frame by frame."""
    data = memoryview(content)
    reader, at, frames, rest = zstandard.ZstdDecompressor(max_window_size=1 << 31), 0, 0, b""
    while at < len(data):
        try:
            magic = struct.unpack_from("<I", data, at)[0]
            if magic & ~15 == SKIPPABLE & ~15:
                end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
                if end > len(data):
                    raise ValueError(f"no whole frame at byte {at}")
                held = bytes(data[at + 8:end])
                if magic == SKIPPABLE and held[:4] == struct.pack("<I", FRAME):
                    held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
                # the leading one, or that of another archive joined to this one
                if magic == SKIPPABLE and held and (not frames or held[:4] == struct.pack("<I", DICTIONARY)):
                    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held), max_window_size=1 << 31)
            else:
                end = frame_end(data, at)
                if end > len(data):
                    raise ValueError(f"no whole frame at byte {at}")
                rest += reader.decompressobj().decompress(data[at:end])
                frames += 1
        except (zstandard.ZstdError, struct.error) as e:
            raise ValueError(f"no whole frame at byte {at}") from e
        at = end
        while rest and (got := _record_end(rest)):
            yield _record(got[0], rest[got[1]:got[2]])
            rest = rest[got[2] + 4:]
    if rest:
        raise ValueError("cut off in a record")


def _page(record: str | None):
    """page_id of a record that ``write_archives`` made; null for any other."""
    value = (record or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(value) if record == f"<urn:x-page:{value}>" and value.removeprefix("-").isdecimal() else None


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, sample_pages: int = SAMPLE_PAGES,
                   date: str = "2020-01-01T00:00:00Z") -> None:
    """Write one record for each of pages (page_id, url, html) into archives below ``path``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    named = pages.select("page_id", F.octet_length("payload").alias("size"), F.sha2("payload", 256).alias("name")).where(F.col("size") >= least_bytes)
    # only payloads that occur twice; a hot one is a single row here
    target = named.groupBy("name", "size").agg(F.max("page_id").alias("target"), F.count("*").alias("k")).where("k > 1 AND target IS NOT NULL")
    marked = (pages.withColumn("name", F.sha2("payload", 256)).join(target.select("name", "target"), "name", "left")
              .select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target")).alias("refers_to")))

    def train(batches):
        rows = [record_bytes(i, u, p, None, date) for b in batches for i, u, p in zip(*(b.column(k).to_pylist() for k in range(3)))]
        try:
            made = zstandard.train_dictionary(DICT_BYTES, rows).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few or too short records
            made = b""
        yield pa.RecordBatch.from_pydict({"d": pa.array([made], pa.binary())})

    ids = pages.select("page_id").where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    sample = pages.join(F.broadcast(ids), "page_id", "left_semi").orderBy("page_id", F.xxhash64("payload")).limit(sample_pages)
    got = sample.coalesce(1).mapInArrow(train, "d binary").collect()
    dictionary = bytes(got[0].d) if got else b""

    def archives(batches):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=3)
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        part, seq, frames, held = TaskContext.get().partitionId(), 0, [], 0

        def row():
            return pa.RecordBatch.from_pydict({"archive": [f"{part:06d}-{seq:06d}.warc.zst"],
                                               "content": pa.array([b"".join([archive_head(dictionary), *frames])], pa.binary())})

        for b in batches:
            for i, u, p, r in zip(*(b.column(k) for k in range(4))):
                frames.append(packer.compress(record_bytes(i.as_py(), u.as_py(), p.as_py(), r.as_py(), date)))
                held += len(frames[-1])
                if held >= ARCHIVE_BYTES:
                    yield row()
                    seq, frames, held = seq + 1, [], 0
        if frames:
            yield row()

    marked.mapInArrow(archives, "archive string, content binary").write.parquet(path)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of archives (a column ``content``): page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload, record_id, refers_to_id.

    page_id and refers_to are null where the ids aren't of ``write_archives``; payload_digest is the SHA-1 the record states, a response's own where it states none."""
    def rows(batches):
        for b in batches:
            for content in b.column(0):
                records = list(archive_records(content.as_py()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([_page(r["id"]) for r in records], pa.int64()), pa.array([r["url"] for r in records], pa.string()),
                    pa.array([r["type"] for r in records], pa.string()), pa.array([r["bytes"] for r in records], pa.int64()),
                    pa.array([r["digest"] for r in records], pa.string()),
                    pa.array([_page(r["refers_to"]) for r in records], pa.int64()),
                    pa.array([r["payload"] if r["type"] != "revisit" else None for r in records], pa.binary()),
                    pa.array([r["id"] for r in records], pa.string()), pa.array([r["refers_to"] for r in records], pa.string())],
                    names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "record_id", "refers_to_id"])
    return archives.select("content").mapInArrow(
        rows, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, "
              "record_id string, refers_to_id string")


def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all of pages, written and read back."""
    path = scratch_path(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    archives = spark.read.schema("archive string, content binary").parquet(path)
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op9_warc_zstd": op9_warc_zstd}
ORACLE_SQL = {"op9_warc_zstd": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS target FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id <> target THEN target END AS refers_to
FROM m"""}
