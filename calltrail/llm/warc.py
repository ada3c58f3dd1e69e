"""WARC files compressed with a dictionary: each record a Zstandard frame of its own.

The dictionary is fitted on archived records and stands in a skippable frame at the start of each file, so a file reads
without anything else, and any record reads from its offset. A payload that was archived before becomes a revisit.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltrail.llm.blobs import BlobReader, BlobWriter
from calltrail.llm.common import materialize, new_path

#: Of the .warc.zst format: the skippable frame that holds the dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
#: The dictionary's size, and what it is fitted on: so many records of at most so many characters.
DICTIONARY_BYTES, FIT_ROWS, FIT_CHARS = 112_640, 800, 65_536
#: Compressed bytes that one reading task takes at once.
GROUP_BYTES = 4 << 20
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(file: str, at: int) -> str:
    """Name of the record that starts there; file names are unique, so no two records share one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{at}')}>"


def _header(text: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def target_uri(page: str | None, url: str | None) -> str:
    return _header(url) if url else f"urn:page:{page}"


def make_record(urn: str, page: str | None, url: str | None, payload: bytes, first: str | None, first_url: str | None, date: str) -> bytes:
    """A response, or with `first` a revisit of that page's record, named by its address, date and payload digest: its
    block keeps the HTTP head and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {urn}", f"WARC-Date: {date}"]
    head.append(f"WARC-Target-URI: {target_uri(page, url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest32(payload)}")
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Target-URI: {target_uri(first, first_url)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {first}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload, and the payload's length by the HTTP head. A response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if headers["WARC-Type"] == "response" and (len(payload) != length or f"sha1:{digest32(payload)}" != headers["WARC-Payload-Digest"]):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return headers, payload, length


def fit_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Empty where there is too little to fit on; frames then carry no dictionary id."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes() if len(records) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def _codec(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def with_first(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """page, url, payload, first and first_url: the smallest id of the same payload and its address, null where this row
    has that id or is alone.

    Ids and digests alone are grouped, before a shuffle too; the payloads move once, to meet their group's first id. A null
    id is smaller than none, so its row revisits the first one of its payload; rows of null ids alone are all responses.
    """
    own = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    firsts = own.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min(F.struct(F.col("page").isNull().alias("none"), "page", "url")).alias("f"), F.count("*").alias("n")).where("n > 1").select("digest", F.col("f.page").alias("first"), F.col("f.url").alias("first_url"))
    other = ~F.col("page").eqNullSafe(F.col("first"))
    return own.join(firsts, "digest", "left").select("page", "url", "payload", F.when(other, F.col("first")).alias("first"), F.when(other, F.col("first_url")).alias("first_url"))


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Writes one file a task; a row for each group of records: file, at, size.

    Null payloads are empty ones. Of equal payloads of at least `least` bytes, all rows with the smallest id are
    responses and the others revisits, those of null ids too; where all ids are null, all are responses. The dictionary is
    fitted on the records of at most fit_rows pages, as they are archived.
    """
    fit = pages.select(F.col(id_col).cast("string").alias("page"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("p")).where(F.length("p") <= FIT_CHARS)
    # Of about twice as many rows as are needed, by hash, those of the smallest hashes: few bytes come from each task.
    share = int((1 << 20) * min(1.0, 2 * fit_rows / max(1, fit.count())))
    spot = F.pmod(F.xxhash64("page", "p"), F.lit(1 << 20))
    sample = fit.where(spot <= share).orderBy(spot, "page", "p", "url").limit(fit_rows)
    dictionary = fit_dictionary([make_record(record_urn("sample", k), r["page"], r["url"], r["p"].encode("utf-8", "surrogatepass"), None, None, date) for k, r in enumerate(sample.collect())])
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = shared.value
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_codec(dictionary), write_content_size=True).compress
        out, rows, at = None, [], 0
        for batch in batches:
            for page, url, payload, first, first_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out = BlobWriter(folder, ".warc.zst")
                    out.write([dictionary_frame(dictionary)])
                    at = out.tell()
                out.write([pack(make_record(record_urn(out.name, out.tell()), page, url, payload.encode("utf-8", "surrogatepass"), first, first_url, date))])
                if out.tell() - at >= GROUP_BYTES:
                    rows.append((out.name, at, out.tell() - at))
                    at = out.tell()
        if out is not None:
            if out.tell() > at:
                rows.append((out.name, at, out.tell() - at))
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["file", "at", "size"])

    own = with_first(pages, id_col, url_col, payload_col, least)
    columns = own.select(F.col("page").cast("string").alias("page"), "url", "payload", F.col("first").cast("string").alias("first"), "first_url")
    return columns.mapInArrow(run, "file string, at long, size long")


def read_archives(groups: DataFrame, folder: str) -> DataFrame:
    """page, payload_bytes, payload_digest, record_type, refers_to, target_uri, record_id, refers_to_uri: a row for each record read back."""
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "record_id", "refers_to_uri"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name, unpack = BlobReader(folder), None, None
        for batch in batches:
            for file, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    magic, length = struct.unpack("<II", reader.read(file, 0, 8))
                    if magic != DICTIONARY_MAGIC:
                        raise ValueError(f"{file} has no dictionary frame")
                    unpack, name = zstandard.ZstdDecompressor(dict_data=_codec(reader.read(file, 8, length))), file
                rows = []
                for raw in split_frames(reader.read(file, at, size), unpack):
                    headers, _, length = parse_record(raw)
                    rows.append((headers.get("X-Page-ID"), length, headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"], headers.get("X-Refers-To-Page"), headers["WARC-Target-URI"], headers["WARC-Record-ID"], headers.get("WARC-Refers-To-Target-URI")))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k == 1 else pa.string()) for k in range(len(names))], names=names)

    n = max(1, groups.sparkSession.sparkContext.defaultParallelism)
    return groups.repartition(n, "file", "at").mapInArrow(run, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string, target_uri string, record_id string, refers_to_uri string")


def split_frames(raw: bytes, unpack) -> Iterator[bytes]:
    """Records of consecutive frames; their lengths come from decompressing, one frame at a time."""
    at = 0
    while at < len(raw):
        one = unpack.decompressobj()
        window = raw[at : at + (1 << 16)]
        out, fed = [one.decompress(window)], len(window)
        while not one.eof and at + fed < len(raw):
            window = raw[at + fed : at + fed + (1 << 18)]
            out.append(one.decompress(window))
            fed += len(window)
        if not one.eof:
            raise ValueError("a frame has no end")
        yield b"".join(out)
        at += fed - len(one.unused_data)


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Writes all pages, reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A row for each row of pages. Null payloads are empty ones, null ids stay null; see write_archives() for ties.
    """
    folder = new_path(spark, "warc")
    groups = materialize(write_archives(spark, pages, folder, id_col, url_col, payload_col, least), "warc-groups")
    kind = pages.schema[id_col].dataType
    found = read_archives(groups, folder)
    return found.select(F.col("page").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
