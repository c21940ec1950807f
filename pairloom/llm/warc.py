"""Web archives of Zstandard frames: writer and reader.

An archive is a file of frames. The first one is a skippable frame with the dictionary that all others
need; each other one holds one WARC record. Empty skippable frames may stand between them: Spark's
text writer puts one after every row, so that archives are written by Spark itself, to any store that it knows.
"""

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import broadcast_if_small
from pairloom.sources.storage import materialize, shared_dir

# Fixed values of the file formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50  # the last four bits are free
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\0\0\0\0"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"
PAGE = "urn:x-page:"
DATE = "1970-01-01T00:00:00Z"

# Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
# Payload of an archive, about. A file is read in one piece.
ARCHIVE_BYTES = 32 << 20
# The dictionary is trained on so many payloads of at most so many bytes, about.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 32 << 10, 64 << 10
WRITE_BYTES = 8 << 20
# A frame that unpacks to more is an error.
MOST_BYTES = 1 << 30


def revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``(of_page, refers_to)`` of the pages whose payload another page with a larger id has.

    ``pages(page_id, n, digest)``. Pages with null ids revisit like others, and nothing refers to them.
    """
    long_ones = pages.where(F.col("n") >= least_bytes)
    groups = long_ones.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("count"))
    groups = groups.where((F.col("count") > 1) & F.col("refers_to").isNotNull()).drop("count")
    # One row for each repeated payload; where these are few, a page that many copy isn't one task.
    groups = broadcast_if_small(materialize(groups, "repeated"))
    again = long_ones.join(groups, ["digest", "n"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return again.select(F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest"), "refers_to").distinct()


def train_dictionary(payloads: DataFrame) -> bytes:
    """A dictionary for ``payloads(page_id, payload)``; empty if there is too little to learn from."""
    fit = payloads.where(F.length("payload").between(1, SAMPLE_BYTES))
    count = fit.count()
    share = F.pmod(F.xxhash64("page_id", F.lit("dictionary")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = fit.where(share < SAMPLE_PAGES / max(count, 1)).limit(2 * SAMPLE_PAGES).select("payload").collect()
    samples = sorted(bytes(r["payload"]) for r in rows)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record(page_id: str | None, url: str | None, payload: bytes, n: int, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit record without its payload if it refers to another."""
    name = f"urn:x-page:{page_id if page_id is not None else 'null'}"
    uri = "".join(c if c.isprintable() and c != " " else "%20" for c in url) if url else name
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    fields += [f"WARC-Target-URI: {uri}", "Content-Type: application/http; msgtype=response"]
    fields += ["WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()]
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    fields += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(fields).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Writes a record for every row. Null html is an empty payload, a null url the record's own name."""
    payloads = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"),
    )
    measured = payloads.withColumn("n", F.length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    narrow = materialize(measured.select("page_id", "n", "digest"), "digests")
    total = narrow.agg(F.sum("n")).first()[0] or 0
    again = broadcast_if_small(materialize(revisits(narrow, least_bytes), "revisits"))
    learnt = train_dictionary(payloads)
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("digest") == F.col("of_digest"))
    rows = measured.join(again, same, "left").select(
        F.col("page_id").cast("string"), "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "n", "digest", F.col("refers_to").cast("string")
    )
    archives = max(1, -(-total // archive_bytes))
    rows = rows.repartition(archives, F.xxhash64("page_id", "digest"))

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary = zstandard.ZstdCompressionDict(learnt) if learnt else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        out, size = [], 0
        if learnt:
            out.append(struct.pack("<II", DICTIONARY_MAGIC, len(learnt)) + learnt)
        out.append(packer.compress(_info()))
        for batch in batches:
            for row in batch.itertuples(index=False):
                payload = bytes(row.payload) if row.payload is not None else b""
                refers_to = row.refers_to if isinstance(row.refers_to, str) else None
                page_id = row.page_id if isinstance(row.page_id, str) else None
                out.append(packer.compress(record(page_id, row.url, payload, int(row.n), row.digest, refers_to)))
                size += len(out[-1])
                if size >= WRITE_BYTES:
                    yield pd.DataFrame({"frame": out})
                    out, size = [], 0
        if out:
            yield pd.DataFrame({"frame": out})

    # Bytes pass as they are through a column of text.
    written = rows.mapInPandas(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    written.write.option("lineSep", EMPTY_FRAME).text(path)


def _info() -> bytes:
    text = b"format: WARC file version 1.1\r\n"
    fields = [VERSION, "WARC-Type: warcinfo", "WARC-Record-ID: <urn:x-page:info>", f"WARC-Date: {DATE}"]
    fields += ["Content-Type: application/warc-fields", f"Content-Length: {len(text)}", "", ""]
    return "\r\n".join(fields).encode() + text + b"\r\n\r\n"


def frame_end(data: memoryview, at: int) -> int:
    """Where the compressed frame that begins at ``at`` ends, by the sizes of its blocks."""
    flags = data[at + 4]
    single, checksum, dict_flag, size_flag = flags >> 5 & 1, flags >> 2 & 1, flags & 3, flags >> 6
    header = 5 + (0 if single else 1) + (0, 1, 2, 4)[dict_flag] + ((1 if single else 0), 2, 4, 8)[size_flag]
    at += header
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        kind, size = block >> 1 & 3, block >> 3
        if kind == 3 or at + 3 > len(data):
            raise ValueError(f"bad block at byte {at}")
        at += 3 + (1 if kind == 1 else size)
        if block & 1:
            return at + 4 * checksum


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each compressed frame; the dictionary comes from the leading skippable frame."""
    data, at, unpacker = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"cut off at byte {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            if at + 8 + size > len(data):
                raise ValueError(f"skippable frame cut off at byte {at}")
            if magic == DICTIONARY_MAGIC and at == 0:
                learnt = bytes(data[8 : 8 + size])
                if learnt[:4] == struct.pack("<I", FRAME_MAGIC):
                    learnt = zstandard.ZstdDecompressor().decompress(learnt)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learnt))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = frame_end(data, at)
            if end > len(data):
                raise ValueError(f"frame cut off at byte {at}")
            try:
                yield at, unpacked(unpacker, data[at:end])
            except zstandard.ZstdError as error:
                raise ValueError(f"frame at byte {at}: {error}") from error
            at = end
        else:
            raise ValueError(f"no frame at byte {at}")


def unpacked(unpacker: zstandard.ZstdDecompressor, frame: memoryview, most: int = MOST_BYTES) -> bytes:
    """Content of a frame, whether or not its header has the size of it."""
    size = zstandard.frame_content_size(frame)
    if size > most:
        raise ValueError(f"a frame of {size} bytes, more than {most}")
    if size >= 0:
        return unpacker.decompress(frame)
    stream, out, total = unpacker.decompressobj(), [], 0
    # Small pieces of the frame, as each may unpack to very much.
    for begin in range(0, len(frame), 4096):
        out.append(stream.decompress(frame[begin : begin + 4096]))
        total += len(out[-1])
        if total > most:
            raise ValueError(f"a frame of more than {most} bytes")
    if not stream.eof:
        raise ValueError("frame cut off")
    return b"".join(out)


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by their names in lower case. A line that begins with white space goes on with the field before."""
    fields: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in " \t" and last is not None:
            fields[last] = f"{fields[last]} {line.strip()}"
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:80]!r}")
        last = name.strip().lower()
        fields[last] = value.strip()
    return fields


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of the one record in a frame; anything else is an error."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the header")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdecimal():
        raise ValueError("bad content-length")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"content-length is {length}, {len(rest) - 4} bytes are there")
    return fields, rest[:length]


def unchunked(body: bytes) -> bytes:
    """A body without the sizes of its chunks."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("no end of a chunk's size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if not size:
            return b"".join(out)
        at = end + 2 + size
        if at + 2 > len(body):
            raise ValueError("chunk cut off")
        out.append(body[end + 2 : at])
        at += 2


def _digest(text: str) -> tuple[str, str] | None:
    """Algorithm and hexadecimal digest, which may be written in base 32; None if the algorithm isn't known here."""
    algorithm, _, value = text.partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return None
    value, size = value.strip(), 2 * hashlib.new(algorithm).digest_size
    if len(value) == size:
        return algorithm, value.lower()
    return algorithm, base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()


def read_record(fields: dict[str, str], block: bytes) -> dict:
    """Row of a response or revisit record; its length and digest are checked if it has them.

    The payload is the body of an HTTP answer, without the sizes of chunks, or the whole block if it is none. The digest
    of a body in chunks may be that with their sizes.
    """
    name = lambda key: fields[key].strip("<>")
    page = lambda text: text.removeprefix(PAGE) if text.startswith(PAGE) else None
    kind, cut = fields["warc-type"], "warc-truncated" in fields
    http, payload, bodies = {}, block, [block]
    if block.startswith(b"HTTP/"):
        head, found, payload = block.partition(b"\r\n\r\n")
        if not found and not cut and kind == "response":
            raise ValueError("no end of the HTTP header")
        http = _fields(head.decode("latin-1").rstrip("\r\n").split("\r\n")[1:])
        bodies = [payload]
        if "chunked" in http.get("transfer-encoding", "").lower() and payload and not cut:
            payload = unchunked(payload)
            bodies.append(payload)
    told = http.get("content-length", "")
    n = int(told) if told.isdecimal() and len(bodies) == 1 else None
    digest = _digest(fields["warc-payload-digest"]) if "warc-payload-digest" in fields else None
    if kind == "response":
        if n is not None and n != len(payload) and not cut:
            raise ValueError(f"the payload has {len(payload)} bytes, its header says {n}")
        n = len(payload)
        if digest and not cut and digest[1] not in [hashlib.new(digest[0], body).hexdigest() for body in bodies]:
            raise ValueError("the payload differs from its digest")
    elif payload and block.startswith(b"HTTP/"):
        raise ValueError("a revisit record with a payload")
    sha1 = digest[1] if digest and digest[0] == "sha1" else hashlib.sha1(payload).hexdigest() if kind == "response" else None
    refers = name("warc-refers-to") if kind == "revisit" and "warc-refers-to" in fields else None
    return {
        "record_id": name("warc-record-id"),
        "page_id": page(name("warc-record-id")),
        "url": name("warc-target-uri") if "warc-target-uri" in fields else None,
        "payload": payload if kind == "response" else None,
        "payload_bytes": n,
        "payload_digest": sha1,
        "record_type": kind,
        "refers_to_record": refers,
        "refers_to": page(refers) if refers else None,
    }


RECORDS = "record_id string, page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to_record string, refers_to string"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Response and revisit records of all archives in a folder; a bad one is an error with file and byte.

    Archives may be by any writer, as long as a record is a frame. Without ``payloads``, they are checked but not
    returned. ``page_id`` and ``refers_to`` are null in records that weren't written here.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [part.split()[0] for part in RECORDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                out, size = [], 0
                for at, raw in frames(bytes(content)):
                    try:
                        fields, block = parse_record(raw)
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        row = read_record(fields, block)
                    except (ValueError, KeyError) as error:
                        raise ValueError(f"{path}, byte {at}: {error}") from error
                    if not payloads:
                        row["payload"] = None
                    out.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= WRITE_BYTES:
                        yield pd.DataFrame(out, columns=columns).astype({"payload_bytes": "Int64"})
                        out, size = [], 0
                if out:
                    yield pd.DataFrame(out, columns=columns).astype({"payload_bytes": "Int64"})

    rows = files.mapInPandas(read, RECORDS)
    number = lambda name: F.when(F.col(name) != "null", F.col(name)).try_cast("long").alias(name)
    return rows.select(*[number(f.name) if f.name in ("page_id", "refers_to") else F.col(f.name) for f in rows.schema])


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the pages to archives in the shared folder and returns the records that are read back."""
    path = f"{shared_dir(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path, payloads=False)
