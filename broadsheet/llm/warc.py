"""WARC archives: writing, normalising whole-file gzip streams to one member per record, and reading by offset."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.llm.common import shared_path, spread, stored
from broadsheet.llm.files import new_name, open_folder

#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 100
#: Bytes that are inflated, and copied, at a time.
BLOCK = 1 << 20
#: A header of more bytes is taken for damage.
MAX_HEADER = 1 << 20
GZIP = 31  # window bits of zlib with a gzip wrapper
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, record_id string, record_type string, target_uri string"


def _urn(page: str | None) -> str:
    return "<urn:page:" + ("" if page is None else "id:" + quote(page, safe="")) + ">"


def _page(urn: str) -> str | None:
    inner = urn.removeprefix("<urn:page:").removesuffix(">")
    return unquote(inner.removeprefix("id:")) if inner.startswith("id:") else None


def record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that has only the head of the HTTP message."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", _urn(page)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row below `folder`/crawl, each file one gzip stream; gives file, records of the committed files.

    Of rows with equal payloads of MIN_REVISIT_BYTES or more the smallest identifier is the response, the others revisit
    it; a null identifier comes last, a null payload is empty, rows that repeat the identifier of a response are
    responses too. Payloads are compared by SHA-256, counted before they shuffle; only the rows of repeated payloads are joined back.
    """
    rows = spread(pages.select(F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                               F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")), "page")
    keyed = rows.select("page", "id", F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("size"))
    repeated = keyed.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    revisits = keyed.select("page", "id", "digest").join(repeated, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).select(
        F.col("page").alias("again"), F.col("digest").alias("again_digest"), F.col("first").cast("string").alias("refers_to")).distinct()
    full = rows.select("page", "url", "html", F.sha2("html", 256).alias("digest")).join(
        revisits, F.col("page").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("again_digest")), "left").select("page", "url", "html", "digest", "refers_to")
    open_folder(folder)[0].create_dir(f"{open_folder(folder)[1]}/crawl", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        name, out, n = new_name("crawl", ".warc.gz"), None, 0
        pack = zlib.compressobj(1, zlib.DEFLATED, GZIP)
        try:
            for b in batches:
                for page, url, html, digest, refers in zip(*(b.column(i) for i in range(5))):
                    out = out or fs.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(pack.compress(record(page.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), refers.as_py())))
                    n += 1
            if out:
                out.write(pack.flush())
        finally:
            if out:
                out.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "records"])

    return stored(full.mapInArrow(write, "file string, records long"), "warc-crawl")


class _Stream:
    """Bytes of a gzip file, of one member or several, inflated a block at a time."""

    def __init__(self, source) -> None:
        self.source, self.inflate, self.buffer, self.rest, self.done = source, zlib.decompressobj(GZIP), b"", b"", False

    def fill(self) -> bool:
        while not self.done:
            if not self.rest:
                self.rest = self.source.read(BLOCK)
            if not self.rest:
                self.done = True
                if not self.inflate.eof and self.started:
                    raise ValueError("the gzip stream is cut off")
                break
            self.started = True
            got = self.inflate.decompress(self.rest, BLOCK)
            self.rest = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
                self.inflate, self.started = zlib.decompressobj(GZIP), bool(self.rest)
            if got:
                self.buffer += got
                return True
        return False

    started = False

    def head(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        seen = 0
        while (at := self.buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.buffer)
            if seen > MAX_HEADER:
                raise ValueError("no WARC record where one should start")
            if not self.fill():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a header")
                return None
        out, self.buffer = self.buffer[:at + 4], self.buffer[at + 4:]
        return out

    def copy(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.fill():
                raise ValueError("the archive ends inside a record")
            piece, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(piece)
            yield piece


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (column file, below `folder`) with every record as a gzip member of its own, and write the index.

    A file is one task, inflated once from front to back, whether its gzip stream is whole-file or already by record; a
    record is copied block by block, so memory does not grow with files or records. Gives the index, which also
    lies in `folder`/index as Parquet: file, offset, length (of the member), record_id, record_type, target_uri.
    """
    open_folder(folder)[0].create_dir(f"{open_folder(folder)[1]}/records", recursive=True)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        for batch in batches:
            for source_name in batch.column("file").to_pylist():
                name, at, rows = new_name("records", ".warc.gz"), 0, []
                with fs.open_input_stream(f"{path}/{source_name}", compression=None) as source, fs.open_output_stream(f"{path}/{name}", compression=None) as out:
                    stream = _Stream(source)
                    while (head := stream.head()) is not None:
                        f = fields_of(head.lstrip(b"\r\n"))
                        pack, size = zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
                        size += _put(out, pack.compress(head.lstrip(b"\r\n")))
                        for piece in stream.copy(int(f["content-length"]) + 4):  # the empty lines that end a record too
                            size += _put(out, pack.compress(piece))
                        size += _put(out, pack.flush())
                        rows.append((name, at, size, f["warc-record-id"], f["warc-type"], f.get("warc-target-uri")))
                        at += size
                        if len(rows) == 10_000:
                            yield _index(rows)
                            rows = []
                if rows:
                    yield _index(rows)

    n = max(1, files.count())  # one row per file
    index = files.select("file").repartition(n).mapInArrow(rewrite, INDEX)
    index.write.parquet(f"{folder}/index")
    return files.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _put(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def _index(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in INDEX.split(", ")])


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Records by the index: page_id (string), payload_bytes, payload_digest, record_type, refers_to, url (and payload of responses).

    The digest of a response is computed from the payload that was read and must equal the header's; of a revisit both
    come from its headers.
    """
    index = spark.read.schema(INDEX).parquet(f"{folder}/index").select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string" + ", payload binary" * payloads

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, fs.open_input_file(f"{path}/{file}")
                source.seek(offset)
                data = zlib.decompress(source.read(length), GZIP)
                cut = data.index(b"\r\n\r\n") + 4
                f = fields_of(data[:cut])
                http, _, payload = data[cut:cut + int(f["content-length"])].partition(b"\r\n\r\n")
                claimed = f["warc-payload-digest"].removeprefix("sha256:")
                size = int(next(line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")))
                if f["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest() != claimed or len(payload) != size):
                    raise ValueError(f"{file} at {offset}: the payload is not the one that was written")
                refers = f.get("warc-refers-to")
                url = f.get("warc-target-uri")
                row = (_page(f["warc-record-id"]), size, claimed, f["warc-type"], None if refers is None else _page(refers), None if url is None else unquote(url))
                out.append((*row, payload) if payloads else row)
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * payloads
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in schema.split(", ")])

    return index.mapInArrow(read, schema)


def write_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archive `pages` in a new shared folder, normalise the files, and read every record back; page_id and refers_to have the type of the table."""
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    folder = shared_path(spark, "warc")
    normalise(write_archives(pages, folder, id_col, url_col, html_col), folder)
    return read_archives(spark, folder).select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
