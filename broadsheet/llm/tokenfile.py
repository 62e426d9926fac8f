"""Token ids in binary files: one zstandard frame per document, a shared dictionary, an offset index."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from broadsheet.llm.common import shared_path, stored
from broadsheet.llm.files import new_name, open_folder
from broadsheet.llm.minhash import parts
from broadsheet.llm.tokens import Encoder, default_vocabulary

#: A data file starts with these bytes, the width of an id in bytes and the SHA-256 of the dictionary.
MAGIC = b"TKZ1"
HEADER = "<4sI32s"
#: The dictionary is trained on the ids of at most so many documents, the ones with the smallest hashes of the identifier,
#: and on at most so many bytes in total; its own size is bounded too.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8 << 20, 112 << 10
LEVEL = 3

INDEX = "file string, start_in_file long, offset long, size int, n_tokens long"


def id_width(vocabulary: str) -> int:
    return 2 if Encoder.of(vocabulary).size <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> bytes:
    """A dictionary for serialized id arrays; empty if there is too little to train on.

    The sample is bounded by SAMPLE_DOCS and SAMPLE_BYTES at every size of the corpus; it shapes compression only.
    """
    import zstandard

    ids = docs.select(F.col(id_col).alias("id")).where("id is not null")
    chosen = ids.select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(SAMPLE_DOCS).select(F.col("id").alias("chosen"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("chosen"), "left_semi").select(
        "text", F.xxhash64("id").alias("h"))
    width = id_width(vocabulary)

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        for batch in batches:
            for part in parts(batch):
                flat, at = encoder.encode(part.column(0))
                rows = [_bytes(flat[a:b], end_id, width)for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), part.column(1), pa.array([len(r) for r in rows], pa.int64())], names=["ids", "h", "size"])

    sample = stored(texts.mapInArrow(serialize, "ids binary, h long, size long").withColumn("row", F.monotonically_increasing_id()), "token-sample")
    samples = [bytes(r["ids"]) for r in within_bytes(sample, SAMPLE_DOCS, SAMPLE_BYTES).collect()]
    samples = sorted(s for s in samples if s)
    if sum(map(len, samples)) < 64 << 10:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # samples too alike to learn from
        return b""


def within_bytes(sample: DataFrame, docs: int, size: int) -> DataFrame:
    """Rows (h, row, size, ids) with the smallest hashes, at most `docs` of at most `size` bytes in total; one of more than an eighth of that is left out."""
    small = sample.where(F.col("size") <= size // 8).select("h", "row", "size").orderBy("h", "row").limit(docs)
    total = F.sum("size").over(Window.orderBy("h", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow))  # over at most `docs` numbers
    return sample.join(F.broadcast(small.withColumn("total", total).where(F.col("total") <= size).select("row")), "row", "left_semi").select("ids")


def _bytes(ids: np.ndarray, end_id: int, width: int) -> bytes:
    return np.append(ids, np.uint32(end_id)).astype(f"<u{width}").tobytes()


def write_tokens(docs: DataFrame, folder: str, end_id: int = 1, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append `end_id`, and write the ids below `folder`, a shared folder.

    `data/part-*.tkz`: a header (width of an id, hash of the dictionary), then one zstandard frame per document,
    each compressed on its own with the shared dictionary, so that a short document is read without its
    neighbours. `dictionary`: its bytes. `index` (Parquet): doc_id, file, position of the document in the
    file, offset and size of its frame, tokens, and start, the ids of all documents before it. Files follow
    each other in ascending order of doc_id (nulls first), as the range partitioning cuts them. A null text is the end
    id alone; repeated identifiers are documents of their own. An attempt of a task writes under its own name, and only
    files of committed attempts are in the index.
    """
    vocabulary = vocabulary or default_vocabulary()
    spark, width = docs.sparkSession, id_width(vocabulary)
    dictionary = train_dictionary(docs, vocabulary, end_id, id_col, text_col)
    fs, path = open_folder(folder)
    fs.create_dir(f"{path}/data", recursive=True)
    with fs.open_output_stream(f"{path}/dictionary") as out:
        out.write(dictionary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(f"part int, {INDEX}").fields])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        encoder, part_id = Encoder.of(vocabulary), TaskContext.get().partitionId()
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        fs, path = open_folder(folder)
        name = new_name("data", ".tkz")
        out, at, n = None, 0, 0
        try:
            for batch in batches:
                for part in parts(batch):
                    if out is None:
                        out = fs.open_output_stream(f"{path}/{name}")
                        out.write(struct.pack(HEADER, MAGIC, width, hashlib.sha256(dictionary).digest()))
                        at = struct.calcsize(HEADER)
                    flat, ends = encoder.encode(part.column(1))
                    frames = [pack.compress(_bytes(flat[a:b], end_id, width)) for a, b in zip(ends[:-1], ends[1:])]
                    size = np.array([len(f) for f in frames], dtype=np.int64)
                    out.write(b"".join(frames))
                    k = len(frames)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), pa.array(np.full(k, part_id, np.int32)), pa.array([name] * k, pa.string()), pa.array(np.arange(n, n + k)),
                        pa.array(at + np.cumsum(size) - size), pa.array(size.astype(np.int32)), pa.array(np.diff(ends) + 1)], names=schema.names)
                    at, n = at + int(size.sum()), n + k
        finally:
            if out is not None:
                out.close()

    frames = stored(ordered.mapInArrow(write, schema), "token-frames")
    totals = frames.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # one row per file
    before = totals.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("start_in_file").rowsBetween(Window.unboundedPreceding, -1)
    frames.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(F.broadcast(before), "part").select(
        "doc_id", "file", F.col("start_in_file").alias("position"), "offset", "size", "n_tokens", (F.col("start") + F.col("before")).alias("start")
    ).write.parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, ids (array of ints) of every document, read back through the index."""
    return _read(spark, folder, "ids array<int>")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) of every document, from the files."""
    return _read(spark, folder, "n_tokens long, ids_crc32 long")


def _read(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    index = spark.read.parquet(f"{folder}/index").repartition("file").sortWithinPartitions("file", "offset").select("doc_id", "file", "offset", "size", "start")
    schema = T.StructType([index.schema["doc_id"], index.schema["start"], *T._parse_datatype_string(columns).fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        fs, path = open_folder(folder)
        with fs.open_input_stream(f"{path}/dictionary") as f:
            dictionary = f.read()
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        name, source, width = None, None, 2
        for batch in batches:
            # runs of neighbouring frames are read at once, a few megabytes at most
            files, offsets, sizes = batch.column("file").to_pylist(), batch.column("offset").to_numpy(), batch.column("size").to_numpy()
            out, i = [], 0
            while i < len(files):
                if files[i] != name:
                    if source is not None:
                        source.close()
                    name = files[i]
                    source = fs.open_input_file(f"{path}/{name}")
                    magic, width, digest = struct.unpack(HEADER, source.read(struct.calcsize(HEADER)))
                    if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
                        raise ValueError(f"{name} was written with another dictionary or is no token file")
                j = i + 1
                while j < len(files) and files[j] == name and offsets[j] == offsets[j - 1] + sizes[j - 1] and offsets[j] - offsets[i] < 4 << 20:
                    j += 1
                source.seek(int(offsets[i]))
                block = source.read(int(offsets[j - 1] + sizes[j - 1] - offsets[i]))
                for k in range(i, j):
                    a = int(offsets[k] - offsets[i])
                    out.append(np.frombuffer(unpack.decompress(block[a:a + int(sizes[k])]), f"<u{width}"))
                i = j
            first = [batch.column("doc_id"), batch.column("start")]
            if columns.startswith("ids "):
                at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                rest = [pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(out).astype(np.int32)))] if out else [pa.array([], pa.list_(pa.int32()))]
            else:
                rest = [pa.array([len(x) for x in out], pa.int64()), pa.array([zlib.crc32(x.astype("<u4")) for x in out], pa.int64())]
            yield pa.RecordBatch.from_arrays([*first, *rest], names=schema.names)

    return index.mapInArrow(read, schema)


def write_and_read(docs: DataFrame, end_id: int = 1, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """token_digests of `docs`, written to a new shared folder."""
    folder = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, end_id, vocabulary, id_col, text_col)
    return token_digests(docs.sparkSession, folder)
