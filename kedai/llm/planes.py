"""Token-id files: fixed-size id blocks, transposed into byte planes, compressed plane by plane.

A stored relation is a Parquet folder whose rows are chunks. A chunk holds whole documents in order
and is decoded by itself; its columns are the chunk index:

``shard, chunk``   place in document order (shards are ordered by document id)
``first``          ids of the shard before this chunk
``n_ids``          ids in the chunk
``doc_ids, lengths``  the chunk's documents and their numbers of ids, end id included
``plane_sizes``    compressed bytes of every plane, planes of one block after another
``payload``        the compressed planes

Block ``i`` holds ids ``[i * BLOCK, (i + 1) * BLOCK)`` of the chunk as four byte planes, lowest
byte first. High planes of small ids are constant and compress to a few bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kedai.llm.common import batch_rows, small_batches, text_or_empty
from kedai.llm.tokens import encoder

BLOCK = 1 << 14
CHUNK_IDS = 1 << 18
LEVEL = 3

CHUNKS = (
    "shard int, chunk int, first long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
    "plane_sizes array<int>, payload binary"
)


def pack_planes(ids: np.ndarray, compressor) -> tuple[list[int], bytes]:
    """Sizes and bytes of the compressed planes of an id array."""
    parts = []
    for at in range(0, len(ids), BLOCK):
        block = np.ascontiguousarray(ids[at : at + BLOCK], dtype="<u4")
        for plane in block.view(np.uint8).reshape(-1, 4).T:
            parts.append(compressor.compress(plane.tobytes()))
    return [len(part) for part in parts], b"".join(parts)


def unpack_planes(n_ids: int, sizes: list[int], payload: bytes, decompressor) -> np.ndarray:
    """The id array behind compressed planes."""
    out = np.empty(n_ids, dtype="<u4")
    taken, plane = 0, iter(sizes)
    for at in range(0, n_ids, BLOCK):
        held = min(BLOCK, n_ids - at)
        block = np.empty((held, 4), dtype=np.uint8)
        for byte in range(4):
            size = next(plane)
            raw = decompressor.decompress(payload[taken : taken + size], max_output_size=held)
            block[:, byte] = np.frombuffer(raw, dtype=np.uint8)
            taken += size
        out[at : at + held] = block.reshape(-1).view("<u4")
    return out


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write the ids of all documents below ``path`` in ascending order of ``id_col``.

    Null texts and empty texts become the end id alone. Rows with a null id come first. Rows that
    share an id are ordered by text and stay separate documents. Other columns are not looked at.
    An empty table gives a folder without chunks. One shuffle by ranges of the id; a task holds one
    batch of texts and one chunk of ids.
    """
    small_batches(docs.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode = encoder(tokenizer).documents
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        shard = TaskContext.get().partitionId()
        number, first = 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal number, first
            ids = np.concatenate(held)
            sizes, payload = pack_planes(ids, compressor)
            row = [shard, number, first, len(ids), list(names), [len(x) for x in held], sizes, payload]
            number, first = number + 1, first + len(ids)
            names.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, CHUNK_TYPES, strict=True)],
                names=CHUNK_NAMES,
            )

        size = 0
        for batch in batches:
            for name, ids in zip(batch.column("id").to_pylist(), encode(batch.column("text")), strict=True):
                names.append(name)
                held.append(ids)
                size += len(ids)
                if size >= CHUNK_IDS:
                    yield close()
                    size = 0
        if names:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    (
        rows.repartitionByRange("id")
        .sortWithinPartitions("id", "text")
        .mapInArrow(chunks, CHUNKS)
        .write.option("compression", "uncompressed")
        .parquet(path)
    )


CHUNK_NAMES = ["shard", "chunk", "first", "n_ids", "doc_ids", "lengths", "plane_sizes", "payload"]
CHUNK_TYPES = [
    pa.int32(),
    pa.int32(),
    pa.int64(),
    pa.int64(),
    pa.list_(pa.int64()),
    pa.list_(pa.int64()),
    pa.list_(pa.int32()),
    pa.binary(),
]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a folder written by ``write_ids``: doc_id, start, n_tokens, ids.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` counts the ids of all documents
    before it. Chunks are decoded where they are read; only the shards' totals are summed up in
    order, one row for each writing task.
    """
    stored = spark.read.schema(CHUNKS).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("held"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        columns = ("shard", "first", "n_ids", "doc_ids", "lengths", "plane_sizes", "payload")
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                shard, first, n_ids, doc_ids, lengths, sizes, payload = next(
                    batch_rows(iter([one]), *columns)
                )
                ids = unpack_planes(n_ids, sizes, payload, decompressor)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(lengths), pa.int32()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(first + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(
                            [ids[end - n : end].tobytes() for end, n in zip(ends, lengths, strict=True)],
                            pa.binary(),
                        ),
                    ],
                    names=["shard", "doc_id", "inside", "n_tokens", "ids"],
                )

    small_batches(spark)
    found = stored.drop("chunk").mapInArrow(
        documents, "shard int, doc_id long, inside long, n_tokens long, ids binary"
    )
    return found.join(offsets, "shard").select(
        "doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "ids"
    )
