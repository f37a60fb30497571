"""Token ids of documents in packs of fixed-width bits.

A pack is one self-contained binary value: a header, the documents' ids and where
each begins, the byte offset of every block of BLOCK_IDS ids, then the blocks. In a
block each id takes the least bits that hold the vocabulary. Blocks begin at whole
bytes, so any of them is unpacked alone. Packs are stored as a Parquet column, as
Spark's writers commit whole files only and reach every store that Spark reads.

Order: ascending doc_id (nulls first), rows with equal doc_id by a hash of the text
and then by the text. Defined results: a null text is written as empty, that is as the end
id alone; repeated rows are written each; an empty table makes no pack; other
columns are ignored. A document lies in one pack, however long it is.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import slots, text_key
from llm.tokens import encoder

MAGIC = b"IDPK"
HEADER = struct.Struct("<4sBxxxIIQ")  # magic, bits, ids in a block, documents, ids
BLOCK_IDS = 4096
PACK_IDS = 1 << 20
PACK_SCHEMA = "part int, first_id long, n_docs long, n_ids long, pack binary"


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(spread[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack_bits(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    spread = np.zeros((n, 32), dtype=np.uint8)
    spread[:, :bits] = np.unpackbits(data, bitorder="little")[: n * bits].reshape(n, bits)
    return np.packbits(spread, axis=1, bitorder="little").reshape(-1).view("<u4")


def make_pack(doc_ids: list[int | None], parts: list[np.ndarray], bits: int) -> bytes:
    ids = np.concatenate(parts)
    starts = np.cumsum([0, *map(len, parts)]).astype("<u8")
    blocks = [pack_bits(ids[k : k + BLOCK_IDS], bits) for k in range(0, len(ids), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    names = np.array([d or 0 for d in doc_ids], dtype="<i8")
    head = HEADER.pack(MAGIC, bits, BLOCK_IDS, len(parts), len(ids))
    return b"".join([head, names.tobytes(), known.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class Pack:
    """Reads a pack without unpacking more than what is asked for."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, n_docs, self.n_ids = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a pack of token ids")
        at = HEADER.size
        names = np.frombuffer(data, "<i8", n_docs, at).tolist()
        known = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [d if k else None for d, k in zip(names, known, strict=True)]
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, at + 9 * n_docs).astype(np.int64)
        at += 9 * n_docs + 8 * (n_docs + 1)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.blocks = np.frombuffer(data, np.uint8, offset=at + 8 * (n_blocks + 1))

    def ids(self, start: int, end: int) -> np.ndarray:
        """ids[start:end] of the pack; only the blocks that hold them are unpacked."""
        if start >= end:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block, (end - 1) // self.block
        found = [
            unpack_bits(
                self.blocks[self.offsets[b] : self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits
            )
            for b in range(first, last + 1)
        ]
        return np.concatenate(found)[start - first * self.block : end - first * self.block]


def write_packs(
    df: DataFrame, path: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode the texts and write them in ascending doc_id order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(vocabulary)
        bits = max(1, (max(library.vocabulary_size() - 1, end_id)).bit_length())
        part, first = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        size = 0

        def pack():
            values = [[part], [first], [len(parts)], [size], [make_pack(names, parts, bits)]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types, strict=True)],
                ["part", "first_id", "n_docs", "n_ids", "pack"],
            )

        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for name, ids in zip(batch.column("doc_id").to_pylist(), library.encode_many(texts), strict=True):
                names.append(name)
                parts.append(np.append(ids, end))
                size += len(ids) + 1
                if size >= PACK_IDS:
                    yield pack()
                    first, names, parts, size = first + size, [], [], 0
        if parts:
            yield pack()

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("key", text_key())
    ordered = rows.repartitionByRange(slots(df.sparkSession), "doc_id", "key")
    ordered = ordered.sortWithinPartitions("doc_id", "key", "text").select("doc_id", "text")
    ordered.mapInArrow(encode, PACK_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the packs alone."""
    packs = spark.read.parquet(path)
    # One row for each task that wrote: a bounded table.
    sizes = packs.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, first, base in zip(*(batch.column(c).to_pylist() for c in ("pack", "first_id", "base")), strict=True):
                pack = Pack(data)
                checks = [
                    zlib.crc32(pack.ids(s, e).tobytes())
                    for s, e in zip(pack.starts[:-1].tolist(), pack.starts[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pack.doc_ids, pa.int64()),
                        pa.array(pack.starts[:-1] + first + base),
                        pa.array(np.diff(pack.starts)),
                        pa.array(checks, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    with_base = packs.join(F.broadcast(bases), "part").select("pack", "first_id", "base")
    return with_base.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
