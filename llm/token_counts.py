"""Token counts of whole texts by a two-tier lookup of pre-tokens.

First tier: a compact table (sorted 64-bit hashes, one byte of length each) of the
pre-tokens that tasks found most frequent, at most TABLE_ENTRIES, broadcast.
Second tier: each worker's own cache, which encodes what it meets for the first time.
No pre-token is shuffled; building the table moves at most TASK_ENTRIES hashes a task.

Defined results: a null text counts as empty and has no tokens; rows are
independent, so repeated rows and null or repeated ids change nothing; an empty
table gives an empty result; columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.tokens import CachedEncoder, Pieces, encoder

TABLE_ENTRIES = 65_536
TASK_ENTRIES = 4_096
TASK_MEMORY = 400_000


def _top(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(hashes) <= n:
        return hashes, counts
    kept = np.argpartition(counts, -n)[-n:]
    return hashes[kept], counts[kept]


def frequent_lengths(df: DataFrame, vocabulary: str, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, token counts) of pre-tokens that are frequent over all rows.

    What is in the table changes the speed only.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(vocabulary)
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        lengths: dict[int, int] = {}
        for batch in batches:
            for p in library.pieces([t or "" for t in batch.column(0).to_pylist()]):
                found, first, n = np.unique(p.hash, return_index=True, return_counts=True)
                often = np.flatnonzero(n > 1)
                part = Pieces(p.data, p.rows[first[often]], p.start[first[often]], p.end[first[often]], found[often])
                lengths |= zip(found[often].tolist(), library.piece_lengths(part).tolist(), strict=True)
                merged, back = np.unique(np.concatenate([hashes, found[often]]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, n[often]]), len(merged)).astype(np.int64)
                hashes, counts = _top(merged, counts, TASK_MEMORY)
                if len(lengths) > 2 * TASK_MEMORY:
                    lengths = {h: lengths[h] for h in hashes.tolist()}
        hashes, counts = _top(hashes, counts, TASK_ENTRIES)
        size = [lengths[h] for h in hashes.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(size, pa.int32()), pa.array(counts)], ["hash", "size", "n"]
        )

    top = (
        df.select(F.col(text))
        .mapInArrow(summarise, "hash long, size int, n long")
        .where("size between 1 and 255")
        .groupBy("hash", "size")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "hash")
        .limit(TABLE_ENTRIES)
        .toArrow()
    )
    hashes = top["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top["size"].to_numpy()[order].astype(np.uint8)


def _lengths(library: CachedEncoder, p: Pieces, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(hashes, p.hash), max(len(hashes) - 1, 0))
    hit = hashes[at] == p.hash if len(hashes) else np.zeros(len(p.hash), dtype=bool)
    out = np.zeros(len(p.hash), dtype=np.int64)
    out[hit] = sizes[at[hit]]
    rest = ~hit
    out[rest] = library.piece_lengths(Pieces(p.data, p.rows[rest], p.start[rest], p.end[rest], p.hash[rest]))
    return out


def count_tokens(
    df: DataFrame, vocabulary: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row."""
    table = df.sparkSession.sparkContext.broadcast(frequent_lengths(df, vocabulary, text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = np.zeros(len(texts), dtype=np.int64)
            for p in library.pieces(texts):
                found = _lengths(library, p, *table.value)
                tokens += np.bincount(p.rows, found, len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
