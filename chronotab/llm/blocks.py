"""Blocks of documents and the search for anchors that repeat between them.

Documents are dealt to blocks of bounded size by a hash of id and text. Each block sends the
distinct hashes of its anchors, bucketed by hash; a bucket gets each hash at most once a block, so
no key, however common, gathers in one task more than one entry a block. The bucket sends back to
every block the hashes that another block also has.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 8 << 20
#: Bytes of text handled at once inside a task.
PIECE_BYTES = 1 << 20
BUCKET_BLOCKS = 8


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(doc_id, text, block) and the number of blocks; other columns are left out, but for those named in ``keep``."""
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(1, -(-total // block_bytes)))
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *keep)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    return out.withColumn("block", block), n


def repeated_keys(blocks: DataFrame, n: int, keys: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """(block, keys binary): per block, those of its keys that other blocks have as well.

    ``keys`` maps a block to its distinct uint64 keys, sorted. A key that repeats inside a block
    only is left to the block itself.
    """
    buckets = max(1, -(-n // BUCKET_BLOCKS))

    def send(table: pa.Table) -> pa.Table:
        found = keys(table)
        to = (found % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        found, edges = found[order], np.searchsorted(to[order], np.arange(buckets + 1))
        block = table.column("block")[0].as_py()
        rows = [(b, found[edges[b]:edges[b + 1]].tobytes()) for b in range(buckets) if edges[b] < edges[b + 1]]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "block": pa.array([block] * len(rows), pa.int32()),
                         "keys": pa.array([r[1] for r in rows], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]
        every = np.sort(np.concatenate(own))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        back = [x[np.isin(x, twice)].tobytes() for x in own]
        return pa.table({"block": table.column("block").cast(pa.int32()), "keys": pa.array(back, pa.binary())})

    sent = blocks.groupBy("block").applyInArrow(send, "bucket int, block int, keys binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block int, keys binary")


def ordered(table: pa.Table, key: str | None = None) -> pa.Table:
    """A block's rows in an order that every pass sees alike: doc_id (nulls last), text, then any row key."""
    return table.sort_by([(c, "ascending") for c in ("doc_id", "text", key) if c])


def gather(table: pa.Table) -> np.ndarray:
    """The keys of a block's rows of ``repeated_keys``, sorted."""
    if table.num_rows == 0:
        return np.zeros(0, dtype=np.uint64)
    return np.sort(np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]))


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``among``."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values
