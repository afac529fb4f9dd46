"""Substring dedup by Rabin-Karp hashes of fixed-length word windows.

Words are runs of anything but the six ASCII blanks, taken unchanged. A window is ``window``
consecutive words of one document. A window is repeated if its words also start in a document with
a smaller doc_id; repeated windows merge into maximal removal intervals. Windows are judged on the
input, not on what is left, and a repeat inside one document alone removes nothing.

Scale: equal windows have equal anchors (``hashing.anchors``), so a window whose anchor occurs
nowhere else is settled without leaving its block. All other windows go by their hash to one
count in Spark (smallest doc_id), except those that a smaller document of the same block already
decides: a window so common that it is in every document sends one row a block. Text is dealt out
once by block and that exchange serves all three passes.

Nulls and empty texts have no words and are returned with zero counts; a null doc_id is greater
than all others and equal to none, so its repeated windows go but it removes nothing from others;
rows sharing a doc_id are one document for the rule and each keep their row; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from chronotab.llm import blocks as B, hashing as H

WINDOW_WORDS = 50
ANCHOR_WORDS = 10
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id


def _pieces(table: pa.Table):
    """Per piece of a block: doc ids, word hashes, first word of each text."""
    table = B.ordered(table)
    data, offs = H.utf8(table.column("text"))
    ids = pc.fill_null(table.column("doc_id").cast(pa.int64()), _LAST).to_numpy()
    for i, j in H.pieces(offs, B.PIECE_BYTES):
        h, _, _, first = H.words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], H.NOT_BLANK)
        yield i, ids[i:j], h, first


def repeated_spans(docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
                   block_bytes: int = B.BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(blocks, spans): the dealt documents and (block, row, start, end) word spans to remove.

    ``row`` is the row's place in its block by ``blocks.ordered``.
    """
    blocks, n = B.in_blocks(docs, block_bytes)

    def keys(table: pa.Table) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64)] + [
            H.anchors(h, first, window, anchor)[1] for _, _, h, first in _pieces(table)]))

    def candidates(key, table: pa.Table, repeated: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if table.num_rows:
            there = B.gather(repeated)
            found = []
            for i, ids, h, first in _pieces(table):
                p, a, _, lo, hi = H.anchors(h, first, window, anchor)
                found.append((i, ids, first, p, a, lo, hi))
            every = np.sort(np.concatenate([x[4] for x in found]))
            there = np.union1d(there, every[1:][every[1:] == every[:-1]])
            for i, ids, first, p, a, lo, hi in found:
                ok = B.member(a, there)
                lo, hi = lo[ok], hi[ok]
                size = hi - lo + 1
                starts = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                text = np.searchsorted(first, starts, side="right") - 1
                out[0].append(H.span(p, starts, starts + window))
                out[1].append(ids[text])
                out[2].append(text + i)
                out[3].append(starts - first[text])
        h, ids, row, pos = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out)
        h = h.astype(np.uint64, copy=False)
        order = np.lexsort((ids, h))
        h, ids, row, pos = h[order], ids[order], row[order], pos[order]
        new = np.r_[True, h[1:] != h[:-1]][:len(h)]
        least = ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else ids
        sure = ids > least
        if table.num_rows:
            block = key[0].as_py()
        # windows that the block itself decides leave as spans, the others by their hash
        order = np.lexsort((pos[sure], row[sure]))
        r, s = row[sure][order], pos[sure][order]
        cut = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)][:len(r)])
        last = np.r_[cut[1:] - 1, len(r) - 1][:len(cut)]
        k = len(cut)
        rest = ~sure
        m = int(rest.sum())
        return pa.table({
            "hash": pa.array(np.r_[np.zeros(k, dtype=np.int64), h[rest].view(np.int64)]),
            "doc": pa.array(np.r_[np.zeros(k, dtype=np.int64), ids[rest]]),
            "block": pa.array(np.full(k + m, block if table.num_rows else 0, dtype=np.int32)),
            "row": pa.array(np.r_[r[cut], row[rest]].astype(np.int32)),
            "start": pa.array(np.r_[s[cut], pos[rest]].astype(np.int32)),
            "until": pa.array(np.r_[s[last] + window, np.zeros(m, dtype=np.int64)].astype(np.int32)),
        })

    schema = "hash long, doc long, block int, row int, start int, until int"
    repeated = B.repeated_keys(blocks, n, keys)
    rows = blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(candidates, schema)
    # a decided span carries no hash: its own place deals it out
    deal = F.when(F.col("until") > 0, F.xxhash64("block", "row", "start")).otherwise(F.col("hash"))
    least = F.min(F.when(F.col("until") == 0, F.col("doc"))).over(Window.partitionBy("deal"))
    spans = (rows.withColumn("deal", deal).withColumn("least", least)
             .where((F.col("until") > 0) | (F.col("least") < F.col("doc")))
             .select("block", "row", "start",
                     F.when(F.col("until") > 0, F.col("until")).otherwise(F.col("start") + window).alias("until")))
    return blocks, spans


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
                   block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept holds the words left, joined by one blank."""
    blocks, spans = repeated_spans(docs, window, anchor, block_bytes)

    def cut(table: pa.Table, drop: pa.Table) -> pa.Table:
        table = B.ordered(table)
        rows = drop.column("row").to_numpy()
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        cuts = np.column_stack([drop.column("start").to_numpy()[order], drop.column("until").to_numpy()[order]])
        at = np.searchsorted(rows, np.arange(table.num_rows + 1))
        data, offs = H.utf8(table.column("text"))
        raw = data.tobytes()
        total, removed, kept = [], [], []
        for r in range(table.num_rows):
            own = raw[offs[r]:offs[r + 1]].split()
            total.append(len(own))
            if at[r] < at[r + 1]:
                gone = H.cover(cuts[at[r]:at[r + 1]], len(own))
                removed.append(int(gone.sum()))
                own = compress(own, ~gone)
            else:
                removed.append(0)
            kept.append(b" ".join(own))
        return pa.table({"doc_id": table.column("doc_id").cast(pa.int64()),
                         "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "kept": pa.array(kept, pa.binary())})

    out = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))
