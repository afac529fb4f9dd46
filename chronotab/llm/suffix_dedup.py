"""Removal of repeated byte strings by a common-prefix interval tree over suffix arrays.

Texts are UTF-8 bytes; matches never cross documents. A byte goes if a string of ``length`` bytes
covers it that also starts earlier: in a document before it, or earlier in the same document;
strings are judged on the input. The spans removed are the occurrences, but for the first, of the
maximal repeats: an interval of the enhanced suffix array whose common prefix is long enough and
whose occurrences are not all preceded by one byte.

Scale: equal strings have equal anchors (``hashing.anchors``). Around an anchor that occurs
nowhere else nothing can repeat, so only the neighbourhoods of repeated anchors leave their block:
up to 2 x ``length`` bytes each, every distinct one once a block (its further copies in the block
are later occurrences as they stand). A bucket of anchors keeps the first of equal neighbourhoods
and builds suffix arrays over the distinct ones, anchor by anchor in small lots. Text is dealt out
once by block and that exchange serves all three passes.

Documents are ordered by doc_id, nulls last; rows that share a doc_id count as documents in a
fixed order by block and text. Null and empty texts have no bytes and are returned with zero
counts; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from chronotab.llm import blocks as B, hashing as H
from chronotab.llm.esa import SuffixArray, later_occurrences

LENGTH = 100
ANCHOR_BYTES = 32
LOT_BYTES = 1 << 19
_LAST = np.iinfo(np.int64).max  # stands for a null doc_id


def _pieces(table: pa.Table):
    data, offs = H.utf8(table.column("text"))
    for i, j in H.pieces(offs, B.PIECE_BYTES):
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES,
                   block_bytes: int = B.BLOCK_BYTES, key: str | None = None, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(blocks, spans): the dealt documents and (block, row, start, until) byte spans to remove."""
    blocks, n = B.in_blocks(docs, block_bytes, (*([key] if key else []), *keep))

    def keys(table: pa.Table) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64)] + [
            H.anchors(H.byte_values(data), offs, length, anchor)[1] for _, data, offs in _pieces(table)]))

    def neighbourhoods(table: pa.Table, repeated: pa.Table) -> pa.Table:
        table = B.ordered(table, key)
        ids = pc.fill_null(table.column("doc_id").cast(pa.int64()), _LAST).to_numpy()
        found = []
        for i, data, offs in _pieces(table):
            p, a, at, lo, hi = H.anchors(H.byte_values(data), offs, length, anchor)
            with np.errstate(over="ignore"):
                whole = H.mix(H.span(p, lo, hi + length) + np.uint64(length) * (at - lo).astype(np.uint64)
                              + (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B1))
            text = np.searchsorted(offs, lo, side="right") - 1
            found.append((a, whole, text + i, lo - offs[text], hi - lo + length))
        body, offs = H.utf8(table.column("text"))
        a, whole, row, start, size = (np.concatenate(x) for x in zip(*found))
        every = np.sort(a)
        there = np.union1d(B.gather(repeated), every[1:][every[1:] == every[:-1]])
        ok = B.member(a, there)
        a, whole, row, start, size = a[ok], whole[ok], row[ok], start[ok], size[ok]
        order = np.lexsort((start, row, whole, a))
        a, whole, row, start, size = a[order], whole[order], row[order], start[order], size[order]
        first = np.r_[True, (a[1:] != a[:-1]) | (whole[1:] != whole[:-1])][:len(a)]
        # later copies in this block: maximal spans, kept apart by one place between rows
        shift = offs[row[~first]] + row[~first]
        s, e = H.join_spans(shift + start[~first], shift + start[~first] + size[~first])
        r = np.searchsorted(offs[:-1] + np.arange(len(offs) - 1), s, side="right") - 1
        back = offs[r] + r
        a, whole, row, start, size = (x[first] for x in (a, whole, row, start, size))
        raw = body.tobytes()
        begin = offs[row] + start
        bodies = [raw[x:y] for x, y in zip(begin.tolist(), (begin + size).tolist())]
        k, m, block = len(s), len(a), table.column("block")[0].as_py()
        none = np.zeros(k, dtype=np.int64)
        return pa.table({
            "bucket": pa.array(np.r_[none + block, (a % np.uint64(n)).astype(np.int64)].astype(np.int32)),
            "anchor": pa.array(np.r_[none, a.view(np.int64)]), "whole": pa.array(np.r_[none, whole.view(np.int64)]),
            "doc": pa.array(np.r_[none, ids[row]]), "block": pa.array(np.full(k + m, block, dtype=np.int32)),
            "row": pa.array(np.r_[r, row].astype(np.int32)), "start": pa.array(np.r_[s - back, start].astype(np.int32)),
            "until": pa.array(np.r_[e - back, start + size].astype(np.int32)),
            "body": pa.array([None] * k + bodies, pa.binary()),
        })

    def later(table: pa.Table) -> pa.Table:
        body = table.column("body").combine_chunks()
        sure = body.is_null().to_numpy(zero_copy_only=False)
        get = {c: table.column(c).to_numpy() for c in ("anchor", "whole", "doc", "block", "row", "start", "until")}
        out = [np.column_stack([get[c][sure] for c in ("block", "row", "start", "until")])]
        own = np.flatnonzero(~sure)
        order = own[np.lexsort([get[c][own] for c in ("start", "row", "block", "doc", "whole", "anchor")])]
        anchor_, whole = get["anchor"][order], get["whole"][order]
        fresh = np.r_[True, anchor_[1:] != anchor_[:-1]][:len(order)]
        first = fresh | np.r_[True, whole[1:] != whole[:-1]][:len(order)]
        out.append(np.column_stack([get[c][order[~first]] for c in ("block", "row", "start", "until")]))
        order, group = order[first], np.cumsum(fresh)[first]
        # anchors with one neighbourhood only have nothing more to compare
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True][:len(group) + 1]) if len(group) else np.zeros(1, int)
        several = np.repeat(np.diff(edges) > 1, np.diff(edges)) if len(group) else np.zeros(0, bool)
        order, group = order[several], group[several]
        size = get["until"][order] - get["start"][order]
        ends = np.cumsum(size)
        cut = 0
        while cut < len(order):
            to = int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + LOT_BYTES, side="right"))
            to = int(np.searchsorted(group, group[min(max(to, cut + 1), len(order)) - 1], side="right"))
            lot = order[cut:to]
            text = b"".join(x.as_py() for x in body.take(pa.array(lot)))
            array = SuffixArray(np.frombuffer(text, dtype=np.uint8),
                                np.r_[0, np.cumsum(size[cut:to])].astype(np.int64), length)
            place = np.empty(len(lot), dtype=np.int64)
            place[np.lexsort([get[c][lot] for c in ("start", "row", "block", "doc")])] = np.arange(len(lot))
            # neighbourhoods may overlap in their document: order by document, then by byte
            doc_order = np.lexsort([get[c][lot] for c in ("row", "block", "doc")])
            same = np.r_[False, np.all([get[c][lot[doc_order]][1:] == get[c][lot[doc_order]][:-1]
                                        for c in ("row", "block", "doc")], axis=0)][:len(lot)]
            number = np.empty(len(lot), dtype=np.int64)
            number[doc_order] = np.cumsum(~same)
            begin = get["start"][lot].astype(np.int64)
            rank = (number[array.string] << 32) + begin[array.string] + array.offset
            at, many = later_occurrences(array, length, rank)
            which = lot[array.string[at]]
            begin = get["start"][which] + array.offset[at]
            out.append(np.column_stack([get["block"][which], get["row"][which], begin, begin + many]))
            cut = to
        spans = np.concatenate(out)
        return pa.table({c: pa.array(spans[:, i].astype(np.int32)) for i, c in enumerate(("block", "row", "start", "until"))})

    schema = ("bucket int, anchor long, whole long, doc long, block int, row int, start int, until int, body binary")
    repeated = B.repeated_keys(blocks, n, lambda t: keys(t))
    rows = blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(neighbourhoods, schema)
    return blocks, rows.groupBy("bucket").applyInArrow(later, "block int, row int, start int, until int")


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR_BYTES,
                   block_bytes: int = B.BLOCK_BYTES, key: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, text, kept binary, spans): what is left of each text.

    ``kept`` holds the remaining bytes, which need not be whole characters; ``spans`` the removed
    runs as an array of [start, until). ``key`` names a column that sets rows alike in doc_id and text in
    order; it and the columns named in ``keep`` travel with the text and come back with their row, so
    that nothing has to be joined to the texts afterwards.
    """
    blocks, spans = repeated_spans(docs, length, anchor, block_bytes, key, keep)
    carried = [*([key] if key else []), *keep]

    def cut(table: pa.Table, drop: pa.Table) -> pa.Table:
        table = B.ordered(table, key)
        rows = drop.column("row").to_numpy()
        order = np.argsort(rows, kind="stable")
        at = np.searchsorted(rows[order], np.arange(table.num_rows + 1))
        begin, until = (drop.column(c).to_numpy()[order].astype(np.int64) for c in ("start", "until"))
        data, offs = H.utf8(table.column("text"))
        kept, removed, runs = [], [], []
        for r in range(table.num_rows):
            own = data[offs[r]:offs[r + 1]]
            s, e = H.join_spans(begin[at[r]:at[r + 1]], until[at[r]:at[r + 1]])
            removed.append(int((e - s).sum()))
            runs.append([{"start": x, "until": y} for x, y in zip(s.tolist(), e.tolist())])
            kept.append((own[~H.cover(np.column_stack([s, e]), len(own))] if len(s) else own).tobytes())
        return pa.table({
            "doc_id": table.column("doc_id").cast(pa.int64()), "n_bytes": pa.array(np.diff(offs)),
            "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()),
            "spans": pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("until", pa.int32())]))),
        } | {c: table.column(c) for c in carried})

    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:int,until:int>>")
    schema = T.StructType([*schema.fields, *[docs.schema[c] for c in carried]])
    out = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)
    return out.withColumn("n_spans", F.size("spans").cast("long"))
