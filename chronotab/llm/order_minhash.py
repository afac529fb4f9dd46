"""Near-duplicate classes by Order MinHash with banded alignment.

A text is the sequence of its five-word shingles (``shingles``; a text of one to four words is one
shingle). Two texts are linked if 1 - edit distance / longer length of the two sequences is at
least ``threshold``; classes are the connected components of the links.

Sketch: shingles are labelled with their occurrence number. Each of ``entries`` hash functions
picks the ``tuple_size`` labelled shingles with the smallest hashes and keeps them in text order;
the hash of that tuple is one entry, so order counts as well as content. Linked texts share at
least 2/3 of their labelled shingles, so an entry agrees with probability 0.29 or more; of 32
entries fewer than MIN_AGREE agree for one pair in 1,000 at the threshold itself, and for one in
10**5 at similarity 0.85.

Search: texts with equal words are one node (smallest doc_id), found by a grouped minimum. Nodes
meet by equal entries. First, maximum spanning trees over the number of agreeing entries give the
likeliest pairs, as many as nodes. Then the verified classes are contracted, and every pair of
different classes with MIN_AGREE agreeing entries is verified, so a pair that fails costs no link,
whatever the trees took. Where a bucket holds few such pairs for its nodes (``SPARSE``) they are
listed and dealt out. Where it holds many, a family of texts that agree but are not linked, they are
never listed: the nodes' sequences go to the tasks in which the parts of the bucket meet, which test
the pairs of classes not yet joined there and return the links that join two, fewer than their nodes.
Candidates are verified on their whole texts by banded alignment: first the exact bound from the
shared shingles, then furthest-reaching diagonals, never more than the distance allowed by
``threshold``.

Texts without words (null, empty) and rows without doc_id take no part and are in no class with
others; rows sharing a doc_id are one node; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronotab.llm import hashing as H, shingles as S
from chronotab.llm.components import components
from chronotab.llm.scratch import remove, shuffles_removed, written
from chronotab.session import cut_lineage

THRESHOLD = 0.8
ENTRIES = 32
TUPLE = 3
MIN_AGREE = 3
BUCKET_NODES = 4096
#: A task lists its pairs if they are at most so many for each of its nodes.
SPARSE = 2
#: Bytes of sequences that a part of a bucket may hold where pairs are tested in place.
PART_BYTES = 8 << 20
_SEEDS = np.random.default_rng(77).integers(1, 1 << 62, ENTRIES * 2, dtype=np.uint64)


def sequence(words: np.ndarray) -> np.ndarray:
    """The text's shingles in order; fewer than five words make one shingle."""
    if 0 < len(words) < S.WORDS:
        return H.span(H.prefix(words), np.array([0]), np.array([len(words)]))
    return S.shingles(words)


def labelled(seq: np.ndarray) -> np.ndarray:
    """The sequence with each shingle's occurrence number mixed in."""
    order = np.argsort(seq, kind="stable")
    ranked = seq[order]
    new = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    number = np.arange(len(seq)) - np.repeat(new, np.diff(np.r_[new, len(seq)]))
    out = np.empty(len(seq), dtype=np.uint64)
    with np.errstate(over="ignore"):
        out[order] = H.mix(ranked + number.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    return out


def sketch(seq: np.ndarray, entries: int = ENTRIES, size: int = TUPLE) -> np.ndarray:
    """One hash per entry, of the smallest labelled shingles in text order."""
    n = len(seq)
    own = labelled(seq)
    out = np.empty(entries, dtype=np.uint64)
    step = max(1, (1 << 20) // max(1, n))
    for lo in range(0, entries, step):
        seeds = _SEEDS[2 * lo:2 * min(entries, lo + step)]
        with np.errstate(over="ignore"):
            h = (own[None, :] ^ seeds[0::2, None]) * (seeds[1::2, None] | np.uint64(1))
            h ^= h >> np.uint64(32)
            rows = np.arange(len(h))
            at = np.empty((len(h), min(size, n)), dtype=np.int64)
            for k in range(at.shape[1]):
                at[:, k] = h.argmin(axis=1)
                h[rows, at[:, k]] = np.iinfo(np.uint64).max
            at.sort(axis=1)
            total = np.arange(lo, lo + len(h), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for k in range(at.shape[1]):
                total = H.mix(total + seq[at[:, k]])
        out[lo:lo + len(h)] = total
    return out


def aligned_cost(at: np.ndarray, to: np.ndarray, n: int, m: int) -> int:
    """Edits of the alignment that keeps the longest run, in order on both sides, of the matches
    (at, to) of two sequences of ``n`` and ``m``: no less than their edit distance."""
    order = np.argsort(at)
    at, to = at[order], to[order]
    if np.any(to[1:] < to[:-1]):
        tails: list[int] = []
        last: list[int] = []
        back = np.full(len(to), -1)
        for i, x in enumerate(to.tolist()):
            k = bisect.bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
                last.append(i)
            else:
                tails[k], last[k] = x, i
            back[i] = last[k - 1] if k else -1
        keep, i = [], last[-1]
        while i >= 0:
            keep.append(i)
            i = back[i]
        at, to = at[keep[::-1]], to[keep[::-1]]
    gaps = np.maximum(np.diff(np.r_[-1, at, n]), np.diff(np.r_[-1, to, m])) - 1
    return int(gaps.sum())


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD, named_a: np.ndarray | None = None,
            named_b: np.ndarray | None = None) -> bool:
    """Whether 1 - edit distance / longer length is at least ``threshold``; ``named_a`` and ``named_b`` are the
    labelled sequences, if known.

    Two exact bounds decide most pairs: the number of shared shingles, and the cost of the
    alignment along them. The rest is aligned greedily along diagonals: for each number of edits
    the furthest place reached on every diagonal of the band; runs of equal shingles are skipped
    by comparing prefix hashes.
    """
    n, m = len(a), len(b)
    most = max(n, m)
    if most == 0:
        return False
    band = int(np.floor(most * (1 - threshold) + 1e-9))
    if abs(n - m) > band:
        return False
    _, at, to = np.intersect1d(labelled(a) if named_a is None else named_a, labelled(b) if named_b is None else named_b,
                                assume_unique=True, return_indices=True)
    if most - len(at) > band:
        return False  # too few shingles are shared for any alignment
    if aligned_cost(at, to, n, m) <= band:
        return True  # an alignment that is good enough
    pa_, pb = H.prefix(a), H.prefix(b)

    def slide(x: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """From a[x], b[x - diagonal]: the end of the run of equal shingles."""
        lo, hi = np.zeros(len(x), dtype=np.int64), np.minimum(n - x, m - (x - diagonal))
        while np.any(lo < hi):
            mid = (lo + hi + 1) >> 1
            ok = H.span(pa_, x, x + mid) == H.span(pb, x - diagonal, x - diagonal + mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return x + lo

    goal = n - m
    reach = slide(np.array([0]), np.array([0]))  # diagonals -d..d for d edits
    if goal == 0 and reach[0] >= n:
        return True
    for d in range(1, band + 1):
        diagonal = np.arange(-d, d + 1)
        old = np.full(2 * d + 3, -1, dtype=np.int64)
        old[2:-2] = reach
        best = np.maximum(old[1:-1] + 1, np.maximum(old[:-2] + 1, old[2:]))  # change, leave out of a, of b
        best = np.where(old[1:-1] < 0, np.maximum(np.where(old[:-2] >= 0, old[:-2] + 1, -1), old[2:]), best)
        best = np.minimum(best, np.minimum(n, m + diagonal))
        ok = (best >= 0) & (best - diagonal >= 0)
        reach = np.full(2 * d + 1, -1, dtype=np.int64)
        reach[ok] = slide(best[ok], diagonal[ok])
        if abs(goal) <= d and reach[goal + d] >= n:
            return True
    return False


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, low, high, n, sketch): a 128-bit name of the words, sequence length, entries."""

    def sign(batches):
        for batch in batches:
            ids, low, high, size, made = [], [], [], [], []
            for doc, words in zip(batch.column("doc_id").to_pylist(), S.word_rows(batch.column("text"))):
                if doc is None or not len(words):
                    continue
                seq = sequence(words)
                ids.append(doc)
                size.append(len(seq))
                end = np.array([len(words)])
                low.append(int(H.span(H.prefix(words), 0 * end, end).view(np.int64)[0]))
                high.append(int(H.span(H.prefix(H.mix(~words)), 0 * end, end).view(np.int64)[0]))
                made.append(sketch(seq).tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64()),
                "n": pa.array(size, pa.int64()), "sketch": pa.array(made, pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, low long, high long, n long, sketch binary")


def spanning_tree(nodes: np.ndarray, size: np.ndarray, rows: np.ndarray, threshold: float):
    """Maximum spanning tree by agreeing entries: (a, b) pairs and, per node, its tree's first node.

    ``nodes`` ascend. Pairs that agree in fewer than MIN_AGREE entries or differ too much in
    length are no edges; agreement counts in steps of four so that ties fall to the first node.
    """
    count = len(nodes)
    best, parent = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
    waiting = np.ones(count, dtype=bool)
    a, b, head, tree, i = [], [], np.zeros(count, dtype=np.int64), 0, 0
    for _ in range(count):
        waiting[i] = False
        head[i] = tree
        same = (rows == rows[i]).sum(axis=1)
        weight = np.where((same >= MIN_AGREE) & (np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i])),
                          1 + same // 4, 0)
        better = waiting & (weight > best)
        best[better], parent[better] = weight[better], i
        left = np.where(waiting, best, -1)
        i = int(left.argmax())
        if left[i] > 0:
            a.append(nodes[parent[i]])
            b.append(nodes[i])
        elif left[i] == 0:
            tree = i
    return a, b, nodes[head]


def in_groups(rows: DataFrame, threshold: float) -> DataFrame:
    """Trees of the groups (key, part) of rows (key, part, node, n, sketch): (key, a, b) pairs, and
    (key, a, n, sketch) with null b for each tree's first node."""

    def trees(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            key, part = rest.column("key").to_numpy(), rest.column("part").to_numpy()
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])][:len(key)])
            if len(new) > 1:  # the last group may go on in the next batch
                yield from made(rest.slice(0, int(new[-1])), new)
                rest = rest.slice(int(new[-1]))
        if rest is not None and rest.num_rows:
            key, part = rest.column("key").to_numpy(), rest.column("part").to_numpy()
            yield from made(rest, np.r_[np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])]), len(key)])

    def made(table: pa.Table, edges: np.ndarray):
        key, node, size = (table.column(c).to_numpy() for c in ("key", "node", "n"))
        sketches_ = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(node), ENTRIES)
        small = sketches_.astype(np.uint32)
        many = np.diff(edges)
        two = edges[:-1][many == 2]
        a, b, k, heads = [], [], [], [edges[:-1][many == 1]]
        if len(two):  # pairs, all at once
            same = (small[two] == small[two + 1]).sum(axis=1)
            near = np.minimum(size[two], size[two + 1]) >= threshold * np.maximum(size[two], size[two + 1])
            ok = (same >= MIN_AGREE) & near
            a.append(node[two[ok]])
            b.append(node[two[ok] + 1])
            k.append(key[two[ok]])
            heads += [two, two[~ok] + 1]
        for lo, hi in zip(edges[:-1][many > 2].tolist(), edges[1:][many > 2].tolist()):
            x, y, head = spanning_tree(node[lo:hi], size[lo:hi], small[lo:hi], threshold)
            a.append(np.array(x, dtype=np.int64))
            b.append(np.array(y, dtype=np.int64))
            k.append(np.full(len(x), key[lo]))
            heads.append(lo + np.flatnonzero(head == node[lo:hi]))
        a, b, k = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (a, b, k))
        lead = np.concatenate(heads)
        m, n = len(a), len(lead)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(np.r_[k, key[lead]]), "a": pa.array(np.r_[a, node[lead]]),
            "b": pa.array(np.r_[b, np.zeros(n, dtype=np.int64)], mask=np.r_[np.zeros(m, bool), np.ones(n, bool)]),
            "n": pa.array(np.r_[np.zeros(m, dtype=np.int64), size[lead]]),
            "sketch": pa.array([None] * m + [sketches_[i].tobytes() for i in lead], pa.binary())})

    grouped = rows.repartition("key", "part").sortWithinPartitions("key", "part", "node")
    return grouped.select("key", "part", "node", "n", "sketch").mapInArrow(trees, "key long, a long, b long, n long, sketch binary")


def meetings(nodes: DataFrame) -> DataFrame:
    """(key, node, count): the nodes of every bucket of two or more."""

    def explode(batches):
        for batch in batches:
            made = batch.column("sketch").to_pylist()
            keys = np.frombuffer(b"".join(made), dtype=np.int64)
            take = pa.array(np.repeat(np.arange(len(made)), ENTRIES))
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys), "node": batch.column("node").take(take)})

    keys = nodes.select("node", "sketch").mapInArrow(explode, "key long, node long").distinct()
    counts = keys.groupBy("key").count().where("count > 1")
    return keys.join(counts, "key")


def candidates(met: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """(a, b) pairs of nodes to verify first, a < b: trees of the buckets, or of parts of large ones."""
    dealt = met.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("count") / bucket_nodes)).cast("int"))
    # few nodes meet at all: their sketches join here, once a key
    rows = dealt.join(nodes.select("node", "n", "sketch"), "node").select("key", "part", "node", "n", "sketch")

    parts = cut_lineage(in_groups(rows, threshold).select("key", "a", "b", "n", "sketch"))
    large = met.where(F.col("count") > bucket_nodes).select("key").distinct()
    heads = parts.where("b is null").join(large, "key")
    many = heads.groupBy("key").agg(F.ceil(F.count("*") / bucket_nodes).alias("parts"))
    heads = heads.join(many, "key").select("key", F.pmod(F.xxhash64("a", F.lit(1)), "parts").cast("int").alias("part"),
                                           F.col("a").alias("node"), "n", "sketch")
    again = in_groups(heads, threshold)
    pairs = parts.where("b is not null").select("a", "b").union(again.where("b is not null").select("a", "b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_in(table: pa.Table):
    """Of a group of ``left_over``: its rows' nodes, classes and, node by node, the (i, places, agreement)
    of the pairs of different classes that belong to it.

    The nodes that ``ask`` meet those that are ``told``. A pair belongs to the bucket of its first
    agreeing entry only, and of two nodes that both ask it is given by the smaller one.
    """
    key = np.uint64(table.column("key")[0].as_py() & ((1 << 64) - 1))
    node, size, group = (table.column(c).to_numpy() for c in ("node", "n", "class"))
    ask, told = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("ask", "told"))
    asks_too = table.column("minor").to_numpy(zero_copy_only=False)[told]
    entry = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(node), ENTRIES)
    other = entry[told]

    def pairs(threshold: float):
        for i in ask.tolist():
            ok = (group[told] != group[i]) & (~asks_too | (node[told] > node[i]))
            ok &= np.minimum(size[told], size[i]) >= threshold * np.maximum(size[told], size[i])
            at = np.flatnonzero(ok)
            same = other[at] == entry[i]
            many = same.sum(axis=1)
            ok = (many >= MIN_AGREE) & (entry[i][same.argmax(axis=1)] == key)
            if ok.any():
                yield i, told[at[ok]], many[ok]

    return node, group, pairs


def few_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(key, a, b) pairs, a < b, of different classes among the rows of ``left_over``; a group of more
    than SPARSE pairs for each row gives none of them but one row with null b."""

    def meet(table: pa.Table) -> pa.Table:
        node, _, pairs = near_in(table)
        a, b, most = [], [], SPARSE * len(node)
        for i, at, _ in pairs(threshold):
            a.append(np.full(len(at), node[i]))
            b.append(node[at])
            most -= len(at)
            if most < 0:
                break
        key = table.column("key")[0].as_py()
        if most < 0:
            return pa.table({"key": pa.array([key], pa.int64()), "a": pa.array([None], pa.int64()), "b": pa.array([None], pa.int64())})
        a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (a, b))
        return pa.table({"key": pa.array(np.full(len(a), key, dtype=np.int64)), "a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return rows.groupBy("key", "part", "lot").applyInArrow(meet, "key long, a long, b long")


def links_in_place(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b) similar pairs that join the classes of a group of ``left_over`` (with sequences): the likeliest
    pairs of a node first, none of two classes that the group has joined already."""

    def test(table: pa.Table) -> pa.Table:
        node, group, pairs = near_in(table)
        raw = table.column("seq").to_pylist()
        root = {int(c): int(c) for c in group}
        known: dict[int, tuple] = {}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def text(i: int) -> tuple:
            if i not in known:
                seq = np.frombuffer(raw[i], dtype=np.uint64)
                known[i] = (seq, labelled(seq))
            return known[i]

        a, b = [], []
        for i, at, many in pairs(threshold):
            for j in at[np.lexsort((node[at], -many))].tolist():
                x, y = find(int(group[i])), find(int(group[j]))
                if x != y and similar(text(i)[0], text(j)[0], threshold, text(i)[1], text(j)[1]):
                    root[max(x, y)] = min(x, y)
                    a.append(node[i])
                    b.append(node[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("key", "part", "lot").applyInArrow(test, "a long, b long")


def left_over(met: DataFrame, nodes: DataFrame, roots: DataFrame, bucket_nodes: int, only: DataFrame | None = None) -> DataFrame:
    """The rows of buckets (of those in ``only``, if given) that still hold several classes.

    Two nodes of a bucket's most frequent class need no comparison, so only the others ask. The nodes
    are dealt to parts of about ``bucket_nodes`` and PART_BYTES, and those that ask to lots; every lot
    meets every part in a task of its own, so no task grows with a bucket and no pair is left out.
    """
    own = met if only is None else met.join(only, "key", "leftsemi")
    own = own.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("class"))
    own = own.join(nodes.select("node", "n"), "node")
    sizes = own.groupBy("key", "class").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("n"))
    buckets = (sizes.groupBy("key").agg(F.count("*").alias("classes"), F.max_by("class", F.struct("count", "class")).alias("major"),
                                        F.sum("count").alias("size"), F.max("count").alias("most"), F.sum("n").alias("n"))
               .where("classes > 1").withColumn("share", F.ceil(F.col("n") * 8 / PART_BYTES))
               .select("key", "major", F.greatest("share", F.ceil(F.col("size") / bucket_nodes)).alias("parts"),
                       F.greatest("share", F.ceil((F.col("size") - F.col("most")) / bucket_nodes)).alias("lots")))
    rows = own.join(buckets, "key").withColumns({
        "minor": F.col("class") != F.col("major"), "own_part": F.pmod(F.xxhash64("node"), "parts"),
        "own_lot": F.pmod(F.xxhash64("node", F.lit(1)), "lots")})
    told = (rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
            .withColumns({"part": F.col("own_part"), "told": F.lit(True), "ask": F.expr("minor and lot = own_lot")}))
    asks = (rows.where("minor and parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .where("part <> own_part").withColumns({"lot": F.col("own_lot"), "told": F.lit(False), "ask": F.lit(True)}))
    dealt = told.select(columns := ["key", "part", "lot", "node", "class", "minor", "ask", "told"]).union(asks.select(columns))
    return dealt.join(nodes.select("node", "n", "sketch"), "node")


def sequences(texts: DataFrame) -> DataFrame:
    """(node, seq): every text's shingles in order."""

    def make(batches):
        for batch in batches:
            made = [sequence(w).tobytes() for w in S.word_rows(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["node", "seq"])

    return texts.select("doc_id", "text").mapInArrow(make, "node long, seq binary")


def verified(docs: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs whose texts are similar."""

    def align(batches):
        for batch in batches:
            left = S.word_rows(batch.column("left"))
            right = S.word_rows(batch.column("right"))
            ok = [similar(sequence(x), sequence(y), threshold) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    text = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    both = (pairs.join(text.withColumnsRenamed({"doc_id": "b", "text": "right"}), "b")
            .join(text.withColumnsRenamed({"doc_id": "a", "text": "left"}), "a"))
    return both.select("a", "b", "left", "right").mapInArrow(align, "a long, b long")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` with the classes of ``links`` joined."""
    if links.isEmpty():
        return roots
    return cut_lineage(components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(links)))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """(doc_id, class_id), one row per document: the least doc_id of its class.

    Documents that take no part are their own class.
    """
    with shuffles_removed(docs.sparkSession):
        made = cut_lineage(sketches(docs))
        names = made.groupBy("low", "high").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                                                F.first("sketch").alias("sketch"))
        nodes = names.select("node", "n", "sketch")
        met = cut_lineage(meetings(nodes))
        # few nodes meet at all: their texts are dealt out once
        texts, folder = written(docs.select("doc_id", "text").where("text is not null")
                                .join(met.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "leftsemi"), "texts")
        tested = cut_lineage(candidates(met, nodes, threshold, bucket_nodes))
        # a doc_id on rows of different texts ties their nodes together
        own = made.select("low", "high", "doc_id").distinct().join(names.select("low", "high", "node"), ["low", "high"])
        twice = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
        tied = own.join(twice, "doc_id").select("a", F.col("node").alias("b"))
        roots = cut_lineage(components(verified(texts, tested, threshold).union(tied)))
        found = cut_lineage(few_pairs(left_over(met, nodes, roots, bucket_nodes), threshold))
        fresh = cut_lineage(found.where("b is not null").select("a", "b").distinct().join(tested, ["a", "b"], "leftanti"))
        roots = joined(roots, cut_lineage(verified(texts, fresh, threshold)))
        many = cut_lineage(found.where("b is null").select("key").distinct())
        if not many.isEmpty():
            rows = left_over(met, nodes, roots, bucket_nodes, many).join(sequences(texts), "node")
            roots = joined(roots, cut_lineage(links_in_place(rows, threshold)))
        remove(docs.sparkSession, folder)
    member = (own.join(roots, "node", "left").groupBy("doc_id")
              .agg(F.min(F.coalesce("root", "node")).alias("class_id")))
    return (docs.select("doc_id").join(member, "doc_id", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")))
