"""Merkle manifest of a document table, with membership proofs by pointer jumping.

A leaf is the SHA-256 of its fields (``-`` for null, else UTF-8 byte count, ``:``, value). The leaves
of a language, by ascending doc_id, form a tree in which every ``ARITY`` consecutive nodes become
the hash of their digests; the last run may be shorter, even one node. The languages' subroots, null
first and then by bytes, form one more tree over them. Digests are lowercase hex text.

Every node holds the segment of siblings on the way to an ancestor, at first its parent. A round of
pointer jumping joins the table with itself on the ancestor: the distance doubles and the segments
are joined end to end, until every node has reached the root, after log2(height) rounds. Leaves are
nobody's ancestors, so they jump once, last, all leaves of a run with the run's own segment.

Defined cases: null doc_ids come first in their language; rows alike in doc_id are ordered by their
leaf, and rows alike in all fields are leaves of their own, side by side. Null and empty texts differ
(``-`` and ``0:``). A table of one row is its own root, with the empty proof; an empty table gives
an empty result. Columns beyond doc_id, source, lang, n_chars and text are ignored.

Scale: positions come from running totals over ranges of (language, doc_id), so a language with
most rows spreads over tasks. A group is a run of at most ``ARITY`` nodes. Proofs are joined run by
run, an eighth of the rows; the tables that are joined with themselves hold inner nodes only, and
nodes that have reached the root leave the rounds, so the root never is a join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chronotab.llm.mixing import running_total
from chronotab.session import cut_lineage

ARITY = 8
HEX = 64
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Names the tree over the subroots; those of languages are "" (null) or start with "+".
TOP = "^"
SEGMENTS = "array<struct<at:int,siblings:string>>"


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of the named fields in the fixed order."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return sha(F.concat(*[part(fields[f]) for f in FIELDS]))


def leaves(docs: DataFrame, tampered: Column, tamper: dict[str, Column]) -> DataFrame:
    """(tree, pos, doc_id, leaf, other): the leaves of every language in order; ``other`` is the
    leaf of the row with ``tamper``'s fields where ``tampered`` holds."""
    fields = {f: F.col(f) for f in FIELDS}
    own = leaf(fields)
    other = F.when(tampered, leaf(fields | tamper)).otherwise(own)
    tree = F.coalesce(F.concat(F.lit("+"), "lang"), F.lit(""))
    rows = docs.select("doc_id", tree.alias("tree"), own.alias("leaf"), other.alias("other"), F.lit(1).cast("long").alias("one"))
    placed = running_total(rows, [F.col("tree").asc(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], ["one"], group="tree")
    return placed.select("tree", (F.col("one_to") - 1).alias("pos"), "doc_id", "leaf", "other")


def runs(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, pos, kids): every ``ARITY`` consecutive nodes as one row, kids in order with their
    pos, digest and ``payload``. Written to the shared folder."""
    kid = F.struct("pos", "digest", *payload)
    return cut_lineage(nodes.groupBy("tree", F.expr(f"pos div {ARITY}").alias("_run"))
                       .agg(F.array_sort(F.collect_list(kid)).alias("kids"))
                       .select("tree", F.col("_run").alias("pos"), "kids"))


LONE = "pos = 0 and size(kids) = 1"  # the only node left of its tree


def digest_of(kids: str = "kids") -> Column:
    return sha(F.array_join(F.col(f"{kids}.digest"), ""))


def segment(at: Column, kids: str = "kids") -> Column:
    """A kid's siblings in its run and its place among them."""
    together = F.array_join(F.col(f"{kids}.digest"), "")
    return F.struct(at.cast("int").alias("at"),
                    F.concat(F.substring(together, F.lit(1), at * HEX),
                             F.substring(together, at * HEX + HEX + 1, F.lit(ARITY * HEX))).alias("siblings"))


def climb(first: DataFrame, depth: int) -> tuple[DataFrame, DataFrame, int]:
    """From a tree table's runs (``runs`` of its lowest nodes): its inner nodes' links
    (tree, level, pos, up_tree, up_level, up_pos, segments), its subroots (tree, level, digest) and
    its height. ``depth`` is the level of the nodes in ``first``."""
    links, subroots, level, now = None, None, depth, first
    while True:
        lone = now.where(LONE).select("tree", F.lit(level).alias("level"), F.col("kids")[0]["digest"].alias("digest"))
        subroots = lone if subroots is None else subroots.unionByName(lone)
        formed = now.where(f"not ({LONE})")
        if formed.isEmpty():
            return links, subroots, level
        level += 1
        above = formed.select("tree", "pos", digest_of().alias("digest"))
        now = runs(above, [])
        link = (now.where(f"not ({LONE})").select("tree", F.col("pos").alias("up_pos"), "kids", F.posexplode("kids").alias("at", "kid"))
                .select("tree", F.lit(level).alias("level"), F.col("kid.pos").alias("pos"), F.col("tree").alias("up_tree"),
                        F.lit(level + 1).alias("up_level"), "up_pos", F.array(segment(F.col("at"))).cast(SEGMENTS).alias("segments")))
        links = link if links is None else links.unionByName(link)


def jump(links: DataFrame, root: tuple[str, int], height: int) -> DataFrame:
    """(tree, level, pos, segments): every node's siblings on the whole way to the root, the node
    at position 0 of the tree and level ``root``. up_tree is null once a node is there."""
    there = (F.col("up_tree") == root[0]) & (F.col("up_level") == root[1])
    links = cut_lineage(links.withColumn("up_tree", F.when(~there, F.col("up_tree"))))
    reach = 1
    while reach < height:
        far = links.select(*[F.col(c).alias(f"up_{c}") for c in ("tree", "level", "pos")], F.col("up_tree").alias("_tree"),
                           F.col("up_level").alias("_level"), F.col("up_pos").alias("_pos"), F.col("segments").alias("_segments"))
        moved = (links.where("up_tree is not null").join(far, ["up_tree", "up_level", "up_pos"])
                 .select("tree", "level", "pos", F.col("_tree").alias("up_tree"), F.col("_level").alias("up_level"),
                         F.col("_pos").alias("up_pos"), F.concat("segments", "_segments").alias("segments")))
        links = cut_lineage(links.where("up_tree is null").unionByName(moved))
        reach *= 2
    return links.select("tree", "level", "pos", "segments")


def fold(digest: Column, segments: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    def up(acc: Column, s: Column) -> Column:
        return sha(F.concat(F.substring(s["siblings"], F.lit(1), s["at"] * HEX), acc,
                            F.substring(s["siblings"], s["at"] * HEX + 1, F.lit(ARITY * HEX))))

    return F.aggregate(segments, digest, up)


def manifest(docs: DataFrame, tampered: Column, tamper: dict[str, Column]) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root): proof holds (at, siblings) level by level;
    folded_root follows from the proof and the leaf of the row as it is where ``tampered`` holds."""
    low = leaves(docs, tampered, tamper)
    first = runs(low.select("tree", "pos", F.col("leaf").alias("digest"), "doc_id", "other"), ["doc_id", "other"])
    links, subroots, height = climb(first, 0)

    ranked = running_total(subroots.withColumn("one", F.lit(1).cast("long")), [F.col("tree").asc()], ["one"])
    top = cut_lineage(ranked.select("tree", "level", "digest", (F.col("one_to") - 1).alias("pos")))
    # a subroot is known by its tree and level, a node of the top tree by TOP, its level and pos
    tops = runs(top.select(F.lit(TOP).alias("tree"), "pos", "digest", F.col("tree").alias("_tree"), F.col("level").alias("_level")), ["_tree", "_level"])
    top_links, roots, top_height = climb(tops, 0)
    joint = (tops.where(f"not ({LONE})").select(F.col("pos").alias("up_pos"), "kids", F.posexplode("kids").alias("at", "kid"))
             .select(F.col("kid._tree").alias("tree"), F.col("kid._level").alias("level"), F.lit(0).cast("long").alias("pos"),
                     F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_level"), "up_pos", F.array(segment(F.col("at"))).cast(SEGMENTS).alias("segments")))
    for more in (top_links, links):
        joint = joint if more is None else joint.unionByName(more)
    only = top.first() if top_height == 0 else None  # one language: its subroot is the root
    way_up = (TOP, top_height) if top_height else (only.tree, only.level) if only else (TOP, 0)
    ways = jump(joint, way_up, height + top_height)

    # the leaves' own jump: their run's segment, then the way of the run's node
    node = F.when(F.expr(LONE), F.lit(0)).otherwise(F.lit(1))
    below = first.withColumn("level", node).withColumn("_lone", F.expr(LONE)).join(ways, ["tree", "level", "pos"], "left")
    below = below.withColumn("segments", F.coalesce("segments", F.array().cast(SEGMENTS)))
    below = below.join(top.select("tree", F.col("digest").alias("subroot")), "tree", "left")
    root = roots.select("digest").limit(1).scalar()
    each = below.select("subroot", "_lone", "segments", "kids", F.posexplode("kids").alias("at", "kid"))
    proof = F.when(F.col("_lone"), F.col("segments")).otherwise(F.concat(F.array(segment(F.col("at"))).cast(SEGMENTS), "segments"))
    each = each.select(F.col("kid.doc_id").alias("doc_id"), F.col("kid.digest").alias("leaf"), F.col("kid.other").alias("_other"),
                       "subroot", root.alias("root"), proof.alias("proof"))
    return each.select("doc_id", "leaf", "subroot", "root", "proof", fold(F.col("_other"), F.col("proof")).alias("folded_root"))
