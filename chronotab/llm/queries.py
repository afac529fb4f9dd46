"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronotab.session import ensure_checkpoint_dir, prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that the cluster shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("op9_window_dedup", sql=r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
first AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT windows.doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (h) WHERE d < doc_id)),
each AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""")
def op9(t):
    """Word windows of 50 that also start in a smaller document, removed from `documents`."""
    from chronotab.llm.window_dedup import remove_repeats

    out = remove_repeats(t("documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_suffix_dedup", sql=r"""
WITH hexed AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
starts AS (
  SELECT doc_id, i, md5(x[2 * i + 1:2 * i + 200]) AS h
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM hexed)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM starts) WHERE r > 1),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS new
  FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, min(i) AS s, max(i) + 100 AS e
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked) GROUP BY doc_id, g),
gaps AS (  -- what stands before each removed run
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM runs),
parts AS (
  SELECT doc_id, string_agg(x[2 * before + 1:2 * s], '' ORDER BY s) AS k, max(e) AS e,
         sum(gaps.e - gaps.s) AS n, count(*) AS c
  FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k, '') || x[2 * coalesce(e, 0) + 1:])) AS kept_sha256
FROM hexed LEFT JOIN parts USING (doc_id)
""")
def op8(t):
    """Strings of 100 bytes that start earlier in `documents`, removed."""
    from chronotab.llm.suffix_dedup import remove_repeats

    out = remove_repeats(t("documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_containment", sql=r"""
WITH item_words AS (
  SELECT min(item_id) AS item_id, w FROM (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark)
  GROUP BY w),
item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words)),
sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id),
doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words)),
shared AS (
  SELECT doc_id, item_id, count(*) AS m FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS item_shingles, m AS shared, CAST(m AS DOUBLE) / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE m >= 0.8 * n
""")
def op6(t):
    """Items of `benchmark` of which a document of `documents` holds 0.8 or more of the five-word shingles."""
    from chronotab.llm.containment import matches

    return matches(t("documents"), t("benchmark"))


@query("op10_order_minhash")
def op10(t):
    """Every document with the least doc_id of its class of near duplicates (class_id)."""
    from chronotab.llm.order_minhash import near_classes

    out = near_classes(t("documents"))
    return out.withColumn("keep", F.col("doc_id") == F.col("class_id"))


@query("op3_mixing", sql=r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:15] AS BIGINT) AS shuffled
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, least(weight * (SELECT max(level) FROM levels), CAST(3 * source_size AS DOUBLE)) AS target
  FROM levels),
queued AS (
  SELECT d.*, source_size, target,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY shuffled, doc_id NULLS LAST, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS size_to
  FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
copies AS (
  SELECT *, ((copy - 1) * source_size + size_to) / target AS finish
  FROM (SELECT *, unnest([1, 2, 3]) AS copy FROM queued WHERE size > 0)),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, shuffled, doc_id NULLS LAST, size, copy
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM copies)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target,
       CAST(q.size * coalesce(n, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN (
  SELECT doc_id, count(*) AS n FROM cut WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id) USING (doc_id)
""")
def op3(t):
    """What a mix of `documents` by source weights takes of every document."""
    from chronotab.llm.mixing import mix

    return mix(t("documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_language")
def op5(t):
    """Language of every document of `documents`, learned from the folds 0 and 2 of 3."""
    from chronotab.llm.folds import fold
    from chronotab.llm.language import fit, predict

    docs = t("documents")
    out = predict(docs, fit(docs.where(fold(3) != 1)))
    return out.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query("op2_toxicity")
def op2(t):
    """Toxicity of every document of `documents`, learned from `labels` outside fold 0 of 5."""
    from chronotab.llm.folds import fold
    from chronotab.llm.toxicity import toxicity

    out = toxicity(t("documents"), t("labels"))
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_quality")
def op7(t):
    """Quality of every document of `documents`, learned from `labels` outside fold 0 of 5."""
    from chronotab.llm.folds import fold
    from chronotab.llm.quality import ACCEPT, quality

    out = quality(t("documents"), t("labels"))
    return out.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


@query("op1_warc", sql=r"""
WITH pages_ AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
kept AS (SELECT h, max(page_id) AS kept FROM pages_ GROUP BY h),
base32 AS (
  SELECT h, kept, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(CAST('0x' || h[5 * (i // 4) + 1:5 * (i // 4) + 5] AS INT) // [32768, 1024, 32, 1][i % 4 + 1] % 32 AS INT) + 1, 1),
    '' ORDER BY i) AS payload_digest
  FROM (SELECT h, kept, unnest(range(32)) AS i FROM kept) GROUP BY h, kept)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM pages_ JOIN base32 USING (h)
""")
def op1(t):
    """`pages` written as Zstandard WARC archives to the shared folder and read back."""
    from chronotab.llm.warc import read_archives, write_archives

    pages = t("pages")
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, payloads=False).drop("url")


@query("op4_ann")
def op4(t):
    """The 20 nearest found by inner product of every row of `embeddings` whose vec_id is divisible by 20."""
    from chronotab.llm.ann import nearest

    return nearest(t("embeddings"), F.col("vec_id") % 20 == 0)


@query("op11_line_dedup", sql=r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS p FROM split),
keyed AS (
  SELECT *, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.k) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY p) FILTER (common.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (k) GROUP BY doc_id
""")
def op11(t):
    """Lines found in ten documents or more, dropped from every document of `documents`."""
    from chronotab.llm.line_runs import drop_common_lines

    out = drop_common_lines(t("documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_merkle", sql=r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, source, n_chars, text,
         -- crc32 of the decimal id
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
           lambda crc, b: list_reduce(list_concat([xor(crc, b)], [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
             lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 3 = 0 AS tampered
  FROM documents),
texts AS (
  SELECT doc_id, lang, tampered, text, source, n_chars,
         CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other FROM fields),
parts AS (
  SELECT doc_id, lang, text, other,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS front
  FROM texts),
hashed AS (
  SELECT doc_id, lang, sha256(front || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(front || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS other FROM parts),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM hashed),
nodes AS (
  SELECT 0 AS level, tree, pos, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, tree, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY level, tree, pos // 8),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
subroots AS (SELECT tree, height, h FROM nodes JOIN heights USING (tree) WHERE level = height),
tops AS (
  SELECT 0 AS level, tree AS pos, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, pos // 8),
runs AS (
  SELECT tree, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes JOIN heights USING (tree) WHERE level < height GROUP BY ALL
  UNION ALL
  SELECT -1, level, pos // 8, list(h ORDER BY pos) FROM tops WHERE level < (SELECT max(level) FROM tops) GROUP BY ALL),
ways AS (  -- a step is a run of the language's tree, then of the tree over the subroots
  SELECT l.tree, pos AS leaf_pos, tree AS at_tree, 0 AS level, pos, '' AS proof, other AS folded FROM leaves l
  UNION ALL
  SELECT w.tree, leaf_pos, CASE WHEN at_tree >= 0 AND level = height THEN -1 ELSE at_tree END,
         CASE WHEN at_tree >= 0 AND level = height THEN 0 ELSE level + 1 END,
         CASE WHEN at_tree >= 0 AND level = height THEN at_tree ELSE pos // 8 END,
         CASE WHEN at_tree >= 0 AND level = height THEN proof
              ELSE proof || array_to_string(hs[1:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '') END,
         CASE WHEN at_tree >= 0 AND level = height THEN folded
              ELSE sha256(array_to_string(hs[1:pos % 8], '') || folded || array_to_string(hs[pos % 8 + 2:], '')) END
  FROM (SELECT w.*, height, hs FROM ways w JOIN heights USING (tree)
        LEFT JOIN runs r ON r.tree = w.at_tree AND r.level = w.level AND r.run = w.pos // 8) w
  WHERE (at_tree >= 0 AND level = height) OR hs IS NOT NULL)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves l JOIN subroots s USING (tree)
JOIN (SELECT tree, leaf_pos, proof, folded FROM ways
      WHERE at_tree = -1 AND level = (SELECT max(level) FROM tops)) w ON w.tree = l.tree AND w.leaf_pos = l.pos
CROSS JOIN (SELECT h AS root FROM tops WHERE level = (SELECT max(level) FROM tops)) r
""")
def op12(t):
    """Merkle leaves, subroots, root and membership proofs of `documents`; tampered rows fail."""
    from chronotab.llm.merkle import UPPER, manifest, sha

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = manifest(t("documents"), tampered, {"text": F.translate("text", UPPER, UPPER.lower())})
    return out.select("doc_id", "leaf", "subroot", "root", sha(F.array_join("proof.siblings", "")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_whitening")
def op13(t):
    """Whitened components of every usable row of `embeddings`, from the exact scatter matrix."""
    from chronotab.llm.whitening import whiten

    return whiten(t("embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
