"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm import (
    bpe, chunkdedup, langid, linededup, merkle, minhash, mixing, pii, quality, runs, sharding, spotsigs, warc,
)
from touchpath.llm.common import ship

VOCABULARY = "byte_bpe_50k.tiktoken"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    found = bpe.decode(bpe.encode(documents(spark, folder), path, public_tokenizers.PATTERN), path)
    return found.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_kd_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, folder), 16)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunkdedup.passages(documents(spark, folder))


def op4_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(documents(spark, folder))


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder), shingle=2)


def op6_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder))


def op7_language_gru(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(documents(spark, folder)).select("doc_id", "held_out", "lang_pred", "score")


def op8_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace(documents(spark, folder)).select("doc_id", "text", "n_replaced")


def op9_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.neighbours(documents(spark, folder))


def spot_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The search over all documents by the fingerprints of ``op9_spot_signatures``."""
    return spotsigs.near_duplicates(documents(spark, folder))


def op10_warc_segments(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return warc.round_trip(spark.read.parquet(f"{folder}/pages.parquet"))


def op11_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.without_common_lines(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_merkle_blocks(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.document_manifest(documents(spark, folder))
    proof = F.sha2(F.translate("proof", "LR,-", ""), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op13_recompression_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_planted_periods(documents(spark, folder)))
    # the longest run; of equal ones the first, then the one with the smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    table = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest.alias("_longest"),
        F.sha2(table, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("_longest.col2")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.col3")).alias("period"),
        F.floor(1000 * F.col("_longest.length") / -F.col("_longest.col3")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_byte_bpe, op2_kd_tree_shards, op3_chunk_dedup, op4_pivotal_mix, op5_minhash, op6_weak_supervision,
        op7_language_gru, op8_surrogates, op9_spot_signatures, op10_warc_segments, op11_line_runs, op12_merkle_blocks,
        op13_recompression_runs, spot_near_duplicates,
    )
}

ORACLE = {
    "op10_warc_segments": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        f AS (SELECT body, min(page_id) AS first FROM p WHERE strlen(body) >= 100 GROUP BY body)
        SELECT p.page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes, sha256(p.body) AS payload_digest,
               CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f USING (body)""",
    "op11_line_runs": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        common AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40
                   GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        judged AS (SELECT k.*, coalesce(k.doc_id <> owner, false) AS goes FROM k LEFT JOIN common USING (key))
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (goes) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '')) AS kept_sha256
        FROM judged GROUP BY r""",
    # levels of all trees; what stands beside a document's node at each level; the fold from leaf to root
    "op12_merkle_blocks": """
        WITH RECURSIVE c AS (
            SELECT *, CAST(doc_id AS VARCHAR) AS d, CAST(n_chars AS BIGINT) AS chars FROM documents),
        f AS (
            SELECT doc_id, lang, coalesce('=' || lang, '') AS tree,
                   coalesce(strlen(d) || ':' || d, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(chars::VARCHAR) || ':' || chars, '-') AS own,
                   coalesce(strlen((chars + 1)::VARCHAR) || ':' || (chars + 1), '-') AS other,
                   coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(d, ''),
                       lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                       lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END),
                       4294967295) % 7 = 0 AS chosen
            FROM c),
        leaves AS MATERIALIZED (
            SELECT doc_id, tree, leaf, CASE WHEN chosen THEN sha256(head || other || tail) ELSE leaf END AS changed,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY tree) AS n
            FROM (SELECT *, sha256(head || own || tail) AS leaf FROM f)),
        nodes AS (
            SELECT 0 AS level, tree, place, leaf AS digest, n FROM leaves
            UNION ALL
            SELECT level + 1, tree, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2
            FROM nodes WHERE n > 1 GROUP BY level, tree, place // 2, n),
        subroots AS MATERIALIZED (
            SELECT tree, digest, level, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n
            FROM nodes WHERE n = 1),
        crown AS (
            SELECT 0 AS level, place, digest, n FROM subroots
            UNION ALL
            SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2
            FROM crown WHERE n > 1 GROUP BY level, place // 2, n),
        inner_steps AS (
            SELECT l.tree, l.place, v.level, s.digest AS beside, s.place < v.place AS before
            FROM leaves l JOIN nodes v ON v.tree = l.tree AND v.n > 1 AND v.place = l.place >> v.level
            LEFT JOIN nodes s ON s.tree = v.tree AND s.level = v.level AND s.place = xor(v.place, 1)),
        outer_steps AS (
            SELECT r.tree, r.level + v.level AS level, s.digest AS beside, s.place < v.place AS before
            FROM subroots r JOIN crown v ON v.n > 1 AND v.place = r.place >> v.level
            LEFT JOIN crown s ON s.level = v.level AND s.place = xor(v.place, 1)),
        steps AS MATERIALIZED (
            SELECT * FROM inner_steps
            UNION ALL SELECT l.tree, l.place, o.level, beside, before FROM leaves l JOIN outer_steps o USING (tree)),
        fold AS (
            SELECT 0 AS level, tree, place, changed AS digest FROM leaves
            UNION ALL
            SELECT f.level + 1, f.tree, f.place,
                   sha256(CASE WHEN beside IS NULL THEN f.digest WHEN before THEN beside || f.digest
                               ELSE f.digest || beside END)
            FROM fold f JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.level = f.level),
        folded AS (SELECT tree, place, max_by(digest, level) AS folded_root FROM fold GROUP BY ALL),
        proofs AS (
            SELECT tree, place, string_agg(beside, '' ORDER BY level) AS proof FROM steps GROUP BY ALL)
        SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
               folded_root, folded_root = t.digest AS verified
        FROM leaves l JOIN subroots r USING (tree) JOIN (SELECT digest FROM crown WHERE n = 1) t ON true
        JOIN folded d ON d.tree = l.tree AND d.place = l.place
        LEFT JOIN proofs p ON p.tree = l.tree AND p.place = l.place""",
}
