"""A registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopgrain.plans.saving import new_folder, saved

from . import (
    bpe,
    cap_filters,
    html_blocks,
    kmeans_tree,
    merkle,
    mixing,
    order_minhash,
    pii,
    resampling,
    simhash,
    suffix_groups,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The byte-level vocabulary, a parameter of the encoder.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"), "html", ["page_id", "url"])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(documents, "doc_id", "text", words=4, max_bits=4)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return resampling.resample(documents, labels)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"), "text", ["doc_id"])


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return order_minhash.edited_fingerprints(documents, "doc_id", "text")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder, "page_id", "url", "html")
    records = saved(warc.read_archives(spark, folder, content=False), "records")
    return warc.capture_digests(warc.transactions(records))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return bpe.token_digests(documents, "text", VOCABULARY, ["doc_id"])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_groups.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return mixing.taken_words(mixing.mix_sources(documents, "doc_id", "text", "source"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return merkle.document_proofs(documents, "doc_id", "source", "lang", "n_chars", "text")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


QUERIES: dict[str, Query] = {
    "op1_html_blocks": op1,
    "op2_simhash": op2,
    "op3_quality": op3,
    "op4_cap_filters": op4,
    "op5_pii": op5,
    "op6_order_minhash": op6,
    "op7_warc": op7,
    "op8_bpe": op8,
    "op9_suffix_groups": op9,
    "op10_mixing": op10,
    "op11_merkle": op11,
    "op12_kmeans_tree": op12,
    "op13_whitening": op13,
}

#: Where SQL can say it; the rest is tested against brute force, round trips or labels.
SQL: dict[str, str] = {
    "op7_warc": """WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    measured AS (SELECT page_id, strlen(payload) AS payload_bytes,
        sha1(payload) AS payload_digest FROM payloads),
    held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes)
        AS holder FROM measured)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND holder IS DISTINCT FROM page_id
            THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND holder IS DISTINCT FROM page_id
            THEN holder END AS refers_to
    FROM held""",
    "op11_merkle": """WITH RECURSIVE texts AS (
        SELECT doc_id, coalesce('=' || source, '') AS g, source, lang, n_chars, text,
            CASE WHEN list_reduce(list_concat([4294967295], list_transform(
                    range(1, length(doc_id::VARCHAR) + 1),
                    lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT)),
                lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
                    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                        ELSE c >> 1 END)) & 1 = 1
                THEN replace(text, chr(10), '') ELSE text END AS tampered
        FROM documents),
    framed AS (SELECT doc_id, g,
            coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
            || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-')
            || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
            coalesce(strlen(text) || ':' || text, '-') AS body,
            coalesce(strlen(tampered) || ':' || tampered, '-') AS other
        FROM texts),
    hashed AS (SELECT doc_id, g, sha256(head || body) AS leaf, sha256(head || other) AS start
        FROM framed),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY g
            ORDER BY doc_id NULLS FIRST, leaf, start) - 1 AS i FROM hashed),
    nodes(g, l, i, h) AS (SELECT g, 0, i, leaf FROM leaves
        UNION ALL
        SELECT g, l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
        FROM (SELECT *, count(*) OVER (PARTITION BY g) AS width FROM nodes)
        WHERE width > 1 GROUP BY g, l + 1, i // 3),
    ends AS (SELECT g, l, h AS subroot FROM nodes QUALIFY l = max(l) OVER (PARTITION BY g)),
    subroots AS (SELECT *, row_number() OVER (ORDER BY g) - 1 AS nth FROM ends),
    upper(l, i, h) AS (SELECT 0, nth, subroot FROM subroots
        UNION ALL
        SELECT l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
        FROM (SELECT *, count(*) OVER () AS width FROM upper)
        WHERE width > 1 GROUP BY l + 1, i // 3),
    every_node AS (SELECT g, l, i, h FROM nodes
        UNION ALL SELECT 'top', l, i, h FROM upper),
    ways AS (SELECT g, l, i,
            coalesce(string_agg(h, '') OVER (run ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
            coalesce(string_agg(h, '') OVER (run ORDER BY i
                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
        FROM every_node WINDOW run AS (PARTITION BY g, l, i // 3)
        QUALIFY l < max(l) OVER (PARTITION BY g)),
    steps AS (SELECT g, l, i, true AS up, before, after, g AS to_g, l + 1 AS to_l,
            i // 3 AS to_i FROM ways
        UNION ALL SELECT g, l, 0, false, '', '', 'top', 0, nth FROM subroots),
    climb(leaf_g, leaf_i, g, l, i, proof, h) AS (
        SELECT g, i, g, 0, i, '', start FROM leaves
        UNION ALL
        SELECT leaf_g, leaf_i, to_g, to_l, to_i, proof || before || after,
            CASE WHEN up THEN sha256(before || h || after) ELSE h END
        FROM climb JOIN steps USING (g, l, i)),
    arrived AS (SELECT leaf_g AS g, leaf_i AS i, sha256(proof) AS proof_sha256, h
        FROM climb WHERE g = 'top' AND l = (SELECT max(l) FROM upper)),
    whole AS (SELECT h AS root FROM upper WHERE l = (SELECT max(l) FROM upper))
    SELECT doc_id, leaf, subroot, root, proof_sha256, arrived.h AS folded_root,
        arrived.h = root AS verified
    FROM leaves JOIN subroots USING (g) JOIN arrived USING (g, i), whole""",
}
