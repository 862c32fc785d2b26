"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers

from . import decontaminate, jaccard, langid, lmscore, media, packing, pii, substring, toxicity, warc
from .common import table


def op1_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark, sf_dir):
    """Chain over the label table: a junk category first, then toxicity."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "1 - quality AS junk", "toxic")
    return toxicity.classify(table(spark, sf_dir, "documents"), labels, ("junk", "toxic"))


def op6_language(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_recompression(spark, sf_dir):
    return substring.dedup(table(spark, sf_dir, "documents"))


def op8_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_media(spark, sf_dir):
    """Images rendered from every row of the embedding table, the only media-like column there is."""
    found = media.copies(media.rendered(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id")


def op10_lattice(spark, sf_dir):
    return lmscore.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_packing, op3_warc, op4_decontaminate, op5_toxicity, op6_language, op7_recompression, op8_jaccard, op9_media, op10_lattice)}

#: DuckDB SQL of the queries that SQL can express over whole tables.
SQL = {
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(sha1(payload), CAST(5 * (i // 4) + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM p""",
}
