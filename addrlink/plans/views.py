"""Views over the driver's tables that stand in for street data, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FEATURE = """
SELECT p_partkey AS ord, CAST(p_partkey AS STRING) AS osm_id, 'rua ' || p_name || ' ' || lower(replace(p_brand, '#', ' ')) AS name_norm,
  CASE WHEN p_type = 'SMALL' THEN 'square' WHEN p_type = 'PROMO' THEN 'park' ELSE 'residential' END AS kind, p_size AS n,
  (-(10000000 + CAST(floor((p_partkey % 25) / 5) AS BIGINT) * 500000) - ((p_partkey * 7919) % 1001) * 50) AS lat_e6,
  (-(40000000 + (p_partkey % 5) * 500000) - ((p_partkey * 104729) % 1001) * 50) AS lng_e6
FROM part"""

POINT = f"""
SELECT ord, osm_id, name_norm, kind, n, CAST(lat_e6 AS DOUBLE) / 1000000.0 AS lat, CAST(lng_e6 AS DOUBLE) / 1000000.0 AS lng FROM ({FEATURE}) f"""

REGISTER = """
SELECT c_custkey AS ord, c_custkey AS log_nu, CAST(c_nationkey AS STRING) AS loc_nu, c_mktsegment AS bai,
  lpad(CAST(c_nationkey * 1000 + c_custkey % 7 AS STRING), 5, '0') || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') AS cep,
  c_nationkey + 25 * (c_custkey % CAST(floor((SELECT count(*) FROM part) / 25) AS BIGINT)) AS partkey
FROM customer"""

#: Names with types, titles, connectors and accents, so that every rule of the key functions has work to do.
NAMES = """
SELECT p_partkey AS id,
  CASE p_partkey % 8 WHEN 0 THEN 'Rua ' WHEN 1 THEN 'Estrada Municipal ' WHEN 2 THEN 'Travessa da ' WHEN 3 THEN 'Praça ' WHEN 4 THEN '' WHEN 5 THEN 'Avenida Marginal do ' WHEN 6 THEN 'Vila dos ' ELSE 'da ' END
  || CASE p_partkey % 5 WHEN 0 THEN 'Doutor ' WHEN 1 THEN 'Prof. Eng. ' WHEN 2 THEN 'Senador ' ELSE '' END
  || p_name || CASE p_partkey % 6 WHEN 0 THEN ' da Conceição' WHEN 1 THEN ' e Souza' WHEN 2 THEN ' Luiz  Gushiken' WHEN 3 THEN ' Philippe' WHEN 4 THEN ' Xavier-Ayrton' ELSE ' Affonso dos Anjos Quinhentos Massey' END AS name
FROM part"""


def as_spark(sql: str) -> str:
    return sql.replace("AS VARCHAR", "AS STRING")


def as_duckdb(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view's rows; its tables are read from ``sf_dir``."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names if re.search(rf"\b(FROM|JOIN) {t}\b", sql)}
    text = as_spark(sql)
    for t in tables:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **tables)
