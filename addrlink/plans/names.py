"""Queries of the name and code functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from .views import NAMES, as_duckdb, view


def text_keys(spark, sf_dir):
    """N1-N7, N10, N11, N27 over every part."""
    d = view(spark, sf_dir, NAMES).withColumn("norm", t.name_norm("name"))
    core = t.core_name("norm")
    return d.select(
        "id", "norm", core.alias("core"), t.strip_titles("norm").alias("untitled"), F.array_join(t.titles_removed(core), "+").alias("removed"), t.core_bare("norm").alias("bare"),
        t.strip_mid_link("norm").alias("unlinked"), t.mid_bare("norm").alias("mid"), t.phonetic_key("norm").alias("sound"), t.fuzzy_max_dist("norm").alias("fuzzy"), t.is_area_type(F.split_part("norm", F.lit(" "), F.lit(1))).alias("area"), t.sample_name("name").alias("loose"),
    )


def _list(words):
    return "[" + ",".join(f"'{w}'" for w in words) + "]"


#: The rules again as list steps: how many leading tokens go, then what is left.
_LEAD = f"""(SELECT coalesce(min(i), len(tok)) FROM (SELECT unnest(range(1, len(tok) + 1)) AS i) WHERE i = len(tok)
   OR NOT (list_contains({_list(t.TYPES)}, tok[i]) OR list_contains({_list(t.LEADING_LINKS)}, tok[i])
     OR (list_contains({_list(t.TYPE_QUALIFIERS)}, tok[i]) AND len(list_filter(tok[1:i-1], lambda x: list_contains({_list(t.TYPES)}, x))) > 0)))"""
_HONOUR = f"(SELECT coalesce(min(i), len(tok)) FROM (SELECT unnest(range(1, len(tok) + 1)) AS i) WHERE i = len(tok) OR NOT list_contains({_list(t.TITLES)}, tok[i]))"
_UNLINK = f"list_filter(tok, lambda x, i: i = 1 OR NOT list_contains({_list(t.MIDDLE_LINKS)}, x))"


def _sound(x: str) -> str:
    for p, to in [("ph", "f"), ("ch", "x"), ("([ln])h", "\\1~"), ("h", ""), ("~", "h"), ("y", "i"), ("w", "v"), ("qu?", "k"), ("c([ei])", "s\\1"), ("ss", "s"), ("sc([ei])", "s\\1"), ("c", "k"), ("g([ei])", "j\\1"), ("z", "s"), ("m\\b", "n")]:
        x = f"regexp_replace({x}, '{p}', '{to}', 'g')"
    return f"array_to_string(list_filter(string_split({x}, ''), lambda c, i: i = 1 OR c = ' ' OR c <> string_split({x}, '')[i-1]), '')"


TEXT_KEYS = f"""
WITH n AS (SELECT id, name, trim(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', ' ', 'g')) AS norm FROM ({as_duckdb(NAMES)}) v),
a AS (SELECT *, string_split(norm, ' ') AS tok FROM n),
b AS (SELECT id, name, norm, array_to_string(tok[{_LEAD}:], ' ') AS core, array_to_string(tok[{_HONOUR}:], ' ') AS untitled, array_to_string({_UNLINK}, ' ') AS unlinked FROM a),
c AS (SELECT *, string_split(core, ' ') AS tok FROM b),
d AS (SELECT *, array_to_string(tok[1:{_HONOUR}-1], '+') AS removed, array_to_string(tok[{_HONOUR}:], ' ') AS bare FROM c),
e AS (SELECT * EXCLUDE (tok), string_split(bare, ' ') AS tok FROM d)
SELECT id, norm, core, untitled, removed, bare, unlinked, array_to_string({_UNLINK}, ' ') AS mid, {_sound('norm')} AS sound,
  CASE WHEN length(norm) >= 10 THEN 1 ELSE 0 END AS fuzzy, list_contains({_list(t.AREA_TYPES)}, string_split(norm, ' ')[1]) AS area,
  trim(regexp_replace(lower(strip_accents(name)), '\\s+', ' ', 'g')) AS loose FROM e"""


def codes(spark, sf_dir):
    """N14-N19, N21, N23, N24, N26, N30, W1, W2 over every customer."""
    d = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    raw = F.concat(F.lpad((k % 100000).cast("string"), 5, "0"), F.lit("-"), F.substring(F.col("c_name"), -3, 3))
    way = F.element_at(F.array(*map(F.lit, ["yes", "-1", "NO ", "", "reversible", "1", "reverse"])), (k % 7 + 1).cast("int"))
    number = F.element_at(F.array(*map(F.lit, ["1.5", "", "x", "NaN", "-7e2"])), (k % 5 + 1).cast("int"))
    state = F.element_at(F.array(*map(F.lit, ["sp", "RJ", "", "x1", "Minas"])), (k % 5 + 1).cast("int"))
    http = F.element_at(F.array(*map(F.lit, [200, 404, 400, 500])), (k % 4 + 1).cast("int"))
    return d.select(
        F.col("c_custkey").alias("id"), t.postal_digits(raw).alias("cep"), t.postal_prefix(raw).alias("cep5"), t.oneway_code(way).alias("oneway"), t.parse_oneway((k % 5).cast("string")).alias("oneway_field"), t.municipality_code((k * 997 % 10000000).cast("string")).alias("ibge"),
        t.num(number).alias("num"), t.cache_state(state).alias("state"), t.distance_band(F.abs("c_acctbal") / 200).alias("band"), t.api_status(http, number, number).alias("api"),
        t.sanitize(F.concat("c_name", F.lit("@\r\n"), "c_mktsegment")).alias("clean"), t.row_text("c_custkey", F.concat("c_name", F.lit("@")), F.lit(None)).alias("row"), t.format_count(k * 12345).alias("count"), t.elapsed(k * 77777).alias("elapsed"), t.fmt7(F.col("c_nationkey") / 64).alias("f7"),
    )


CODES = """
WITH c AS (SELECT c_custkey AS k, c_name, c_nationkey, c_acctbal, c_mktsegment,
  lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || right(c_name, 3) AS digits,
  (['yes', '-1', 'NO ', '', 'reversible', '1', 'reverse'])[c_custkey % 7 + 1] AS way, (['1.5', '', 'x', 'NaN', '-7e2'])[c_custkey % 5 + 1] AS number,
  (['sp', 'RJ', '', 'x1', 'Minas'])[c_custkey % 5 + 1] AS state, ([200, 404, 400, 500])[c_custkey % 4 + 1] AS http, CAST(c_custkey * 997 % 10000000 AS VARCHAR) AS ibge FROM customer)
SELECT k AS id, digits AS cep, left(digits, 5) AS cep5,
  CASE lower(trim(way)) WHEN 'yes' THEN 1 WHEN '1' THEN 1 WHEN '-1' THEN 2 WHEN 'reverse' THEN 2 WHEN 'no' THEN 3 ELSE 0 END AS oneway,
  CASE WHEN k % 5 BETWEEN 1 AND 3 THEN CAST(k % 5 AS INT) ELSE 0 END AS oneway_field, CASE WHEN length(ibge) = 7 THEN ibge ELSE '' END AS ibge,
  CASE number WHEN '1.5' THEN 1.5::DOUBLE WHEN '-7e2' THEN -700.0::DOUBLE END AS num, CASE state WHEN 'sp' THEN 'SP' WHEN 'RJ' THEN 'RJ' ELSE 'XX' END AS state,
  CASE WHEN abs(c_acctbal) / 200 < 1 THEN 'ate_1km' WHEN abs(c_acctbal) / 200 < 5 THEN 'de_1_a_5km' WHEN abs(c_acctbal) / 200 <= 25 THEN 'de_5_a_25km' ELSE 'mais_de_25km' END AS band,
  CASE http WHEN 404 THEN 'not_found' WHEN 400 THEN 'invalid' WHEN 500 THEN 'error' ELSE CASE WHEN number IN ('1.5', '-7e2') THEN 'ok' ELSE 'empty_coords' END END AS api,
  c_name || '  ' || c_mktsegment AS clean, CAST(k AS VARCHAR) || '@' || c_name || ' @' AS row,
  replace(format('{:,}', k * 12345), ',', '.') AS count, format('{:02d}:{:02d}:{:02d}', k * 77777 // 3600000, k * 77777 // 60000 % 60, k * 77777 // 1000 % 60) AS elapsed,
  format('{:.7f}', c_nationkey / 64.0) AS f7 FROM c"""


def tag_names(spark, sf_dir):
    """N12-N14, N20 and the feature predicates F1-F5 over tag maps built from every part."""
    from ..operators import extract as x

    d = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.col("p_partkey")
    some = lambda m, key, v: F.when(k % m == 0, F.create_map(F.lit(key), v)).otherwise(F.create_map().cast("map<string,string>"))
    tags = F.map_concat(
        some(2, "name", F.col("p_name")), some(3, "name:pt", F.col("p_brand")), some(5, "official_name", F.col("p_type")), some(4, "alt_name", F.concat("p_name", F.lit("; "), "p_type", F.lit(";"), "p_type")),
        some(6, "highway", F.lit("residential")), some(7, "place", F.element_at(F.array(*map(F.lit, ["square", "suburb", "city", "state"])), (k % 4 + 1).cast("int"))), some(11, "leisure", F.lit("garden")), some(13, "boundary", F.lit("administrative")),
        some(13, "admin_level", F.when(k % 2 == 0, "4").otherwise("8")), some(8, "IBGE:GEOCODIGO", F.lit(" 3550308")), some(9, "ref:IBGE", F.lit("1302603")), some(10, "addr:street", F.col("p_name")),
    )
    d = d.withColumn("tags", tags)
    return d.select(
        F.col("p_partkey").alias("id"), t.display_name("tags").alias("shown"), F.array_join(t.alt_names("tags", t.display_name("tags")), ";").alias("others"), t.street_kind("tags").alias("kind"), t.ibge_of("tags").alias("ibge"), t.ibge_source("tags").alias("ibge_tag"),
        x.is_state("tags").alias("is_state"), x.is_municipality("tags").alias("is_municipality"), x.is_neighbourhood("tags").alias("is_neighbourhood"), x.is_street_way("tags").alias("is_street"), x.is_address("tags").alias("is_address"),
    )


TAG_NAMES = """
WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS pt, CASE WHEN p_partkey % 5 = 0 THEN p_type END AS official,
  CASE WHEN p_partkey % 4 = 0 THEN [p_name, p_type] ELSE [] END || CASE WHEN p_partkey % 5 = 0 THEN [p_type] ELSE [] END AS alts,
  CASE WHEN p_partkey % 7 = 0 THEN (['square', 'suburb', 'city', 'state'])[p_partkey % 4 + 1] END AS place FROM part),
q AS (SELECT *, coalesce(pt, name, official, '') AS shown, coalesce(k % 13 = 0 AND k % 2 = 0, false) AS adm4, coalesce(k % 13 = 0 AND k % 2 = 1, false) AS adm8,
  CASE WHEN k % 6 = 0 THEN 'residential' WHEN place = 'square' THEN 'square' WHEN k % 11 = 0 THEN 'park' ELSE '' END AS kind FROM p)
SELECT k AS id, shown, array_to_string(list_filter(alts, lambda x, i: x <> shown AND NOT list_contains(alts[1:i-1], x)), ';') AS others, kind,
  CASE WHEN k % 8 = 0 THEN '3550308' WHEN k % 9 = 0 THEN '1302603' ELSE '' END AS ibge, CASE WHEN k % 8 = 0 THEN 'IBGE:GEOCODIGO' WHEN k % 9 = 0 THEN 'ref:IBGE' ELSE '' END AS ibge_tag,
  coalesce(place = 'state', false) OR adm4 AS is_state, coalesce(place = 'city', false) OR adm8 AS is_municipality, coalesce(place = 'suburb', false) AS is_neighbourhood,
  kind <> '' AND shown <> '' AS is_street, k % 10 = 0 AS is_address FROM q"""


def edit_distance(spark, sf_dir):
    """Nation names one edit apart, by shared deletions."""
    d = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.lower("s_name").alias("name"))
    c = d.withColumn("cut", F.explode(t.deletes1("name")))
    pairs = c.join(c.select(F.col("s_suppkey").alias("b"), F.col("name").alias("other"), "cut"), "cut").where("s_suppkey < b").select(F.col("s_suppkey").alias("a"), "b", "name", "other").distinct()
    return pairs.withColumn("d", t.levenshtein_capped("name", "other", 1)).where("d = 1").select("a", "b", "d")


EDIT_DISTANCE = "SELECT a.s_suppkey AS a, b.s_suppkey AS b, 1 AS d FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey AND levenshtein(lower(a.s_name), lower(b.s_name)) = 1"

QUERIES = {"text_keys": text_keys, "codes": codes, "tag_names": tag_names, "edit_distance": edit_distance}
SQL = {"text_keys": TEXT_KEYS, "codes": CODES, "tag_names": TAG_NAMES, "edit_distance": EDIT_DISTANCE}
