"""Names and codes as Column expressions. Inputs of key functions are normalised names."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Street types, type qualifiers, connectors and honorifics that names differ in.
TYPES = (
    "rua avenida travessa viela praca alameda estrada rodovia via passagem largo viaduto ponte acesso servidao beco marginal "
    "ladeira complexo anel corredor caminho trevo elevado galeria area trecho ciclovia calcada passarela terminal pedestre "
    "partilhada lateral vila parque jardim condominio loteamento residencial quadra conjunto boulevard retorno alca"
).split()
TYPE_QUALIFIERS = "municipal estadual federal vicinal".split()
LEADING_LINKS = "de da do das dos e a o em no na".split()
MIDDLE_LINKS = "de da do das dos e".split()
TITLES = (
    "doutor doutora dr dra professor professora prof engenheiro engenheira eng desembargador desembargadora senador senadora "
    "deputado deputada ministro ministra presidente padre frei monsenhor marechal general brigadeiro coronel major capitao "
    "tenente almirante comendador comendadora vereador vereadora prefeito prefeita governador governadora"
).split()
AREA_TYPES = "praca largo parque jardim vila area".split()
AREA_KINDS = "square park".split()
ALT_NAME_TAGS = "alt_name short_name old_name loc_name name:pt-BR official_name".split()
IBGE_TAGS = "IBGE:GEOCODIGO ref:IBGE IBGE".split()


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


@cache
def _accents() -> tuple[str, str]:
    """Letters with marks and their bare letters, then the marks alone (which translate() drops)."""
    at, to = [], []
    for i in range(0xC0, min(sys.maxunicode, 0xFFFF) + 1):
        d = unicodedata.normalize("NFD", c := chr(i))
        bare = "".join(x for x in d if not "̀" <= x <= "ͯ")
        if d != c and len(bare) == 1 and bare.isascii():
            at.append(c)
            to.append(bare)
    return "".join(at) + "".join(map(chr, range(0x300, 0x370))), "".join(to)


def strip_accents(x: Column | str) -> Column:
    return F.translate(_c(x), *_accents())


def name_norm(x: Column | str) -> Column:
    """No accents, lower case, runs of other characters as one space; null is ''."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(_c(x).cast("string"), F.lit("")))), "[^a-z0-9]+", " "))


def sample_name(x: Column | str) -> Column:
    """As ``name_norm`` but punctuation stays."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(_c(x).cast("string"), F.lit("")))), r"\s+", " "))


def core_name(x: Column | str) -> Column:
    """Without leading types, connectors, and qualifiers after a type; the last token always stays."""
    links, types = _any(LEADING_LINKS), _any(TYPES)
    return F.regexp_replace(_c(x), f"^(?:{links} )*(?:{types} (?:(?:{types}|{links}|{_any(TYPE_QUALIFIERS)}) )*)?", "")


def title_prefix(x: Column | str) -> Column:
    return F.regexp_extract(_c(x), f"^(?:{_any(TITLES)} )+", 0)


def strip_titles(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), f"^(?:{_any(TITLES)} )+", "")


def titles_removed(x: Column | str) -> Column:
    """The honorifics that ``strip_titles`` takes away, in order."""
    return F.filter(F.split(title_prefix(x), " "), lambda t: t != "")


def core_bare(x: Column | str) -> Column:
    return strip_titles(core_name(x))


def strip_mid_link(x: Column | str) -> Column:
    """Without connectors, except as the first token."""
    return F.regexp_replace(_c(x), f" {_any(MIDDLE_LINKS)}(?= |$)", "")


def mid_bare(x: Column | str) -> Column:
    return strip_mid_link(core_bare(x))


#: Spelling rules of the sound key, in order. ``~`` guards the h of lh and nh.
SOUND_RULES = [("ph", "f"), ("ch", "x"), ("([ln])h", "$1~"), ("h", ""), ("~", "h"), ("y", "i"), ("w", "v"), ("qu?", "k"), ("c([ei])", "s$1"), ("ss", "s"), ("sc([ei])", "s$1"), ("c", "k"), ("g([ei])", "j$1"), ("z", "s"), (r"m(?= |$)", "n"), (r"([^ ])\1+", "$1")]


def phonetic_key(x: Column | str) -> Column:
    out = _c(x)
    for pattern, to in SOUND_RULES:
        out = F.regexp_replace(out, pattern, to)
    return out


def deletes1(x: Column | str) -> Column:
    """The text and the texts that lack one character."""
    x = _c(x)
    cut = F.when(F.length(x) > 0, F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(x), cut))


def fuzzy_max_dist(x: Column | str) -> Column:
    return F.when(F.length(_c(x)) >= 10, 1).otherwise(0)


def levenshtein_capped(a: Column | str, b: Column | str, most: int) -> Column:
    """Edit distance, most + 1 where it is larger."""
    d = F.levenshtein(_c(a), _c(b), most)
    return F.when(d < 0, most + 1).otherwise(d)


def is_area_type(x: Column | str) -> Column:
    return _c(x).isin(AREA_TYPES)


def is_area_kind(x: Column | str) -> Column:
    return _c(x).isin(AREA_KINDS)


def _tag(tags: Column, key: str) -> Column:
    return F.nullif(F.element_at(tags, F.lit(key)), F.lit(""))


def display_name(tags: Column | str) -> Column:
    t = _c(tags)
    return F.coalesce(_tag(t, "name:pt"), _tag(t, "name"), _tag(t, "official_name"), F.lit(""))


def alt_names(tags: Column | str, primary: Column | str) -> Column:
    """Other names in tag order, split at ';', without the primary one and repeats."""
    t = _c(tags)
    parts = F.flatten(F.array(*(F.split(F.coalesce(_tag(t, k), F.lit("")), ";") for k in ALT_NAME_TAGS)))
    return F.array_remove(F.array_distinct(F.filter(F.transform(parts, lambda v: F.trim(v)), lambda v: v != "")), F.coalesce(_c(primary), F.lit("")))


def street_kind(tags: Column | str) -> Column:
    t = _c(tags)
    get = lambda k: F.element_at(t, F.lit(k))
    return (
        F.when(_tag(t, "highway").isNotNull(), get("highway"))
        .when(get("place") == "square", "square")
        .when(get("leisure").isin("park", "garden") | (get("landuse") == "village_green"), "park")
        .otherwise("")
    )


def oneway_code(x: Column | str) -> Column:
    v = F.lower(F.trim(_c(x)))
    return F.when(v.isin("yes", "true", "1"), 1).when(v.isin("-1", "reverse"), 2).when(v.isin("no", "false", "0"), 3).otherwise(0)


def parse_oneway(x: Column | str) -> Column:
    n = _c(x).try_cast("double")
    return F.when(n.isin(1.0, 2.0, 3.0), n.cast("int")).otherwise(0)


def postal_digits(x: Column | str) -> Column:
    d = F.substring(F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit("")), "[^0-9]", ""), 1, 8)
    return F.when(d == "", "").otherwise(F.lpad(d, 8, "0"))


def postal_prefix(x: Column | str) -> Column:
    d = F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit("")), "[^0-9]", "")
    return F.when(F.length(d) >= 5, F.substring(d, 1, 5)).otherwise("")


def municipality_code(x: Column | str) -> Column:
    v = F.trim(F.coalesce(_c(x).cast("string"), F.lit("")))
    return F.when(v.rlike("^[0-9]{7}$"), v).otherwise("")


def ibge_of(tags: Column | str) -> Column:
    t = _c(tags)
    return F.coalesce(*(F.trim(_tag(t, k)) for k in IBGE_TAGS), F.lit(""))


def ibge_source(tags: Column | str) -> Column:
    t = _c(tags)
    return F.coalesce(*(F.when(_tag(t, k).isNotNull(), k) for k in IBGE_TAGS), F.lit(""))


def num(x: Column | str) -> Column:
    """A finite number, else null."""
    v = _c(x).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def distance_band(km: Column | str) -> Column:
    d = _c(km)
    return F.when(d < 1, "ate_1km").when(d < 5, "de_1_a_5km").when(d <= 25, "de_5_a_25km").otherwise("mais_de_25km")


def cache_state(x: Column | str) -> Column:
    v = F.upper(F.trim(F.coalesce(_c(x), F.lit(""))))
    return F.when(v.rlike("^[A-Z]{2}$"), v).otherwise("XX")


def sanitize(x: Column | str) -> Column:
    """A field of an @ table: line breaks and separators become spaces; null is ''."""
    return F.translate(F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit("")), "[\\r\\n]+", " "), "@", " ")


def row_text(*cols: Column | str) -> Column:
    return F.concat_ws("@", *(sanitize(c) for c in cols))


def format_count(x: Column | str) -> Column:
    """1234567 as 1.234.567 (thousands by dots)."""
    return F.translate(F.format_number(_c(x).cast("long"), 0), ",", ".")


def data_size(x: Column | str) -> Column:
    n = _c(x).cast("double")
    unit = F.when(n >= 1 << 40, F.struct(F.lit(float(1 << 40)).alias("by"), F.lit("TB").alias("u"))).when(n >= 1 << 30, F.struct(F.lit(float(1 << 30)).alias("by"), F.lit("GB").alias("u"))).when(n >= 1 << 20, F.struct(F.lit(float(1 << 20)).alias("by"), F.lit("MB").alias("u"))).when(n >= 1 << 10, F.struct(F.lit(float(1 << 10)).alias("by"), F.lit("KB").alias("u"))).otherwise(F.struct(F.lit(1.0).alias("by"), F.lit("B").alias("u")))
    return F.concat(F.format_string("%.2f", n / unit["by"]), F.lit(" "), unit["u"])


def elapsed(ms: Column | str) -> Column:
    s = F.floor(_c(ms) / 1000).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def api_status(http: Column | str, lat: Column | str, lng: Column | str) -> Column:
    h = _c(http)
    return F.when(h == 404, "not_found").when(h == 400, "invalid").when(h != 200, "error").when(num(lat).isNull() | num(lng).isNull(), "empty_coords").otherwise("ok")


def fmt7(x: Column | str) -> Column:
    """Seven decimals; null is ''."""
    return F.when(_c(x).isNull(), "").otherwise(F.format_string("%.7f", _c(x)))


def relevance(city: Column, status: Column, cep: Column, kind: Column, capitals: list[str]) -> Column:
    """How much a missing row matters for sampling: city, status, postal prefix and type each add points."""
    c, t, p = sample_name(city), sample_name(kind), F.substring(cep, 1, 2)
    points = lambda *rules: sum((F.when(cond, n).otherwise(0) for cond, n in rules), F.lit(0))
    return points(
        (c.isin(capitals), 100), (c == "sao paulo", 40), (c == "rio de janeiro", 30), (c == "belo horizonte", 25), (status == "sem_nome_osm", 50), (status == "ambiguo", 20),
        (p.isin("01", "02", "04", "05"), 15), (p.isin("20", "21", "22"), 12), (p.isin("30", "31"), 10), (t.isin("rua", "avenida"), 8), (t.isin("praca", "alameda"), 4),
    )
