"""Positional schemas of the @ tables (all strings; numbers are cast by the operators)."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


#: Column orders of the tables that other tools read and write.
STATE = _strings("osm_type osm_id uf name name_norm lat lng lat_min lat_max lng_min lng_max admin_level place")
MUNICIPALITY = _strings("osm_type osm_id ibge uf name name_norm lat lng lat_min lat_max lng_min lng_max admin_level place source_tag")
NEIGHBOURHOOD = _strings("osm_type osm_id name name_norm uf city city_norm ibge_hint lat lng lat_min lat_max lng_min lng_max place")
STREET = _strings("osm_id name name_norm kind uf city city_norm suburb suburb_norm postcode lat lng lat_min lat_max lng_min lng_max way_node_count name_alt name_alt_norm osm_type")
GEOMETRY = _strings("osm_id polyline oneway")
ADDRESS = _strings("osm_id lat lng street street_norm housenumber city suburb postcode name")
LOCALITY = _strings("loc_nu uf name cep sit type sub abbrev ibge")
REGISTER_NEIGHBOURHOOD = _strings("bai_nu uf loc_nu name abbrev")
REGISTER = _strings("log_nu uf loc_nu bai_ini bai_fim log_no compl cep tlo sta abrev")
LINKED = _strings("log_nu uf loc_nu bai_ini bai_fim log_no compl cep tlo sta abrev loc_name bai_name ibge lat lng lat_min lat_max lng_min lng_max status rule kinds ways n_candidates way_ids")
LINKED_NEIGHBOURHOOD = _strings("bai_nu uf loc_nu name loc_name ibge lat lng lat_min lat_max lng_min lng_max n")
NETWORK_POINT = _strings("log_nu lat lng origin osm_id")
NETWORK_EDGE = _strings("log_a log_b lat lng type osm_a osm_b")
POSTAL_CACHE = _strings("cep http_status status lat lng city state district ibge address address_type queried_at source")
