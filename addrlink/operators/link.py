"""Entity resolution: official streets to clusters of map features.

The phases are DataFrame steps. Candidates of the name cascade are computed once
and reused by all of them; only the running neighbourhood centre of round 2 and
the last recovery depend on row order, and they are folds over what is left by
then, grouped by neighbourhood and by candidate.

Inputs (see ``schemas``): register rows with a stable ordinal ``ord``, features
with ``ord``, localities and neighbourhoods. Where features have ``uf``, a row
meets features of its own state only: ``scope`` is part of every name key, so a
name that the whole country uses is split by state before any join.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..params import LinkParams
from .lineage import cut
from .clusters import components, footprint, summarise, trim_outliers

RULES = ["", "exato", "exato", "name_alt", "name_alt", "nucleo", "fonetico", "titulo", "titulo_fonetico", "conectores", "fuzzy"]


def register_keys(register: DataFrame) -> DataFrame:
    """Register rows with ``bare_name``, ``full_name`` (with its type unless sta is N) and ``is_area``."""
    bare = text.name_norm("log_no")
    full = F.when(F.col("sta") == "N", bare).otherwise(text.name_norm(F.concat_ws(" ", "tlo", "log_no")))
    return register.withColumn("bare_name", bare).withColumn("full_name", full).withColumn("is_area", text.is_area_type(text.name_norm("tlo")))


def load_features(streets: DataFrame) -> DataFrame:
    """Features with a place and a name; boxes default to the point and n to 1."""
    lat, lng = text.num("lat"), text.num("lng")
    out = streets.withColumn("lat", lat).withColumn("lng", lng).where("lat is not null and lng is not null and coalesce(name_norm, '') != ''")
    for c, base in (("lat_min", "lat"), ("lat_max", "lat"), ("lng_min", "lng"), ("lng_max", "lng")):
        out = out.withColumn(c, F.coalesce(text.num(c), F.col(base)))
    return out.withColumn("n", F.coalesce(F.nullif(F.col("way_node_count").cast("int"), F.lit(0)), F.lit(1)))


def scoped(df: DataFrame, by_state: bool) -> DataFrame:
    """``df`` with ``scope``: its state, or nothing where states are not told apart."""
    return df.withColumn("scope", F.coalesce("uf", F.lit("")) if by_state else F.lit(""))


def usable(features: DataFrame) -> DataFrame:
    """Features with a place and a name; rows of the text table are typed first."""
    if "way_node_count" in features.columns:
        return load_features(features)
    return features.where("lat is not null and lng is not null and coalesce(name_norm, '') != ''")


def add_address_points(features: DataFrame, points: DataFrame) -> DataFrame:
    """Address points, first one a street name (of a state, where both tables have ``uf``), where no feature has that name."""
    by = ["uf"] if "uf" in features.columns and "uf" in points.columns else []
    w = Window.partitionBy(*by, "street_norm").orderBy("ord")
    named = points.where("coalesce(street_norm, '') != '' and lat is not null and lng is not null")
    lone = named.join(features.select(*by, F.col("name_norm").alias("street_norm")).distinct(), [*by, "street_norm"], "left_anti")
    first = lone.withColumn("nth", F.row_number().over(w)).where("nth = 1")
    cols = {c: F.lit(None).cast(t) for c, t in features.dtypes}
    place = {"lat": "lat", "lng": "lng", "lat_min": "lat", "lat_max": "lat", "lng_min": "lng", "lng_max": "lng"}
    cols |= {c: F.col(c) for c in by} | {c: F.col(v) for c, v in place.items()} | {"name_norm": F.col("street_norm"), "kind": F.lit("addr"), "n": F.lit(1), "osm_id": F.lit(""), "ord": F.col("ord") + (1 << 40)}
    return features.unionByName(first.select(*(cols[c].cast(t).alias(c) for c, t in features.dtypes)))


def key_table(clusters: DataFrame, features: DataFrame) -> DataFrame:
    """(scope, family, key, cid, has_via): every way in which a cluster's name can be asked for."""
    core = text.core_name("name_norm")
    bare = text.strip_titles(core)
    derived = [("core", core), ("sound", text.phonetic_key(core)), ("bare", bare), ("bare_sound", text.phonetic_key(bare)), ("mid", text.strip_mid_link(bare))]
    own = clusters.select("scope", "cid", "has_via", F.explode(F.array(F.struct(F.lit("name").alias("family"), F.col("name_norm").alias("key")), *(F.struct(F.lit(f).alias("family"), k.alias("key")) for f, k in derived))).alias("x"))
    alt = features.select("scope", "name_norm", F.explode(F.split(F.coalesce("name_alt_norm", F.lit("")), ";")).alias("key")).where("key != ''").distinct()
    by_alt = alt.join(clusters.select("scope", "name_norm", "cid", "has_via"), ["scope", "name_norm"]).select("scope", F.lit("alt").alias("family"), "key", "cid", "has_via")
    return own.select("scope", "x.family", "x.key", "cid", "has_via").where("key != ''").unionByName(by_alt).distinct()


def probes(rows: DataFrame) -> DataFrame:
    """(ord, scope, rank, family, key) that a register row asks, in the order of the cascade."""
    core = text.core_name("full_name")
    bare = text.strip_titles(core)
    asked: list[tuple[str, Column]] = [("name", F.col("full_name")), ("name", F.col("bare_name")), ("alt", F.col("full_name")), ("alt", F.col("bare_name")), ("core", core), ("sound", text.phonetic_key(core)), ("bare", bare), ("bare_sound", text.phonetic_key(bare)), ("mid", text.strip_mid_link(bare))]
    one = F.array(*(F.struct(F.lit(n).alias("rank"), F.lit(f).alias("family"), k.alias("key")) for n, (f, k) in enumerate(asked, 1)))
    return rows.select("ord", "scope", "is_area", F.explode(one).alias("x")).select("ord", "scope", "is_area", "x.*").where("key != ''")


def candidates(rows: DataFrame, keys: DataFrame, fuzzy: bool = True) -> DataFrame:
    """(ord, rank, cid): the clusters of the first tier that has any, after the area guard."""
    fits = F.col("is_area") | F.col("has_via")
    hits = probes(rows).join(keys, ["scope", "family", "key"]).where(fits).select("ord", "rank", "cid").distinct()
    first = hits.groupBy("ord").agg(F.min("rank").alias("rank"))
    found = hits.join(first, ["ord", "rank"])
    if not fuzzy:
        return found
    left = rows.join(first.select("ord"), "ord", "left_anti").select("ord", "scope", "is_area", text.mid_bare("full_name").alias("mid")).where(F.length("mid") >= 10)
    mids = keys.where("family = 'mid'").where(F.length("key") >= 4)
    a = left.withColumn("cut", F.explode(text.deletes1("mid")))
    b = mids.select("scope", "key").distinct().withColumn("cut", F.explode(text.deletes1("key")))
    near = a.join(b, ["scope", "cut"]).where(F.levenshtein("mid", "key", 1) == 1).select("ord", "scope", "is_area", "key").distinct()
    more = near.join(mids, ["scope", "key"]).where(fits).select("ord", F.lit(10).alias("rank"), "cid").distinct()
    return found.unionByName(more)


def anchor_points(rows: DataFrame, clusters: DataFrame, members: DataFrame) -> DataFrame:
    """Points (loc_nu, lat, lng, ord) of names that one locality and one cluster have."""
    lone = rows.groupBy("scope", F.col("full_name").alias("name_norm")).agg(F.count_distinct("loc_nu").alias("locs"), F.first("loc_nu").alias("loc_nu"), F.min("ord").alias("name_ord")).where("locs = 1")
    single = clusters.groupBy("scope", "name_norm").agg(F.count("*").alias("n"), F.first("cid").alias("cid")).where("n = 1")
    return lone.join(single, ["scope", "name_norm"]).join(members.select("cid", "lat", "lng", F.col("ord").alias("feat_ord")), "cid").select("loc_nu", "lat", "lng", (F.col("name_ord") * (1 << 32) + F.col("feat_ord")).alias("ord"))


def centres(points: DataFrame) -> DataFrame:
    """Mean of a locality's points and the distance of the farthest."""
    mid = points.groupBy("loc_nu").agg(F.avg("lat").alias("clat"), F.avg("lng").alias("clng"))
    return points.join(mid, "loc_nu").groupBy("loc_nu").agg(F.first("clat").alias("clat"), F.first("clng").alias("clng"), F.max(geo.dist_km("clat", "clng", "lat", "lng")).alias("radius"))


def inherit(cells: DataFrame, localities: DataFrame) -> DataFrame:
    """Footprints, with those of the parent for localities that have none of their own."""
    own = cells.select("loc_nu").distinct()
    child = localities.where("coalesce(sub, '') != ''").join(own, "loc_nu", "left_anti").select("loc_nu", F.col("sub").alias("parent"))
    return cells.unionByName(child.join(cells.withColumnRenamed("loc_nu", "parent"), "parent").select("loc_nu", "ci", "cj"))


def overlaps(pairs: DataFrame, members: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """(loc_nu, cid) whose features lie in the footprint by half or more."""
    held = members.groupBy("cid", geo.cell("lat", size).alias("ci"), geo.cell("lng", size).alias("cj")).agg(F.count("*").alias("n"))
    inside = pairs.select("loc_nu", "cid").distinct().join(held, "cid").join(cells.withColumn("hit", F.lit(True)), ["loc_nu", "ci", "cj"], "left")
    return inside.groupBy("loc_nu", "cid").agg((F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)) / F.sum("n")).alias("share")).where("share >= 0.5").select("loc_nu", "cid")


def considered(rows: DataFrame, cand: DataFrame, clusters: DataFrame, members: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """One row a register row that has candidates: their number, whether its locality has a footprint, and those inside it."""
    pairs = rows.select("ord", "loc_nu").join(cand, "ord")
    inside = overlaps(pairs, members, cells, size).withColumn("inside", F.lit(True))
    info = clusters.select("cid", "lat", "lng", "weight", geo.extent_km("lat_min", "lat_max", "lng_min", "lng_max").alias("extent"), F.col("ord").alias("c_ord"))
    one = F.struct("c_ord", "cid", "lat", "lng", "weight", "extent")
    grouped = pairs.join(inside, ["loc_nu", "cid"], "left").join(info, "cid").groupBy("ord", "loc_nu").agg(F.first("rank").alias("rank"), F.count("*").alias("n_cand"), F.sort_array(F.collect_list(F.when(F.col("inside"), one))).alias("within"), F.sort_array(F.collect_list(one)).alias("all_cand"))
    has = cells.select("loc_nu").distinct().withColumn("has_footprint", F.lit(True))
    out = grouped.join(has, "loc_nu", "left").withColumn("has_footprint", F.coalesce("has_footprint", F.lit(False)))
    lone = (F.size("within") == 0) & ~F.col("has_footprint") & (F.col("n_cand") == 1)
    return out.withColumn("within", F.when(lone, F.col("all_cand")).otherwise(F.col("within")))


def by_weight(within: Column) -> tuple[Column, Column]:
    """The heaviest cluster (the first of equals) and whether there are equals."""
    top = F.array_max(F.transform(within, lambda x: x["weight"]))
    best = F.filter(within, lambda x: x["weight"] == top)
    return F.get(best, 0), F.size(best) > 1


def _decided(df: DataFrame, chosen: Column, tied: Column, most_km: float) -> DataFrame:
    many = F.size("within") > 1
    long = (chosen["extent"] > most_km) & many
    motive = (
        F.when((F.size("within") == 0) & F.col("has_footprint"), "fora_do_footprint")
        .when(F.size("within") == 0, "sem_footprint")
        .when(tied, "empate_de_tamanho")
        .when(long, F.concat(F.lit("extensao_"), F.floor(chosen["extent"] + 0.5).cast("string"), F.lit("km")))
        .otherwise("")
    )
    n = F.when(F.size("within") == 0, F.col("n_cand")).otherwise(F.size("within"))
    return df.withColumn("motive", motive).withColumn("cid", F.when(F.col("motive") == "", chosen["cid"])).withColumn("status", F.when(F.col("motive") == "", "ok").otherwise("ambiguo")).withColumn("n_candidates", n.cast("long"))


def round_one(found: DataFrame, most_km: float) -> DataFrame:
    """(ord, status, motive, cid, n_candidates): order-independent choice by weight."""
    best, equal = by_weight(F.col("within"))
    return _decided(found, best, (F.size("within") > 1) & equal, most_km)


def _fold(most_km: float):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        out, slat, slng, n = [], float(g["slat"].iloc[0] or 0), float(g["slng"].iloc[0] or 0), int(g["sn"].iloc[0] or 0)
        for r in g.sort_values("ord").itertuples():
            within, motive = r.within, ""
            best = within[0]
            if len(within) > 1:
                if n > 0:
                    best = min(within, key=lambda x: _km(slat / n, slng / n, x["lat"], x["lng"]))
                else:
                    best = max(within, key=lambda x: x["weight"])
                    if sum(x["weight"] == best["weight"] for x in within) > 1:
                        motive = "empate_de_tamanho"
                if not motive and best["extent"] > most_km:
                    motive = f"extensao_{int(best['extent'] + 0.5)}km"
            if not motive:
                slat, slng, n = slat + best["lat"], slng + best["lng"], n + 1
            out.append((r.ord, motive, None if motive else best["cid"]))
        return pd.DataFrame(out, columns=["ord", "motive", "cid"])

    return run


def _km(a: float, b: float, c: float, d: float) -> float:
    import math

    dy, dx = (c - a) * geo.KM, (d - b) * geo.KM * math.cos(math.radians((a + c) / 2))
    return math.sqrt(dx * dx + dy * dy)


def round_two(found: DataFrame, rows: DataFrame, first: DataFrame, clusters: DataFrame, most_km: float) -> DataFrame:
    """As round 1 on the enlarged footprints; several candidates go by the neighbourhood's running centre."""
    done = first.where("status = 'ok'").select("ord", "cid").join(rows.select("ord", "bai_ini"), "ord").join(clusters.select("cid", "lat", "lng"), "cid")
    sums = done.groupBy("bai_ini").agg(F.sum("lat").alias("slat"), F.sum("lng").alias("slng"), F.count("*").alias("sn"))
    open_ = found.join(first.where("status = 'ok'").select("ord"), "ord", "left_anti")
    inside = open_.where(F.size("within") > 0).join(rows.select("ord", "bai_ini"), "ord").join(sums, "bai_ini", "left").fillna(0, ["slat", "slng", "sn"])
    folded = inside.select("bai_ini", "ord", "within", "slat", "slng", "sn").groupBy("bai_ini").applyInPandas(_fold(most_km), "ord long, motive string, cid string")
    chosen = inside.drop("bai_ini", "slat", "slng", "sn").join(folded, "ord").withColumn("status", F.when(F.col("motive") == "", "ok").otherwise("ambiguo")).withColumn("n_candidates", F.size("within").cast("long"))
    none = _decided(open_.where(F.size("within") == 0), F.get(F.col("within"), 0), F.lit(False), most_km)
    cols = ["ord", "loc_nu", "rank", "status", "motive", "cid", "n_candidates"]
    return first.where("status = 'ok'").select(*cols).unionByName(chosen.select(*cols)).unionByName(none.select(*cols))


def envelope(state: DataFrame, cand: DataFrame, clusters: DataFrame, centre: DataFrame, p: LinkParams) -> DataFrame:
    """Rows outside their footprint with exactly one candidate near their locality's anchors."""
    info = clusters.select(F.col("cid").alias("e_cid"), "lat", "lng", geo.extent_km("lat_min", "lat_max", "lng_min", "lng_max").alias("extent"))
    open_ = state.where("motive = 'fora_do_footprint'").select("ord", "loc_nu").join(centre, "loc_nu")
    near = open_.join(cand.select("ord", F.col("cid").alias("e_cid")), "ord").join(info, "e_cid").where(F.greatest(F.lit(0.0), geo.dist_km("clat", "clng", "lat", "lng") - F.col("radius")) <= p.envelope_km)
    lone = near.groupBy("ord").agg(F.count("*").alias("n"), F.first("e_cid").alias("e_cid"), F.first("extent").alias("extent")).where((F.col("n") == 1) & (F.col("extent") <= p.max_extent_km))
    return _recovered(state, lone.select("ord", "e_cid", F.lit(1).cast("long").alias("e_n")), "envelope")


def _recovered(state: DataFrame, got: DataFrame, phase: str, neighbour: bool = False) -> DataFrame:
    hit = F.col("e_cid").isNotNull()
    out = state.join(got, "ord", "left")
    if "phase" not in state.columns:
        out = out.withColumn("phase", F.lit(""))
    if neighbour:
        out = out.withColumn("rank", F.when(hit, 11).otherwise(F.col("rank")))
    return out.withColumn("status", F.when(hit, "ok").otherwise(F.col("status"))).withColumn("motive", F.when(hit, "").otherwise(F.col("motive"))).withColumn("cid", F.coalesce("e_cid", "cid")).withColumn("n_candidates", F.when(hit, F.col("e_n")).otherwise(F.col("n_candidates"))).withColumn("phase", F.when(hit, phase).otherwise(F.col("phase"))).drop("e_cid", "e_n")


def near_neighbours(state: DataFrame, rows: DataFrame, cand: DataFrame, clusters: DataFrame, motive: str, p: LinkParams) -> DataFrame:
    """(ord, cid, dist, n_cand): candidates of open rows within reach of the nearest matched row of their postal prefix, else neighbourhood."""
    keyed = rows.select("ord", "bai_ini", F.when(text.postal_prefix("cep") != "", F.concat_ws("|", "loc_nu", text.postal_prefix("cep"))).alias("by_cep"), F.nullif(F.col("bai_ini"), F.lit("")).alias("by_bai"))
    centre = clusters.select("cid", F.col("lat").alias("alat"), F.col("lng").alias("alng"))
    done = state.where("status = 'ok'").select("ord", "cid").join(centre, "cid").join(keyed, "ord")
    scopes = done.select(F.explode(F.array(F.concat(F.lit("c"), "by_cep"), F.concat(F.lit("b"), "by_bai"))).alias("scope"), "alat", "alng").where("scope is not null")
    sizes = scopes.groupBy("scope").agg(F.count("*").alias("n")).where(F.col("n") >= p.neighbour_min)
    open_ = state.where(F.col("motive") == motive).select("ord", "loc_nu").join(keyed, "ord")
    a = open_.withColumn("scope", F.concat(F.lit("c"), "by_cep")).join(sizes.select("scope"), "scope", "left_semi")
    b = open_.join(a.select("ord"), "ord", "left_anti").withColumn("scope", F.concat(F.lit("b"), "by_bai")).join(sizes.select("scope"), "scope", "left_semi")
    scoped = a.select("ord", "loc_nu", "scope").unionByName(b.select("ord", "loc_nu", "scope"))
    info = clusters.select("cid", "lat", "lng", geo.extent_km("lat_min", "lat_max", "lng_min", "lng_max").alias("extent"))
    total = cand.groupBy("ord").agg(F.count("*").alias("n_cand"))
    # points of a scope lie in few cells; only those within reach of the candidate meet it
    step = max(p.neighbour_km, 0.001) / 100.0
    wanted = scoped.join(cand.select("ord", "cid"), "ord").join(info, "cid").where(F.col("extent") <= p.max_extent_km)
    around = F.sequence(F.lit(-1), F.lit(1))
    probe = wanted.withColumn("di", F.explode(around)).withColumn("dj", F.explode(around)).withColumn("ci", geo.cell("lat", step) + F.col("di")).withColumn("cj", geo.cell("lng", step) + F.col("dj"))
    held = scopes.withColumn("ci", geo.cell("alat", step)).withColumn("cj", geo.cell("alng", step))
    reach = probe.join(held, ["scope", "ci", "cj"]).withColumn("dist", geo.dist_km("lat", "lng", "alat", "alng")).where(F.col("dist") <= p.neighbour_km)
    return reach.groupBy("ord", "loc_nu", "cid").agg(F.min("dist").alias("dist")).join(total, "ord")


def recover_neighbours(state: DataFrame, rows: DataFrame, cand: DataFrame, clusters: DataFrame, p: LinkParams) -> DataFrame:
    near = near_neighbours(state, rows, cand, clusters, "fora_do_footprint", p)
    lone = near.groupBy("ord").agg(F.count("*").alias("n"), F.first("cid").alias("e_cid"), F.first("n_cand").alias("e_n")).where("n = 1").drop("n")
    return _recovered(state, lone, "fora_do_footprint", neighbour=True)


def owners(state: DataFrame, clusters: DataFrame, centre: DataFrame) -> DataFrame:
    """(cid, owner, claimants): the locality with most rows, then the nearest, then the first."""
    claims = state.where("status = 'ok'").groupBy("cid", "loc_nu").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    far = claims.join(clusters.select("cid", "lat", "lng"), "cid").join(centre, "loc_nu", "left").withColumn("d", F.coalesce(geo.dist_km("clat", "clng", "lat", "lng"), F.lit(1e9)))
    return far.groupBy("cid").agg(F.min_by("loc_nu", F.struct(-F.col("n"), "d", "first")).alias("owner"), F.count("*").alias("claimants"))


def exclude(state: DataFrame, own: DataFrame) -> DataFrame:
    """Rows whose cluster another locality owns lose it."""
    lost = (F.col("status") == "ok") & (F.col("owner") != F.col("loc_nu"))
    out = state.join(own, "cid", "left").withColumn("lost", F.coalesce(lost, F.lit(False)))
    return out.withColumn("status", F.when(F.col("lost"), "ambiguo").otherwise(F.col("status"))).withColumn("motive", F.when(F.col("lost"), "conflito_municipio").otherwise(F.col("motive"))).withColumn("n_candidates", F.when(F.col("lost"), F.col("claimants")).otherwise(F.col("n_candidates"))).withColumn("cid", F.when(~F.col("lost"), F.col("cid"))).drop("owner", "claimants", "lost")


def _last(g: pd.DataFrame) -> pd.DataFrame:
    """Rows in order; a cluster taken by one locality is closed to the others from then on."""
    owner = {}
    for r in g.itertuples():
        if r.owner is not None and r.owner == r.owner:
            owner[r.cid] = r.owner
    out = []
    for ord_, rows in g.sort_values("ord").groupby("ord", sort=True):
        mine = [r for r in rows.itertuples() if owner.get(r.cid, r.loc_nu) == r.loc_nu]
        if len(mine) == 1:
            owner[mine[0].cid] = mine[0].loc_nu
            out.append((ord_, mine[0].cid, int(mine[0].n_cand)))
    return pd.DataFrame(out, columns=["ord", "e_cid", "e_n"])


def recover_after_conflict(state: DataFrame, rows: DataFrame, cand: DataFrame, clusters: DataFrame, p: LinkParams) -> DataFrame:
    """Losers of a conflict that have exactly one free candidate near their neighbours.

    Order matters only among rows of one name (they share candidates), so the fold runs for each name.
    """
    near = near_neighbours(state, rows, cand, clusters, "conflito_municipio", p)
    taken = state.where("status = 'ok'").groupBy("cid").agg(F.min_by("loc_nu", "ord").alias("owner"))
    named = near.join(taken, "cid", "left").join(clusters.select("cid", "scope", "name_norm"), "cid").withColumn("family", F.concat_ws("|", "scope", text.mid_bare("name_norm")))
    group = named.groupBy("ord").agg(F.min("family").alias("group"))
    got = named.join(group, "ord").select("group", "ord", "loc_nu", "cid", "owner", "n_cand").groupBy("group").applyInPandas(_last, "ord long, e_cid string, e_n long")
    return _recovered(state, got, "pos_conflito", neighbour=True)


@dataclass
class Linked:
    state: DataFrame
    clusters: DataFrame
    members: DataFrame
    centres: DataFrame
    anchors: DataFrame
    cells: DataFrame


def prepared(features: DataFrame, p: LinkParams) -> tuple[DataFrame, DataFrame]:
    """(clusters with cid and ord, features with cid)."""
    features = features if "scope" in features.columns else scoped(features, False)
    placed = components(features, p.cluster_cell, ("scope", "name_norm"))
    members = placed.withColumn("cid", F.concat_ws("|", F.nullif(F.col("scope"), F.lit("")), "name_norm", "comp_i", "comp_j"))
    rows = summarise(members, ["cid", "scope", "name_norm"])
    return rows.join(members.groupBy("cid").agg(F.min("ord").alias("ord")), "cid"), members


def link(register: DataFrame, features: DataFrame, localities: DataFrame, p: LinkParams | None = None, rounds: int = 2, families: tuple[str, ...] = ()) -> Linked:
    """Run the cascade and all phases; ``state`` has one row a register row.

    Tables that several phases read are checkpointed, so that no phase is planned or run twice; with one round, what is read once is not. ``families`` restricts the cascade to some key
    families; with ``rounds`` 1 the phases after the first round are left out.
    Features without a place or name take no part; rows of a state without any feature are ``sem_extract``.
    """
    p = p or LinkParams()
    by_state = "uf" in features.columns and "uf" in register.columns
    rows, features = cut(scoped(register_keys(register), by_state)), scoped(usable(features), by_state)
    clusters, members = (cut(x) for x in prepared(features, p))
    keys = key_table(clusters, features)
    keys = keys.where(F.col("family").isin(list(families))) if families else keys
    later = cut if rounds > 1 else lambda df: df
    cand = cut(candidates(rows, cut(keys) if p.fuzzy else keys, p.fuzzy))
    base = later(trim_outliers(anchor_points(rows, clusters, members), p.anchor_radius_km, p.mass_cell))
    own = footprint(base, p.footprint_cell, p.dilate)
    cells = cut(inherit(own, localities))
    centre = later(centres(base))
    state = later(round_one(considered(rows, cand, clusters, members, cells, p.footprint_cell), p.max_extent_km).select("ord", "loc_nu", "rank", "status", "motive", "cid", "n_candidates"))
    if rounds > 1:
        matched = state.where("status = 'ok'").join(members.select("cid", "lat", "lng", F.col("ord").alias("f_ord")), "cid").select("loc_nu", "lat", "lng", (F.lit(1 << 62) + F.col("ord") * (1 << 20) + F.col("f_ord") % (1 << 20)).alias("ord"))
        grown = footprint(trim_outliers(base.join(matched.select("loc_nu").distinct(), "loc_nu", "left_semi").unionByName(matched), p.anchor_radius_km, p.mass_cell), p.footprint_cell, p.dilate)
        grown = cut(grown)
        cells = cut(cells.join(grown.select("loc_nu").distinct(), "loc_nu", "left_anti").unionByName(grown))
        state = cut(round_two(considered(rows, cand, clusters, members, cells, p.footprint_cell), rows, state, clusters, p.max_extent_km))
        if p.envelope:
            state = cut(envelope(state, cand, clusters, centre, p))
        if p.neighbours:
            state = cut(recover_neighbours(state, rows, cand, clusters, p))
        if p.exclusive:
            state = cut(exclude(state, owners(state, clusters, centre)))
            if p.neighbours:
                state = cut(recover_after_conflict(state, rows, cand, clusters, p))
    if "phase" not in state.columns:
        state = state.withColumn("phase", F.lit(""))
    held = members.select("scope").distinct().withColumn("held", F.lit(True))  # at most one row a state
    named = rows.select("ord", "scope", F.col("loc_nu").alias("r_loc")).join(state, "ord", "left").join(held, "scope", "left").drop("scope")
    none = F.col("status").isNull()
    missing = F.when(F.col("held"), "sem_nome_osm").otherwise("sem_extract")
    out = named.withColumn("status", F.when(none, missing).otherwise(F.col("status"))).drop("held").withColumn("loc_nu", F.col("r_loc")).drop("r_loc").fillna("", ["motive", "phase"]).fillna(0, ["n_candidates", "rank"])
    labelled = out.join(rows.select("ord", "is_area"), "ord").join(clusters.select("cid", "kinds", "has_via"), "cid", "left")
    tier = F.element_at(F.array(*(F.lit(r) for r in [*RULES, "vizinho_cep5"])), F.col("rank") + 1)
    area = (tier == "exato") & F.col("is_area") & ~F.col("has_via")
    rule = F.when(F.col("status") != "ok", "").when(F.col("rank") == 11, tier).when((F.col("kinds") == "addr") & (F.col("phase") != "envelope"), "addr").when(area, "area").otherwise(tier)
    state = labelled.withColumn("rule", rule).select("ord", "loc_nu", "status", "rule", "motive", "n_candidates", "phase", "cid")
    return Linked(state, clusters, members, centre, base, cells)


def emit(register: DataFrame, linked: Linked, localities: DataFrame, neighbourhoods: DataFrame) -> DataFrame:
    """The 26 columns of the linked register, one row a register row, in its order."""
    ids = linked.members.where("coalesce(osm_id, '') != ''").groupBy("cid").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(F.col("osm_id").try_cast("long").alias("i"), F.col("osm_id").alias("s")))), lambda x: x["s"]), "+").alias("way_ids"))
    c = linked.clusters.select("cid", "lat", "lng", "lat_min", "lat_max", "lng_min", "lng_max", "kinds", "ways").join(ids, "cid", "left")
    parent = localities.select(F.col("loc_nu").alias("sub"), F.nullif(F.col("ibge"), F.lit("")).alias("parent_ibge"))
    loc = localities.join(parent, "sub", "left").select("loc_nu", F.col("name").alias("loc_name"), F.coalesce(F.nullif(F.col("ibge"), F.lit("")), "parent_ibge", F.lit("")).alias("ibge"))
    bai = neighbourhoods.select(F.col("bai_nu").alias("bai_ini"), F.col("name").alias("bai_name"))
    out = register.join(linked.state.drop("loc_nu"), "ord").join(c, "cid", "left").join(loc, "loc_nu", "left").join(bai, "bai_ini", "left")
    return out.select(
        "ord", "log_nu", "uf", "loc_nu", "bai_ini", "bai_fim", "log_no", "compl", "cep", "tlo", "sta", "abrev", F.coalesce("loc_name", F.lit("")).alias("loc_name"), F.coalesce("bai_name", F.lit("")).alias("bai_name"), F.coalesce("ibge", F.lit("")).alias("ibge"),
        *(text.fmt7(x).alias(x) for x in ("lat", "lng", "lat_min", "lat_max", "lng_min", "lng_max")),
        "status", "rule", F.coalesce("kinds", F.lit("")).alias("kinds"), F.coalesce("ways", F.lit(0)).cast("string").alias("ways"), F.col("n_candidates").cast("string").alias("n_candidates"), F.coalesce("way_ids", F.lit("")).alias("way_ids"),
    )


def neighbourhood_boxes(register: DataFrame, linked: Linked, neighbourhoods: DataFrame) -> DataFrame:
    """Box, mean and number of matched rows of each known neighbourhood."""
    c = linked.clusters.select("cid", "lat", "lng", "lat_min", "lat_max", "lng_min", "lng_max")
    rows = register.select("ord", "bai_ini").join(linked.state.where("status = 'ok'"), "ord").join(c, "cid").join(neighbourhoods, F.col("bai_ini") == F.col("bai_nu"))
    return rows.groupBy("bai_nu").agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"), F.min("lat_min").alias("lat_min"), F.max("lat_max").alias("lat_max"), F.min("lng_min").alias("lng_min"), F.max("lng_max").alias("lng_max"), F.count("*").alias("n"))


def report(linked: Linked) -> DataFrame:
    """Histogram rows (kind, value, n): status, rule, motive (long extents as one), phase."""
    s = linked.state
    motive = F.when(F.col("motive").startswith("extensao_"), "extensao_longa").otherwise(F.col("motive"))
    one = s.select(F.explode(F.array(F.struct(F.lit("status").alias("kind"), F.col("status").alias("value")), F.struct(F.lit("rule").alias("kind"), F.col("rule").alias("value")), F.struct(F.lit("motive").alias("kind"), motive.alias("value")), F.struct(F.lit("phase").alias("kind"), F.col("phase").alias("value")))).alias("x"))
    return one.select("x.*").where("value != ''").groupBy("kind", "value").agg(F.count("*").alias("n"))
