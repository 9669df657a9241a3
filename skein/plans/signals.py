"""What contract texts say about where a service ends: signals, addresses that match, seeds.

A signal is a text of a service with its kind; a seed is a signal that may be an address, with the
address of the gazetteer that matches it. Cities are known by a join with the gazetteer, which no task
needs to hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from skein.functions.address import TECHNICAL, kind_of, normalize_city, parse_address, signal_of
from skein.functions.references import route_refs, service_refs
from skein.functions.text import is_blank, norm_text, place_tokens, text_list, words
from skein.operators.ranking import best_per_key, quota_top

# How far a source is trusted, and how many seeds of each strength a service keeps.
PRIORITY = {
    "CMD - Secteur géographique2": 100, "CMD - Secteur géographique1": 95, "Client Final (ADV)": 70, "CMD - Numéro commande externe": 60, "nom fichier": 45,
    "endpoint_z_raw": 90, "endpoint_a_raw": 85, "client_final": 65, "principal_external_ref": 55, "principal_client": 25,
}
HINT_PRIORITY, OTHER_PRIORITY = 110, 10
QUOTAS = {"strong": 3, "medium": 2, "weak": 2}
ADDRESS_KINDS = ["postal_address_precise", "mixed_site_address", "postal_address_partial"]


def raw_values(services: DataFrame, links: DataFrame, lines: DataFrame) -> DataFrame:
    """(service_id, lea_line_id, source_column, source_priority, raw_value) of all texts that may be
    signals: of every line of a service its ends, final client and spatial hints (a map, if lines have
    one), and of the service its client and outer reference."""
    both = links.select("service_id", "lea_line_id").join(lines, "lea_line_id")
    hint = lambda column, value, priority: F.struct(F.lit(column).alias("c"), value.cast("string").alias("v"), F.lit(priority).alias("p"))
    of_lines = F.explode(F.array(*(hint(c, F.col(c), PRIORITY[c]) for c in ("endpoint_a_raw", "endpoint_z_raw", "client_final"))))
    of_service = F.explode(F.array(*(hint(c, F.col(c), PRIORITY[c]) for c in ("principal_external_ref", "principal_client"))))
    none = F.lit(None).cast("string").alias("lea_line_id")
    out = [both.select("service_id", none, of_lines.alias("x")), services.select("service_id", none, of_service.alias("x"))]
    parts = [df.select("service_id", "lea_line_id", F.col("x.c").alias("source_column"), F.col("x.p").alias("source_priority"), F.col("x.v").alias("raw_value")) for df in out]
    if "spatial_hints" in lines.columns:
        priority = F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv))
        hints = both.select("service_id", F.col("lea_line_id").cast("string").alias("lea_line_id"), F.explode("spatial_hints").alias("source_column", "raw_value"))
        parts.append(hints.select("service_id", "lea_line_id", "source_column", F.coalesce(F.try_element_at(priority, F.col("source_column")), F.lit(HINT_PRIORITY)).alias("source_priority"), "raw_value"))
    return reduce(DataFrame.unionByName, parts).where(~is_blank(F.col("raw_value"))).withColumn("raw_value", F.trim("raw_value"))


def classified(texts: DataFrame, cities: DataFrame) -> DataFrame:
    """texts (raw_value, and others) with the parsed address, the kind and what it may stand for, and
    the references and tokens in it. cities: (city) of the gazetteer, normalised. Each text is parsed
    once, however many rows have it."""
    distinct = texts.select("raw_value").distinct().withColumn("normalized_value", norm_text(F.col("raw_value"))).where("normalized_value <> ''")
    parsed = distinct.withColumn("a", parse_address(F.col("raw_value")))
    known = cities.where("city <> ''").select(F.col("city").alias("__city")).distinct().withColumn("__known", F.lit(True))
    raw = F.col("raw_value")
    met = parsed.join(known, F.col("a.city") == F.col("__city"), "left")
    kind = kind_of(raw, F.col("a"), F.coalesce("__known", F.lit(False)))
    out = met.select("raw_value", "normalized_value", "a", signal_of(kind).alias("s")).select(
        "raw_value", "normalized_value", F.col("s.kind").alias("signal_kind"), F.col("s.score").alias("signal_score"), F.col("s.strength").alias("semantic_strength"),
        *(F.col(f"s.is_{x}").alias(f"is_{x}_candidate") for x in ("ban", "site", "optical", "route")), (F.col("s.kind") == "noise").cast("int").alias("is_noise"),
        *(F.nullif(F.col(f"a.{x}"), F.lit("")).alias(y) for x, y in (("street_name", "street_hint"), ("house_number", "house_number_hint"), ("city", "city_hint"), ("postcode", "postcode_hint"))),
        route_refs(raw).alias("route_refs"), service_refs(raw).alias("service_refs"), place_tokens(raw).alias("site_tokens"),
        F.array_intersect(words(F.col("normalized_value")), text_list(*TECHNICAL)).alias("technical_tokens"),
    )
    return texts.join(out, "raw_value")


def service_signals(services: DataFrame, links: DataFrame, lines: DataFrame, cities: DataFrame) -> DataFrame:
    """The signals of all services, each source, normalised text and kind once; of equal ones the least
    text stays."""
    rows = classified(raw_values(services, links, lines), cities)
    return best_per_key(rows, ["service_id", "source_column", "normalized_value", "signal_kind"], [F.col("lea_line_id"), F.col("raw_value")])


def address_matches(parsed: DataFrame, addresses: DataFrame) -> DataFrame:
    """For each text (normalized_value, street, city, house_number, postcode): the address that matches,
    with match_rule and match_score. A street and city match on both, the house number first; other
    texts match a full label; a city alone counts only where there is no text."""
    street, city = norm_text(F.col("street")), normalize_city(words(norm_text(F.col("city"))))
    want = parsed.select("normalized_value", "house_number", street.alias("s"), city.alias("c"), F.coalesce("postcode", F.lit("")).alias("p")).distinct()
    have = addresses.select("ban_id", "house_number", "normalized_city", "normalized_street_name", "normalized_label", "postcode", "x_l93", "y_l93", "reuse_count", "reuse_class", "reuse_score")
    have = have.withColumnRenamed("house_number", "number").withColumnRenamed("postcode", "code")
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    whole, label = has("s") & has("c"), has("normalized_value")
    same = has("house_number") & (F.col("number") == F.col("house_number"))
    score = lambda rule, value: [F.lit(rule).alias("match_rule"), value.cast("int").alias("match_score")]
    # Of the addresses that a rule finds by the same key the first wins, so only that one is joined.
    first = lambda *keys: have.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.min_by(F.struct(*(c for c in have.columns if c not in keys)), F.struct("number", "ban_id")).alias("h"))
    flat = lambda df, *keys: df.select(*(c for c in df.columns if c != "h"), *(F.col(f"h.{c}").alias(c) for c in have.columns if c not in keys))
    street_city = ("normalized_city", "normalized_street_name")
    at = (F.col("c") == F.col("normalized_city")) & (F.col("s") == F.col("normalized_street_name"))
    # A house number that the street has comes before all others.
    by_number = flat(want.where(whole & has("house_number")).join(first(*street_city, "number"), at & (F.col("house_number") == F.col("number"))), *street_city, "number")
    by_street = by_number.unionByName(flat(want.where(whole).join(first(*street_city), at), *street_city))
    by_street = by_street.select("*", *score("ban_street_city", F.when(same, 98).otherwise(90)))
    by_label = flat(want.where(~whole & label).join(first("normalized_label"), F.col("normalized_value") == F.col("normalized_label")), "normalized_label").select("*", *score("ban_full_label_exact", F.lit(94)))
    rest = want.where(~whole & ~label & has("c"))
    by_code = flat(rest.where(has("p")).join(first("normalized_city", "code"), (F.col("c") == F.col("normalized_city")) & (F.col("p") == F.col("code"))), "normalized_city", "code").select("*", *score("ban_city_postcode_only", F.lit(45)))
    by_city = flat(rest.where(~has("p")).join(first("normalized_city"), F.col("c") == F.col("normalized_city")), "normalized_city").select("*", *score("ban_city_only", F.lit(35)))
    every = reduce(DataFrame.unionByName, [by_street, by_label, by_code, by_city])
    best = best_per_key(every, ["normalized_value", "house_number", "s", "c", "p"], [F.desc("match_score"), F.col("number"), F.col("ban_id")])
    near = F.col("match_score") >= 80
    return best.select(
        "normalized_value", F.col("house_number").alias("house_number_hint"), F.col("s").alias("street_key"), F.col("c").alias("city_key"), F.col("p").alias("postcode_key"), "ban_id", "match_rule", "match_score",
        F.when(near, F.col("x_l93")).alias("x"), F.when(near, F.col("y_l93")).alias("y"), "reuse_count", "reuse_class", "reuse_score",
    )


def seeds(signals: DataFrame, addresses: DataFrame) -> DataFrame:
    """Of each service the best signals that may be addresses, by strength and quota, each kind and
    text once, with the address that matches. match_score is the least of the scores of the match, the
    signal and the point; pick orders the seeds of a service."""
    usable = signals.where("is_ban_candidate = 1 and is_noise = 0")
    order = [F.desc("source_priority"), F.desc("signal_score"), F.col("normalized_value")]
    chosen = quota_top(usable, ["service_id"], "semantic_strength", QUOTAS, order, ["signal_kind", "normalized_value"])
    parsed = chosen.select("normalized_value", F.col("street_hint").alias("street"), F.col("city_hint").alias("city"), F.col("house_number_hint").alias("house_number"), F.col("postcode_hint").alias("postcode"))
    found = address_matches(parsed, addresses).withColumnsRenamed({"normalized_value": "__n", "house_number_hint": "__h", "street_key": "__s", "city_key": "__c", "postcode_key": "__p", "match_score": "raw_match_score"})
    same = (
        (F.col("normalized_value") == F.col("__n")) & (norm_text(F.col("street_hint")) == F.col("__s")) & (normalize_city(words(norm_text(F.col("city_hint")))) == F.col("__c"))
        & (F.coalesce("postcode_hint", F.lit("")) == F.col("__p")) & F.col("house_number_hint").eqNullSafe(F.col("__h"))
    )
    met = chosen.join(found, same, "left").drop("__n", "__h", "__s", "__c", "__p")
    effective = F.when(F.col("ban_id").isNotNull(), F.least("raw_match_score", "signal_score", "reuse_score")).otherwise(0)
    return met.withColumn("match_score", effective)


def seeds_of_end(seed_rows: DataFrame, end: str) -> DataFrame:
    """The seeds that speak for one end (A or Z) of each service, best first by place: those from its
    own text or of an address kind, and only where there are none the others."""
    own = (F.col("source_column") == f"endpoint_{end.lower()}_raw") | F.col("signal_kind").isin(ADDRESS_KINDS)
    rank = F.when(F.col("semantic_strength") == "strong", 3).when(F.col("semantic_strength") == "medium", 2).otherwise(1)
    ranked = seed_rows.withColumn("__own", own.cast("int"))
    most = ranked.groupBy("service_id").agg(F.max("__own").alias("__most"))
    kept = ranked.join(most, "service_id").where(F.col("__own") == F.col("__most")).drop("__own", "__most")
    # A service has at most as many seeds as the quotas allow.
    return kept.withColumn("place", F.struct((-rank).alias("r"), (-F.col("source_priority")).alias("p"), (-F.col("match_score")).alias("m"), F.col("pick").alias("i")))
