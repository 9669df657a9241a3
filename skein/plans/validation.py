"""Checks of proposed resolutions against the tables: sites, devices and their POPs, ends of routes.

Each check takes all resolutions at once and gives one row per resolution, with a score and whether it
passes. What is compared by its text is joined by tokens or codes, never by a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.references import route_refs
from skein.functions.text import business_tokens, clean_label, is_blank, norm_text
from skein.operators.matching import exploded, label_matches
from skein.operators.ranking import best_per_key, stored
from skein.plans.resolutions import missing_target, route_end_score

# The least score of a site's name, words that are not a business here, the POP in a
# host name, and scores of its check.
SITE_LEAST = 72
STOPWORDS = [
    "CLIENT", "CLIENTS", "LAN2LAN", "L2L", "TRUNK", "VERS", "CPE", "DSP", "VLAN", "POP", "SITE", "PORT", "ACCES", "ACCESS", "TRANSPORT", "COLLECTE",
    "SERVICE", "SERVICES", "SHUT", "TEMPORAIRE", "NE", "PAS", "CPEDSP", "CLIENTLAN2LAN", "CLIENTL2L",
]
POP = r"(?i)^([a-z]+\d+)-"
POP_LINKED, POP_ELSEWHERE = 85, 30


def site_checks(values: DataFrame, sites: DataFrame) -> DataFrame:
    """(value, site_id, score, passed) of distinct values: 100 for a site's id or normalised reference,
    else the best label score of a reference; a site counts from SITE_LEAST on."""
    v = values.select("value").where(~is_blank(F.col("value"))).distinct()
    names = sites.select("site_id", F.col("site_id").alias("name")).union(sites.select("site_id", norm_text(F.col("reference")))).where("name <> ''")
    exact = v.join(names.groupBy("name").agg(F.min("site_id").alias("site_id")), F.col("value") == F.col("name")).select("value", "site_id", F.lit(100).alias("score"))
    label = lambda df, key, text: df.select(F.col(key), clean_label(F.col(text), STOPWORDS).alias(f"{key}_l"))
    a = label(v.join(exact.select("value"), "value", "left_anti"), "value", "value")
    b = label(sites.where(~is_blank(F.col("reference"))), "site_id", "reference")
    tokens = lambda df, c: df.withColumn("ts_" + c, business_tokens(F.col(c + "_l")))
    found = label_matches(tokens(a, "value"), "value", "value_l", "ts_value", tokens(b, "site_id"), "site_id", "site_id_l", "ts_site_id", 1)
    best = best_per_key(found, ["value"], [F.desc("score"), F.col("site_id")])
    every = exact.unionByName(best.select("value", "site_id", F.col("score").cast("int").alias("score")))
    out = v.join(every, "value", "left").withColumn("score", F.coalesce("score", F.lit(0)))
    return out.withColumn("passed", F.col("score") >= SITE_LEAST)


def pop_code(device_name: Column) -> Column:
    """The POP in a host name, upper case, empty if there is none."""
    return F.upper(F.regexp_extract(F.coalesce(device_name, F.lit("")), POP, 1))


def codes_in(text: Column) -> Column:
    """All codes (letters, then digits) that occur in a text, parts of longer ones included."""
    up = F.upper(F.coalesce(text, F.lit("")))
    runs = F.zip_with(F.regexp_extract_all(up, F.lit("([A-Z]+)([0-9]+)"), F.lit(1)), F.regexp_extract_all(up, F.lit("([A-Z]+)([0-9]+)"), F.lit(2)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    ends = lambda a: F.transform(F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, F.length(a)))
    heads = lambda b: F.transform(F.sequence(F.lit(1), F.length(b)), lambda i: F.substring(b, F.lit(1), i))
    both = lambda r: F.flatten(F.transform(ends(r["a"]), lambda x: F.transform(heads(r["b"]), lambda y: F.concat(x, y))))
    return F.array_distinct(F.flatten(F.transform(runs, both)))


def pop_checks(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """rows (resolution_id, device_name, site_a, site_z) with pop, score and passed: 85 if the device's
    POP is one of the two sites or in its name, 30 if the POP is another site, 0 if no site has it."""
    held = exploded(sites.withColumn("codes", F.array_union(codes_in(F.col("site_id")), codes_in(F.col("reference")))), "codes", "pop").groupBy("pop").agg(F.min("site_id").alias("pop_site"))
    out = rows.withColumn("pop", pop_code(F.col("device_name"))).join(held, "pop", "left")
    linked = lambda s: F.coalesce(~is_blank(F.col(s)) & (F.contains(F.lower(F.col(s)), F.lower(F.col("pop"))) | (F.col(s) == F.col("pop_site"))), F.lit(False))
    some = ~is_blank(F.col("site_a")) | ~is_blank(F.col("site_z"))
    usable = (F.col("pop") != "") & some & F.col("pop_site").isNotNull()
    score = F.when(~usable, 0).when(linked("site_a") | linked("site_z"), POP_LINKED).otherwise(POP_ELSEWHERE)
    return out.withColumn("score", score).withColumn("passed", F.col("score") == POP_LINKED).drop("pop_site")


def route_checks(rows: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """rows (resolution_id, route_ref, site_a, site_z) with route_id, score and passed. A route is found
    by its id, its reference, or a reference in its text. stops: (route_id, site, step_type); the ends
    of a route are its steps DEPART and ARRIVEE. A site is a stop if one name holds the other."""
    names = routes.select("route_id", F.explode(F.array_union(F.array(F.col("route_id"), F.trim("route_ref")), route_refs(F.col("route_ref")))).alias("name")).where("name <> ''")
    name = names.groupBy("name").agg(F.min("route_id").alias("route_id"))
    met = rows.join(name, F.trim(F.col("route_ref")) == F.col("name"), "left").drop("name")
    held = stops.select("route_id", norm_text(F.col("site")).alias("stop"), F.upper("step_type").isin("DEPART", "ARRIVEE").alias("end")).distinct()
    ends = F.explode(F.array(*(F.struct(F.lit(e).alias("e"), norm_text(F.col(f"site_{e}")).alias("n")) for e in "az")))
    mine = met.where("route_id is not null").select("resolution_id", "route_id", ends.alias("x")).select("resolution_id", "route_id", "x.e", "x.n")
    holds = (F.col("n") != "") & (F.col("stop") != "") & (F.contains(F.col("n"), F.col("stop")) | F.contains(F.col("stop"), F.col("n")))
    # Each name is compared once with the stops of a route, however many resolutions ask.
    seen = mine.select("route_id", "n").distinct().join(held, "route_id").groupBy("route_id", "n").agg(F.coalesce(F.bool_or(holds & F.col("end")), F.lit(False)).alias("t"), F.coalesce(F.bool_or(holds), F.lit(False)).alias("p"))
    seen = mine.join(seen, ["route_id", "n"]).groupBy("resolution_id", "e").agg(F.bool_or("t").alias("t"), F.bool_or("p").alias("p"))
    counts = seen.groupBy("resolution_id").agg(F.count_if("t").alias("terminal"), F.count_if(F.col("p") & ~F.col("t")).alias("passage"), F.lit(1).alias("stops"))
    out = met.join(counts, "resolution_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    score = F.when(F.col("route_id").isNull(), 0).otherwise(route_end_score(zero("terminal"), zero("passage"), zero("stops")))
    return out.withColumn("score", score).withColumn("passed", F.col("score") > 20).drop("terminal", "passage", "stops")


def validate(rows: DataFrame, t: dict[str, DataFrame]) -> DataFrame:
    """rows (the newest resolution of each service, with its nature_service) with errors, warnings and
    status: declared_gap, rejected, needs_review or validated. t: sites, devices, interfaces, routes,
    stops and parties."""
    base = rows.withColumn("resolution_status", F.coalesce(F.nullif(F.trim("resolution_status"), F.lit("")), F.lit("validated")))
    values = base.select(F.col("site_a").alias("value")).union(base.select("site_z"))
    site = stored(site_checks(values, t["sites"]))
    for end in ("a", "z"):
        base = base.join(site.select(F.col("value").alias(f"site_{end}"), F.col("passed").alias(f"__site_{end}")), f"site_{end}", "left")
    pops = pop_checks(base.select("resolution_id", F.col("network_support_id").alias("device_name"), "site_a", "site_z"), t["sites"]).select("resolution_id", F.col("passed").alias("__pop"))
    known = t["devices"].select("device_name", F.lit(2).alias("k")).union(t["interfaces"].select("device_name", F.lit(1))).groupBy(F.col("device_name").alias("network_support_id")).agg(F.max("k").alias("__device"))
    wanted = F.trim(F.coalesce(F.when(~is_blank(F.col("route_ref")), F.col("route_ref")), F.col("optical_support_ref"), F.lit("")))
    routes = route_checks(base.select("resolution_id", wanted.alias("route_ref"), "site_a", "site_z"), t["routes"], t["stops"]).select("resolution_id", F.col("score").alias("__route"))
    party = t["parties"].select(F.col("party_id").alias("party_final_id"), F.lit(True).alias("__party")).distinct()
    met = base.join(pops, "resolution_id", "left").join(known, "network_support_id", "left").join(routes, "resolution_id", "left").join(party, "party_final_id", "left")
    has = lambda c: ~is_blank(F.col(c))
    gap = F.col("resolution_status") == "declared_gap"
    nature = F.col("nature_service")
    l2l, fon = nature == "Lan To Lan", nature.isin("IRU FON", "Location FON")
    tell = lambda **tests: F.array_compact(F.array(*(F.when(F.coalesce(x, F.lit(False)), F.lit(n)) for n, x in tests.items())))
    errors = tell(
        gap_without_reason=gap & ~has("data_gap_reason"), self_loop=has("site_a") & has("site_z") & (F.upper(F.trim("site_a")) == F.upper(F.trim("site_z"))),
        missing_network_vlan_id=~gap & l2l & ~has("network_vlan_id"), missing_route_ref=~gap & (l2l | fon) & ~has("route_ref"),
    )
    several = F.size(F.array_distinct(F.coalesce("inferred_vlans", F.array().cast("array<string>")))) > 1
    warnings = tell(
        site_a_unknown=has("site_a") & ~F.col("__site_a"), site_z_unknown=has("site_z") & ~F.col("__site_z"),
        device_unknown=has("network_support_id") & F.col("__device").isNull(), pop_elsewhere=has("network_support_id") & (F.col("__device") == 2) & ~F.col("__pop"),
        route_doubtful=(wanted != "") & (F.coalesce("__route", F.lit(0)) < 90), party_unknown=has("party_final_id") & F.col("__party").isNull(),
        several_vlans=~gap & l2l & several & ~has("network_interface_id") & ~has("cpe_id"),
    )
    out = met.withColumn("errors", errors).withColumn("warnings", warnings).withColumn("missing_target", missing_target(nature, F.col("network_vlan_id"), F.col("route_ref")))
    status = F.when(F.size("errors") > 0, "rejected").when(gap, "declared_gap").when(F.size("warnings") > 0, "needs_review").otherwise("validated")
    return out.withColumn("status", status).select(*(c for c in rows.columns if c != "status"), "errors", "warnings", "missing_target", "status")
