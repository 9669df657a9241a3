"""Candidates of each service in one row of nested arrays: parties, signals, spatial evidence, optical and
network supports, and the decision pack made of them.

Rows that look alike are ranked together, and a row that stands in several parts is one row. Each
ranking cuts rows in every task before they move by service, so a service with very many rows sends no
more than the limits from a task; what is left is listed where the join with the services finds it.
Parts of the optical bundle have no limit: they are listed whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from skein.functions.text import ascii_upper, is_blank, norm_text
from skein.operators.matching import exploded
from skein.operators.ranking import best_per_key
from skein.operators.substrings import contained
from skein.plans.hunts import NO_CLIENT, bare_route
from skein.plans.route_hunt import stop_words

# Rows of each part, those of other parts are not cut; kinds of signals by what they are recommended for; words that name no
# client here (the first of NO_CLIENT); rows that one word or circuit may give.
LIMITS = {
    "contract_parties": 20, "final_parties": 20, "principal_aliases": 20, "final_aliases": 20, "signals": 40, "address_signals": 5, "site_signals": 5, "technical_signals": 5, "route_signals": 5, "noise_signals": 5,
    "seeds": 20, "spatial_evidence": 20,
    "network_hints": 20, "vlans_by_label": 20, "subinterfaces": 30, "cpes": 10,
}
ADDRESS = ["postal_address_precise", "mixed_site_address", "postal_address_partial", "postcode_city", "city_only"]
SITE = ["technical_site_anchor", "site_label_business", "mixed_site_address", "postal_address_precise", "postal_address_partial"]
NO_NAME = NO_CLIENT[:10]
PER_WORD = {"vlans_by_label": 15, "cpes": 5, "circuit": 5}
KEYS = ["k0", "k1", "k2", "k3"]


@dataclass
class Part:
    """Rows of one part, or of several: service_id, what rows are ranked by, least first (order), and the
    fields that are listed; of several parts also `parts`, a bit for each that the row stands in."""

    names: list[str]
    rows: DataFrame
    order: list[str]
    fields: list[str]


def part(rows: DataFrame, name: str | dict[str, Column], order: list[Column | str], fields: list[str]) -> Part:
    """name: the part, or the parts with the test of each. A row that stands in several stays one row.
    order: numbers, or columns by name, which rank as texts; texts that are fields move once."""
    text = lambda k: isinstance(k, str) and k in fields and isinstance(rows.schema[k].dataType, StringType)
    made = {f"k{i}": F.col(k).cast("string") if isinstance(k, str) else k.cast("double") for i, k in enumerate(order) if not text(k)}
    ranked = [k if text(k) else f"k{i}" for i, k in enumerate(order)]
    own = [*(c.alias(k) for k, c in made.items()), *fields]
    if isinstance(name, str):
        return Part([name], rows.select("service_id", *own), ranked, fields)
    bits = reduce(Column.bitwiseOR, (F.when(t, F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(name.values())))
    return Part(list(name), rows.select("service_id", bits.alias("parts"), *own).where("parts <> 0"), ranked, fields)


def _listed(p: Part, limits: dict[str, int]) -> DataFrame:
    """service_id and an array of each part, ranked and cut; a single part without a limit whole. Rows are cut in every task before they move:
    those of several parts first by the parts that they stand in, of which any may need as many rows as
    its limit."""
    several, value = len(p.names) > 1, F.struct(*p.fields)
    if not several and p.names[0] not in limits:
        ranked = F.struct(*(F.col(k).alias(f"o{i}") for i, k in enumerate(p.order)), value.alias("value"))
        return p.rows.groupBy("service_id").agg(F.transform(F.array_sort(F.collect_list(ranked)), lambda x: x["value"]).alias(p.names[0]))
    kept = best_per_key(p.rows, ["service_id", "parts"] if several else ["service_id"], [F.col(k) for k in p.order], max(limits[n] for n in p.names))
    # The rows move again before the value is made of their fields.
    kept = kept.repartition("service_id") if several else kept
    mine = Window.partitionBy("service_id").orderBy(*p.order, *(["parts"] if several else []))
    every = F.collect_list(F.struct("parts", value.alias("value")) if several else value).over(mine.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    whole = kept.select("service_id", F.row_number().over(mine).alias("first"), every.alias("every")).where("first = 1")
    if not several:
        return whole.select("service_id", F.col("every").alias(p.names[0]))
    of = lambda i: F.filter("every", lambda x: x["parts"].bitwiseAND(F.lit(1 << i)) != 0)
    return whole.select("service_id", *(F.slice(of(i), 1, limits[n])["value"].alias(n) for i, n in enumerate(p.names)))


def bundle(services: DataFrame, parts: list[Part], limits: dict[str, int] = LIMITS) -> DataFrame:
    """services with an array of each part, ranked and cut to its limit if it has one; empty where a service has none."""
    out = services
    for p in parts:
        whole = _listed(p, limits)
        out = out.join(whole, "service_id", "left").withColumns({n: F.coalesce(n, F.array().cast(whole.schema[n].dataType)) for n in p.names})
    return out


def party_parts(services: DataFrame, service_parties: DataFrame, aliases: DataFrame, parties: DataFrame) -> list[Part]:
    """Parties that the rules gave (service_id, role_name, party_id, rule_name, score), and aliases
    (party_id, alias_value, normalized_alias) equal to the service's names."""
    named = parties.select("party_id", "canonical_name")
    roles = {n: F.col("role_name") == n.replace("parties", "party") for n in ("contract_parties", "final_parties")}
    given = service_parties.where(F.col("role_name").isin("contract_party", "final_party")).join(named, "party_id", "left")
    out = [part(given, roles, [-F.col("score"), "party_id"], ["party_id", "canonical_name", "rule_name", "score"])]
    wanted = services.select("service_id", F.explode(F.array(F.struct(F.lit("principal_aliases").alias("p"), norm_text(F.col("principal_client")).alias("normalized_alias")), F.struct(F.lit("final_aliases").alias("p"), norm_text(F.col("client_final")).alias("normalized_alias")))).alias("w"))
    first = best_per_key(aliases.join(named, "party_id", "left"), ["normalized_alias"], [F.col("canonical_name"), F.col("alias_value"), F.col("party_id")], LIMITS["final_aliases"])
    met = wanted.select("service_id", "w.*").where("normalized_alias <> ''").join(first, "normalized_alias")
    return [*out, part(met, {n: F.col("p") == n for n in ("principal_aliases", "final_aliases")}, ["canonical_name", "alias_value", "party_id"], ["party_id", "canonical_name", "alias_value"])]


SIGNALS = ["signals", "address_signals", "site_signals", "technical_signals", "route_signals", "noise_signals"]


def signal_parts(signals: DataFrame) -> list[Part]:
    """Signals (service_id, source_column, raw_value, signal_kind, signal_score, source_priority,
    is_noise), each one row in all parts it is recommended for."""
    kind = F.col("signal_kind")
    tests = {"signals": F.lit(True), "address_signals": kind.isin(ADDRESS), "site_signals": kind.isin(SITE), "technical_signals": kind == "technical_site_anchor", "route_signals": kind == "route_or_service_reference", "noise_signals": F.col("is_noise").cast("boolean")}
    # Priority and score, both high first, as one number.
    rank = -(F.coalesce("source_priority", F.lit(0)) * 100_000 + F.coalesce("signal_score", F.lit(0)))
    return [part(signals, tests, [rank, "source_column", "raw_value"], ["source_column", "raw_value", "signal_kind", "signal_score"])]


def spatial_parts(seeds: DataFrame, evidence: DataFrame) -> list[Part]:
    """Seeds by priority and score, and evidence by adjusted score and distance."""
    rank = -(F.coalesce("seed_priority", F.lit(0)) * 100_000 + F.coalesce("match_score", F.lit(0)))
    far = F.coalesce("distance_meters", F.lit(1e9))
    return [
        part(seeds, "seeds", [rank, "source_column", "raw_value"], ["source_column", "raw_value", "match_rule", "match_score"]),
        part(evidence, "spatial_evidence", [-F.col("adjusted_score"), far, "target_id", "target_table"], ["target_table", "target_id", "distance_meters", "adjusted_score", "rule_name"]),
    ]


OPTICAL = ["optical_hints", "logical_routes", "lease_ends", "cables", "housings", "nearby_cables", "stops"]


def optical_parts(services: DataFrame, supports: DataFrame, tables: dict[str, DataFrame]) -> list[Part]:
    """Supports (service_id, support_type, support_id, route_ref, rule_name, score) and what the plant says
    of them: logical routes, ends of leases, cables, housings; cables and stops that the names of the
    service's sites (site_a_name, site_z_name) name, all of them. tables: logical_routes, lease_ends, cables
    (site_tokens: an array), housings, stops."""
    of = lambda *kinds: supports.where(F.col("support_type").isin(*kinds)).select("service_id", F.col("support_id").cast("string").alias("id")).distinct()
    hints = part(supports, "optical_hints", [-F.col("score"), "support_type", "support_id", "rule_name"], ["support_type", "support_id", "route_ref", "rule_name", "score"])
    routes = supports.where("route_ref is not null").select("service_id", "route_ref").distinct().join(tables["logical_routes"], "route_ref")
    ends = tables["lease_ends"].withColumn("id", F.col("optical_lease_id").cast("string"))
    cables = tables["cables"].withColumn("id", F.col("cable_id").cast("string"))
    mine = of("cable").join(cables, "id")
    words = F.array_distinct(F.concat(stop_words(F.col("site_a_name")), stop_words(F.col("site_z_name"))))
    asked = services.select("service_id", F.posexplode(words).alias("at", "token"))
    named = exploded(cables.select("id", "reference", "userreference", "number_of_fibers", "site_tokens"), "site_tokens", "token").drop("site_tokens")
    # From here on rows move by service only: those of a place are found and listed where they lie.
    own = of("cable").groupBy("service_id").agg(F.collect_set("id").alias("own"))
    near = asked.join(named, "token").repartition("service_id").join(own, "service_id", "left").where(~F.coalesce(F.array_contains("own", F.col("id")), F.lit(False)))
    near = near.groupBy("service_id", "id", "reference", "userreference", "number_of_fibers").agg(F.min("at").alias("at"))
    texts = tables["stops"].where(~is_blank(F.col("route_ref"))).select(F.trim("route_ref").alias("text_id"), ascii_upper(F.col("site")).alias("text")).distinct()
    held = contained(asked.select(F.col("token").alias("pattern")), texts, [])
    stops = asked.join(held, F.col("token") == F.col("pattern")).repartition("service_id").groupBy("service_id", F.col("text_id").alias("route_ref")).agg(F.min(F.struct("at", "token")).alias("m")).select("service_id", "route_ref", "m.at", "m.token")
    housings = of("housing").join(tables["housings"].withColumn("id", F.col("housing_id").cast("string")), "id")
    cable = ["id", "reference", "userreference", "number_of_fibers"]
    return [
        hints, part(routes, "logical_routes", ["route_ref", "source_layer", "logical_route_id"], ["logical_route_id", "route_ref", "source_layer"]),
        part(of("lease", "fiber_lease", "isp_lease").join(ends, "id"), "lease_ends", ["id", "endpoint_label", "site_id"], ["id", "endpoint_label", "site_id"]),
        part(mine, "cables", [F.col("number_of_fibers"), "reference", "id"], cable), part(near, "nearby_cables", [F.col("at"), "id"], cable),
        part(housings, "housings", ["housing_type", "reference", "id"], ["id", "housing_type", "reference", "site_id"]),
        part(stops, "stops", [F.col("at"), "route_ref"], ["route_ref", "token"]),
    ]


NETWORK = ["network_hints", "vlans_by_label", "subinterfaces", "cpes"]


def name_words(*texts: Column) -> Column:
    """Distinct words of five letters or digits or more that may name a client, as they stand."""
    good = lambda t: (F.length(t) >= 5) & ~t.isin(NO_NAME)
    return F.array_distinct(F.concat(*(F.filter(F.split(F.upper(F.coalesce(t, F.lit(""))), "[^A-Z0-9]+"), good) for t in texts)))


def network_parts(services: DataFrame, supports: DataFrame, tables: dict[str, DataFrame]) -> list[Part]:
    """Supports (service_id, support_type, support_id, rule_name, score); VLANs whose label and equipment
    whose hostname hold a word of the client or of end Z; sub-interfaces of the supports' VLANs, then of
    the service's circuits. tables: signals, vlans, subinterfaces (subif_id), cpe_inventory."""
    asked = services.select("service_id", F.posexplode(name_words(F.col("client_final"), F.col("endpoint_z_raw"))).alias("at", "pattern"))
    vlans = tables["vlans"].select(F.col("network_vlan_id").cast("string").alias("id"), F.col("vlan_id").cast("string").alias("vlan_id"), "device_name", "label")
    cpes = tables["cpe_inventory"].select(F.col("cpe_id").cast("string").alias("id"), "hostname")
    texts = vlans.select(F.lit("vlans_by_label").alias("kind"), F.col("id").alias("text_id"), norm_text(F.col("label")).alias("text"))
    texts = texts.union(cpes.select(F.lit("cpes"), "id", ascii_upper(F.col("hostname"))))
    wants = asked.select("pattern").distinct().withColumn("kind", F.explode(F.array(F.lit("vlans_by_label"), F.lit("cpes"))))
    limit = F.when(F.col("kind") == "cpes", PER_WORD["cpes"]).otherwise(PER_WORD["vlans_by_label"])
    place = F.row_number().over(Window.partitionBy("kind", "pattern").orderBy("text_id"))
    held = contained(wants, texts, ["kind"], max(PER_WORD.values())).withColumn("n", place).where(F.col("n") <= limit)
    met = asked.join(held, "pattern").groupBy("service_id", "kind", F.col("text_id").alias("id")).agg(F.min("at").alias("at"))
    sub = ["subif_id", "device_name", "interface_name", "vlan_id", "xconnect_circuit_id"]
    subs = tables["subinterfaces"].withColumn("vlan_id", F.col("vlan_id").cast("string")).select(*(F.col(c).cast("string").alias(c) for c in sub))
    mine = supports.where("support_type = 'vlan'").select("service_id", F.col("support_id").cast("string").alias("id")).join(vlans.select("id", "vlan_id"), "id").select("service_id", "vlan_id").distinct()
    by_vlan = mine.join(best_per_key(subs, ["vlan_id"], [F.col("subif_id")], LIMITS["subinterfaces"]), "vlan_id").withColumn("way", F.lit(0))
    refs = exploded(tables["signals"], "route_refs", "ref").where("length(ref) >= 4").select("service_id", F.trim("ref").alias("ref"))
    circuits = exploded(refs.withColumn("ks", F.array("ref", F.trim(bare_route(F.upper("ref"))))), "ks", "xconnect_circuit_id").select("service_id", "xconnect_circuit_id").distinct()
    by_circuit = circuits.join(best_per_key(subs.where("xconnect_circuit_id is not null"), ["xconnect_circuit_id"], [F.col("subif_id")], PER_WORD["circuit"]), "xconnect_circuit_id").withColumn("way", F.lit(1))
    both = by_vlan.unionByName(by_circuit).groupBy("service_id", *sub).agg(F.min("way").alias("way"))
    return [
        part(supports, "network_hints", [-F.col("score"), "support_type", "support_id", "rule_name"], ["support_type", "support_id", "rule_name", "score"]),
        part(met.where("kind = 'vlans_by_label'").join(vlans, "id"), "vlans_by_label", [F.col("at"), "id"], ["id", "vlan_id", "device_name", "label"]),
        part(both, "subinterfaces", [F.col("way"), "subif_id"], sub), part(met.where("kind = 'cpes'").join(cpes, "id"), "cpes", [F.col("at"), "id"], ["id", "hostname"]),
    ]


def decision_pack(services: DataFrame, service_parties: DataFrame, aliases: DataFrame, parties: DataFrame, signals: DataFrame, seeds: DataFrame, evidence: DataFrame) -> DataFrame:
    """services with the parties, signals and spatial candidates of each: sites, housings and cables among
    the best evidence, and the best of all."""
    parts = [*party_parts(services, service_parties, aliases, parties), *signal_parts(signals), *spatial_parts(seeds, evidence)]
    out = bundle(services, parts)
    of = lambda table: F.filter("spatial_evidence", lambda e: e["target_table"] == table)
    return out.withColumns({"site_candidates": of("ref_sites"), "housing_candidates": of("ref_optical_housing"), "cable_candidates": of("ref_optical_cable"), "best_spatial_evidence": F.get("spatial_evidence", 0)})
