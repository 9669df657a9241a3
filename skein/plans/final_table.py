"""The published table by groups of fields: what a validated resolution says of an optical or network
support replaces the consolidated group as a whole, nulls included; names of sites count only if they
belong to one site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.text import is_blank, norm_text
from skein.operators.ranking import best_per_key
from skein.plans.publication import critical_gaps, gap_flags, publication_status

# The fields of each group, those that a hint may name, and what a resolution's own group
# replaces of the network support.
OPTICAL = ["route_ref", "route_id", "lease_id", "fiber_lease_id", "isp_lease_id", "cable_id", "housing_id"]
ROUTE = OPTICAL[:5]
NETWORK = ["interface_id", "network_interface_id", "network_vlan_id", "cpe_id", "config_id"]
AGENT_NETWORK = NETWORK[1:]


def group(df_alias: str | None, fields: list[str]) -> Column:
    """The fields as one value, which may be there though all of them are null."""
    at = lambda c: F.col(f"{df_alias}.{c}" if df_alias else c).cast("string").alias(c)
    return F.struct(*map(at, fields))


def filled(value: Column, fields: list[str]) -> Column:
    """Whether any field of a group is not blank; false of a null group."""
    each = [F.coalesce(~is_blank(value[c]), F.lit(False)) for c in fields]
    out = each[0]
    for e in each[1:]:
        out = out | e
    return out


def unique_names(sites: DataFrame) -> DataFrame:
    """name (normalised), site_id of names (the array names) that one site alone has."""
    flat = sites.select("site_id", F.explode(F.array_distinct(F.transform("names", norm_text))).alias("name")).where("name <> ''")
    held = flat.groupBy("name").agg(F.count_distinct("site_id").alias("n"), F.min("site_id").alias("site_id"))
    return held.where("n = 1").select("name", "site_id")


def best_group(supports: DataFrame, fields: list[str], out: str) -> DataFrame:
    """service_id and the fields of its best support as one value: by score; ties by the fields."""
    named = [c for c in fields if c in supports.columns]
    order = [F.desc("score"), *(F.asc_nulls_last(c) for c in named)]
    whole = [F.col(c).cast("string").alias(c) if c in named else F.lit(None).cast("string").alias(c) for c in fields]
    return best_per_key(supports, ["service_id"], order).select("service_id", F.struct(*whole).alias(out))


def hinted_group(hints: DataFrame, supports: DataFrame) -> DataFrame:
    """service_id and the optical group of the first support of the service that has the hint (hint) as
    one of its fields: by score; ties by the fields. One equality join."""
    ids = F.array_distinct(F.array_compact(F.array(*(F.trim(F.col(c).cast("string")) for c in OPTICAL))))
    keyed = supports.select("service_id", "score", *OPTICAL, F.explode(ids).alias("hint"))
    met = keyed.join(hints, ["service_id", "hint"])
    return best_group(met, OPTICAL, "hinted")


def publish(services: DataFrame, golden: DataFrame, optical: DataFrame, network: DataFrame, resolutions: DataFrame, sites: DataFrame, parties: DataFrame, links: DataFrame) -> DataFrame:
    """One row per service.

    services: service_id, nature_service. golden: service_id, match_state, contract_party_id,
    final_party_id, site_a_id, site_z_id. optical, network: supports by service_id with score and the
    fields of OPTICAL and NETWORK. resolutions: the newest row of each service: status, party_final_id,
    resolved_site_a_id, resolved_site_z_id, site_a, site_z, the fields of OPTICAL and AGENT_NETWORK,
    inferred_vlans, optical_support_ref, network_support_id. sites: site_id, site_name, names.
    parties: party_id, canonical_name. links: service_id, line_ids.
    """
    agent = resolutions.where("status = 'validated'")
    agent = agent.select("service_id", F.lit(True).alias("ok"), *(F.col(c).alias(f"a_{c}") for c in ("party_final_id", "resolved_site_a_id", "resolved_site_z_id", "site_a", "site_z", "inferred_vlans")), group(None, OPTICAL).alias("a_optical"), group(None, AGENT_NETWORK).alias("a_network"), F.nullif(F.trim("optical_support_ref"), F.lit("")).alias("hint"), F.nullif(F.trim("network_support_id"), F.lit("")).alias("network_hint"))
    out = services.select("service_id", "nature_service").join(golden.withColumn("gold", F.lit(True)), "service_id", "left").join(agent, "service_id", "left")
    out = out.join(best_group(optical, OPTICAL, "g_optical"), "service_id", "left").join(best_group(network, NETWORK, "g_network"), "service_id", "left")
    hints = agent.where("hint is not null").select("service_id", "hint")
    out = out.join(hinted_group(hints, optical), "service_id", "left")
    unique = unique_names(sites)
    names = sites.select("site_id", "site_name")
    for end in "az":
        named = unique.select(F.col("name").alias("n"), F.col("site_id").alias(f"unique_{end}"))
        out = out.withColumn("n", F.nullif(norm_text(F.col(f"a_site_{end}")), F.lit(""))).join(named, "n", "left").drop("n")
        told, alone, gold = F.nullif(F.trim(f"a_resolved_site_{end}_id"), F.lit("")), F.col(f"unique_{end}"), F.nullif(F.trim(f"site_{end}_id"), F.lit(""))
        tried = F.coalesce(~is_blank(F.col(f"a_site_{end}")), F.lit(False)) & F.col("ok").isNotNull()
        source = F.when(told.isNotNull() | alone.isNotNull(), "agent_validated").when(gold.isNotNull(), "gold").when(tried, "agent_hint_unmapped").otherwise("missing")
        out = out.withColumns({f"site_{end}_source": source, f"published_site_{end}_id": F.coalesce(told, alone, gold)})
        out = out.join(names.select(F.col("site_id").alias(f"published_site_{end}_id"), F.col("site_name").alias(f"name_{end}")), f"published_site_{end}_id", "left")
        out = out.withColumn(f"published_site_{end}_name", F.coalesce(f"name_{end}", f"published_site_{end}_id"))
    party, held = F.nullif(F.trim("a_party_final_id"), F.lit("")), F.nullif(F.trim("final_party_id"), F.lit(""))
    out = out.withColumns({"final_party_source": F.when(party.isNotNull(), "agent_validated").when(held.isNotNull(), "gold").otherwise("missing"), "published_final_party_id": F.coalesce(party, held)})
    called = lambda key, name: parties.select(F.col("party_id").alias(key), F.col("canonical_name").alias(name))
    out = out.join(called("published_final_party_id", "published_final_party_name"), "published_final_party_id", "left").join(called("contract_party_id", "published_contract_party_name"), "contract_party_id", "left")
    # Optical: the resolution's group, the support that its hint names, the consolidated group.
    a, h, g = F.col("a_optical"), F.col("hinted"), F.col("g_optical")
    own, meant, has = filled(a, OPTICAL), h.isNotNull(), filled(g, OPTICAL)
    lost = F.col("hint").isNotNull() & ~own & ~meant & ~has
    chosen = F.when(own, a).when(meant, h).otherwise(g)
    # The consolidated source counts its route's fields alone.
    out = out.withColumn("optical_source", F.when(own | meant, "agent_validated").when(lost, "agent_hint_unmapped").when(filled(g, ROUTE), "gold").otherwise("missing")).withColumn("optical", chosen)
    # Network: the resolution has no field for the interface of the equipment, which stays.
    a, g = F.col("a_network"), F.col("g_network")
    own, has = filled(a, AGENT_NETWORK) | F.coalesce(~is_blank(F.col("a_inferred_vlans")), F.lit(False)), filled(g, NETWORK)
    lost = F.col("network_hint").isNotNull() & ~own & ~has
    merged = F.struct(g["interface_id"].alias("interface_id"), *(a[c].alias(c) for c in AGENT_NETWORK))
    out = out.withColumn("network_source", F.when(own, "agent_validated").when(lost, "agent_hint_unmapped").when(has, "gold").otherwise("missing")).withColumn("network", F.when(own, merged).otherwise(g))
    out = out.join(links.select("service_id", "line_ids"), "service_id", "left")
    o, n = F.col("optical"), F.col("network")
    lacks = lambda c: F.col(c).isNull()
    flags = gap_flags({
        "missing_final_party": lacks("published_final_party_id"), "missing_site_a": lacks("published_site_a_id"), "missing_site_z": lacks("published_site_z_id"), "missing_optical_support": ~filled(o, OPTICAL),
        "missing_logical_route_ref": ~filled(o, ROUTE), "missing_network_support": ~filled(n, NETWORK), "missing_bss_link": lacks("line_ids"),
        "agent_hint_unmapped": F.lit("agent_hint_unmapped").isin(*map(F.col, ("site_a_source", "site_z_source", "optical_source", "network_source"))),
    })
    truth = F.when(F.col("ok"), "agent_validated").when(F.col("match_state") == "auto_valid", "gold_auto_valid").when(F.col("gold"), "gold_review_required").otherwise("fallback_bss_only")
    out = out.withColumn("gap_flags", flags).withColumn("critical_gaps", critical_gaps(F.col("nature_service"), F.col("gap_flags"))).withColumn("selected_truth_source", truth)
    said = [F.when(F.col(f"{c}_source") == "agent_validated", F.lit(f"{t} from agent")) for c, t in (("final_party", "party"), ("site_a", "site_a"), ("site_z", "site_z"), ("optical", "optical"), ("network", "network"))]
    gold_party = F.when((F.col("final_party_source") == "gold") & F.col("ok"), F.lit("party from gold"))
    kind = F.when(~is_blank(o["cable_id"]), "cable").when(~is_blank(o["housing_id"]), "housing").when(~is_blank(o["route_id"]) | ~is_blank(o["route_ref"]), "route")
    some = lambda *cs: F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in cs))
    return out.select(
        "service_id", "nature_service", "contract_party_id", "published_contract_party_name", "final_party_source", "published_final_party_id", "published_final_party_name",
        *(f"{x}_{end}_{y}" for end in "az" for x, y in (("site", "source"), ("published_site", "id"), ("published_site", "name"))), "optical_source", *(o[c].alias(c) for c in OPTICAL), "network_source",
        *(n[c].alias(c) for c in NETWORK), kind.alias("spatial_best_object_type"),
        F.when(kind == "cable", o["cable_id"]).when(kind == "housing", o["housing_id"]).when(kind == "route", some(o["route_id"], o["route_ref"])).alias("spatial_best_object_id"),
        "line_ids", "gap_flags", "critical_gaps", "selected_truth_source", publication_status(F.col("selected_truth_source"), F.col("critical_gaps")).alias("publication_status"),
        F.array_compact(F.array(said[0], gold_party, *said[1:])).alias("notes"),
    )
