"""The log of proposed resolutions: append only, the newest version of each counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.text import hash16_lower, is_blank
from skein.operators.ranking import latest_per_key
from skein.operators.tables import kpis, mix

# What a resolution may say.
CONFIDENCES = ["high", "medium", "low"]
STATUSES = ["proposed", "validated", "needs_review", "rejected", "declared_gap"]
GAP_ATTRIBUTES = ["network_vlan_id", "route_ref", "both"]
GAP_TYPES = ["label_absent", "site_code_unlinked", "toip_not_in_xconnect", "no_lease_at_site", "gdb_site_out_of_scope", "spatial_seed_unreliable", "data_not_loaded"]
LISTED = 100


def checked(proposed: DataFrame, services: DataFrame, evidence: DataFrame) -> DataFrame:
    """proposed with `problem`, null if the row may be appended: a known service, a known confidence,
    at least one piece of evidence, a justification."""
    known = services.select("service_id", F.lit(True).alias("__known")).distinct()
    counts = evidence.groupBy("resolution_id").agg(F.count("*").alias("__n"))
    problem = (
        F.when(F.col("__known").isNull(), "unknown service")
        .when(~F.coalesce(F.col("confidence").isin(CONFIDENCES), F.lit(False)), "unknown confidence")
        .when(F.coalesce("__n", F.lit(0)) < 1, "no evidence")
        .when(is_blank(F.col("justification")), "no justification")
    )
    return proposed.join(known, "service_id", "left").join(counts, "resolution_id", "left").withColumn("problem", problem).drop("__known", "__n")


def appended(log: DataFrame, proposed: DataFrame, services: DataFrame, evidence: DataFrame, now: Column) -> DataFrame:
    """log with the proposals that checked() finds no fault with, as `proposed` at this time. Rows of the
    log are never changed; columns that one side lacks are null there."""
    good = checked(proposed, services, evidence).where("problem is null").drop("problem")
    return log.unionByName(good.withColumn("status", F.lit("proposed")).withColumn("created_at", now), allowMissingColumns=True)


def complete(proposed: DataFrame, services: DataFrame) -> DataFrame:
    """proposed with `blocked`: the attribute that a service of its nature needs and the proposal lacks,
    null if it may go on to validation."""
    natures = services.select("service_id", "nature_service").distinct()
    return proposed.join(natures, "service_id", "left").withColumn("blocked", missing_target(F.col("nature_service"), F.col("network_vlan_id"), F.col("route_ref"))).drop("nature_service")


def gaps(declared: DataFrame, services: DataFrame, now: Column) -> DataFrame:
    """Declared gaps (service_id, missing_attribute, searched_sources, observed_gap_type, next_best_hint,
    justification) as rows of the log, with `problem` where one may not be appended."""
    known = services.select("service_id", F.lit(True).alias("__known")).distinct()
    kind = F.coalesce(F.trim("observed_gap_type"), F.lit(""))
    problem = (
        F.when(is_blank(F.col("service_id")), "no service").when(is_blank(F.col("missing_attribute")), "no attribute").when(is_blank(F.col("justification")), "no justification")
        .when(~F.trim("missing_attribute").isin(GAP_ATTRIBUTES), "unknown attribute").when((kind != "") & ~kind.isin(GAP_TYPES), "unknown kind of gap")
        .when(F.col("__known").isNull(), "unknown service")
    )
    reason = F.to_json(F.struct("missing_attribute", F.nullif(F.trim("next_best_hint"), F.lit("")).alias("next_best_hint"), F.nullif(kind, F.lit("")).alias("observed_gap_type"), "searched_sources"))
    out = declared.join(known, "service_id", "left").withColumn("problem", problem)
    name = hash16_lower(F.col("service_id"), F.lit("declared_gap"), now.cast("string"))
    return out.select(
        name.alias("resolution_id"), "service_id", now.alias("created_at"), F.lit("low").alias("confidence"), F.lit("declared_gap").alias("resolution_status"), F.lit("declared_gap").alias("status"),
        reason.alias("data_gap_reason"), "justification", "problem",
    )


def listed(log: DataFrame, services: DataFrame, client: str = "", nature: str = "", status: str = "", limit: int = LISTED) -> DataFrame:
    """The newest resolutions with their services, narrowed by parts of names, whatever their case."""
    rows = log.join(services.select("service_id", "principal_client", "nature_service"), "service_id")
    for column, part in (("principal_client", client), ("nature_service", nature)):
        if part:
            rows = rows.where(F.contains(F.lower(column), F.lit(part.lower())))
    if status:
        rows = rows.where(F.col("status") == status)
    return rows.orderBy(F.desc("created_at"), F.desc("resolution_id")).limit(limit)


def unresolved(services: DataFrame, log: DataFrame) -> DataFrame:
    """Services without any resolution."""
    return services.join(log.select("service_id").distinct(), "service_id", "left_anti")


def queue_summary(queue: DataFrame, services: DataFrame, log: DataFrame) -> DataFrame:
    """How many services without a resolution wait for each kind of review: nature_service,
    principal_client, review_type, cnt."""
    left = unresolved(queue.select("service_id", "review_type").distinct(), log)
    return left.join(services.select("service_id", "nature_service", "principal_client"), "service_id").groupBy("nature_service", "principal_client", "review_type").agg(F.count("*").alias("cnt"))


def party_gaps(log: DataFrame, services: DataFrame, party: DataFrame, aliases: DataFrame) -> DataFrame:
    """Newest resolutions without a final party, with what might tell it: a final party that the rules
    found, the contract's final client, an alias of the contract's client."""
    rows = latest(log).where(is_blank(F.col("party_final_id"))).join(services.select("service_id", "principal_client", "client_final"), "service_id")
    final = party.where("role_name = 'final_party' and party_id is not null").select("service_id", F.lit(True).alias("__f")).distinct()
    named = aliases.select(F.col("alias_value").alias("principal_client"), F.lit(True).alias("__a")).distinct()
    out = rows.join(final, "service_id", "left").join(named, "principal_client", "left")
    reasons = {"pipeline_final_party": F.col("__f"), "client_final_raw": ~is_blank(F.col("client_final")), "principal_alias": F.col("__a")}
    told = F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in reasons.items())))
    return out.withColumn("reasons", F.when(F.size(told) > 0, told).otherwise(F.array(F.lit("no_direct_candidate")))).select("service_id", "principal_client", "confidence", "status", "reasons")


def coverage(log: DataFrame) -> DataFrame:
    """Newest resolutions by confidence and status: confidence, status, n."""
    return mix(latest(log), ["confidence", "status"])


def evidence_coverage(evidence: DataFrame, log: DataFrame) -> DataFrame:
    """Per kind of evidence of the newest resolutions: rows, services, strong rows and the mean score."""
    newest = latest(log).select("resolution_id", "service_id")
    met = evidence.drop("service_id").join(newest, "resolution_id")
    return met.groupBy("evidence_type").agg(F.count("*").alias("n"), F.count_distinct("service_id").alias("services"), F.count_if(F.col("score") >= 90).alias("strong"), F.round(F.avg("score"), 1).alias("mean_score"))


def agreement(log: DataFrame, ends: DataFrame, party: DataFrame) -> DataFrame:
    """One row: how many newest resolutions there are, and in how many each of sites A and Z and the final
    party is the one that the rules chose. The party's role may go by its older name."""
    at = lambda e: F.max(F.when(F.col("endpoint_label") == e, F.col("matched_site_id")))
    rules = ends.groupBy("service_id").agg(at("A").alias("__a"), at("Z").alias("__z"))
    final = party.where("role_name in ('final_party', 'client_final')").groupBy("service_id").agg(F.collect_set("party_id").alias("__parties"))
    met = latest(log).join(rules, "service_id", "left").join(final, "service_id", "left")
    return kpis(met, {
        "resolutions": F.lit(True), "same_site_a": F.col("resolved_site_a_id") == F.col("__a"), "same_site_z": F.col("resolved_site_z_id") == F.col("__z"),
        "same_party": F.array_contains("__parties", F.col("party_final_id")),
    })


def missing_target(nature: Column, vlan: Column, route: Column) -> Column:
    """Which attribute a resolution must have and lacks, or null."""
    need_vlan = (nature == "Lan To Lan") & is_blank(vlan)
    need_route = nature.isin("Lan To Lan", "IRU FON", "Location FON") & is_blank(route)
    return F.when(need_vlan, "network_vlan_id").when(need_route, "route_ref")


def latest(log: DataFrame) -> DataFrame:
    """By time, then by the greater resolution_id."""
    return latest_per_key(log, ["service_id"], "created_at", "resolution_id")


def validated(rows: DataFrame) -> DataFrame:
    """status of rows (nature_service, site_a, site_z, route_score, site_score, resolution_status,
    network_vlan_id, route_ref): declared gaps stay so, one site at both ends is rejected, what is
    missing or weak (below 60) goes to review."""
    gap = missing_target(F.col("nature_service"), F.col("network_vlan_id"), F.col("route_ref"))
    weak = (F.coalesce("route_score", F.lit(0)) < 60) | (F.coalesce("site_score", F.lit(0)) < 72)
    status = (
        F.when(F.col("resolution_status") == "declared_gap", "declared_gap")
        .when(~is_blank(F.col("site_a")) & (F.upper(F.trim("site_a")) == F.upper(F.trim("site_z"))), "rejected")
        .when(gap.isNotNull() | weak, "needs_review")
        .otherwise("validated")
    )
    return rows.withColumn("missing_target", gap).withColumn("status", status)


def route_end_score(terminal: Column, passage: Column, stops: Column) -> Column:
    """Of a route: how many of the two sites are its ends, how many it passes, how many stops it has."""
    return (
        F.when(stops == 0, 60).when(terminal == 2, 97).when((terminal == 1) & (passage == 1), 78).when(terminal == 1, 72)
        .when(passage == 2, 60).when(passage == 1, 45).otherwise(20)
    )


def scorecard(services: DataFrame, log: DataFrame) -> DataFrame:
    """One row of counts over all services and their latest resolutions."""
    both = services.join(latest(log).drop("nature_service"), "service_id", "left")
    lan, fibre = F.col("nature_service") == "Lan To Lan", F.col("nature_service").isin("IRU FON", "Location FON")
    route, vlan = ~is_blank(F.col("route_ref")), ~is_blank(F.col("network_vlan_id"))
    device = ~is_blank(F.col("cpe_id")) | ~is_blank(F.col("network_interface_id"))
    gap = F.coalesce("resolution_status", F.lit("validated")) == "declared_gap"
    return kpis(both, {
        "l2l_total": lan, "l2l_route": lan & route, "l2l_vlan": lan & vlan, "l2l_dual": lan & route & vlan, "l2l_triplet": lan & route & vlan & device,
        "l2l_declared_gap": lan & gap, "fon_total": fibre, "fon_route": fibre & route, "fon_declared_gap": fibre & gap,
    })


def restated(log: DataFrame, statuses: DataFrame, now: Column) -> DataFrame:
    """log with a new row for each resolution_id of statuses (resolution_id, status): its newest row with
    that status, at this time. Nothing is changed in place, so what the status was stays on record; a
    resolution that has the status already, or is unknown, gets no row."""
    newest = latest_per_key(log, ["resolution_id"], "created_at", "status")
    told = statuses.groupBy("resolution_id").agg(F.max("status").alias("__new"))
    rows = newest.join(told, "resolution_id").where(~F.col("status").eqNullSafe(F.col("__new")))
    return log.unionByName(rows.withColumns({"status": F.col("__new"), "created_at": now}).select(*log.columns))


FOCUSED = 50


def focus(services: DataFrame, client: str = "", nature: str = "", limit: int = FOCUSED) -> DataFrame:
    """The first services, by id, whose client or nature holds a part, whatever its case."""
    rows = services
    for column, part in (("principal_client", client), ("nature_service", nature)):
        if part:
            rows = rows.where(F.contains(F.lower(column), F.lit(part.lower())))
    return rows.orderBy("service_id").limit(limit)


def focus_unresolved(services: DataFrame, log: DataFrame, limit: int = FOCUSED) -> DataFrame:
    """The first services without a resolution, by client and nature."""
    return unresolved(services, log).orderBy(F.asc_nulls_first("principal_client"), F.asc_nulls_first("nature_service"), "service_id").limit(limit)


def focus_auto_valid(services: DataFrame, golden: DataFrame, log: DataFrame) -> DataFrame:
    """Services that the rules settled, with the confidence of the rules, and of the newest resolution its
    confidence and status as `agent`, `-` where there is none."""
    told = latest(log).select("service_id", F.concat_ws("/", "confidence", "status").alias("agent"))
    sure = golden.where("match_state = 'auto_valid'").select("service_id", "confidence_band", "match_state")
    return sure.join(services.select("service_id", "principal_client", "nature_service"), "service_id").join(told, "service_id", "left").withColumn("agent", F.coalesce("agent", F.lit("-")))


def review_rows(golden: DataFrame, services: DataFrame, queue: DataFrame) -> DataFrame:
    """Open questions with their services and what is known of them: one row per question."""
    known = golden.select("service_id", "match_state", "confidence_band").join(services.select("service_id", "nature_service", "principal_client"), "service_id")
    return known.join(queue.select("service_id", "review_type", "severity", "reason"), "service_id")
