"""Contract lines to services, and maintenance services into those they maintain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skein.functions.references import classify_offer, contract_base, grouping_key, route_refs, service_refs, without_suffix
from skein.functions.text import norm_text
from skein.operators.ranking import best_per_key, numbered


def enriched(lines: DataFrame) -> DataFrame:
    """Lines with nature, role, references, is_old and grouping_key."""
    offer = classify_offer(F.col("offer_label"))
    texts = [F.col(c) for c in ("command_external", "contract_file", "endpoint_a_raw", "endpoint_z_raw", "client_final")]
    out = lines.withColumns({"nature_service": offer["nature"], "role_ligne": offer["role"], "route_refs": route_refs(*texts), "service_refs": service_refs(*texts)})
    out = out.withColumn("is_old", F.contains(norm_text(F.concat_ws(" ", "command_internal", "contract_file")), F.lit("OLD")).cast("int"))
    names = ("client_contractant", "nature_service", "role_ligne", "route_refs", "service_refs", "endpoint_a_raw", "endpoint_z_raw", "client_final", "contract_file", "command_internal")
    return out.withColumn("grouping_key", grouping_key(*map(F.col, names)))


def rollup(lines: DataFrame, key: str, order: list[str], role: str, carry: list[str]) -> DataFrame:
    """One row per key: the carried columns of its first principal line, else of its first line, and
    the number of lines. One aggregate with a partial step."""
    rank = F.struct(F.when(F.col(role) == "principal", 0).otherwise(1).alias("p"), *order)
    first = F.min_by(F.struct(*carry), rank).alias("f")
    return lines.groupBy(key).agg(first, F.count("*").alias("line_count"), F.min(F.struct(*order)).alias("first_order")).select(
        key, *(F.col(f"f.{c}").alias(c) for c in carry), "line_count", "first_order"
    )


def service_master(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(services, links of services to lines) of enriched lines that are not old. Services are numbered
    in the order of their first line by client, offer and line id."""
    live = lines.where("is_old = 0")
    order = ["client_contractant", "offer_label", "lea_line_id"]
    carry = ["lea_line_id", "nature_service", "client_contractant", "offer_label", "command_external", "command_internal", "endpoint_a_raw", "endpoint_z_raw", "client_final"]
    heads = rollup(live, "grouping_key", order, "role_ligne", carry)
    merged = {}
    for c in ("route_refs", "service_refs"):
        # A line names a few references; a service's are as many as its lines name distinct ones.
        flat = live.select("grouping_key", F.posexplode(c).alias("i", "ref"), *order).groupBy("grouping_key", "ref").agg(F.min(F.struct(*order, "i")).alias("at"))
        merged[c] = flat.groupBy("grouping_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "ref"))), lambda s: s["ref"]).alias(c))
    out = heads
    for c, m in merged.items():
        out = out.join(m, "grouping_key", "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    ordered = out.select("*", *(F.col(f"first_order.{c}").alias(f"__o{i}") for i, c in enumerate(order)))
    ids = numbered(ordered, ["__o0", "__o1", "__o2"], "service_id", "SVC-").drop("__o0", "__o1", "__o2", "first_order")
    services = ids.select(
        "service_id", F.col("grouping_key").alias("service_key"), "nature_service", F.col("client_contractant").alias("principal_client"), F.col("offer_label").alias("principal_offer"),
        F.col("command_external").alias("principal_external_ref"), F.col("command_internal").alias("principal_internal_ref"), "route_refs", "service_refs", "endpoint_a_raw", "endpoint_z_raw",
        "client_final", "line_count", F.col("lea_line_id").alias("principal_line_id"),
    )
    links = live.select("grouping_key", "lea_line_id", "role_ligne").join(services.select(F.col("service_key").alias("grouping_key"), "service_id", "principal_line_id"), "grouping_key")
    return services, links.select("service_id", "lea_line_id", "role_ligne", (F.col("lea_line_id") == F.col("principal_line_id")).cast("int").alias("is_principal"))


def maintenance_matches(members: DataFrame) -> DataFrame:
    """(maintenance_service_id, principal_service_id, strategy, match_detail). members: service_id,
    client, role, command, contract, endpoint_a, endpoint_z of the lines of fibre services.

    A service with only maintenance lines goes to the one service of its client with principal lines
    and the same base of a command; else of a contract file; else to the first with a common end.
    """
    roles = members.groupBy("service_id", "client").agg(F.max(F.col("role") == "principal").alias("p"), F.max(F.col("role") == "maintenance").alias("m"))
    kind = roles.where("p <> m").select("service_id", "client", "p")
    ends = F.array("endpoint_a", "endpoint_z")
    keys = F.explode(F.flatten(F.array(
        F.array(F.struct(F.lit(0).alias("s"), without_suffix(F.col("command")).alias("k"))), F.array(F.struct(F.lit(1).alias("s"), contract_base(F.col("contract")).alias("k"))),
        F.transform(ends, lambda e: F.struct(F.lit(2).alias("s"), F.trim(F.coalesce(e, F.lit(""))).alias("k"))),
    ))).alias("x")
    keyed = members.select("service_id", "client", keys).select("service_id", "client", "x.s", "x.k").where("k <> ''").distinct()
    keyed = keyed.join(kind, ["service_id", "client"])
    # Per key the principal services, summed up: how many, and the first.
    held = keyed.where("p").groupBy("client", "s", "k").agg(F.count_distinct("service_id").alias("n"), F.min("service_id").alias("principal_service_id"))
    found = keyed.where("not p").join(held, ["client", "s", "k"]).where("s = 2 or n = 1")
    first = best_per_key(found, ["service_id"], [F.col("s"), F.when(F.col("s") == 2, F.col("principal_service_id")), F.col("k")])
    names = F.element_at(F.array(F.lit("command_base"), F.lit("contract_file"), F.lit("endpoint_overlap")), F.col("s") + 1)
    return first.select(F.col("service_id").alias("maintenance_service_id"), "principal_service_id", names.alias("strategy"), F.col("k").alias("match_detail"))


def merge_maintenance(services: DataFrame, links: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Services without those merged, line counts added to the ones they go to, and the moved links."""
    moved = matches.select(F.col("maintenance_service_id").alias("service_id"), "principal_service_id")
    new_links = links.join(moved, "service_id", "left").select(
        F.coalesce("principal_service_id", "service_id").alias("service_id"), "lea_line_id", "role_ligne",
        F.when(F.col("principal_service_id").isNotNull(), 0).otherwise(F.col("is_principal")).alias("is_principal"),
    )
    counts = new_links.groupBy("service_id").agg(F.count("*").alias("line_count"))
    return services.drop("line_count").join(moved, "service_id", "left_anti").join(counts, "service_id"), new_links


def with_lines(services: DataFrame, links: DataFrame, lines: DataFrame, how: str = "left") -> DataFrame:
    """services with the contract lines of each: `left` keeps services without lines, `inner` drops them.
    Columns that both have are the service's; a line's are called line_ there."""
    clash = {c: f"line_{c}" for c in lines.columns if c in services.columns and c != "lea_line_id"}
    own = links.select("service_id", "lea_line_id").join(lines.withColumnsRenamed(clash), "lea_line_id")
    return services.join(own, "service_id", how)
