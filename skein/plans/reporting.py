"""The build's report, its exports, and what a run of resolutions came to at pinned versions of the log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.text import is_blank
from skein.operators.ranking import stored
from skein.sinks import write_export

# The least score of strong evidence, and the fields that make a support.
STRONG = 95
OPTICAL = {"route": ["route_id"], "lease": ["lease_id", "fiber_lease_id", "isp_lease_id"], "cable": ["cable_id"], "housing": ["housing_id"]}
NETWORK = ["interface_id", "network_interface_id", "network_vlan_id", "cpe_id", "config_id"]
FINAL_OPTICAL = ["route_ref", "route_id", "lease_id", "fiber_lease_id", "isp_lease_id", "cable_id", "housing_id"]
SECTIONS = ["Scope", "Coverage", "Service mix", "Referential assets", "Final publication", "Final publication statuses", "Final truth sources"]
#: Exports: columns (none: all) and the order of the rows; a minus is descending.
EXPORTS = {
    "service_master_active": (
        "service_id nature_service match_state confidence_band principal_client principal_offer principal_external_ref endpoint_a_raw endpoint_z_raw client_final contract_party_id final_party_id endpoint_a_site_id endpoint_z_site_id"
        " route_ref route_id lease_id fiber_lease_id isp_lease_id interface_id network_interface_id network_vlan_id cpe_id config_id inferred_vlans_json strong_evidence_count evidence_count".split(),
        ["nature_service", "principal_client", "service_id"],
    ),
    "service_facturable_final": ([], ["nature_service", "principal_client_raw", "service_id"]), "service_match_evidence": ([], ["service_id", "evidence_type", "-score"]),
    "service_review_queue": ([], ["-severity", "service_id", "review_type"]), "party_master": ([], ["canonical_name"]), "network_vlan_catalog": ([], ["device_name", "vlan_id"]),
}


def _any(fields: list[str], there: list[str]) -> Column:
    known = [F.col(c).isNotNull() for c in fields if c in there]
    return reduce(lambda a, b: a | b, known, F.lit(False))


def _rows(df: DataFrame, section: str, values: dict[str, Column]) -> DataFrame:
    """One aggregate over df as rows (section, name, value)."""
    one = df.agg(*(v.cast("long").alias(f"v{i}") for i, v in enumerate(values.values())))
    pairs = F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"v{i}").alias("value")) for i, n in enumerate(values)))
    return one.select(F.lit(section).alias("section"), F.explode(pairs).alias("p")).select("section", "p.name", "p.value")


def _services(df: DataFrame, section: str, tests: dict[str, Column]) -> DataFrame:
    """How many services have a row for which each test holds. A service's rows are summed up first, in
    every task, so no set of services is held and all tests share one pass."""
    per = df.groupBy("service_id").agg(*(F.bool_or(F.coalesce(t, F.lit(False))).alias(f"t{i}") for i, t in enumerate(tests.values())))
    return _rows(per.where("service_id is not null"), section, {n: F.count_if(f"t{i}") for i, n in enumerate(tests)})


def figures(tables: dict[str, DataFrame]) -> DataFrame:
    """section, name and value of the report's aggregates: one pass a table. tables: lines, services,
    optical, network, endpoints, evidence, gold, queue, parties, devices, vlans, final."""
    t, has = tables, {n: df.columns for n, df in tables.items()}
    every = F.count(F.lit(1))
    filled = lambda c: F.count_if(~is_blank(F.col(c))) if c in has["final"] else F.lit(0)
    near = F.count_if(F.col("spatial_confidence_band") != "none") if "spatial_confidence_band" in has["final"] else F.lit(0)
    published = {
        "Published rows": every, "Rows with final party": filled("final_party_id"), "Rows with site A": filled("site_a_id"), "Rows with site Z": filled("site_z_id"), "Rows with network support": F.count_if(_any(NETWORK, has["final"])),
        "Rows with optical support": F.count_if(_any(FINAL_OPTICAL, has["final"])), "Rows with usable spatial evidence": near,
    }
    # The published rows are costly to make, so they are counted once, by status and source.
    kinds = ["publication_status", "selected_truth_source"]
    per = stored(t["final"].groupBy(*kinds).agg(*(c.cast("long").alias(f"c{i}") for i, c in enumerate(published.values()))))
    parts = [
        _rows(t["lines"], "Scope", {"Active lines loaded": every}),
        _services(t["endpoints"], "Coverage", {"Services with matched site": F.col("matched_site_id").isNotNull()}),
        _services(t["optical"], "Coverage", {f"Services with matched {k}": _any(fs, has["optical"]) for k, fs in OPTICAL.items()}),
        _services(t["network"], "Coverage", {"Services with network support": _any(NETWORK, has["network"])}),
        _services(t["evidence"], "Coverage", {"Services with strong evidence": (F.col("score") >= STRONG) & (F.col("evidence_type") != "party")}),
        _rows(t["gold"], "Coverage", {"Services auto-validated": F.count_if(F.col("match_state") == "auto_valid"), "Services requiring review": F.count_if(F.col("match_state") == "review_required")}),
        _rows(t["queue"], "Coverage", {"Open review items": F.count_if(F.col("current_state") == "open")}),
        *(_rows(t[n], "Referential assets", {title: every}) for n, title in (("parties", "Parties"), ("devices", "Network devices"), ("vlans", "Network VLAN labels"))),
        _rows(per, "Final publication", {n: F.coalesce(F.sum(f"c{i}"), F.lit(0)) for i, n in enumerate(published)}),
    ]
    # The total and the natures are grouping sets of one pass, as are statuses and sources.
    mix = t["services"].rollup("nature_service").agg(every.alias("value"), F.grouping("nature_service").alias("g"))
    parts.append(mix.select(F.when(F.col("g") == 1, "Scope").otherwise("Service mix").alias("section"), F.when(F.col("g") == 1, "Active services built").otherwise(F.coalesce("nature_service", F.lit("unknown"))).alias("name"), "value"))
    sets = per.groupingSets([[c] for c in kinds], *kinds)
    sets = sets.agg(F.sum("c0").alias("value"), F.grouping("publication_status").alias("g"))
    parts.append(sets.select(F.when(F.col("g") == 1, "Final truth sources").otherwise("Final publication statuses").alias("section"), F.when(F.col("g") == 1, F.col("selected_truth_source")).otherwise(F.col("publication_status")).alias("name"), "value"))
    return reduce(DataFrame.unionByName, parts)


def markdown(rows: DataFrame) -> str:
    """The report of figures(), which are a few dozen rows; a section's in the order given, the mix by
    size."""
    found: dict[str, list] = {s: [] for s in SECTIONS}
    for r in rows.collect():
        found.setdefault(r.section, []).append(r)
    out = ["# Active service referential build"]
    for section, items in found.items():
        items = sorted(items, key=lambda r: (-r.value, r.name)) if section == "Service mix" else sorted(items, key=lambda r: str(r.name)) if section.startswith("Final ") and section != "Final publication" else items
        out += ["", f"## {section}", *(f"- {r.name}: {r.value}" for r in items)]
    return "\n".join(out)


def export(tables: dict[str, DataFrame], folder: str) -> None:
    """Writes each of EXPORTS that tables have, as ordered delimited files."""
    for name, (columns, order) in EXPORTS.items():
        if name in tables:
            df = tables[name].select(*columns) if columns else tables[name]
            write_export(df, f"{folder}/{name}", [F.desc(c[1:]) if c.startswith("-") else F.asc_nulls_first(c) for c in order])


# Versions of the log


def append_version(rows: DataFrame, folder: str, version: int) -> None:
    """Adds rows to the log as one version; a version is written once."""
    rows.write.mode("error").parquet(f"{folder}/version={version}")


def as_of(spark, folder: str, version: int) -> DataFrame:
    """The log as it was at a version; later ones are not read."""
    return spark.read.parquet(folder).where(F.col("version") <= version)


STATUSES = ["proposed", "validated", "needs_review", "rejected"]
CONFIDENCES = ["high", "medium", "low"]


def benchmark(log: DataFrame, targets: DataFrame, versions: list[int]) -> DataFrame:
    """What the newest resolutions of the targets (service_id) come to at each of versions: version,
    services_targeted, services_touched, counts by status and confidence, party_final_gaps and
    party_final_coverage in percent. log: service_id, created_at, resolution_id, status, confidence,
    party_final_id, version. All versions in one pass: a row counts for each from its own on, and the
    newest of a service is a max in every task."""
    wanted = targets.select("service_id").distinct()
    row = F.struct("status", "confidence", (~is_blank(F.col("party_final_id"))).alias("party"))
    known = log.join(wanted, "service_id", "left_semi").withColumn("at", F.explode(F.filter(F.array(*map(F.lit, sorted(versions))), lambda v: v >= F.col("version"))))
    newest = known.groupBy("at", "service_id").agg(F.max_by(row, F.struct("created_at", "resolution_id")).alias("r"))
    count = lambda field, values: {f"{'services' if field == 'status' else field}_{v}": F.count_if(F.col(f"r.{field}") == v) for v in values}
    counts = {"services_touched": F.count("*"), **count("status", STATUSES), **count("confidence", CONFIDENCES), "with_party": F.count_if("r.party")}
    per = newest.groupBy(F.col("at").alias("version")).agg(*(c.alias(n) for n, c in counts.items()))
    every = wanted.agg(F.count("*").alias("services_targeted")).withColumn("version", F.explode(F.array(*map(F.lit, sorted(set(versions))))))
    out = every.join(per, "version", "left").fillna(0)
    gaps = F.col("services_targeted") - F.col("with_party")
    share = F.when(F.col("services_targeted") > 0, F.col("with_party") / F.col("services_targeted") * 100).otherwise(0.0)
    return out.select("version", "services_targeted", *(n for n in counts if n != "with_party"), gaps.alias("party_final_gaps"), share.alias("party_final_coverage"))
