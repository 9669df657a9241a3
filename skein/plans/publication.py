"""One consolidated row per service, what remains to be reviewed, and the published table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.text import hash16, is_blank

# Natures, review types with severity and reason, gaps.
FIBRE = ["IRU FON", "Location FON"]
REVIEWS = {
    "missing_contract_party": ("high", "Contract party unresolved"),
    "missing_final_party": ("medium", "Final party unresolved"),
    "missing_site_z": ("medium", "Endpoint Z site unresolved"),
    "missing_network_support": ("high", "No reliable network support matched"),
    "missing_optical_support": ("high", "No reliable optical support matched"),
    "manual_review": ("medium", "Service requires analyst review"),
}


def evidence_stats(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("service_id").agg(F.count("*").alias("evidence_count"), F.count_if(F.col("score") >= 90).alias("strong_evidence_count"))


def gold(services: DataFrame, evidence: DataFrame) -> DataFrame:
    """services (service_id, nature_service, ...) with the best target of each kind of evidence
    (service_id, kind, target, score): contract_party, final_party, site_a, site_z, optical, network;
    ties: the least target. Confidence is medium if any score reaches 80, else low."""
    kinds = ["contract_party", "final_party", "site_a", "site_z", "optical", "network"]
    first = F.min(F.struct((-F.col("score")).alias("s"), F.col("target").alias("t"))).alias("b")
    known = evidence.where(F.col("kind").isin(kinds) & F.col("target").isNotNull())
    best = known.groupBy("service_id", "kind").agg(first).select("service_id", "kind", F.col("b.t").alias("target"), (-F.col("b.s")).alias("score"))
    wide = best.groupBy("service_id").pivot("kind", kinds).agg(F.first("target").alias("id"), F.first("score").alias("score"))
    out = services.join(wide, "service_id", "left").join(evidence_stats(evidence), "service_id", "left")
    scores = [F.coalesce(F.col(f"{k}_score"), F.lit(0)) for k in kinds]
    out = out.withColumns({f"{k}_score": s for k, s in zip(kinds, scores)} | {c: F.coalesce(c, F.lit(0)) for c in ("evidence_count", "strong_evidence_count")})
    band = F.when(F.greatest(*scores) >= 80, "medium").otherwise("low")
    return out.withColumn("match_state", F.lit("review_required")).withColumn("confidence_band", band)


def review_queue(golden: DataFrame) -> DataFrame:
    """One row per service and open question."""
    nature = F.col("nature_service")
    tests = {
        "missing_contract_party": F.col("contract_party_id").isNull(),
        "missing_final_party": F.col("final_party_id").isNull(),
        "missing_site_z": (F.col("site_z_score") < 60) & (nature != "Hebergement"),
        "missing_network_support": (F.col("network_score") < 72) & (nature == "Lan To Lan"),
        "missing_optical_support": (F.col("optical_score") < 80) & nature.isin(FIBRE),
        "manual_review": F.col("match_state") != "auto_valid",
    }
    open_ = F.array_compact(F.array(*(F.when(t, F.struct(F.lit(k).alias("review_type"), F.lit(REVIEWS[k][0]).alias("severity"), F.lit(REVIEWS[k][1]).alias("reason"))) for k, t in tests.items())))
    rows = golden.select("service_id", F.explode(open_).alias("r")).select("service_id", "r.*", F.lit("open").alias("current_state"))
    return rows.withColumn("review_id", F.concat(F.lit("RVW-"), hash16(F.col("service_id"), F.col("review_type"), F.col("reason"))))


def preferred(sources: dict[str, Column]) -> tuple[Column, Column]:
    """(value, source) of the first source that is not blank."""
    tests = [(~is_blank(c), c, n) for n, c in sources.items()]
    value = reduce(lambda out, t: out.when(t[0], t[1]), tests[1:], F.when(tests[0][0], tests[0][1]))
    source = reduce(lambda out, t: out.when(t[0], t[2]), tests[1:], F.when(tests[0][0], F.lit(tests[0][2])))
    return value, source


def gap_flags(tests: dict[str, Column]) -> Column:
    """Names of the gaps whose test holds, in order of their names."""
    return F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), F.lit(g)) for g, t in sorted(tests.items()))))


def critical_gaps(nature: Column, gaps: Column) -> Column:
    """Of all gaps those that matter for this nature: site Z not for hosting, network supports for Lan To
    Lan alone, optical ones for fibre services alone."""
    asked = {"missing_site_z": nature != "Hebergement", "missing_network_support": nature == "Lan To Lan", "missing_optical_support": nature.isin(*FIBRE, "FON")}
    always = ["missing_bss_link", "missing_final_party", "missing_site_a"]
    matter = F.concat(F.array(*map(F.lit, always)), *(F.when(F.coalesce(t, F.lit(False)), F.array(F.lit(g))).otherwise(F.array().cast("array<string>")) for g, t in asked.items()))
    return F.array_intersect(gaps, matter)


def publication_status(source: Column, critical: Column) -> Column:
    return (
        F.when(F.size(critical) > 0, "needs_review")
        .when(source == "agent_validated", "published_validated")
        .when(source.isin("gold_auto_valid", "gold_review_required"), "published_from_gold")
        .otherwise("published_with_gaps")
    )


def publish(services: DataFrame, golden: DataFrame, resolutions: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """The final table, one row per service: for each attribute what the newest resolution says, if it is
    validated, else the consolidated row. resolutions: one newest row per service, with status,
    final_party, site_a, site_z, optical, network and network_hint (a device that names no support).
    links: service_id of services with contract lines; by default all have some."""
    names = ["final_party", "site_a", "site_z", "optical", "network"]
    valid = resolutions.where("status = 'validated'").select("service_id", F.lit(True).alias("__ok"), *(F.col(c).alias(f"__{c}") for c in names), F.col("network_hint").alias("__hint"))
    gold_row = golden.select("service_id", F.col("match_state").alias("__state"), *(F.col(f"{c}_id").alias(f"__gold_{c}") for c in ["contract_party", *names]))
    out = services.join(valid, "service_id", "left").join(gold_row, "service_id", "left")
    for name in names:
        value, source = preferred({"agent": F.col(f"__{name}"), "gold": F.col(f"__gold_{name}")})
        out = out.withColumn(f"published_{name}", value).withColumn(f"{name}_source", F.coalesce(source, F.lit("missing")))
    unmapped = F.col("published_network").isNull() & ~is_blank(F.col("__hint"))
    out = out.withColumn("network_source", F.when(unmapped, "agent_hint_unmapped").otherwise(F.col("network_source"))).withColumn("published_contract_party", F.col("__gold_contract_party"))
    linked = F.lit(True)
    if links is not None:
        out = out.join(links.select("service_id", F.lit(True).alias("__linked")).distinct(), "service_id", "left")
        linked = F.coalesce("__linked", F.lit(False))
    lacks = lambda c: is_blank(F.col(f"published_{c}"))
    flags = gap_flags({
        "missing_final_party": lacks("final_party"), "missing_site_a": lacks("site_a"), "missing_site_z": lacks("site_z"), "missing_network_support": lacks("network"),
        "missing_optical_support": lacks("optical"), "missing_bss_link": ~linked, "agent_hint_unmapped": unmapped,
    })
    truth = (
        F.when(F.col("__ok"), "agent_validated").when(F.col("__state") == "auto_valid", "gold_auto_valid").when(F.col("__state").isNotNull(), "gold_review_required").otherwise("fallback_bss_only")
    )
    out = out.withColumn("gap_flags", flags).withColumn("critical_gaps", critical_gaps(F.col("nature_service"), F.col("gap_flags"))).withColumn("selected_truth_source", truth)
    out = out.withColumn("publication_status", publication_status(truth, F.col("critical_gaps")))
    return out.drop(*(c for c in out.columns if c.startswith("__")))


def spatial_best(*candidates: tuple[str, Column, Column]) -> Column:
    """struct(kind, id, meters) of the nearest of candidates (kind, id, meters)."""
    each = [F.struct(m.alias("meters"), F.lit(k).alias("kind"), i.alias("id")) for k, i, m in candidates]
    return F.array_min(F.filter(F.array(*each), lambda s: s["meters"].isNotNull()))


