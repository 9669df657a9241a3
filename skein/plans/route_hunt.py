"""Routes that may carry a service: seven sources for all services at once, direct or context.

A route is told once per service, with the first source that names it and all others in order. A
source's budget holds per service or per part it looks for; rows beyond it are left out by id. Rows of
a site are cut to the budget before services meet them, which loses none that a service would keep.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.functions.scores import coherence_band
from skein.functions.text import ascii_upper, first_filled, is_blank
from skein.operators.matching import exploded, pair_key
from skein.operators.ranking import best_per_key, stored
from skein.operators.substrings import contained
from skein.plans.candidates import PROOF_LEVELS
from skein.plans.hunts import NO_SITE, client_tokens

# Sources in order; words that name no stop (the first of NO_SITE); rows that count of each
# source; words that are looked up.
SOURCES = ["ref_exploit_exact", "toip_lease", "lease_endpoint", "lease_site_pair_view", "site_z_lease_presence", "lease_comment_token_match", "parcours_site_pair", "parcours_site_z", "housing_site_z"]
NO_STOP = NO_SITE[:15]
BUDGETS = {"ref_exploit_exact": 5, "toip_lease": 5, "lease_endpoint": 10, "lease_site_pair_view": 10, "site_z_lease_presence": 20, "lease_comment_token_match": 12, "stops_a": 20, "stops_z": 10, "housing": 10, "housing_token": 5}
WORDS = {"client": 5, "stop": 3, "housing": 2}


def stop_words(name: Column) -> Column:
    """Words of four letters or digits or more of a name, as they stand, that may name a stop."""
    return F.filter(F.split(F.upper(F.coalesce(name, F.lit(""))), "[^A-Z0-9]+"), lambda t: (F.length(t) >= 4) & ~t.isin(NO_STOP))


def _row(df: DataFrame, source: str, direct: bool | None, level: str | Column | None, *facts: Column, hit: Column | None = None) -> DataFrame:
    """df's service_id, candidate, route_ref and lease_id as one source tells them. hit (at, pattern, apart): one
    word that names the candidate; such rows are judged together once all of a candidate are known."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    rank = F.array_position(F.array(*map(F.lit, PROOF_LEVELS)), lit(level)).cast("int").alias("rank")
    none = F.lit(None).cast("struct<at:int,pattern:string,apart:boolean>")
    told = F.array_compact(F.array(*facts)) if facts else F.array().cast("array<string>")
    return df.select("service_id", "candidate", "route_ref", "lease_id", F.lit(source).alias("source"), lit(direct).cast("boolean").alias("direct"), rank, told.alias("facts"), (none if hit is None else hit).alias("hit"))


def _pieces(asked: DataFrame, texts: DataFrame, budget: int, rows: DataFrame | None = None) -> DataFrame:
    """asked (service_id, pattern, ...) with the ids of the first texts (text_id, text) that hold the
    pattern, and of rows what they have of that text_id: it is fetched before services meet it."""
    held = contained(asked.select("pattern"), texts, [], budget)
    return asked.join(held if rows is None else held.join(rows, "text_id"), "pattern")


def by_reference(services: DataFrame, signals: DataFrame, leases: DataFrame) -> list[DataFrame]:
    """Leases of the service's own reference, and those whose reference holds one of its routes."""
    own = services.select("service_id", F.trim("principal_external_ref").alias("ref_exploit")).where("ref_exploit <> ''")
    # Of a reference no service keeps more than the first.
    exact = best_per_key(leases.where("route_ref is not null"), ["ref_exploit"], [F.col("lease_id")], BUDGETS["ref_exploit_exact"])
    exact = best_per_key(own.join(exact, "ref_exploit"), ["service_id"], [F.col("lease_id")], BUDGETS["ref_exploit_exact"])
    refs = exploded(signals, "route_refs", "pattern").select("service_id", ascii_upper(F.trim("pattern")).alias("pattern")).distinct()
    told = leases.where("route_ref is not null").withColumn("text_id", F.col("lease_id"))
    held = _pieces(refs, told.select("text_id", ascii_upper(F.col("ref_exploit")).alias("text")), BUDGETS["toip_lease"], told)
    return [_row(exact, "ref_exploit_exact", True, "strong", F.concat(F.lit("external:"), "ref_exploit")), _row(held, "toip_lease", True, "strong", F.concat(F.lit("route_ref:"), "pattern"))]


def by_ends(services: DataFrame, leases: DataFrame, lease_ends: DataFrame) -> list[DataFrame]:
    """Leases that end at the service's sites, those that join both, and those at site Z. They are looked up
    once for all services of the same two sites."""
    ends = lease_ends.where("site_id is not null").select(F.col("optical_lease_id").alias("lease_id"), "endpoint_label", "site_id")
    held = ends.select("lease_id", "site_id").distinct().join(leases, "lease_id")
    order = [F.asc_nulls_first("ref_exploit"), F.col("lease_id")]
    top = lambda n: best_per_key(held, ["site_id"], order, n)
    pair_of = services.select("service_id", F.struct("site_a_id", "site_z_id").alias("both_ids"))
    kinds = pair_of.select("both_ids").distinct().select("both_ids", "both_ids.*")
    sites = kinds.select("*", F.explode(F.array_distinct(F.array_compact(F.array("site_a_id", "site_z_id")))).alias("site_id"))
    met = sites.join(top(BUDGETS["lease_endpoint"]), "site_id")
    both = F.coalesce(F.bool_or(F.col("site_id") == F.col("site_a_id")), F.lit(False)) & F.coalesce(F.bool_or(F.col("site_id") == F.col("site_z_id")), F.lit(False))
    met = met.groupBy("both_ids", "lease_id", "candidate", "route_ref", "ref_exploit").agg(both.alias("both"), F.array_join(F.array_sort(F.collect_set("site_id")), ",").alias("sites"))
    met = best_per_key(met, ["both_ids"], order, BUDGETS["lease_endpoint"]).where("route_ref is not null")
    a_end, z_end = (ends.where(F.col("endpoint_label") == e).select("lease_id", F.col("site_id").alias(f"end_{e}")) for e in "AZ")
    pairs = a_end.join(z_end, "lease_id").select("lease_id", pair_key(F.col("end_A"), F.col("end_Z")).alias("pair")).where("pair is not null").distinct()
    pairs = best_per_key(pairs.join(leases, "lease_id").where("route_ref is not null"), ["pair"], [F.col("lease_id")], BUDGETS["lease_site_pair_view"])
    joined = kinds.select("both_ids", pair_key(F.col("site_a_id"), F.col("site_z_id")).alias("pair")).where("pair is not null").join(pairs, "pair")
    at_z = kinds.select("both_ids", F.col("site_z_id").alias("site_id")).where("site_id is not null").join(top(BUDGETS["site_z_lease_presence"]), "site_id").where("route_ref is not null")
    site = lambda c: F.concat(F.lit("sites:"), c)
    found = [
        (met, "lease_endpoint", True, F.when(F.col("both"), "strong").otherwise("medium"), site("sites")),
        (joined, "lease_site_pair_view", True, "strong", site(F.concat_ws(",", "pair.low", "pair.high"))), (at_z, "site_z_lease_presence", False, "context_only", site("site_id")),
    ]
    rows = reduce(DataFrame.unionByName, (_row(df.withColumnRenamed("both_ids", "service_id"), *told) for df, *told in found)).withColumnRenamed("service_id", "both_ids")
    # A struct is never null, and nulls in it are equal.
    return [pair_of.join(rows, "both_ids").drop("both_ids")]


def by_words(services: DataFrame, leases: DataFrame, texts: DataFrame) -> DataFrame:
    """Leases whose texts (lease_id, text) hold words of the client or its sites, a row for each word."""
    words = client_tokens(*map(F.col, ("client_final", "principal_client", "site_a_name", "site_z_name", "endpoint_z_raw")))
    asked = services.select("service_id", F.posexplode(F.slice(words, 1, WORDS["client"])).alias("at", "pattern"))
    told = leases.select(F.col("lease_id").alias("text_id"), "lease_id", "candidate", "route_ref")
    met = _pieces(asked, texts.withColumnRenamed("lease_id", "text_id"), BUDGETS["lease_comment_token_match"], told)
    return _row(met, "lease_comment_token_match", None, None, hit=F.struct("at", "pattern", F.lit(False).alias("apart")))


def by_stops(services: DataFrame, stops: DataFrame) -> list[DataFrame]:
    """Routes with stops that words of end A and of end Z name, a row for each word; apart: the word is none
    of the other end's."""
    words = lambda e: stop_words(first_filled(F.col(f"site_{e}_name"), F.col(f"endpoint_{e}_raw")))
    known = services.select("service_id", words("a").alias("a"), words("z").alias("z"))
    texts = stops.where(~is_blank(F.col("route_ref"))).select(F.trim("route_ref").alias("text_id"), ascii_upper(F.col("site")).alias("text")).distinct()

    def named(own: str, other: str, source: str, budget: str) -> DataFrame:
        ask = known.select("service_id", F.col(other).alias("other"), F.posexplode(F.slice(own, 1, WORDS["stop"])).alias("at", "pattern"))
        met = _pieces(ask.select("service_id", "at", "pattern", (~F.array_contains("other", F.col("pattern"))).alias("apart")), texts, BUDGETS[budget])
        met = met.select("*", F.col("text_id").alias("candidate"), F.col("text_id").alias("route_ref"), F.lit(None).cast("string").alias("lease_id"))
        return _row(met, source, None, None, hit=F.struct("at", "pattern", "apart"))

    return [named("a", "z", "parcours_site_pair", "stops_a"), named("z", "a", "parcours_site_z", "stops_z")]


def _judged(rows: DataFrame) -> DataFrame:
    """One row per service, candidate and route_ref: m (what counts first: direct sources before context,
    then the order of sources decides), all (sources) and why (facts). Leases found by words are direct if two
    words of a route's leases are held, else context; routes found by stops if words of both ends name
    stops and tell the ends apart. Words of end A alone name no candidate."""
    step = lambda source: SOURCES.index(source) + 1
    steps = F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source")).cast("int")
    level = lambda name: F.lit(PROOF_LEVELS.index(name) + 1)
    said = lambda s, facts: F.transform(facts, lambda f: F.struct(s.alias("s"), f.alias("f")))
    one = lambda direct, s, lease, rank, by: F.struct((~direct).alias("c"), s.alias("s"), F.coalesce(lease, F.lit("")).alias("i"), rank.cast("int").alias("r"), by.alias("by"), lease.alias("lease"))
    plain, hit = F.col("hit").isNull(), F.col("hit")
    of = lambda source: (F.col("source") == source) & ~plain
    words, ends_a, ends_z = of("lease_comment_token_match"), of("parcours_site_pair"), of("parcours_site_z")
    once = rows.groupBy("service_id", "candidate", "route_ref").agg(
        F.min(F.when(plain, one(F.col("direct"), steps, F.col("lease_id"), F.col("rank"), F.col("source")))).alias("m0"),
        F.collect_set(F.when(plain, F.struct(steps.alias("s"), F.col("source").alias("by")))).alias("all0"), F.flatten(F.collect_set(F.when(plain, said(steps, F.col("facts"))))).alias("why0"),
        F.array_sort(F.collect_set(F.when(words, F.struct("hit.at", "hit.pattern")))).alias("words"), F.min(F.when(words, F.struct("hit.at", "lease_id")))["lease_id"].alias("word_lease"),
        F.array_sort(F.collect_set(F.when(ends_a, hit["pattern"]))).alias("by_a"), F.coalesce(F.bool_or(F.when(ends_a, hit["apart"])), F.lit(False)).alias("apart_a"), F.min(F.when(ends_z, hit)).alias("by_z"),
    )
    two, pair = F.size("words") >= 2, F.size("by_a") > 0
    apart = pair & (F.col("by_z.apart") | F.col("apart_a"))
    stop_step, stop_by = F.when(pair, step("parcours_site_pair")).otherwise(step("parcours_site_z")), F.when(pair, "parcours_site_pair").otherwise("parcours_site_z")
    word_step, word_by, none = F.lit(step("lease_comment_token_match")), F.lit("lease_comment_token_match"), F.lit(None).cast("string")
    judged = lambda direct: F.when(direct, level("medium")).otherwise(level("context_only"))
    by_word, by_stop = F.size("words") > 0, F.col("by_z").isNotNull()
    word = F.when(by_word, one(two, word_step, F.col("word_lease"), judged(two), word_by))
    stop = F.when(by_stop, one(apart, stop_step, none, judged(apart), stop_by))
    word_fact = F.array(F.concat(F.lit("words:"), F.array_join(F.transform("words", lambda w: w["pattern"]), " ")))
    stop_fact = F.array_compact(F.array(F.concat(F.lit("stop_z:"), "by_z.pattern"), F.when(pair, F.concat(F.lit("stop_a:"), F.array_join("by_a", " ")))))
    named = lambda test, s, by: F.when(test, F.struct(s.alias("s"), by.alias("by")))
    no_facts = F.array().cast("array<struct<s:int,f:string>>")
    told = lambda test, s, facts: F.when(test, said(s, facts)).otherwise(no_facts)
    return once.select(
        "service_id", "candidate", "route_ref", F.array_min(F.array_compact(F.array("m0", word, stop))).alias("m"),
        F.array_sort(F.concat("all0", F.array_compact(F.array(named(by_word, word_step, word_by), named(by_stop, stop_step, stop_by))))).alias("all"),
        F.array_sort(F.array_distinct(F.concat("why0", told(by_word, word_step, word_fact), told(by_stop, stop_step, stop_fact)))).alias("why"),
    ).where("m is not null")


def housing_chains(services: DataFrame, housings: DataFrame, connections: DataFrame, cables: DataFrame) -> DataFrame:
    """service_id, housing_id and cable_refs: housings at site Z, or where it has none those whose site is
    named by the words of end Z, and the cables connected to them."""
    named = housings.select(F.col("housing_id").cast("string").alias("housing_id"), "migration_oid", "site_id", "site_name")
    objects = [F.struct(F.col(f"obj{i}_type").alias("kind"), F.col(f"obj{i}_oid").alias("oid")) for i in (1, 2)]
    flat = connections.select(F.explode(F.array_distinct(F.array_compact(F.array("housing_oid", "obj1_oid", "obj2_oid")))).alias("migration_oid"), F.array(*objects).alias("os"))
    linked = flat.select("migration_oid", F.explode("os").alias("o")).where("upper(o.kind) like '%CABLE%' and o.oid is not null").select("migration_oid", F.col("o.oid").alias("cable_oid")).distinct()
    name = F.coalesce(*(F.when(~is_blank(F.col(c)), F.col(c)) for c in ("reference", "userreference")), F.col("cable_id").cast("string"))
    held = linked.join(cables.select("cable_oid", name.alias("ref")), "cable_oid").groupBy("migration_oid").agg(F.array_sort(F.collect_set("ref")).alias("cable_refs"))
    # Cables are joined with housings before services meet them.
    named = named.join(held, "migration_oid", "left").select("housing_id", "site_id", "site_name", F.coalesce("cable_refs", F.array().cast("array<string>")).alias("cable_refs"))
    here = best_per_key(named.where("site_id is not null"), ["site_id"], [F.col("housing_id")], BUDGETS["housing"])
    at_site = services.select("service_id", F.col("site_z_id").alias("site_id")).join(here, "site_id").select("service_id", "housing_id", "cable_refs")
    words = stop_words(first_filled(F.col("site_z_name"), F.col("endpoint_z_raw")))
    rest = services.join(here.select(F.col("site_id").alias("site_z_id")).distinct(), "site_z_id", "left_anti").select("service_id", F.explode(F.slice(words, 1, WORDS["housing"])).alias("pattern"))
    by_word = _pieces(rest, named.select(F.col("housing_id").alias("text_id"), ascii_upper(F.col("site_name")).alias("text")), BUDGETS["housing_token"], named.withColumn("text_id", F.col("housing_id")))
    return at_site.union(by_word.select("service_id", "housing_id", "cable_refs")).distinct()


def hunt(services: DataFrame, tables: dict[str, DataFrame], marks: DataFrame) -> DataFrame:
    """One row per service and candidate (a route, a lease without one, or a housing at site Z):
    evidence (direct if any source is), proof_level, source, sources, lease_id, facts, cable_refs,
    coherence with its band, and place: direct ones first, by proof and coherence.

    services: service_id, client_final, principal_client, principal_external_ref, endpoint_a_raw,
    endpoint_z_raw, site_a_id, site_a_name, site_z_id, site_z_name. tables: signals, leases, lease_ends,
    stops, housings, connections, cables. marks: coherence of (service_id, route_ref).
    """
    route = F.nullif(F.trim("ref_exploit"), F.lit(""))
    every = tables["leases"].withColumn("lease_id", F.col("optical_lease_id").cast("string"))
    leases = stored(every.select("lease_id", "ref_exploit", route.alias("route_ref"), F.coalesce(route, F.concat(F.lit("LEASE:"), "lease_id")).alias("candidate")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    texts = every.select("lease_id", ascii_upper(F.concat_ws(" ", *map(blank, ("ref_exploit", "reference", "client", "lessee", "comments")))).alias("text"))
    chains = housing_chains(services, tables["housings"], tables["connections"], tables["cables"])
    housed = chains.select("service_id", F.concat(F.lit("HOUSING:"), "housing_id").alias("candidate"), F.lit(None).cast("string").alias("route_ref"), F.lit(None).cast("string").alias("lease_id"), "cable_refs")
    parts = [*by_reference(services, tables["signals"], leases), *by_ends(services, leases, tables["lease_ends"]), by_words(services, leases, texts), *by_stops(services, tables["stops"])]
    parts.append(_row(housed, "housing_site_z", False, "context_only", F.concat(F.lit("cables:"), F.array_join("cable_refs", " "))))
    # The only time that services' rows move; all that follows finds them in place.
    once = _judged(reduce(DataFrame.unionByName, parts).repartition("service_id"))
    known = marks.where("route_ref is not null").groupBy("service_id").agg(F.collect_list(F.struct("route_ref", "coherence")).alias("marks"))
    mine = F.explode_outer(F.filter("marks", lambda x: x["route_ref"] == F.col("route_ref"))).alias("mark")
    out = once.join(known, "service_id", "left").select("service_id", "candidate", "route_ref", "m", "all", "why", mine).withColumn("coherence", F.coalesce("mark.coherence", F.lit(0)))
    # Among direct ones the proof counts first.
    order = [F.col("m.c"), F.when(~F.col("m.c"), F.col("m.r")), F.desc("coherence"), F.col("candidate")]
    return out.select(
        "service_id", "candidate", "route_ref", F.col("m.lease").alias("lease_id"), F.when(F.col("m.c"), "context").otherwise("direct").alias("evidence"),
        F.element_at(F.array(*map(F.lit, PROOF_LEVELS)), F.col("m.r").cast("int")).alias("proof_level"), F.col("m.by").alias("source"), F.transform("all", lambda x: x["by"]).alias("sources"),
        F.transform("why", lambda x: x["f"]).alias("facts"), "coherence", coherence_band(F.col("coherence")).alias("band"),
        F.row_number().over(Window.partitionBy("service_id").orderBy(*order)).alias("place"),
    )
