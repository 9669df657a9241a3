"""The optical plant: sites of housings and of the ends of leases, logical routes and their stops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.references import fiber_count, route_refs
from skein.functions.text import hash16, is_blank, norm_text, place_tokens
from skein.operators.ranking import best_per_key, stored
from skein.plans.candidates import site_matches

# Rules and scores.
RELATION = ("gdb_relation", 100)
CABLE_HINT = ("fiber_cable_name_token", 90, 75, 24)
# One in HOT rows makes a label hot, and the rows of one go to as many as SALTS tasks.
HOT, SALTS = 1000, 64
STEPS = {"L1": (1, "origin"), "L2": (2, "destination")}


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


def site_links(relations: DataFrame, hubsites: DataFrame) -> DataFrame:
    """object_type, object_oid, site_id, site_name, rule_name and score of relations (object_type,
    object_oid, hubsite_oid) to hubsites (oid, site_id, site_name). An object related to several keeps
    them all."""
    known = relations.select("object_type", _text("object_oid").alias("object_oid"), _text("hubsite_oid").alias("oid")).where("object_oid <> '' and oid <> ''")
    rule, score = RELATION
    return known.join(hubsites.select(_text("oid").alias("oid"), "site_id", "site_name"), "oid").select("object_type", "object_oid", "site_id", "site_name", F.lit(rule).alias("rule_name"), F.lit(score).alias("score")).distinct()


def best_named(values: DataFrame, sites: DataFrame) -> DataFrame:
    """(id, site_id, score, rule_name) of values (id, texts: an array): the best site that any text
    names; of equals the first text's."""
    each = values.select("id", F.posexplode("texts").alias("at", "text")).where(~is_blank(F.col("text")))
    # Equal texts are matched once.
    asked = each.select("text").distinct()
    found = site_matches(asked.select(F.col("text").alias("value_id"), "text"), sites).withColumnRenamed("value_id", "text")
    return best_per_key(each.join(found, "text"), ["id"], [F.desc("score"), F.col("at")]).select("id", "site_id", "score", "rule_name")


def reached(parents: DataFrame, known: DataFrame) -> DataFrame:
    """node, site_id, steps and state of every child and parent of parents (child, parent): the site of
    the nearest node upwards, itself included, that known (node, site_id; one row a node) has, and how
    many steps up it is. state: `site`, `none` where the way ends without one, `cycle` where it turns in
    a circle.

    Pointers are doubled each round, so a chain of n nodes takes log2(n) rounds of one join, and only
    open nodes are joined. A way of n steps has ways of every length below n above it, so where a round
    settles no node no finite way is open, and what is left turns in circles. A child with several
    parents keeps the least.
    """
    up = parents.where("child is not null and parent is not null").groupBy("child").agg(F.min("parent").alias("parent"))
    nodes = up.select(F.col("child").alias("node")).union(parents.select("parent").where("parent is not null")).union(known.select("node")).distinct()
    state = nodes.join(up.withColumnRenamed("child", "node"), "node", "left").join(known, "node", "left")
    has = F.col("site_id").isNotNull()
    state = stored(state.select("node", "site_id", F.when(~has, F.col("parent")).alias("up"), F.when(has | F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("steps")))
    closed, open_ = state.where("up is null"), state.where("up is not null")
    left = open_.count()
    while left:
        above = closed.unionByName(open_).select(F.col("node").alias("up"), F.col("site_id").alias("s2"), F.col("up").alias("u2"), F.col("steps").alias("n2"))
        state = stored(open_.join(above, "up", "left").select("node", F.coalesce("site_id", "s2").alias("site_id"), F.col("u2").alias("up"), (F.col("steps") + F.coalesce("n2", F.lit(0))).alias("steps")))
        closed, open_, before = closed.unionByName(state.where("up is null")), state.where("up is not null"), left
        left = open_.count()
        if left == before:
            break
    state = closed.unionByName(open_)
    kind = F.when(has, "site").when(F.col("up").isNull(), "none").otherwise("cycle")
    return state.select("node", "site_id", F.when(has, F.col("steps")).alias("steps"), kind.alias("state"))


def housings(objects: DataFrame, parents: DataFrame, links: DataFrame, sites: DataFrame) -> DataFrame:
    """Housings (object_type, migration_oid, reference, userreference, description, comments, location)
    with housing_id, parent_oid, and site_id, rule_name and score: of a direct relation, else of the best
    name, else of the nearest parent that has a site (rule `parent`, no score)."""
    names = ["reference", "userreference", "description", "comments", "location"]
    own = objects.where(_text("migration_oid") != "").select("object_type", _text("migration_oid").alias("migration_oid"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names))
    layer = F.concat(F.lit("HSG-"), F.upper("object_type"), F.lit("-"))
    own = own.withColumn("housing_id", F.concat(layer, hash16(F.col("migration_oid"), F.col("reference"), F.col("userreference")))).dropDuplicates(["housing_id"])
    related = best_per_key(links.withColumnRenamed("object_oid", "migration_oid"), ["object_type", "migration_oid"], [F.desc("score"), F.col("site_id")])
    related = related.select("object_type", "migration_oid", F.struct("site_id", "rule_name", "score").alias("r"))
    named = best_named(own.select(F.col("housing_id").alias("id"), F.array(*names).alias("texts")), sites).select(F.col("id").alias("housing_id"), F.struct("site_id", "rule_name", "score").alias("n"))
    up = parents.select(_text("child").alias("child"), _text("parent").alias("parent")).where("child <> '' and parent <> ''")
    met = own.join(related, ["object_type", "migration_oid"], "left").join(named, "housing_id", "left").withColumn("m", F.coalesce("r", "n"))
    met = stored(met.drop("r", "n"))
    settled = met.where("m is not null").groupBy(F.col("migration_oid").alias("node")).agg(F.min("m.site_id").alias("site_id"))
    above = reached(up, settled).where("state = 'site' and steps > 0").select(F.col("node").alias("migration_oid"), F.col("site_id").alias("site_above"))
    first = up.groupBy(F.col("child").alias("migration_oid")).agg(F.min("parent").alias("parent_oid"))
    out = met.join(above, "migration_oid", "left").join(first, "migration_oid", "left")
    higher = F.col("m").isNull() & F.col("site_above").isNotNull()
    return out.select("housing_id", "object_type", "migration_oid", "parent_oid", *names, F.coalesce("m.site_id", "site_above").alias("site_id"), F.when(higher, "parent").otherwise(F.col("m.rule_name")).alias("rule_name"), F.col("m.score").alias("score"))


def end_sites(ends: DataFrame, links: DataFrame, sites: DataFrame) -> DataFrame:
    """Ends of leases (lease_id, endpoint_label, housing_type, housing_oid, object_type, object_oid,
    reference_label) with site_id, rule_name and score: of the object's relation, else of the
    housing's, else of the site that the label names."""
    one = best_per_key(links, ["object_type", "object_oid"], [F.desc("score"), F.col("site_id")])
    of = lambda kind: one.select(F.col("object_type").alias(f"{kind}_type"), F.col("object_oid").alias(f"{kind}_oid"), F.struct("site_id", "rule_name", "score").alias(f"by_{kind}"))
    clean = ends.withColumns({c: _text(c) for c in ("object_oid", "housing_oid")})
    out = clean.join(of("object"), ["object_type", "object_oid"], "left").join(of("housing"), ["housing_type", "housing_oid"], "left")
    # Rows without a label, which meet nothing, and rows of a label that many have are dealt out.
    blank = is_blank(F.col("reference_label"))
    asked = stored(clean.where(~blank).groupBy("reference_label").agg(F.count("*").alias("n")))
    named = site_matches(asked.select(F.col("reference_label").alias("value_id"), F.col("reference_label").alias("text")), sites)
    named = named.select(F.col("value_id").alias("reference_label"), F.struct("site_id", "rule_name", "score").alias("by_name"))
    total = asked.agg(F.sum("n")).first()[0] or 0
    # Fewer than HOT labels can be as frequent.
    hot = asked.where(F.col("n") * HOT > total).select("reference_label", F.lit(True).alias("__hot"))
    salt = F.when(blank | F.col("__hot"), F.pmod(F.xxhash64("lease_id", "object_oid", "housing_oid"), F.lit(SALTS))).otherwise(0).cast("int")
    salts = F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    each = named.join(F.broadcast(hot), "reference_label", "left").select(F.col("reference_label").alias("__label"), salts.alias("__salt"), "by_name")
    out = out.join(F.broadcast(hot), "reference_label", "left").withColumns({"__label": F.when(~blank, F.col("reference_label")), "__salt": salt})
    out = out.join(each, ["__label", "__salt"], "left").withColumn("m", F.coalesce("by_object", "by_housing", "by_name"))
    return out.select(*ends.columns, F.col("m.site_id").alias("site_id"), F.col("m.rule_name").alias("rule_name"), F.coalesce("m.score", F.lit(0)).alias("score"))


def logical_routes(leases: dict[str, DataFrame]) -> DataFrame:
    """Logical routes of leases by layer (source_oid, ordinal, ref_exploit, reference, path_id, pair_oid,
    network, client, lessee, status, comments): the reference in operation, or on other layers than
    the templates the first route that the reference or comments name. Leases with neither route nor
    reference have none."""
    parts = []
    for at, (layer, df) in enumerate(leases.items()):
        own = F.nullif(F.upper(_text("ref_exploit")), F.lit(""))
        inferred = F.get(route_refs(F.col("reference"), F.col("comments")), 0)
        ref = own if layer == "LEASE_TEMPLATE" else F.coalesce(own, inferred)
        parts.append(df.select("*", F.lit(layer).alias("source_layer"), F.lit(at).alias("layer_no"), ref.alias("route_ref"), F.nullif(_text("reference"), F.lit("")).alias("ref_text")))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).where("route_ref is not null or ref_text is not null")
    key = ("source_layer", "source_oid", "route_ref", "ref_text", "path_id", "pair_oid")
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    name = norm_text(F.coalesce("route_ref", "ref_text"))
    return rows.select(F.concat(F.lit("OROUTE-"), hash16(*blank)).alias("logical_route_id"), "route_ref", "source_layer", "layer_no", "source_oid", "ordinal", F.col("ref_text").alias("reference"), *("path_id", "pair_oid", "network", "client", "lessee", "status", "comments"), name.alias("normalized_ref"))


def ref_routes(routes: DataFrame) -> DataFrame:
    """One row per route_ref: its first logical route, by layer and order within."""
    order = [F.col("layer_no"), F.col("ordinal"), F.col("logical_route_id")]
    return best_per_key(routes.where("route_ref is not null"), ["route_ref"], order).select(F.col("logical_route_id").alias("route_id"), "route_ref", *("network", "client", "lessee", "status"))


def parcours(routes: DataFrame, ends: DataFrame, sites: DataFrame) -> DataFrame:
    """Stops of the routes of lease templates: route_ref, route_id, step_no, step_type and site (the name
    of the end's site, else its label). ends: end_sites() with lease_id, the template's source_oid."""
    step = F.create_map(*(F.lit(x) for k, v in STEPS.items() for x in (k, v[0])))
    kind = F.create_map(*(F.lit(x) for k, v in STEPS.items() for x in (k, v[1])))
    own = routes.where("source_layer = 'LEASE_TEMPLATE'").select(F.col("source_oid").cast("string").alias("lease_id"), "route_ref", F.col("logical_route_id").alias("route_id"))
    named = ends.withColumn("lease_id", F.col("lease_id").cast("string")).join(sites.select("site_id", "site_name"), "site_id", "left")
    return own.join(named, "lease_id").select("route_ref", "route_id", F.element_at(step, F.col("endpoint_label")).alias("step_no"), F.element_at(kind, F.col("endpoint_label")).alias("step_type"), F.coalesce("site_name", "reference_label", F.lit("")).alias("site"), "housing_type", "reference_label")


def cable_hints(cables: DataFrame) -> DataFrame:
    """cable_id, token, base_score and rule_name: words of a cable's texts that may name a place, which
    count more where the cable has few fibres."""
    rule, few, many, limit = CABLE_HINT
    fibres = fiber_count(*map(F.col, ("reference", "userreference", "comments", "labeltext")))
    tokens = place_tokens(F.concat_ws(" ", "reference", "userreference", "comments"))
    return cables.select("cable_id", F.explode(tokens).alias("token"), F.when(fibres <= limit, few).otherwise(many).alias("base_score"), F.lit(rule).alias("rule_name"))
