"""Queries of the optical plant."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import geometry, references
from skein.functions.text import BUSINESS_STOPWORDS
from skein.plans import candidates, plant
from skein.registry import among, hash16, norm, query
from skein.sources import files

_S = "CAST({} AS STRING)".format
CORPUS = {
    "up": ("part", {"child": _S("p_partkey"), "parent": f"CASE WHEN p_size % 19 = 3 THEN {_S('p_partkey + 1 - 2 * (p_partkey % 2)')} WHEN p_size % 7 > 0 THEN {_S('CAST(floor(p_partkey / 3) AS BIGINT)')} END"}),
    "relations": ("part", {"object_type": "p_type", "object_oid": _S("p_partkey"), "hubsite_oid": f"CASE WHEN p_size % 11 = 0 THEN {_S('p_size % 30')} ELSE ' ' END"}),
    "objects": ("part", {"object_type": "p_type", "migration_oid": _S("p_partkey"), "reference": "CASE WHEN p_size % 13 = 0 THEN 'NATION ' || " + _S("p_size % 25") + " ELSE p_brand END", "userreference": "p_name", "description": "p_type", "comments": "CAST(NULL AS STRING)", "location": "p_brand"}),
    "hubsites": ("nation", {"oid": _S("n_nationkey"), "site_id": f"'S' || {_S('n_nationkey')}", "site_name": "n_name"}),
    "ends": ("lineitem", {
        "lease_id": f"{_S('l_orderkey')} || '-' || {_S('l_linenumber')} || '-' || {_S('l_suppkey')} || '-' || {_S('l_partkey')}", "endpoint_label": "CASE WHEN l_linenumber % 2 = 0 THEN 'L1' ELSE 'L2' END", "housing_type": "CASE l_returnflag WHEN 'A' THEN 'SMALL' WHEN 'N' THEN 'LARGE' END", "housing_oid": _S("l_suppkey"),
        "object_type": "CASE l_linestatus WHEN 'O' THEN 'ECONOMY' ELSE 'PROMO' END", "object_oid": f"' ' || {_S('l_partkey')}", "reference_label": f"CASE WHEN l_suppkey % 3 = 0 THEN 'nation-' || {_S('l_suppkey % 40')} END",
    }),
    "templates": ("orders", {"source_oid": _S("o_orderkey"), "ordinal": "o_orderkey", "ref_exploit": f"CASE WHEN o_custkey % 3 = 0 THEN ' toip ' || {_S('o_custkey')} END", "reference": "CASE WHEN o_custkey % 4 = 0 THEN o_orderpriority END", "network": "o_orderstatus", "client": _S("o_custkey")}),
    "fibers": ("lineitem", {"source_oid": f"{_S('l_orderkey')} || '-' || {_S('l_linenumber')} || '-' || {_S('l_suppkey')} || '-' || {_S('l_partkey')}", "ordinal": "l_orderkey * 1000 + l_linenumber", "ref_exploit": f"CASE WHEN l_suppkey % 2 = 0 THEN 'FREE ' || {_S('l_suppkey')} ELSE ' ' END", "reference": f"CASE WHEN l_linenumber = 1 THEN 'vers toip  ' || {_S('l_partkey')} || ' x' END", "network": "l_returnflag", "client": "l_linestatus"}),
    "cables": ("documents", {"cable_id": "doc_id", "reference": "split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2)", "userreference": "split_part(text, ' ', 3)", "comments": f"source || ' ' || {_S('doc_id % 300')} || ' FO'", "labeltext": "lang"}),
}


def frame(t, name: str):
    table, columns = CORPUS[name]
    return t(table).selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def ctes(*names: str) -> str:
    return ", ".join(f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in CORPUS[n][1].items())} FROM {CORPUS[n][0]})" for n in names)


def _sites(t):
    return t("nation").select(F.expr("'S' || CAST(n_nationkey AS STRING)").alias("site_id"), F.col("n_name").alias("site_name"), F.col("n_nationkey").alias("ordinal"), F.array("n_name").alias("names"))


#: Chains of the test tables halve at least with every step but one, so this many steps show a circle.
_FAR = 64
_REACHED = f"""w(start, node, n) AS (SELECT node, node, 0 FROM nodes UNION ALL SELECT start, parent, n + 1 FROM w JOIN up1 ON child = node LEFT JOIN known k ON k.node = w.node WHERE k.node IS NULL AND n < {_FAR}),
m AS (SELECT start, arg_min(k.site_id, n) AS site_id, min(CASE WHEN k.node IS NOT NULL THEN n END) AS steps, max(n) AS far FROM w LEFT JOIN known k ON k.node = w.node GROUP BY 1)"""


@query(f"""WITH RECURSIVE {ctes('up', 'relations', 'hubsites')}, up1 AS (SELECT child, min(parent) AS parent FROM up WHERE parent IS NOT NULL GROUP BY 1), known AS (SELECT object_oid AS node, min(site_id) AS site_id FROM relations JOIN hubsites ON oid = hubsite_oid GROUP BY 1),
nodes AS (SELECT child AS node FROM up1 UNION SELECT parent FROM up1 UNION SELECT node FROM known), {_REACHED}
SELECT start AS node, site_id, steps, CASE WHEN site_id IS NOT NULL THEN 'site' WHEN far >= {_FAR} THEN 'cycle' ELSE 'none' END AS state FROM m""")
def parent_sites(t):
    links = plant.site_links(frame(t, "relations"), frame(t, "hubsites"))
    return plant.reached(frame(t, "up"), links.groupBy(F.col("object_oid").alias("node")).agg(F.min("site_id").alias("site_id")))


@query(f"""WITH RECURSIVE {ctes('up', 'relations', 'hubsites', 'objects')}, links AS (SELECT object_type, object_oid, min(site_id) AS site_id FROM relations JOIN hubsites ON oid = hubsite_oid GROUP BY ALL),
v AS (SELECT migration_oid, object_type, i, [reference, userreference, description, '', location][i] AS x FROM objects, range(1, 6) r(i)),
nm AS (SELECT migration_oid, object_type, arg_min(site_id, i) AS site_id FROM v JOIN hubsites ON {norm('x')} = {norm('site_name')} AND {norm('x')} <> '' GROUP BY ALL),
o AS (SELECT o.migration_oid, o.object_type, coalesce(l.site_id, nm.site_id) AS site_id, CASE WHEN l.site_id IS NOT NULL THEN 'gdb_relation' WHEN nm.site_id IS NOT NULL THEN 'site_exact' END AS rule FROM objects o LEFT JOIN links l ON l.object_type = o.object_type AND l.object_oid = o.migration_oid LEFT JOIN nm ON nm.object_type = o.object_type AND nm.migration_oid = o.migration_oid),
up1 AS (SELECT child, min(parent) AS parent FROM up WHERE parent IS NOT NULL GROUP BY 1), known AS (SELECT migration_oid AS node, min(site_id) AS site_id FROM o WHERE site_id IS NOT NULL GROUP BY 1), nodes AS (SELECT child AS node FROM up1), {_REACHED}
SELECT o.migration_oid, parent AS parent_oid, coalesce(o.site_id, m.site_id) AS site_id, CASE WHEN o.site_id IS NULL AND m.site_id IS NOT NULL THEN 'parent' ELSE rule END AS rule_name, CASE WHEN o.site_id IS NOT NULL THEN 100 END AS score FROM o LEFT JOIN up1 ON child = o.migration_oid LEFT JOIN m ON m.start = o.migration_oid""")
def housing_sites(t):
    links = plant.site_links(frame(t, "relations"), frame(t, "hubsites"))
    return plant.housings(frame(t, "objects"), frame(t, "up"), links, _sites(t)).select("migration_oid", "parent_oid", "site_id", "rule_name", "score")


@query(f"""WITH {ctes('relations', 'hubsites', 'ends')}, links AS (SELECT object_type AS ty, object_oid AS oid, min(site_id) AS s FROM relations JOIN hubsites h ON h.oid = hubsite_oid GROUP BY ALL)
SELECT lease_id, endpoint_label, coalesce(a.s, b.s, h.site_id) AS site_id, CASE WHEN a.s IS NOT NULL OR b.s IS NOT NULL THEN 'gdb_relation' WHEN h.site_id IS NOT NULL THEN 'site_exact' END AS rule_name, CASE WHEN coalesce(a.s, b.s, h.site_id) IS NOT NULL THEN 100 ELSE 0 END AS score
FROM ends LEFT JOIN links a ON a.ty = object_type AND a.oid = trim(ends.object_oid) LEFT JOIN links b ON b.ty = housing_type AND b.oid = trim(housing_oid) LEFT JOIN hubsites h ON {norm('reference_label')} = {norm('h.site_name')}""")
def lease_end_sites(t):
    links = plant.site_links(frame(t, "relations"), frame(t, "hubsites"))
    return plant.end_sites(frame(t, "ends"), links, _sites(t)).select("lease_id", "endpoint_label", "site_id", "rule_name", "score")


_ROUTE_ID = hash16("CASE layer WHEN 0 THEN 'LEASE_TEMPLATE' ELSE 'Fiber_Lease' END", "source_oid", "route_ref", "reference", "''", "''")


def _leases(t):
    none = {c: F.lit(None).cast("string") for c in ("path_id", "pair_oid", "lessee", "status", "comments")}
    return {"LEASE_TEMPLATE": frame(t, "templates").withColumns(none), "Fiber_Lease": frame(t, "fibers").withColumns(none)}


@query(f"""WITH {ctes('templates', 'fibers')}, r AS (SELECT 0 AS layer, ordinal, source_oid, nullif(upper(trim(ref_exploit)), '') AS route_ref, nullif(trim(reference), '') AS reference, network, client FROM templates
  UNION ALL SELECT 1, ordinal, source_oid, coalesce(nullif(upper(trim(ref_exploit)), ''), nullif(upper(regexp_replace(regexp_extract(reference, '{references.ROUTE}', 1), '\\s+', ' ', 'g')), '')), nullif(trim(reference), ''), network, client FROM fibers),
h AS (SELECT *, 'OROUTE-' || {_ROUTE_ID} AS id FROM r WHERE route_ref IS NOT NULL OR reference IS NOT NULL)
SELECT id AS route_id, route_ref, network, client FROM h WHERE route_ref IS NOT NULL QUALIFY row_number() OVER (PARTITION BY route_ref ORDER BY layer, ordinal, id) = 1""")
def reference_routes(t):
    return plant.ref_routes(plant.logical_routes(_leases(t))).select("route_id", "route_ref", "network", "client")


@query(f"""WITH {ctes('hubsites', 'templates')}, e AS (SELECT o_orderkey, s FROM orders, (VALUES (1), (2)) v(s)),
r AS (SELECT source_oid, nullif(upper(trim(ref_exploit)), '') AS route_ref FROM templates WHERE trim(coalesce(ref_exploit, '')) <> '' OR trim(coalesce(reference, '')) <> ''),
x AS (SELECT r.route_ref, source_oid, s AS step_no, 'Nation ' || (o_orderkey * s % 31) AS label FROM r JOIN e ON source_oid = CAST(o_orderkey AS VARCHAR))
SELECT source_oid AS lease_id, route_ref, CAST(step_no AS INT) AS step_no, CASE step_no WHEN 1 THEN 'origin' ELSE 'destination' END AS step_type, coalesce(site_name, label) AS site FROM x LEFT JOIN hubsites ON {norm('label')} = {norm('site_name')}""")
def route_parcours(t):
    ends = t("orders").select(F.col("o_orderkey").cast("string").alias("lease_id"), F.explode(F.array(F.lit("L1"), F.lit("L2"))).alias("endpoint_label"), "o_orderkey")
    label = F.concat(F.lit("Nation "), (F.col("o_orderkey") * F.when(F.col("endpoint_label") == "L1", 1).otherwise(2) % 31).cast("string"))
    none = {c: F.lit(None).cast("string") for c in ("housing_type", "housing_oid", "object_type", "object_oid")}
    ends = ends.withColumns({"reference_label": label, **none}).drop("o_orderkey")
    links = plant.site_links(frame(t, "relations"), frame(t, "hubsites"))
    routes = plant.logical_routes(_leases(t))
    stops = plant.parcours(routes, plant.end_sites(ends, links, _sites(t)), _sites(t))
    own = routes.where("source_layer = 'LEASE_TEMPLATE'").select(F.col("logical_route_id").alias("route_id"), F.col("source_oid").alias("lease_id"))
    return stops.join(own, "route_id").select("lease_id", "route_ref", "step_no", "step_type", "site")


@query(f"""WITH {ctes('cables')}, k AS (SELECT cable_id, {norm("concat_ws(' ', reference, userreference, comments)")} AS n, TRY_CAST(nullif(regexp_extract(comments, '{references.FIBERS}', 1), '') AS INT) AS f FROM cables),
x AS (SELECT DISTINCT cable_id, f, unnest(list_filter(string_split(n, ' '), lambda x: length(x) >= 4 AND NOT regexp_matches(x, '^[0-9]+$') AND NOT ends_with(x, 'FO') AND x NOT IN ({among(BUSINESS_STOPWORDS)}))) AS token FROM k)
SELECT cable_id, token, CASE WHEN f <= 24 THEN 90 ELSE 75 END AS base_score FROM x""")
def cable_site_hints(t):
    return plant.cable_hints(frame(t, "cables")).select("cable_id", "token", "base_score")


# Sites and cables at the points of vectors; a third of the sites have housings with connections.
_AT = "CAST(embedding[{i}] AS DOUBLE) * 3000"
_GEO = """sites AS (SELECT vec_id AS site_id, {0} AS x, {1} AS y FROM embeddings WHERE vec_id % 2 = 0), chain AS (SELECT DISTINCT a.vec_id AS site_id, b.vec_id AS cable_id FROM embeddings a JOIN embeddings b ON a.vec_id % 6 = 0 AND b.vec_id % 2 = 1 AND b.vec_id // 12 = a.vec_id // 12 AND b.label % 3 = 0),
points AS (SELECT vec_id AS cable_id, unnest([{0}, {2}, {4}]) AS x, unnest([{1}, {3}, {5}]) AS y FROM embeddings WHERE vec_id % 2 = 1)""".format(*(_AT.format(i=i + 1) for i in range(6)))


@query(f"""WITH {_GEO}, near AS (SELECT s.site_id, cable_id, min(sqrt((s.x - p.x) * (s.x - p.x) + (s.y - p.y) * (s.y - p.y))) AS m FROM sites s JOIN points p ON abs(s.x - p.x) <= 300 AND abs(s.y - p.y) <= 300 WHERE s.site_id NOT IN (SELECT site_id FROM chain) GROUP BY ALL)
SELECT site_id, cable_id, 'connection' AS source, NULL AS meters FROM chain UNION ALL
(SELECT site_id, cable_id, 'nearby', round(m, 1) FROM near WHERE m <= 300 QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY m, cable_id) <= {candidates.NEAR_CABLES})""")
def passive_cables(t):
    at = lambda i: F.get("embedding", i).cast("double") * 3000
    v = t("embeddings")
    sites = v.where("vec_id % 2 = 0").select(F.col("vec_id").alias("site_id"), at(0).alias("geom_x"), at(1).alias("geom_y"))
    housings = v.where("vec_id % 6 = 0").select(F.col("vec_id").alias("site_id"), F.col("vec_id").alias("housing_id"), F.expr("vec_id div 12").alias("housing_oid"))
    ends = {f"geom_{e}_{c}": at(2 * i + j) for i, e in enumerate(("start", "end", "centroid")) for j, c in enumerate("xy")}
    cables = v.where("vec_id % 2 = 1").withColumns(ends).select(F.col("vec_id").alias("cable_id"), F.col("vec_id").alias("cable_oid"), *ends)
    linked = v.where("vec_id % 2 = 1 and label % 3 = 0")
    connections = linked.select(F.expr("vec_id div 12").alias("housing_oid"), F.lit("Fiber_Cable").alias("obj1_type"), F.col("vec_id").alias("obj1_oid"), F.lit("Rack").alias("obj2_type"), F.lit(None).cast("long").alias("obj2_oid"))
    return candidates.site_cables(sites, housings, connections, cables)


# The older projection over the points of vectors.
_G = geometry
_OLD = "SELECT vec_id, 600000 + CAST(embedding[{a}] AS DOUBLE) * 400000 AS x, 2200000 + CAST(embedding[{b}] AS DOUBLE) * 400000 AS y FROM embeddings"
_CLOSER = f"2 * atan(pow((1 + {_G._E!r} * sin({{p}})) / (1 - {_G._E!r} * sin({{p}})), {_G._E / 2!r}) * grown) - pi() / 2"
_BACK = f"atan2(gz + {_G._A80 * _G._E280!r} * sin({{p}}) / sqrt(1 - {_G._E280!r} * sin({{p}}) * sin({{p}})), flat)"
_STEPS = ", ".join(f"p{i + 1} AS (SELECT *, {_CLOSER.format(p=f'f{i}')} AS f{i + 1} FROM p{i})" for i in range(_G._ROUNDS))
_TURNS = ", ".join(f"b{i + 1} AS (SELECT *, {_BACK.format(p=f't{i}')} AS t{i + 1} FROM b{i})" for i in range(_G._ROUNDS))


@query(f"""WITH v AS ({_OLD.format(a=1, b=2)}), q AS (SELECT vec_id, atan2(x - {_G._X0}, {_G._R0 + _G._Y0!r} - y) / {_G._N!r} + {_G._PARIS!r} AS lam, pow({_G._C!r} / sqrt(pow(x - {_G._X0}, 2) + pow({_G._R0 + _G._Y0!r} - y, 2)), {1 / _G._N!r}) AS grown FROM v),
p0 AS (SELECT *, 2 * atan(grown) - pi() / 2 AS f0 FROM q), {_STEPS}, n AS (SELECT vec_id, lam, f{_G._ROUNDS} AS phi, {_G._A!r} / sqrt(1 - {_G._E2!r} * pow(sin(f{_G._ROUNDS}), 2)) AS n FROM p{_G._ROUNDS}),
g AS (SELECT vec_id, n * cos(phi) * cos(lam) - 168 AS gx, n * cos(phi) * sin(lam) - 60 AS gy, n * {1 - _G._E2!r} * sin(phi) + 320 AS gz FROM n), g1 AS (SELECT *, sqrt(gx * gx + gy * gy) AS flat FROM g),
b0 AS (SELECT *, atan2(gz, flat * {1 - _G._E280!r}) AS t0 FROM g1), {_TURNS} SELECT vec_id, round(degrees(atan2(gy, gx)), 7) AS lon, round(degrees(t{_G._ROUNDS}), 7) AS lat FROM b{_G._ROUNDS}""")
def old_projection(t):
    at = lambda i: F.get("embedding", i).cast("double") * 400000
    found = t("embeddings").select("vec_id", geometry.from_lambert2(at(0) + 600000, at(1) + 2200000).alias("d"))
    return found.select("vec_id", F.round("d.lon", 7).alias("lon"), F.round("d.lat", 7).alias("lat"))


# Inventories by the place of their columns.
_SHEET = "SELECT 'HOST ' || CAST(conv_id AS STRING) AS a, role || '/' || CAST(turn AS STRING) AS b, 'x' AS c, CASE WHEN turn % 2 = 0 THEN 'up' END AS d, role AS e, text || ' toip  ' || CAST(conv_id AS STRING) || ' OPE ' || CAST(turn AS STRING) || ' - l2l 7' AS f FROM conversations"


@query(f"""SELECT 'IF-' || {hash16('a', 'b')} AS interface_id, a AS hostname, b AS interface_name, coalesce(d, '') AS admin_status, e AS oper_status, '' AS speed, 'TOIP ' || substr(a, 6) AS route, 'OPE' || split_part(b, '/', 2) || '/L2L7' AS service FROM ({_SHEET})""")
def interface_inventory(t):
    raw = t("conversations").selectExpr("'HOST ' || CAST(conv_id AS STRING) AS a", "role || '/' || CAST(turn AS STRING) AS b", "'x' AS c", "CASE WHEN turn % 2 = 0 THEN 'up' END AS d", "role AS e", "text || ' toip  ' || CAST(conv_id AS STRING) || ' OPE ' || CAST(turn AS STRING) || ' - l2l 7' AS f")
    found = files.interface_inventory(raw)
    last = lambda c: F.element_at(c, -1)
    return found.select("interface_id", "hostname", "interface_name", "admin_status", "oper_status", "speed", last("route_refs").alias("route"), last("service_refs").alias("service"))


@query(f"""SELECT 'CPE-' || {hash16('s_name', 'CAST(s_suppkey AS VARCHAR)')} AS cpe_id, CAST(s_suppkey AS VARCHAR) AS first, s_name AS hostname, CAST(s_nationkey AS VARCHAR) AS field_3, {norm('s_name')} AS normalized_hostname FROM supplier""")
def cpe_inventory(t):
    raw = t("supplier").select("s_suppkey", F.lit(None).alias("b"), "s_name", "s_nationkey").union(t("region").select(F.col("r_regionkey").cast("long"), F.lit(None), F.lit(""), "r_regionkey"))
    return files.cpe_inventory(raw).select("cpe_id", "first", "hostname", "field_3", "normalized_hostname")
