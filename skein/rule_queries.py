"""Queries of the rules that link services, of the checks of resolutions and of their log."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import references
from skein.functions.text import BUSINESS_STOPWORDS, norm_text, place_tokens
from skein.operators import tables
from skein.plans import netconfig, reconcile, resolutions, services, signals, validation
from skein.registry import among, clean, hash16, norm, query

_S = "CAST({} AS STRING)".format
CORPUS = {
    "services": ("orders", {
        "service_id": f"'SV' || {_S('o_orderkey')}", "nature_service": "CASE o_orderstatus WHEN 'F' THEN 'Lan To Lan' WHEN 'O' THEN 'IRU FON' ELSE 'Hebergement' END", "principal_client": f"'customer ' || lpad({_S('o_custkey')}, 9, '0')",
        "client_final": f"CASE WHEN o_custkey % 5 > 0 THEN 'Supplier#' || lpad({_S('o_orderkey % 120')}, 9, '0') ELSE ' ' END", "endpoint_a_raw": f"'POP nation ' || {_S('o_custkey % 40')}", "endpoint_z_raw": f"o_orderpriority || ' NATION_' || {_S('o_orderkey % 40')} || ' site'",
        "principal_external_ref": "o_orderpriority",
    }),
    "ends": ("lineitem", {"service_id": f"'SV' || {_S('l_orderkey')}", "endpoint_label": "CASE WHEN l_linenumber % 2 = 0 THEN 'A' ELSE 'Z' END", "matched_site_id": f"CASE WHEN l_quantity < 40 THEN 'S' || {_S('l_suppkey')} END"}),
    "aliases": ("customer", {"party_id": f"'PC' || {_S('c_custkey')}", "alias_value": "c_name"}), "aliases2": ("supplier", {"party_id": f"'PS' || {_S('s_suppkey')}", "alias_value": "s_name"}),
    "leases": ("lineitem", {"lease_id": f"'L' || {_S('l_orderkey')} || '-' || {_S('l_linenumber')} || '-' || {_S('l_suppkey')} || '-' || {_S('l_partkey')}", "ref_exploit": f"' toip ' || {_S('l_partkey')}", "site_1": f"'S' || {_S('l_suppkey')}", "site_2": f"'S' || {_S('CAST(floor(l_partkey / 20) AS BIGINT)')}"}),
    "cables": ("part", {"cable_id": f"'C' || {_S('p_partkey')}", "reference": f"p_name || ' TOIP ' || {_S('p_partkey * 7 % 2000')}", "userreference": "p_type", "comments": f"'free ' || {_S('p_partkey')} || ' toip' || {_S('p_size')}", "number_of_fibers": "CASE WHEN p_size % 3 = 0 THEN CAST(NULL AS INT) ELSE p_size END"}),
    "housings": ("part", {"housing_id": f"'H' || {_S('p_partkey')}", "site_id": f"'S' || {_S('CAST(floor(p_partkey / 20) AS BIGINT)')}", "reference": f"p_type || ' free ' || {_S('p_partkey')}", "userreference": "p_brand", "description": "p_name", "comments": "CAST(NULL AS STRING)"}),
    "routed": ("orders", {"service_id": f"'SV' || {_S('o_orderkey')}", "ref": f"CASE WHEN o_orderkey % 4 = 0 THEN 'FREE ' || {_S('o_custkey')} ELSE 'TOIP ' || {_S('o_custkey')} END"}),
    "routes": ("part", {"logical_route_id": f"'R' || {_S('p_partkey')}", "route_ref": f"' toip ' || {_S('p_partkey % 500')}"}),
    "interfaces": ("part", {"network_interface_id": f"'I' || {_S('p_partkey')}", "ref": f"'TOIP ' || {_S('p_partkey')}", "service_ref": f"'OPE' || {_S('p_partkey')} || '/L2L1'", "description": "p_name || ' ' || p_brand"}),
    "devices": ("supplier", {"device_id": f"'D' || {_S('s_suppkey')}", "device_name": f"'com' || {_S('s_nationkey')} || '-sw-' || {_S('s_suppkey')}", "service_ref": f"'OPE' || {_S('s_suppkey')} || '/L2L1'", "client_hint": "s_name"}),
    "cpes": ("customer", {"cpe_id": f"'CPE' || {_S('c_custkey')}", "hostname": f"'com' || {_S('c_nationkey')} || ' SW ' || {_S('c_custkey')}", "ordinal": "CAST(c_custkey AS INT)"}),
    "log": ("events", {
        "resolution_id": _S("event_id"), "service_id": f"'SV' || {_S('user_id')}", "created_at": "ts", "status": "CASE event_type WHEN 'view' THEN 'proposed' WHEN 'click' THEN 'validated' ELSE 'rejected' END", "confidence": "CASE WHEN value > 50 THEN 'high' ELSE 'low' END",
        "party_final_id": f"CASE WHEN value > 30 THEN 'PS' || {_S('user_id % 120')} END", "resolved_site_a_id": f"'S' || {_S('event_id % 25')}", "resolved_site_z_id": f"'S' || {_S('user_id % 25')}",
    }),
}


def frame(t, name: str):
    table, columns = CORPUS[name]
    return t(table).selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def ctes(*names: str) -> str:
    return ", ".join(f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in CORPUS[n][1].items())} FROM {CORPUS[n][0]})" for n in names)


def _aliases(t):
    both = frame(t, "aliases").union(frame(t, "aliases2"))
    return both.withColumn("normalized_alias", norm_text(F.col("alias_value")))


def _empty(t, schema: str):
    return t("nation").sparkSession.createDataFrame([], schema)


_SEEDS = "service_id string, source_column string, signal_kind string, semantic_strength string, source_priority int, match_score int, pick int, x double, y double, reuse_score int, reuse_class string, reuse_count int"
_ALIASES = f"al AS (SELECT n, max(party_id) AS party_id FROM (SELECT party_id, {norm('alias_value')} AS n FROM (FROM aliases UNION ALL FROM aliases2)) GROUP BY 1)"


@query(f"""WITH {ctes('services', 'aliases', 'aliases2')}, {_ALIASES}, r AS (SELECT service_id, 'contract_party' AS role_name, principal_client AS label, 100 AS score FROM services
  UNION ALL SELECT service_id, 'final_party', CASE WHEN trim(client_final) <> '' THEN client_final ELSE endpoint_z_raw END, 95 FROM services)
SELECT service_id, role_name, coalesce(a.party_id, b.party_id) AS party_id, score FROM r LEFT JOIN al a ON a.n = {norm('label')} LEFT JOIN al b ON b.n = {clean('label')} WHERE coalesce(a.party_id, b.party_id) IS NOT NULL""")
def contract_parties(t):
    return reconcile.service_parties(frame(t, "services"), _aliases(t)).select("service_id", "role_name", "party_id", "score")


def _refs(text: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({text}, '{references.ROUTE}', 1), lambda x: upper(regexp_replace(x, '\\s+', ' ', 'g'))))"


@query(f"""WITH {ctes('routed', 'routes', 'leases', 'interfaces', 'cables', 'housings')}, rt AS (SELECT upper(trim(route_ref)) AS ref, min(logical_route_id) AS target FROM routes GROUP BY 1),
h AS (SELECT DISTINCT housing_id, unnest({_refs("reference || ' ' || userreference || ' ' || description")}) AS ref FROM housings), c AS (SELECT DISTINCT cable_id, number_of_fibers, unnest({_refs("reference || ' ' || userreference || ' ' || comments")}) AS ref FROM cables)
SELECT DISTINCT service_id, ref AS route_ref, 'route' AS kind, target, 'route_ref_exact' AS rule_name, CASE WHEN target IS NULL THEN 0 ELSE 100 END AS score FROM routed LEFT JOIN rt USING (ref)
UNION ALL SELECT DISTINCT service_id, ref, 'lease', lease_id, 'lease_ref_exact', 95 FROM routed JOIN leases ON upper(trim(ref_exploit)) = ref
UNION ALL SELECT DISTINCT service_id, r.ref, 'interface_route', network_interface_id, 'network_interface_route_ref_exact', 90 FROM routed r JOIN interfaces i ON r.ref = i.ref
UNION ALL SELECT DISTINCT service_id, ref, 'housing', housing_id, 'housing_route_ref_exact', 82 FROM routed JOIN h USING (ref)
UNION ALL SELECT DISTINCT service_id, ref, 'cable', cable_id, 'cable_route_ref_exact', CASE WHEN number_of_fibers <= 24 THEN 95 ELSE 88 END FROM routed JOIN c USING (ref)""")
def route_supports(t):
    services = frame(t, "routed").select("service_id", F.array("ref").alias("route_refs"))
    none = _empty(t, "lease_id string, ref_exploit string, device_id string, config_id string, route_refs array<string>")
    tables = {
        "routes": frame(t, "routes"), "leases": frame(t, "leases"), "fiber_leases": none, "isp_leases": none, "interfaces": frame(t, "interfaces").withColumn("route_refs", F.array("ref")), "devices": none, "configs": none,
        "housings": frame(t, "housings"), "cables": frame(t, "cables"),
    }
    return reconcile.route_supports(services, tables)


@query(f"""WITH {ctes('services', 'ends', 'leases')}, e AS (SELECT service_id, max(matched_site_id) FILTER (endpoint_label = 'A') AS a, max(matched_site_id) FILTER (endpoint_label = 'Z') AS z FROM ends GROUP BY 1)
SELECT service_id, lease_id, upper(trim(ref_exploit)) AS route_ref, 85 AS score FROM services JOIN e USING (service_id) JOIN (SELECT DISTINCT * FROM leases) ON (a = site_1 AND z = site_2) OR (a = site_2 AND z = site_1) WHERE CAST(substr(service_id, 3) AS INT) % 3 > 0""")
def lease_pairs(t):
    found = frame(t, "services").where("cast(substr(service_id, 3) as int) % 3 = 0").select("service_id", F.lit("route").alias("kind"), F.lit(100).alias("score"))
    leases = frame(t, "leases").distinct()
    sites_of = leases.select("lease_id", F.col("site_1").alias("site_l1"), F.col("site_2").alias("site_l2"))
    return reconcile.pair_leases(frame(t, "services"), found, frame(t, "ends"), leases, sites_of).select("service_id", "lease_id", "route_ref", "score")


def _places(c: str) -> str:
    return f"list_filter(string_split({norm(c)}, ' '), lambda x: length(x) >= 4 AND NOT regexp_matches(x, '^[0-9]+$') AND NOT ends_with(x, 'FO') AND x NOT IN ({among(BUSINESS_STOPWORDS)}))"


@query(f"""WITH {ctes('ends', 'housings')}, a AS (SELECT DISTINCT service_id, matched_site_id AS site_id FROM ends WHERE matched_site_id IS NOT NULL) SELECT service_id, count(*) AS n, min(housing_id) AS low, max(housing_id) AS high, 78 AS score FROM a JOIN housings USING (site_id) GROUP BY 1""")
def site_housings(t):
    housings = frame(t, "housings").withColumns({c: F.lit(None).cast("double") for c in ("geom_x", "geom_y")})
    found = reconcile.site_housings(frame(t, "ends"), _empty(t, _SEEDS), housings)
    return found.groupBy("service_id").agg(F.count("*").alias("n"), F.min("housing_id").alias("low"), F.max("housing_id").alias("high"), F.max("score").alias("score"))


_WANT = "SELECT 'SV' || CAST(o_orderkey AS STRING) AS service_id, 'OPE' || CAST(o_custkey AS STRING) || '/L2L1' AS service_ref FROM orders"


@query(f"""WITH {ctes('interfaces', 'devices', 'cpes')}, w AS ({_WANT}), k AS (SELECT {norm('hostname')} AS host, arg_max(cpe_id, ordinal) AS cpe_id FROM cpes GROUP BY 1)
SELECT service_id, 'interface' AS kind, network_interface_id AS target, 95 AS score, NULL AS cpe_id, NULL AS cpe_score, description AS label FROM w JOIN interfaces USING (service_ref)
UNION ALL SELECT service_id, 'device', device_id, 90, k.cpe_id, CASE WHEN k.cpe_id IS NOT NULL THEN 90 END, client_hint FROM w JOIN devices USING (service_ref) LEFT JOIN k ON k.host = {norm('device_name')}""")
def service_ref_supports(t):
    wanted = t("orders").select(F.expr("'SV' || CAST(o_orderkey AS STRING)").alias("service_id"), F.array(F.expr("'OPE' || CAST(o_custkey AS STRING) || '/L2L1'")).alias("service_refs"))
    listed = lambda df: df.withColumns({"service_refs": F.array("service_ref"), "vlan_ids": F.array().cast("array<int>"), "vlans": F.array().cast("array<int>")}).drop("service_ref")
    none = _empty(t, "interface_id string, config_id string, hostname string, service_refs array<string>, vlans array<int>")
    tables = {"swag": none, "configs": none, "interfaces": listed(frame(t, "interfaces")), "devices": listed(frame(t, "devices")).withColumn("site_hint", F.lit(None).cast("string")), "cpes": frame(t, "cpes")}
    return reconcile.service_ref_supports(wanted, tables).select("service_id", "kind", "target", "score", "cpe_id", "cpe_score", "label")


_LABELS = "SELECT CAST(doc_id AS STRING) AS service_id, split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2) AS client_final, split_part(text, ' ', 3) || ' ' || split_part(text, ' ', 4) AS endpoint_z_raw, lang AS endpoint_a_raw FROM documents"
_VLANS = "SELECT CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS network_vlan_id, CAST(conv_id % 400 AS INT) AS vlan_id, split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3) AS label FROM conversations"
_LONG = "list_filter(string_split({x}, ' '), lambda x: length(x) >= 6)".format


def _l2l(t):
    s = t("documents").selectExpr("CAST(doc_id AS STRING) AS service_id", "split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2) AS client_final", "split_part(text, ' ', 3) || ' ' || split_part(text, ' ', 4) AS endpoint_z_raw", "lang AS endpoint_a_raw")
    v = t("conversations").selectExpr("CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS network_vlan_id", "CAST(conv_id % 400 AS INT) AS vlan_id", "split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3) AS label")
    return s.withColumn("nature_service", F.lit("Lan To Lan")), v


@query(f"""WITH s AS ({_LABELS}), v AS ({_VLANS}), t AS (SELECT DISTINCT service_id, unnest(list_concat({_LONG(x=clean(clean('client_final')))}, {_LONG(x=clean(clean('endpoint_z_raw')))})) AS token FROM s),
w AS (SELECT DISTINCT network_vlan_id, label, unnest(list_filter(string_split({norm('label')}, ' '), lambda x: x <> '')) AS token FROM v WHERE trim(label) <> ''),
h AS (SELECT token, count(*) AS n, count(DISTINCT {clean('label')}) AS names, min(network_vlan_id) AS target FROM w GROUP BY 1 HAVING count(*) <= 3),
f AS (SELECT service_id, token, n, names, target FROM t JOIN h USING (token) QUALIFY row_number() OVER (PARTITION BY service_id ORDER BY length(token) DESC, token) = 1)
SELECT service_id, target, CASE WHEN n = 1 THEN 68 ELSE 65 END AS score, token FROM f WHERE n = 1 OR names = 1""")
def vlan_fallbacks(t):
    services, vlans = _l2l(t)
    none = _empty(t, "service_id string, label string")
    return reconcile.vlan_fallback(services, none, none.select("service_id"), vlans)


_TEXTS = "SELECT CAST(doc_id AS STRING) AS service_id, " + " || ' ' || ".join(f"split_part(text, ' ', {i})" for i in range(1, 11)) + " AS client_final, lang AS endpoint_z_raw, source AS endpoint_a_raw FROM documents"
_HOSTS = "SELECT CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS cpe_id, text AS hostname, CAST(conv_id % 400 AS INT) AS ordinal FROM conversations"


@query(f"""WITH s AS ({_TEXTS}), v AS ({_HOSTS}), a AS (SELECT service_id, list_distinct(list_filter(string_split({norm("CASE WHEN trim(client_final) <> '' THEN client_final ELSE endpoint_z_raw END")}, ' '), lambda x: length(x) >= 5)) AS ts FROM s),
c AS (SELECT cpe_id, ordinal, string_split({norm('hostname')}, ' ') AS th FROM v), p AS (SELECT service_id, cpe_id, ordinal, len(list_intersect(ts, th)) AS n FROM a JOIN c ON len(list_intersect(ts, th)) >= 2)
SELECT service_id, cpe_id AS target, CAST(least(85, 20 * n) AS INT) AS score FROM p QUALIFY row_number() OVER (PARTITION BY service_id ORDER BY least(85, 20 * n) DESC, ordinal, cpe_id) <= 5""")
def cpe_overlaps(t):
    services = t("documents").selectExpr(*_columns(_TEXTS)).withColumn("nature_service", F.lit("Lan To Lan"))
    return reconcile.cpe_overlap(services, _empty(t, "service_id string"), t("conversations").selectExpr(*_columns(_HOSTS)))


@query(f"""WITH d AS ({_LABELS}), v AS ({_VLANS}), s AS (SELECT DISTINCT service_id, unnest(list_concat({_places('client_final')}, {_places('endpoint_z_raw')})) AS token FROM d), c AS (SELECT DISTINCT network_vlan_id AS cable_id, vlan_id AS f, unnest({_places('label')}) AS token FROM v),
m AS (SELECT service_id, cable_id, f, count(*) AS n FROM s JOIN c USING (token) GROUP BY ALL)
SELECT service_id, cable_id, n AS overlap, CAST(CASE WHEN f <= 24 THEN CASE WHEN n >= 2 THEN 96 ELSE 84 END WHEN n >= 2 THEN 92 ELSE 80 END AS INT) AS score FROM m""")
def cable_places(t):
    services, vlans = _l2l(t)
    services = services.withColumns({"endpoint_a_raw": F.lit(None).cast("string"), "principal_external_ref": F.lit(None).cast("string")})
    cables = vlans.select(F.col("network_vlan_id").alias("cable_id"), F.col("vlan_id").alias("number_of_fibers"), place_tokens(F.col("label")).alias("site_tokens"))
    cables = cables.withColumns({f"geom_{e}_{c}": F.lit(None).cast("double") for e in ("centroid", "start", "end") for c in "xy"})
    found = reconcile.place_cables(services, _empty(t, "service_id string, signal_kind string, site_tokens array<string>"), _empty(t, _SEEDS), cables)
    return found.select("service_id", "cable_id", "overlap", "score")


# Checks of resolutions.


def _nations(t):
    return t("nation").selectExpr("'COM' || CAST(n_nationkey AS STRING) AS site_id", "'POP ' || n_name || ' com' || CAST(n_nationkey * 2 AS STRING) AS reference")


_NATIONS = "SELECT 'COM' || CAST(n_nationkey AS STRING) AS site_id, 'POP ' || n_name || ' com' || CAST(n_nationkey * 2 AS STRING) AS reference FROM nation"


@query(f"""WITH s AS ({_NATIONS}), v AS (SELECT DISTINCT s_name || ' com' || s_nationkey AS value FROM supplier UNION SELECT DISTINCT 'pop nation ' || (c_custkey % 30) || ' COM' || (c_custkey % 30 * 2) FROM customer UNION SELECT 'COM' || r_regionkey FROM region),
x AS (SELECT value, min(site_id) AS site_id FROM v JOIN s ON value = site_id OR value = {norm('reference')} GROUP BY 1),
l AS (SELECT v.value, v.c, s.site_id, s.c AS r, len(list_intersect(list_filter(string_split(v.c, ' '), lambda x: length(x) >= 4), list_filter(string_split(s.c, ' '), lambda x: length(x) >= 4))) AS k
  FROM (SELECT value, {clean('value')} AS c FROM v WHERE value NOT IN (SELECT value FROM x)) v, (SELECT site_id, {clean('reference')} AS c FROM s) s WHERE v.c <> '' AND s.c <> ''),
b AS (SELECT value, site_id, CASE WHEN c = r THEN 96 WHEN (contains(c, r) OR contains(r, c)) AND k >= 2 THEN 90 WHEN k >= 3 THEN least(88, 18 * k + 20) WHEN k = 2 THEN 72 ELSE 0 END AS score FROM l),
f AS (SELECT * FROM b WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY value ORDER BY score DESC, site_id) = 1)
SELECT v.value, coalesce(x.site_id, f.site_id) AS site_id, CASE WHEN x.site_id IS NOT NULL THEN 100 ELSE coalesce(f.score, 0) END AS score, x.site_id IS NOT NULL OR coalesce(f.score, 0) >= {validation.SITE_LEAST} AS passed FROM v LEFT JOIN x USING (value) LEFT JOIN f USING (value)""".replace(among(BUSINESS_STOPWORDS), among(validation.STOPWORDS)))
def site_checks(t):
    values = t("supplier").selectExpr("s_name || ' com' || CAST(s_nationkey AS STRING) AS value").union(t("customer").selectExpr("'pop nation ' || CAST(c_custkey % 30 AS STRING) || ' COM' || CAST(c_custkey % 30 * 2 AS STRING)")).union(t("region").selectExpr("'COM' || CAST(r_regionkey AS STRING)"))
    return validation.site_checks(values, _nations(t))


@query(f"""WITH s AS ({_NATIONS}), r AS (SELECT o_orderkey AS resolution_id, CASE WHEN o_custkey % 3 = 0 THEN 'router' ELSE 'com' || (o_custkey % 60) || '-co-' || o_orderkey END AS device_name, 'COM' || (o_orderkey % 30) AS site_a, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE ' ' END AS site_z FROM orders),
h AS (SELECT pop, min(site_id) AS pop_site FROM (SELECT site_id, 'COM' || substr(n, 1, k) AS pop FROM (SELECT site_id, unnest([substr(site_id, 4), regexp_extract(reference, 'com([0-9]+)', 1)]) AS n FROM s), range(1, 5) t(k) WHERE k <= length(n)) GROUP BY 1),
p AS (SELECT *, upper(regexp_extract(device_name, '(?i)^([a-z]+\\d+)-', 1)) AS pop FROM r)
SELECT resolution_id, p.pop AS pop, CASE WHEN p.pop = '' OR pop_site IS NULL THEN 0 WHEN contains(lower(site_a), lower(p.pop)) OR site_a = pop_site OR (trim(site_z) <> '' AND (contains(lower(site_z), lower(p.pop)) OR site_z = pop_site)) THEN 85 ELSE 30 END AS score FROM p LEFT JOIN h ON h.pop = p.pop""")
def pop_checks(t):
    rows = t("orders").selectExpr("o_orderkey AS resolution_id", "CASE WHEN o_custkey % 3 = 0 THEN 'router' ELSE 'com' || CAST(o_custkey % 60 AS STRING) || '-co-' || CAST(o_orderkey AS STRING) END AS device_name", "'COM' || CAST(o_orderkey % 30 AS STRING) AS site_a", "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE ' ' END AS site_z")
    return validation.pop_checks(rows, _nations(t)).select("resolution_id", "pop", "score")


_STOPS = "SELECT 'RT' || CAST(l_suppkey AS STRING) AS route_id, 'site ' || CAST(l_partkey % 60 AS STRING) || ' ' || l_linestatus AS site, CASE l_linenumber WHEN 1 THEN 'depart' WHEN 2 THEN 'ARRIVEE' ELSE 'PASSAGE' END AS step_type FROM lineitem"
_ASKED = "SELECT o_orderkey AS resolution_id, CASE WHEN o_custkey % 4 = 0 THEN 'RT' || CAST(o_custkey % 120 AS STRING) ELSE 'TOIP ' || CAST(o_custkey % 120 AS STRING) END AS route_ref, 'Site ' || CAST(o_custkey % 60 AS STRING) || ' O' AS site_a, 'le site ' || CAST(o_orderkey % 90 AS STRING) || ' F nord' AS site_z FROM orders"


@query(f"""WITH st AS ({_STOPS}), q AS ({_ASKED}), rt AS (SELECT 'RT' || CAST(s_suppkey AS STRING) AS route_id, CASE WHEN s_suppkey % 2 = 0 THEN ' TOIP ' || s_suppkey ELSE 'vers toip  ' || s_suppkey || ' x' END AS route_ref FROM supplier),
n AS (SELECT route_id AS name, route_id FROM rt UNION SELECT trim(route_ref), route_id FROM rt UNION SELECT 'TOIP ' || regexp_extract(route_ref, '([0-9]+)', 1), route_id FROM rt), nm AS (SELECT name, min(route_id) AS route_id FROM n GROUP BY 1),
m AS (SELECT resolution_id, nm.route_id, site_a, site_z FROM q LEFT JOIN nm ON name = trim(route_ref)),
d AS (SELECT DISTINCT route_id, {norm('site')} AS stop, upper(step_type) IN ('DEPART', 'ARRIVEE') AS e FROM st),
x AS (SELECT resolution_id, coalesce(bool_or((contains({norm('site_a')}, stop) OR contains(stop, {norm('site_a')})) AND e), false) AS ta, bool_or(contains({norm('site_a')}, stop) OR contains(stop, {norm('site_a')})) AS pa, coalesce(bool_or((contains({norm('site_z')}, stop) OR contains(stop, {norm('site_z')})) AND e), false) AS tz, bool_or(contains({norm('site_z')}, stop) OR contains(stop, {norm('site_z')})) AS pz FROM m JOIN d USING (route_id) GROUP BY 1),
c AS (SELECT resolution_id, CAST(ta AS INT) + CAST(tz AS INT) AS t, CAST(pa AND NOT ta AS INT) + CAST(pz AND NOT tz AS INT) AS p FROM x)
SELECT resolution_id, m.route_id, CASE WHEN m.route_id IS NULL THEN 0 WHEN c.resolution_id IS NULL THEN 60 WHEN t = 2 THEN 97 WHEN t = 1 AND p = 1 THEN 78 WHEN t = 1 THEN 72 WHEN p = 2 THEN 60 WHEN p = 1 THEN 45 ELSE 20 END AS score FROM m LEFT JOIN c USING (resolution_id)""")
def route_checks(t):
    stops = t("lineitem").selectExpr(*_columns(_STOPS))
    routes = t("supplier").selectExpr("'RT' || CAST(s_suppkey AS STRING) AS route_id", "CASE WHEN s_suppkey % 2 = 0 THEN ' TOIP ' || CAST(s_suppkey AS STRING) ELSE 'vers toip  ' || CAST(s_suppkey AS STRING) || ' x' END AS route_ref")
    return validation.route_checks(t("orders").selectExpr(*_columns(_ASKED)), routes, stops).select("resolution_id", "route_id", "score")


def _columns(select: str) -> list[str]:
    """The expressions of `SELECT a AS x, b AS y FROM t`."""
    out, depth, quoted, last = [], 0, False, ""
    for c in select.removeprefix("SELECT ").rpartition(" FROM ")[0]:
        quoted ^= c == "'"
        depth += 0 if quoted else (c == "(") - (c == ")")
        if c == "," and not depth and not quoted:
            out.append(last.strip())
            last = ""
        else:
            last += c
    return [*out, last.strip()]


# The log of resolutions.


@query(f"""WITH {ctes('services', 'log')} SELECT resolution_id, service_id, status, nature_service, principal_client FROM log JOIN services USING (service_id) WHERE contains(lower(principal_client), 'customer') AND contains(lower(nature_service), 'lan') AND status = 'validated' ORDER BY created_at DESC, resolution_id DESC LIMIT {resolutions.LISTED}""")
def listed_resolutions(t):
    return resolutions.listed(frame(t, "log"), frame(t, "services"), "Customer", "LAN", "validated").select("resolution_id", "service_id", "status", "nature_service", "principal_client")


@query(f"""WITH {ctes('services', 'log')}, q AS (SELECT DISTINCT 'SV' || CAST(l_orderkey AS STRING) AS service_id, l_returnflag AS review_type FROM lineitem) SELECT nature_service, principal_client, review_type, count(*) AS cnt FROM q JOIN services USING (service_id) WHERE service_id NOT IN (SELECT service_id FROM log) GROUP BY ALL""")
def queue_left(t):
    queue = t("lineitem").select(F.expr("'SV' || CAST(l_orderkey AS STRING)").alias("service_id"), F.col("l_returnflag").alias("review_type"))
    return resolutions.queue_summary(queue, frame(t, "services"), frame(t, "log"))


_GAPS = "SELECT CASE WHEN user_id % 9 = 0 THEN ' ' ELSE 'SV' || CAST(user_id AS STRING) END AS service_id, CASE event_type WHEN 'click' THEN 'both' WHEN 'view' THEN ' route_ref' WHEN 'error' THEN 'odd' ELSE '' END AS missing_attribute, CASE WHEN event_id % 4 = 0 THEN 'label_absent' WHEN event_id % 4 = 1 THEN 'strange' ELSE ' ' END AS observed_gap_type, CAST(NULL AS STRING) AS next_best_hint, CASE WHEN value > 10 THEN 'because' ELSE ' ' END AS justification FROM events"


@query(f"""WITH {ctes('services')}, g AS ({_GAPS}) SELECT problem, count(*) AS n, count(DISTINCT service_id) AS services FROM (SELECT g.service_id, CASE WHEN trim(g.service_id) = '' THEN 'no service' WHEN trim(missing_attribute) = '' THEN 'no attribute' WHEN trim(justification) = '' THEN 'no justification'
  WHEN trim(missing_attribute) NOT IN ({among(resolutions.GAP_ATTRIBUTES)}) THEN 'unknown attribute' WHEN trim(observed_gap_type) <> '' AND trim(observed_gap_type) NOT IN ({among(resolutions.GAP_TYPES)}) THEN 'unknown kind of gap' WHEN s.service_id IS NULL THEN 'unknown service' ELSE 'none' END AS problem
  FROM g LEFT JOIN services s ON s.service_id = g.service_id) GROUP BY 1""")
def declared_gaps(t):
    declared = t("events").selectExpr(*_columns(_GAPS)).withColumn("searched_sources", F.array(F.lit("x")))
    told = resolutions.gaps(declared, frame(t, "services"), F.lit("2024-05-01 00:00:00").cast("timestamp"))
    return told.groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count("*").alias("n"), F.count_distinct("service_id").alias("services"))


_LATEST = "l AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY service_id ORDER BY created_at DESC, resolution_id DESC) = 1)"


@query(f"""WITH {ctes('services', 'log', 'ends', 'aliases', 'aliases2')}, {_LATEST}, {_ALIASES}, e AS (SELECT service_id, max(matched_site_id) FILTER (endpoint_label = 'A') AS a, max(matched_site_id) FILTER (endpoint_label = 'Z') AS z FROM ends GROUP BY 1),
f AS (SELECT service_id, coalesce(x.party_id, y.party_id) AS party_id FROM (SELECT service_id, CASE WHEN trim(client_final) <> '' THEN client_final ELSE endpoint_z_raw END AS label FROM services) LEFT JOIN al x ON x.n = {norm('label')} LEFT JOIN al y ON y.n = {clean('label')})
SELECT count(*) AS resolutions, count(*) FILTER (resolved_site_a_id = a) AS same_site_a, count(*) FILTER (resolved_site_z_id = z) AS same_site_z, count(*) FILTER (party_final_id = f.party_id) AS same_party FROM l LEFT JOIN e USING (service_id) LEFT JOIN f USING (service_id)""")
def rule_agreement(t):
    return resolutions.agreement(frame(t, "log"), frame(t, "ends"), reconcile.service_parties(frame(t, "services"), _aliases(t)))


@query(f"""WITH {ctes('services', 'log', 'aliases', 'aliases2')}, {_LATEST}, {_ALIASES}, f AS (SELECT service_id FROM (SELECT service_id, CASE WHEN trim(client_final) <> '' THEN client_final ELSE endpoint_z_raw END AS label FROM services) LEFT JOIN al x ON x.n = {norm('label')} LEFT JOIN al y ON y.n = {clean('label')} WHERE coalesce(x.party_id, y.party_id) IS NOT NULL),
r AS (SELECT service_id, status, list_filter([CASE WHEN service_id IN (SELECT service_id FROM f) THEN 'pipeline_final_party' END, CASE WHEN trim(client_final) <> '' THEN 'client_final_raw' END], lambda x: x IS NOT NULL) AS why FROM l JOIN services USING (service_id) WHERE party_final_id IS NULL)
SELECT service_id, status, CASE WHEN len(why) > 0 THEN array_to_string(why, ',') ELSE 'no_direct_candidate' END AS reasons FROM r""")
def party_gap_reasons(t):
    party = reconcile.service_parties(frame(t, "services"), _aliases(t))
    return resolutions.party_gaps(frame(t, "log"), frame(t, "services"), party, _aliases(t)).select("service_id", "status", F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH {ctes('log')}, {_LATEST}, v AS (SELECT CAST(l_orderkey AS STRING) AS resolution_id, l_returnflag AS evidence_type, CAST(l_quantity * 2 AS INT) AS score FROM lineitem)
SELECT evidence_type, count(*) AS n, count(DISTINCT service_id) AS services, count(*) FILTER (score >= 90) AS strong, round(avg(score), 1) AS mean_score FROM v JOIN l USING (resolution_id) GROUP BY 1""")
def evidence_mix(t):
    evidence = t("lineitem").select(F.col("l_orderkey").cast("string").alias("resolution_id"), F.lit("x").alias("service_id"), F.col("l_returnflag").alias("evidence_type"), (F.col("l_quantity") * 2).cast("int").alias("score"))
    return resolutions.evidence_coverage(evidence, frame(t, "log"))


@query(f"""WITH {ctes('log')}, {_LATEST} SELECT confidence, status, count(*) AS n FROM l GROUP BY ALL""")
def resolution_mix(t):
    return resolutions.coverage(frame(t, "log"))


# Addresses and configurations.

_ADDRESSES = "SELECT 'B' || CAST(c_custkey AS STRING) AS ban_id, CAST(c_custkey % 7 AS STRING) AS house_number, 'NATION ' || CAST(c_nationkey AS STRING) AS normalized_city, 'RUE ' || c_mktsegment AS normalized_street_name, 'RUE ' || c_mktsegment || ' NATION ' || CAST(c_nationkey AS STRING) AS normalized_label, CAST(c_custkey % 3 AS STRING) AS postcode, c_acctbal AS x_l93, c_acctbal * 2 AS y_l93, CAST(1 AS INT) AS reuse_count, 'precise' AS reuse_class, CAST(100 AS INT) AS reuse_score FROM customer"
_PARSED = "SELECT CASE o_orderkey % 4 WHEN 3 THEN '' ELSE 'RUE ' || CASE o_orderstatus WHEN 'F' THEN 'MACHINERY' WHEN 'O' THEN 'BUILDING' ELSE 'FURNITURE' END || ' NATION ' || CAST(o_custkey % 30 AS STRING) END AS normalized_value, CASE o_orderkey % 2 WHEN 0 THEN CASE o_orderstatus WHEN 'F' THEN 'rue Machinery' ELSE 'Rue building' END ELSE '' END AS street, 'Nation_' || CAST(o_custkey % 30 AS STRING) AS city, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey % 7 AS STRING) END AS house_number, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey % 4 AS STRING) END AS postcode FROM orders"


@query(f"""WITH h AS ({_ADDRESSES}), w AS (SELECT DISTINCT normalized_value AS v, house_number AS n, {norm('street')} AS s, {norm('city')} AS c, coalesce(postcode, '') AS p FROM ({_PARSED})),
m AS (SELECT w.*, h.*, 'ban_street_city' AS rule, CASE WHEN n IS NOT NULL AND house_number = n THEN 98 ELSE 90 END AS score FROM w JOIN h ON s <> '' AND c <> '' AND c = normalized_city AND s = normalized_street_name
  UNION ALL SELECT w.*, h.*, 'ban_full_label_exact', 94 FROM w JOIN h ON NOT (s <> '' AND c <> '') AND v <> '' AND v = normalized_label
  UNION ALL SELECT w.*, h.*, CASE WHEN p <> '' THEN 'ban_city_postcode_only' ELSE 'ban_city_only' END, CASE WHEN p <> '' THEN 45 ELSE 35 END FROM w JOIN h ON NOT (s <> '' AND c <> '') AND v = '' AND c = normalized_city AND (p = '' OR p = postcode))
SELECT v AS normalized_value, n AS house_number_hint, s AS street_key, c AS city_key, p AS postcode_key, ban_id, rule AS match_rule, score AS match_score, CASE WHEN score >= 80 THEN x_l93 END AS x FROM m QUALIFY row_number() OVER (PARTITION BY v, n, s, c, p ORDER BY score DESC, house_number, ban_id) = 1""")
def address_matches(t):
    found = signals.address_matches(t("orders").selectExpr(*_columns(_PARSED)), t("customer").selectExpr(*_columns(_ADDRESSES)))
    return found.select("normalized_value", "house_number_hint", "street_key", "city_key", "postcode_key", "ban_id", "match_rule", "match_score", "x")


# One file for each language of the pages; the numbers of a page's address stand in its blocks.
_TITLE = "trim(regexp_extract(html, '<title>([^<]*)</title>', 1))"
_N = "regexp_extract(url, '/([0-9]+)', 1)"


def _config_lines(t):
    text = F.concat_ws(
        "\n", F.expr("'interface GigabitEthernet0/0/' || page_id || '.' || (page_id % 900 + 100)"), F.expr(f"'  description Vers TOIP ' || {_N} || ' ' || {_TITLE}"), F.expr("' encapsulation dot1Q ' || (page_id % 900 + 101)"),
        F.expr(f"' xconnect 10.0.0.1 ' || {_N} || ' encapsulation mpls'"), F.expr("if(page_id % 2 = 0, '!', 'exit')"), F.expr("'vlan ' || (page_id % 4000)"), F.expr(f"' name ' || {_TITLE}"), F.lit("#"),
    )
    blocks = t("pages").select(F.expr("split_part(url, '/', 4)").alias("source_file"), "page_id", text.alias("x"))
    files = blocks.groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "x"))), lambda b: b["x"]), "\n").alias("payload"))
    return netconfig.lines(files)


@query(f"""SELECT 'GigabitEthernet0/0/' || page_id || '.' || (page_id % 900 + 100) AS interface_name, 'GigabitEthernet0/0/' || page_id AS parent_interface, CAST(page_id % 900 + 101 AS INT) AS vlan_id, {_N} AS xconnect_circuit_id, trim('Vers TOIP ' || {_N} || ' ' || {_TITLE}) AS description, 'TOIP ' || {_N} AS route FROM pages""")
def config_subinterfaces(t):
    found = netconfig.subinterfaces(_config_lines(t))
    return found.select("interface_name", "parent_interface", "vlan_id", "xconnect_circuit_id", "description", F.get("route_refs", 0).alias("route"))


@query(f"""SELECT 'GigabitEthernet0/0/' || page_id || '.' || (page_id % 900 + 100) AS interface_name, trim('Vers TOIP ' || {_N} || ' ' || {_TITLE}) AS description, {clean(f"'Vers TOIP ' || {_N} || ' ' || {_TITLE}")} AS normalized_label FROM pages""")
def config_interfaces(t):
    return netconfig.interfaces(_config_lines(t)).select("interface_name", "description", "normalized_label")


@query(f"""SELECT CAST(page_id % 4000 AS INT) AS vlan_id, {_TITLE} AS label FROM pages""")
def config_vlans(t):
    return netconfig.vlans(_config_lines(t)).select("vlan_id", "label")


# Views of the scorecard, versions of the log, names of files, tables.

_GOLD = "SELECT 'SV' || CAST(o_orderkey AS STRING) AS service_id, CASE WHEN o_totalprice > 400000 THEN 'auto_valid' ELSE 'review_required' END AS match_state, CASE WHEN o_totalprice > 300000 THEN 'medium' ELSE 'low' END AS confidence_band FROM orders"
_QUEUE = "SELECT 'SV' || CAST(l_orderkey AS STRING) AS service_id, l_returnflag AS review_type, l_linestatus AS severity, l_linestatus || CAST(l_linenumber AS STRING) AS reason FROM lineitem"


@query(f"""WITH {ctes('services', 'log')}, {_LATEST}, g AS ({_GOLD}) SELECT service_id, principal_client, nature_service, confidence_band, coalesce(l.confidence || '/' || l.status, '-') AS agent FROM g JOIN services USING (service_id) LEFT JOIN l USING (service_id) WHERE match_state = 'auto_valid'""")
def auto_valid_services(t):
    golden = t("orders").selectExpr(*_columns(_GOLD))
    return resolutions.focus_auto_valid(frame(t, "services"), golden, frame(t, "log")).select("service_id", "principal_client", "nature_service", "confidence_band", "agent")


@query(f"""WITH {ctes('services', 'log')} (SELECT 'unresolved' AS view, service_id FROM services WHERE service_id NOT IN (SELECT service_id FROM log) ORDER BY principal_client, nature_service, service_id LIMIT {resolutions.FOCUSED})
UNION ALL (SELECT 'client', service_id FROM services WHERE contains(lower(principal_client), '00012') ORDER BY service_id LIMIT {resolutions.FOCUSED}) UNION ALL (SELECT 'nature', service_id FROM services WHERE contains(lower(nature_service), 'lan') ORDER BY service_id LIMIT {resolutions.FOCUSED})""")
def focused_services(t):
    s = frame(t, "services")
    view = lambda name, df: df.select(F.lit(name).alias("view"), "service_id")
    return view("unresolved", resolutions.focus_unresolved(s, frame(t, "log"))).union(view("client", resolutions.focus(s, client="00012"))).union(view("nature", resolutions.focus(s, nature="LAN")))


@query(f"""WITH {ctes('log')}, n AS (SELECT resolution_id, CASE WHEN value > 70 THEN 'validated' ELSE 'rejected' END AS s FROM log JOIN events ON resolution_id = CAST(event_id AS VARCHAR) WHERE value > 40) SELECT status, count(*) AS n, count(DISTINCT service_id) AS services
FROM (SELECT service_id, status FROM log UNION ALL SELECT service_id, s FROM log JOIN n USING (resolution_id) WHERE status <> s) GROUP BY 1""")
def restated_log(t):
    statuses = t("events").where("value > 40").selectExpr("CAST(event_id AS STRING) AS resolution_id", "CASE WHEN value > 70 THEN 'validated' ELSE 'rejected' END AS status")
    out = resolutions.restated(frame(t, "log"), statuses, F.lit("2030-01-01 00:00:00").cast("timestamp"))
    return out.groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("service_id").alias("services"))


@query(f"""WITH {ctes('services')}, g AS ({_GOLD}), q AS ({_QUEUE}) SELECT service_id, match_state, confidence_band, nature_service, principal_client, review_type, severity, reason FROM g JOIN services USING (service_id) JOIN q USING (service_id)""")
def review_rows(t):
    return resolutions.review_rows(t("orders").selectExpr(*_columns(_GOLD)), frame(t, "services"), t("lineitem").selectExpr(*_columns(_QUEUE)))


@query("""SELECT c_custkey AS service_id, c_name AS client, o_orderkey AS lea_line_id, o_totalprice AS price FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def service_lines(t):
    heads = t("customer").select(F.col("c_custkey").alias("service_id"), F.col("c_name").alias("client"))
    links = t("orders").select(F.col("o_custkey").alias("service_id"), F.col("o_orderkey").alias("lea_line_id"))
    lines = t("orders").select(F.col("o_orderkey").alias("lea_line_id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("client"))
    return services.with_lines(heads, links, lines).select("service_id", "client", "lea_line_id", "price")


_FILE = "replace(url, '.example.', '-' || CASE page_id % 4 WHEN 0 THEN 'co-1.teloise.' WHEN 1 THEN 'rancidIP_sw-2.teloise.' WHEN 2 THEN 'x5328.' ELSE '' END)"
_NAME = "regexp_extract(f, '([^/]*)$', 1)"


@query(rf"""WITH p AS (SELECT page_id, replace({_FILE}, '/', '_') || '.txt' AS f FROM pages), n AS (SELECT page_id, lower(f) AS l, regexp_replace(f, '\.[^.]*$', '') AS s FROM p)
SELECT page_id, CASE WHEN contains(l, 'rad') THEN 'RAD' WHEN contains(l, 'co-') OR contains(l, 'sec-') OR contains(l, 'bas-') THEN 'Cisco' WHEN contains(l, 'sw-') OR contains(l, 'sws-') OR contains(l, '3328') OR contains(l, '5328') OR contains(l, '5624') THEN 'Huawei' ELSE 'unknown' END AS vendor,
  CASE WHEN regexp_extract(s, 'rancidIP_([^.]+)\.teloise', 1) <> '' THEN regexp_extract(s, 'rancidIP_([^.]+)\.teloise', 1) ELSE s END AS device FROM n""")
def file_names(t):
    name = F.expr(f"'configs/' || replace({_FILE}, '/', '_') || '.txt'")
    return t("pages").select("page_id", netconfig.vendor_of_name(name).alias("vendor"), netconfig.device_of_name(name).alias("device"))


_TABLES = {"nation": "n_nationkey int, n_name string, n_regionkey int", "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", "labels": "doc_id bigint, quality int, toxic int", "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint"}


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, '{c}' AS columns FROM {n}" for n, c in _TABLES.items()))
def schema_summary(t):
    return tables.schema_summary({n: t(n) for n in _TABLES})
