"""Queries of the published table by groups, and of all that is made of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.plans import final_table, reporting
from skein.registry import among, norm, query

_S = "CAST({} AS STRING)".format
#: table of the data model: table it is made of, its columns, by expressions that both engines read.
CORPUS = {
    "heads": ("orders", {"service_id": "o_orderkey", "nature_service": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Lan To Lan' WHEN '2-HIGH' THEN 'IRU FON' WHEN '5-LOW' THEN 'Hebergement' ELSE 'Location FON' END"}),
    "golden": ("orders", {
        "service_id": "o_orderkey", "match_state": "CASE WHEN o_totalprice > 400000 THEN 'auto_valid' ELSE 'review_required' END", "contract_party_id": f"'P' || {_S('o_custkey')}", "final_party_id": f"CASE WHEN o_totalprice > 100000 THEN 'P' || {_S('o_custkey % 700')} ELSE ' ' END",
        "site_a_id": f"CASE WHEN o_custkey % 4 > 0 THEN 'S' || {_S('o_custkey % 25')} END", "site_z_id": f"CASE WHEN o_orderkey % 3 > 0 THEN 'S' || {_S('o_orderkey % 25')} END",
    }),
    "optical": ("lineitem", {
        "service_id": "l_orderkey", "score": "CAST(l_quantity AS INT) * 2", "route_ref": f"CASE WHEN l_returnflag = 'R' THEN 'TOIP ' || {_S('l_partkey')} END", "route_id": f"CASE WHEN l_returnflag = 'R' AND l_suppkey % 2 = 0 THEN 'RT' || {_S('l_suppkey')} END",
        "lease_id": f"CASE WHEN l_returnflag = 'A' THEN 'LS' || {_S('l_partkey')} END", "fiber_lease_id": "CAST(NULL AS STRING)", "isp_lease_id": "CAST(NULL AS STRING)",
        "cable_id": f"CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'C' || {_S('l_suppkey')} END", "housing_id": f"CASE WHEN l_returnflag = 'N' THEN 'H' || {_S('l_partkey % 90')} END",
    }),
    "network": ("lineitem", {
        "service_id": "l_orderkey", "score": "CAST(round(l_tax * 1000) AS INT)", "interface_id": f"CASE WHEN l_linenumber = 1 THEN 'IF' || {_S('l_suppkey')} END", "network_interface_id": f"CASE WHEN l_linenumber IN (2, 3) THEN 'NI' || {_S('l_partkey')} END",
        "network_vlan_id": f"CASE WHEN l_linenumber = 4 THEN 'V' || {_S('l_partkey')} END", "cpe_id": f"CASE WHEN l_linenumber = 5 THEN 'CPE' || {_S('l_suppkey')} END", "config_id": "CAST(NULL AS STRING)",
    }),
    "resolved": ("orders", {
        "service_id": "o_orderkey", "status": "CASE o_orderstatus WHEN 'F' THEN 'validated' WHEN 'O' THEN 'needs_review' ELSE 'rejected' END", "party_final_id": f"CASE WHEN o_custkey % 3 = 0 THEN 'P' || {_S('o_custkey')} ELSE ' ' END",
        "resolved_site_a_id": f"CASE WHEN o_orderkey % 11 = 0 THEN 'S' || {_S('o_orderkey % 40')} END", "resolved_site_z_id": "CAST(NULL AS STRING)", "site_a": f"CASE o_orderkey % 3 WHEN 0 THEN 'nation ' || {_S('o_custkey % 30')} WHEN 1 THEN 'Asia' END", "site_z": f"'Nation-' || {_S('o_orderkey % 31')}",
        "route_ref": f"CASE WHEN o_orderkey % 5 = 0 THEN 'X' || {_S('o_custkey')} END", "route_id": "CAST(NULL AS STRING)", "lease_id": "CASE WHEN o_orderkey % 10 = 0 THEN '  ' END", "fiber_lease_id": "CAST(NULL AS STRING)", "isp_lease_id": "CAST(NULL AS STRING)",
        "cable_id": f"CASE WHEN o_orderkey % 7 = 0 THEN 'C' || {_S('o_custkey')} END", "housing_id": "CAST(NULL AS STRING)", "network_interface_id": "CAST(NULL AS STRING)", "network_vlan_id": f"CASE WHEN o_orderkey % 4 = 0 THEN 'V' || {_S('o_custkey')} END", "cpe_id": "CAST(NULL AS STRING)", "config_id": "CAST(NULL AS STRING)",
        "inferred_vlans": "CASE WHEN o_orderkey % 13 = 0 THEN '[12]' END", "optical_support_ref": f"CASE WHEN o_orderkey % 2 = 0 THEN 'H' || {_S('o_orderkey % 90')} ELSE 'RT' || {_S('o_orderkey % 100')} END", "network_support_id": f"CASE WHEN o_custkey % 2 = 0 THEN 'dev-' || {_S('o_custkey')} END",
    }),
    "parties": ("customer", {"party_id": f"'P' || {_S('c_custkey')}", "canonical_name": "c_name"}),
}


def frame(t, name: str):
    table, columns = CORPUS[name]
    return t(table).selectExpr(*(f"{e} AS {c}" for c, e in columns.items()))


def ctes(*names: str) -> str:
    return ", ".join(f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in CORPUS[n][1].items())} FROM {CORPUS[n][0]})" for n in names)


def _any(alias: str, fields: list[str]) -> str:
    return "(" + " OR ".join(f"trim(coalesce({alias}.{c}, '')) <> ''" for c in fields) + ")"


def _best(table: str, fields: list[str], where: str = "") -> str:
    return f"SELECT service_id, {', '.join(fields)} FROM {table} {where} QUALIFY row_number() OVER (PARTITION BY service_id ORDER BY score DESC, {', '.join(f'{c} NULLS LAST' for c in fields)}) = 1"


_O, _N, _AN = final_table.OPTICAL, final_table.NETWORK, final_table.AGENT_NETWORK
_SITES = "sites AS (SELECT 'S' || CAST(n_nationkey AS STRING) AS site_id, n_name AS site_name, n_name AS n1, r_name AS n2 FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _end(e: str) -> str:
    told, gold = f"nullif(trim(r.resolved_site_{e}_id), '')", f"nullif(trim(g.site_{e}_id), '')"
    return f"""coalesce({told}, u{e}.site_id, {gold}) AS published_site_{e}_id, CASE WHEN {told} IS NOT NULL OR u{e}.site_id IS NOT NULL THEN 'agent_validated' WHEN {gold} IS NOT NULL THEN 'gold' WHEN trim(coalesce(r.site_{e}, '')) <> '' THEN 'agent_hint_unmapped' ELSE 'missing' END AS site_{e}_source"""


FINAL_SQL = f"""WITH {ctes(*CORPUS)}, {_SITES},
u AS (SELECT n AS name, min(site_id) AS site_id FROM (SELECT site_id, unnest([{norm('n1')}, {norm('n2')}]) AS n FROM sites) WHERE n <> '' GROUP BY 1 HAVING count(DISTINCT site_id) = 1),
r AS (SELECT * FROM resolved WHERE status = 'validated'), go AS ({_best('optical', _O)}), gn AS ({_best('network', _N)}),
h AS ({_best('(SELECT o.* FROM optical o JOIN r ON r.service_id = o.service_id WHERE trim(r.optical_support_ref) IN (' + ', '.join(f'o.{c}' for c in _O) + '))', _O)}),
li AS (SELECT l_orderkey AS service_id, count(*) AS n FROM lineitem GROUP BY 1),
b AS (SELECT s.service_id, s.nature_service, g.match_state, g.contract_party_id, r.service_id IS NOT NULL AS ok, {_end('a')}, {_end('z')},
  coalesce(nullif(trim(r.party_final_id), ''), nullif(trim(g.final_party_id), '')) AS pf, CASE WHEN trim(r.party_final_id) <> '' THEN 'agent_validated' WHEN trim(g.final_party_id) <> '' THEN 'gold' ELSE 'missing' END AS final_party_source,
  {_any('r', _O)} AS oa, h.service_id IS NOT NULL AS oh, {_any('go', _O)} AS og, {_any('go', final_table.ROUTE)} AS ogr, {', '.join(f"CASE WHEN {_any('r', _O)} THEN r.{c} WHEN h.service_id IS NOT NULL THEN h.{c} ELSE go.{c} END AS {c}" for c in _O)},
  {_any('r', [*_AN, 'inferred_vlans'])} AS na, {_any('gn', _N)} AS ng, gn.interface_id AS interface_id, {', '.join(f"CASE WHEN {_any('r', [*_AN, 'inferred_vlans'])} THEN r.{c} ELSE gn.{c} END AS {c}" for c in _AN)}, r.network_support_id AS nh, li.n AS lines
  FROM heads s LEFT JOIN golden g USING (service_id) LEFT JOIN r USING (service_id) LEFT JOIN u ua ON ua.name = {norm('r.site_a')} LEFT JOIN u uz ON uz.name = {norm('r.site_z')} LEFT JOIN go ON go.service_id = s.service_id LEFT JOIN gn ON gn.service_id = s.service_id LEFT JOIN h ON h.service_id = s.service_id LEFT JOIN li ON li.service_id = s.service_id),
c AS (SELECT *, CASE WHEN oa OR oh THEN 'agent_validated' WHEN ok AND NOT og THEN 'agent_hint_unmapped' WHEN ogr THEN 'gold' ELSE 'missing' END AS optical_source, CASE WHEN na THEN 'agent_validated' WHEN nh IS NOT NULL AND NOT ng THEN 'agent_hint_unmapped' WHEN ng THEN 'gold' ELSE 'missing' END AS network_source FROM b),
f AS (SELECT *, list_filter([CASE WHEN 'agent_hint_unmapped' IN (site_a_source, site_z_source, optical_source, network_source) THEN 'agent_hint_unmapped' END, CASE WHEN lines IS NULL THEN 'missing_bss_link' END, CASE WHEN pf IS NULL THEN 'missing_final_party' END,
  CASE WHEN NOT {_any('c', final_table.ROUTE)} THEN 'missing_logical_route_ref' END, CASE WHEN NOT {_any('c', _N)} THEN 'missing_network_support' END, CASE WHEN NOT {_any('c', _O)} THEN 'missing_optical_support' END,
  CASE WHEN published_site_a_id IS NULL THEN 'missing_site_a' END, CASE WHEN published_site_z_id IS NULL THEN 'missing_site_z' END], lambda x: x IS NOT NULL) AS gaps FROM c),
k AS (SELECT *, list_filter(gaps, lambda x: x IN ('missing_bss_link', 'missing_final_party', 'missing_site_a') OR (x = 'missing_site_z' AND nature_service <> 'Hebergement') OR (x = 'missing_network_support' AND nature_service = 'Lan To Lan') OR (x = 'missing_optical_support' AND nature_service IN ('IRU FON', 'Location FON'))) AS crit FROM f)
SELECT k.service_id, nature_service, p.canonical_name AS published_contract_party_name, final_party_source, q.canonical_name AS published_final_party_name, site_a_source, published_site_a_id, coalesce(sa.site_name, published_site_a_id) AS published_site_a_name, site_z_source, coalesce(sz.site_name, published_site_z_id) AS published_site_z_name,
  optical_source, {', '.join(_O)}, network_source, {', '.join(_N)}, CASE WHEN trim(cable_id) <> '' THEN 'cable ' || cable_id WHEN trim(housing_id) <> '' THEN 'housing ' || housing_id WHEN coalesce(nullif(trim(route_id), ''), nullif(trim(route_ref), '')) IS NOT NULL THEN 'route ' || coalesce(nullif(trim(route_id), ''), route_ref) END AS spatial_best,
  array_to_string(gaps, ',') AS gap_flags, CASE WHEN ok THEN 'agent_validated' WHEN match_state = 'auto_valid' THEN 'gold_auto_valid' ELSE 'gold_review_required' END AS selected_truth_source,
  CASE WHEN len(crit) > 0 THEN 'needs_review' WHEN ok THEN 'published_validated' ELSE 'published_from_gold' END AS publication_status,
  array_to_string(list_filter([CASE WHEN final_party_source = 'agent_validated' THEN 'party from agent' END, CASE WHEN final_party_source = 'gold' AND ok THEN 'party from gold' END, {', '.join(f"CASE WHEN {c}_source = 'agent_validated' THEN '{c} from agent' END" for c in ('site_a', 'site_z', 'optical', 'network'))}], lambda x: x IS NOT NULL), ', ') AS notes
FROM k LEFT JOIN parties p ON p.party_id = contract_party_id LEFT JOIN parties q ON q.party_id = pf LEFT JOIN sites sa ON sa.site_id = published_site_a_id LEFT JOIN sites sz ON sz.site_id = published_site_z_id"""


def final_rows(t):
    """The published table of the test tables."""
    sites = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.expr("'S' || CAST(n_nationkey AS STRING)").alias("site_id"), F.col("n_name").alias("site_name"), F.array("n_name", "r_name").alias("names"))
    links = t("lineitem").groupBy(F.col("l_orderkey").alias("service_id")).agg(F.count("*").alias("line_ids"))
    return final_table.publish(*(frame(t, n) for n in ("heads", "golden", "optical", "network", "resolved")), sites, frame(t, "parties"), links)


@query(FINAL_SQL)
def final_published(t):
    out = final_rows(t)
    return out.select(
        "service_id", "nature_service", "published_contract_party_name", "final_party_source", "published_final_party_name", "site_a_source", "published_site_a_id", "published_site_a_name", "site_z_source", "published_site_z_name",
        "optical_source", *_O, "network_source", *_N, F.concat_ws(" ", "spatial_best_object_type", "spatial_best_object_id").alias("spatial_best"), F.array_join("gap_flags", ",").alias("gap_flags"), "selected_truth_source", "publication_status", F.array_join("notes", ", ").alias("notes"),
    ).withColumn("spatial_best", F.nullif("spatial_best", F.lit("")))


_FINAL = "f0 AS (" + FINAL_SQL + ")"
_EVIDENCE = "CASE l_returnflag WHEN 'A' THEN 'party' ELSE 'site' END"


def _count(section: str, name: str, what: str, table: str) -> str:
    return f"SELECT '{section}' AS section, '{name}' AS name, CAST({what} AS BIGINT) AS value FROM {table}"


def _with(*names: str) -> str:
    return "(WITH " + ctes(*names) + " FROM " + names[0] + ")"


_ANY = lambda fields: " OR ".join(f"{c} IS NOT NULL" for c in fields)
_OF = "count(DISTINCT service_id) FILTER ({})".format
REPORT_SQL = f"""WITH {_FINAL} """ + " UNION ALL ".join([
    _count("Scope", "Active lines loaded", "count(*)", "lineitem"), _count("Scope", "Active services built", "count(*)", "orders"), f"SELECT 'Service mix', nature_service, count(*) FROM {_with('heads')} GROUP BY 2",
    _count("Coverage", "Services with matched site", "count(DISTINCT o_orderkey) FILTER (o_custkey % 4 > 0)", "orders"),
    *(_count("Coverage", f"Services with matched {k}", _OF(_ANY(fs)), _with("optical")) for k, fs in reporting.OPTICAL.items()), _count("Coverage", "Services with network support", _OF(_ANY(reporting.NETWORK)), _with("network")),
    _count("Coverage", "Services with strong evidence", f"count(DISTINCT l_orderkey) FILTER (l_quantity * 2 >= {reporting.STRONG} AND {_EVIDENCE} <> 'party')", "lineitem"),
    _count("Coverage", "Services auto-validated", "count(*) FILTER (o_totalprice > 400000)", "orders"), _count("Coverage", "Services requiring review", "count(*) FILTER (NOT o_totalprice > 400000)", "orders"),
    _count("Coverage", "Open review items", "count(*) FILTER (event_type = 'error')", "events"), _count("Referential assets", "Parties", "count(*)", "customer"), _count("Referential assets", "Network devices", "count(*)", "supplier"), _count("Referential assets", "Network VLAN labels", "count(*)", "part"),
    _count("Final publication", "Published rows", "count(*)", "f0"), _count("Final publication", "Rows with final party", "count(published_final_party_name)", "f0"), _count("Final publication", "Rows with site A", "count(published_site_a_id)", "f0"), _count("Final publication", "Rows with site Z", "count(published_site_z_name)", "f0"),
    _count("Final publication", "Rows with network support", f"count(*) FILTER ({_ANY(reporting.NETWORK)})", "f0"), _count("Final publication", "Rows with optical support", f"count(*) FILTER ({_ANY(reporting.FINAL_OPTICAL)})", "f0"), _count("Final publication", "Rows with usable spatial evidence", "0", "(SELECT 1)"),
    "SELECT 'Final publication statuses', publication_status, count(*) FROM f0 GROUP BY 2", "SELECT 'Final truth sources', selected_truth_source, count(*) FROM f0 GROUP BY 2",
])


@query(REPORT_SQL)
def report_figures(t):
    final = final_rows(t).withColumnsRenamed({"published_site_a_id": "site_a_id", "published_site_z_id": "site_z_id", "published_final_party_name": "final_party_id"})
    tables = {
        "lines": t("lineitem"), "services": frame(t, "heads"), "optical": frame(t, "optical"), "network": frame(t, "network"), "gold": frame(t, "golden"), "final": final,
        "endpoints": t("orders").select(F.col("o_orderkey").alias("service_id"), F.expr("if(o_custkey % 4 > 0, o_custkey, null)").alias("matched_site_id")),
        "evidence": t("lineitem").select(F.col("l_orderkey").alias("service_id"), (F.col("l_quantity") * 2).alias("score"), F.expr(_EVIDENCE).alias("evidence_type")),
        "queue": t("events").select(F.expr("if(event_type = 'error', 'open', 'closed')").alias("current_state")), "parties": t("customer"), "devices": t("supplier"), "vlans": t("part"),
    }
    return reporting.figures(tables)


_VERSIONS = [2, 5, 9]
_LOG_COLUMNS = [
    "user_id AS service_id", "ts AS created_at", "event_id AS resolution_id", "CASE event_type WHEN 'view' THEN 'proposed' WHEN 'click' THEN 'validated' WHEN 'purchase' THEN 'needs_review' ELSE 'rejected' END AS status",
    "CASE WHEN value > 60 THEN 'high' WHEN value > 20 THEN 'medium' ELSE 'low' END AS confidence", "CASE WHEN value > 30 THEN 'P' ELSE ' ' END AS party_final_id", "CAST(event_id % 10 AS INT) AS version",
]
_LOG = "SELECT " + ", ".join(_LOG_COLUMNS)


@query(" UNION ALL ".join(f"""SELECT {v} AS version, (SELECT count(*) FROM customer) AS services_targeted, count(service_id) AS services_touched, {', '.join(f"count(*) FILTER (status = '{s}') AS services_{s}" for s in reporting.STATUSES)},
  {', '.join(f"count(*) FILTER (confidence = '{c}') AS confidence_{c}" for c in reporting.CONFIDENCES)}, (SELECT count(*) FROM customer) - count(*) FILTER (trim(party_final_id) <> '') AS party_final_gaps, count(*) FILTER (trim(party_final_id) <> '') / (SELECT count(*) FROM customer) * 100 AS party_final_coverage
  FROM (SELECT * FROM ({_LOG} FROM events) WHERE version <= {v} AND service_id IN (SELECT c_custkey FROM customer) QUALIFY row_number() OVER (PARTITION BY service_id ORDER BY created_at DESC, resolution_id DESC) = 1)""" for v in _VERSIONS))
def benchmark_metrics(t):
    log = t("events").selectExpr(*_LOG_COLUMNS)
    return reporting.benchmark(log, t("customer").select(F.col("c_custkey").alias("service_id")), _VERSIONS)
