"""Queries over the test tables, one or more for each operator, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import address, references, scores, text
from skein.operators import matching, ranking, spatial, tables
from skein.plans import candidates, netconfig, publication, resolutions, services
from skein.registry import ORACLE_SQL, QUERIES, among as _in, clean as _clean, hash16 as _hash16, norm as _norm, query, tokens as _tokens


@query(f"SELECT doc_id, md5({_norm('text')}) AS digest, length({_norm('text')}) AS n FROM documents")
def norm_text_docs(t):
    n = text.norm_text(F.col("text"))
    return t("documents").select("doc_id", F.md5(n.cast("binary")).alias("digest"), F.length(n).cast("long").alias("n"))


@query(f"""SELECT doc_id, md5(array_to_string(list_sort(list_distinct(list_filter(string_split({_norm('text')}, ' '), lambda x:
  length(x) >= 4 AND NOT regexp_matches(x, '^[0-9]+$') AND NOT ends_with(x, 'FO') AND x NOT IN ({_in(text.BUSINESS_STOPWORDS)})))), ' ')) AS digest FROM documents""")
def place_tokens_docs(t):
    joined = F.array_join(F.array_sort(text.place_tokens(F.col("text"))), " ")
    return t("documents").select("doc_id", F.md5(joined.cast("binary")).alias("digest"))


_LABEL = "'CLIENT-LAN2LAN/OPE' || p_partkey || '-L2L' || p_size || ' - ' || p_name || '/511'"


@query(f"SELECT p_partkey, {_clean(_LABEL)} AS label, {_clean('p_brand')} AS brand FROM part")
def clean_label_parts(t):
    label = F.expr(_LABEL)
    return t("part").select("p_partkey", text.clean_label(label).alias("label"), text.clean_label(F.col("p_brand")).alias("brand"))


_REFS = "'Vers eq/TOIP ' || doc_id || ' et free ' || (doc_id % 97) || ', toip  ' || doc_id || ' sfrh' || doc_id || '; OPE' || doc_id || '_l2l ' || (doc_id % 7)"


@query(f"""SELECT doc_id,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({_REFS}, '{references.ROUTE}', 1), lambda x: upper(regexp_replace(x, '\\s+', ' ', 'g'))))), ',') AS routes,
  upper(regexp_replace(regexp_extract({_REFS}, '{references.SERVICE}', 1), '\\s+', '', 'g')) || '/' || upper(regexp_replace(regexp_extract({_REFS}, '{references.SERVICE}', 2), '\\s+', '', 'g')) AS services
  FROM documents""")
def references_docs(t):
    c = F.expr(_REFS)
    return t("documents").select("doc_id", F.array_join(F.array_sort(references.route_refs(c)), ",").alias("routes"), F.array_join(references.service_refs(c), ",").alias("services"))


@query("SELECT p_partkey, p_size AS fibers FROM part")
def fiber_count_parts(t):
    return t("part").select("p_partkey", references.fiber_count(F.col("p_name"), F.concat_ws(" ", "p_name", F.col("p_size"), F.lit("fo"), F.lit("288 FO"))).alias("fibers"))


_OFFERS = list(references.OFFERS)
_OFFER = "CASE " + " ".join(f"WHEN p_partkey % 20 = {i} THEN '{k}'" for i, k in enumerate(_OFFERS)) + " WHEN p_partkey % 20 = 15 THEN 'Maintenance ' || p_name WHEN p_partkey % 20 = 16 THEN 'extra-works' ELSE p_type END"


@query(f"SELECT nature, role, count(*) AS n FROM (SELECT CASE p_partkey % 20 " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(references.OFFERS.values()))
       + " WHEN 15 THEN 'IRU FON' WHEN 16 THEN 'Lan To Lan' ELSE 'A qualifier' END AS nature, CASE p_partkey % 20 " + " ".join(f"WHEN {i} THEN '{r}'" for i, (_, r) in enumerate(references.OFFERS.values()))
       + " WHEN 15 THEN 'maintenance' WHEN 16 THEN 'frais_acces' ELSE 'principal' END AS role FROM part) GROUP BY ALL")
def offer_classes(t):
    c = references.classify_offer(F.expr(_OFFER))
    return tables.mix(t("part").select(c["nature"].alias("nature"), c["role"].alias("role")), ["nature", "role"])


_K = {
    "client": "'Client ' || o_custkey", "nature": "o_orderstatus", "end_a": "o_orderpriority", "end_z": "CAST(NULL AS {s})", "final": "''",
    "contract": "CASE WHEN o_orderkey % 5 = 0 THEN 'c-' || o_custkey || '.pdf' ELSE ' ' END", "command": "'cmd ' || o_orderkey",
}


def _keys(kind: str) -> dict[str, str]:
    return {k: v.format(s=kind) for k, v in _K.items()}


_D = _keys("VARCHAR")


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'SVCREF|OPE' || o_custkey || '/L2L1|' || {_norm(_D['client'])} || '|' || o_orderstatus
  WHEN o_orderkey % 3 = 0 THEN 'ROUTE|TOIP ' || o_custkey || '|' || {_norm(_D['client'])} || '|' || o_orderstatus
  WHEN {_norm(_D['contract'])} <> '' THEN 'CONTRACT|' || {_hash16(_D['client'], _D['contract'], _D['nature'])}
  WHEN o_orderkey % 2 = 0 THEN 'AUX|' || {_hash16(*(_D[k] for k in ('client', 'nature', 'end_a', 'end_z', 'final')))}
  ELSE 'FALLBACK|' || {_hash16(*(_D[k] for k in ('client', 'nature', 'end_a', 'end_z', 'final', 'command')))} END AS grouping_key FROM orders""")
def grouping_keys(t):
    k = {n: F.expr(v) for n, v in _keys("STRING").items()}
    source = F.expr("concat(if(o_orderkey % 7 = 0, concat('ope ', o_custkey, '/l2l1 '), ''), if(o_orderkey % 3 = 0, concat('toip ', o_custkey), ''))")
    role = F.expr("if(o_orderkey % 2 = 0, 'annexe', 'principal')")
    key = references.grouping_key(k["client"], k["nature"], role, references.route_refs(source), references.service_refs(source), k["end_a"], k["end_z"], k["final"], k["contract"], k["command"])
    return t("orders").select("o_orderkey", key.alias("grouping_key"))


@query("""SELECT l_orderkey, (b).l_partkey AS l_partkey, (b).l_suppkey AS l_suppkey, line_count FROM (SELECT l_orderkey, count(*) AS line_count,
  arg_min({'l_partkey': l_partkey, 'l_suppkey': l_suppkey}, (CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END, l_linenumber, l_partkey, l_suppkey)) AS b FROM lineitem GROUP BY 1)""")
def service_rollup(t):
    lines = t("lineitem").withColumn("role", F.when(F.col("l_returnflag") == "N", "principal").otherwise("annexe"))
    return services.rollup(lines, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], "role", ["l_partkey", "l_suppkey"]).drop("first_order")


_NAMES = """SELECT c_name AS name, 'contractant' AS party_type FROM customer UNION ALL SELECT upper(c_name) || '!', 'client_final' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT s_name, 'network_vlan' FROM supplier UNION ALL SELECT lower(s_name), 'site_client_hint' FROM supplier UNION ALL SELECT n_name, 'unknown' FROM nation"""


@query(f"""WITH n AS (SELECT name, party_type, {_norm('name')} AS nn, CASE party_type WHEN 'contractant' THEN 0 WHEN 'client_final' THEN 1 WHEN 'site_client_hint' THEN 3 WHEN 'network_vlan' THEN 5 ELSE 99 END AS r FROM ({_NAMES}))
SELECT 'PTY-' || {_hash16('nn')} AS party_id, arg_min(name, (r, name)) AS canonical_name, nn AS normalized_name, arg_min(party_type, (r, name)) AS party_type,
  CASE arg_min(party_type, (r, name)) WHEN 'contractant' THEN 100 WHEN 'client_final' THEN 95 WHEN 'site_client_hint' THEN 75 WHEN 'network_vlan' THEN 70 ELSE 0 END AS source_priority,
  count(DISTINCT name) AS n_aliases FROM n WHERE nn <> '' GROUP BY nn""")
def party_clusters(t):
    of = lambda table, name, kind: t(table).select(F.expr(name).alias("name"), F.lit(kind).alias("party_type"))
    names = of("customer", "c_name", "contractant").union(t("customer").where("c_custkey % 3 = 0").select(F.expr("upper(c_name) || '!'"), F.lit("client_final")))
    names = names.union(of("supplier", "s_name", "network_vlan")).union(of("supplier", "lower(s_name)", "site_client_hint")).union(of("nation", "n_name", "unknown"))
    return tables.party_clusters(names)


@query("""SELECT o_orderkey, coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN a.c_custkey IS NOT NULL THEN 'exact' WHEN b.c_custkey IS NOT NULL THEN 'other' END AS matched_by
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS exact, o_custkey + 40 AS other FROM orders) o
  LEFT JOIN customer a ON o.exact = a.c_custkey LEFT JOIN customer b ON o.other = b.c_custkey""")
def alias_fallback(t):
    left = t("orders").select("o_orderkey", F.expr("if(o_orderkey % 2 = 0, o_custkey, null)").alias("exact"), (F.col("o_custkey") + 40).alias("other"))
    right = t("customer").select(F.col("c_custkey").alias("key"), "c_custkey")
    return matching.fallback_join(left, ["exact", "other"], right, "key", "c_custkey").select("o_orderkey", "c_custkey", "matched_by")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event(t):
    return ranking.latest_per_key(t("events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("SELECT l_partkey, l_orderkey, l_linenumber, l_discount FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount DESC, l_extendedprice, l_orderkey, l_linenumber, l_suppkey) AS r FROM lineitem) WHERE r <= 3")
def best_offers(t):
    order = [F.desc("l_discount"), F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return ranking.best_per_key(t("lineitem"), ["l_partkey"], order, 3).select("l_partkey", "l_orderkey", "l_linenumber", "l_discount")


@query("""WITH q AS (SELECT *, floor(value / 10) AS bucket, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 END AS c FROM events WHERE event_type IN ('purchase', 'click', 'error')),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS i FROM q),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, bucket ORDER BY c, i) AS k FROM r WHERE i <= CASE event_type WHEN 'purchase' THEN 3 ELSE 2 END)
SELECT user_id, event_id, event_type, CAST(row_number() OVER (PARTITION BY user_id ORDER BY c, i) AS INT) AS pick FROM o WHERE k = 1""")
def quota_events(t):
    e = t("events").withColumn("bucket", F.floor(F.col("value") / 10))
    return ranking.quota_top(e, ["user_id"], "event_type", {"purchase": 3, "click": 2, "error": 2}, [F.desc("value"), F.col("event_id")], ["bucket"]).select("user_id", "event_id", "event_type", "pick")


@query(f"SELECT min(doc_id) AS doc_id, source, md5({_norm('text')}) AS digest FROM documents GROUP BY 2, 3")
def first_seen_docs(t):
    d = t("documents").select("doc_id", "source", F.md5(text.norm_text(F.col("text")).cast("binary")).alias("digest"))
    return ranking.first_seen(d, ["source", "digest"], "doc_id")


@query("SELECT *, 'SVC-' || lpad(CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VARCHAR), 9, '0') AS service_id FROM orders")
def numbered_orders(t):
    return ranking.numbered(t("orders"), ["o_orderdate", "o_orderkey"], "service_id", "SVC-", 9)


@query(f"""WITH d AS (SELECT doc_id, unnest({_tokens(_norm('text'))}) AS x FROM documents), b AS (SELECT item_id, unnest({_tokens(_norm('text'))}) AS x FROM benchmark),
p AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (x) GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT doc_id, item_id, CAST(least(85, 20 * shared) AS INT) AS score FROM p QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY least(85, 20 * shared) DESC, item_id) = 1""")
def token_overlap(t):
    tokens = F.filter(text.words(text.norm_text(F.col("text"))), lambda x: F.length(x) >= 4)
    d, b = t("documents").select("doc_id", tokens.alias("ta")), t("benchmark").select("item_id", tokens.alias("tb"))
    return matching.overlap_matches(d, "doc_id", "ta", b, "item_id", "tb").select("doc_id", "item_id", "score")


_L1, _L2 = "p_name || ' ' || p_type || ' ' || (p_size % 4)", "n_name || ' small ring gear ECONOMY ' || n_nationkey"


@query(f"""WITH a AS (SELECT p_partkey, {_clean(_L1)} AS l FROM part), b AS (SELECT n_nationkey, {_clean(_L2)} AS r FROM nation),
s AS (SELECT p_partkey, n_nationkey, l, r, len(list_intersect({_tokens('l')}, {_tokens('r')})) AS k FROM a, b WHERE l <> '' AND r <> ''),
c AS (SELECT p_partkey, n_nationkey, CASE WHEN l = r THEN 96 WHEN (contains(l, r) OR contains(r, l)) AND k >= 2 THEN 90 WHEN k >= 3 THEN least(88, 18 * k + 20) WHEN k = 2 THEN 72 ELSE 0 END AS score FROM s)
SELECT p_partkey, n_nationkey, CAST(score AS INT) AS score FROM c WHERE score >= 65""")
def label_matches(t):
    a = t("part").select("p_partkey", text.clean_label(F.expr(_L1)).alias("l"))
    b = t("nation").select("n_nationkey", text.clean_label(F.expr(_L2)).alias("r"))
    a, b = a.withColumn("tl", text.business_tokens(F.col("l"))), b.withColumn("tr", text.business_tokens(F.col("r")))
    return matching.label_matches(a, "p_partkey", "l", "tl", b, "n_nationkey", "r", "tr")


_PAIR = "SELECT {k}, min(l_suppkey) AS a, max(l_suppkey) AS z FROM lineitem GROUP BY 1"


@query(f"SELECT o.l_orderkey, p.l_partkey FROM ({_PAIR.format(k='l_orderkey')}) o JOIN ({_PAIR.format(k='l_partkey')}) p ON o.a <> o.z AND p.a <> p.z AND least(o.a, o.z) = least(p.a, p.z) AND greatest(o.a, o.z) = greatest(p.a, p.z)")
def sorted_pairs(t):
    ends = t("lineitem")
    pair = lambda k, a, z: ends.groupBy(k).agg(F.min("l_suppkey").alias(a), F.max("l_suppkey").alias(z))
    return matching.pair_join(pair("l_orderkey", "a", "z"), ("a", "z"), pair("l_partkey", "z2", "a2"), ("a2", "z2")).select("l_orderkey", "l_partkey")


@query("SELECT a.l_orderkey, a.l_suppkey AS site_a, z.l_suppkey AS site_z, count(*) AS n FROM lineitem a JOIN lineitem z ON a.l_orderkey = z.l_orderkey AND a.l_linenumber = 1 AND z.l_linenumber = 2 AND a.l_suppkey <> z.l_suppkey GROUP BY ALL")
def end_pairs(t):
    one = lambda n, name: t("lineitem").where(F.col("l_linenumber") == n).select("l_orderkey", F.col("l_suppkey").alias(name))
    return one(1, "site_a").join(one(2, "site_z"), "l_orderkey").where("site_a <> site_z").groupBy("l_orderkey", "site_a", "site_z").agg(F.count("*").alias("n"))


@query("""SELECT s_suppkey, coalesce(n_parts, 0) AS n_parts, coalesce(n_orders, 0) AS n_orders, coalesce(n_nations, 0) AS n_nations FROM supplier
  LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey
  LEFT JOIN (SELECT n_nationkey, count(*) AS n_nations FROM nation GROUP BY 1) ON n_nationkey = s_nationkey""")
def site_assets(t):
    lines = t("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count_distinct("l_partkey").alias("n_parts"), F.count_distinct("l_orderkey").alias("n_orders"))
    nations = t("nation").groupBy(F.col("n_nationkey").alias("s_nationkey")).agg(F.count("*").alias("n_nations"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return t("supplier").join(lines, "s_suppkey", "left").join(nations, "s_nationkey", "left").select("s_suppkey", zero("n_parts"), zero("n_orders"), zero("n_nations"))


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS urgent FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def open_customers(t):
    without = t("customer").join(t("orders").where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    urgent = t("orders").where("o_orderpriority = '1-URGENT'").select("o_custkey").distinct().withColumn("u", F.lit(True))
    return without.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("u", F.lit(False)).alias("urgent"))


@query("""WITH s AS (SELECT l_partkey, l_suppkey, 0 AS source, l_orderkey AS ordinal FROM lineitem WHERE l_returnflag = 'R' UNION ALL
  SELECT l_partkey, l_suppkey, 1, l_orderkey FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT l_partkey, l_suppkey, 2, l_orderkey FROM lineitem),
m AS (SELECT l_partkey, l_suppkey, min((source, ordinal)) AS k FROM s GROUP BY 1, 2)
SELECT l_partkey, l_suppkey, k[1] AS source FROM m QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY k, l_suppkey) <= 8""".replace("k[1]", "struct_extract_at(k, 1)"))
def cascade_lookup(t):
    s = lambda where: t("lineitem").where(where).select("l_partkey", "l_suppkey", F.col("l_orderkey").alias("ordinal"))
    return matching.cascade([s("l_returnflag = 'R'"), s("l_returnflag = 'A'"), s("true")], ["l_partkey"], "l_suppkey", 8).select("l_partkey", "l_suppkey", "source")


@query("""WITH c AS (SELECT c_custkey, c_nationkey, floor(c_acctbal / 500) AS x, c_custkey % 4 AS y FROM customer), r AS (SELECT *, count(*) OVER (PARTITION BY c_nationkey, x, y) AS n FROM c)
SELECT c_custkey, CAST(n AS INT) AS reuse_count, CASE WHEN n >= 10 THEN 'weak_reused_point' WHEN n >= 2 THEN 'shared' ELSE 'precise' END AS reuse_class,
  CASE WHEN n >= 10 THEN 30 WHEN n >= 5 THEN 55 WHEN n >= 2 THEN 75 ELSE 100 END AS reuse_score FROM r""")
def xy_reuse(t):
    c = t("customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("city"), F.floor(F.col("c_acctbal") / 500).alias("x"), (F.col("c_custkey") % 4).alias("y"))
    return spatial.with_reuse(c, "city", "x", "y").select("c_custkey", "reuse_count", "reuse_class", "reuse_score")


def _points(t):
    at = lambda i: (F.get("embedding", i).cast("double") * 20000).alias("xyz"[i])
    return t("embeddings").select("vec_id", "label", at(0), at(1))


_POINTS = "SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) * 20000 AS x, CAST(embedding[2] AS DOUBLE) * 20000 AS y FROM embeddings"


@query(f"""WITH p AS ({_POINTS}), n AS (SELECT a.vec_id AS a, b.vec_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS m, a.label AS l FROM p a JOIN p b ON a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
s AS (SELECT a, b, m, least(CASE WHEN m <= 50 THEN 98 WHEN m <= 100 THEN 94 WHEN m <= 200 THEN 88 ELSE 75 END, 60 + 5 * l) AS score FROM n WHERE m <= 500)
SELECT a, b, CAST(score AS INT) AS score, round(m, 6) AS meters FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, m, b) = 1""")
def nearby_points(t):
    p = _points(t)
    left = p.where("vec_id % 2 = 0").select(F.col("vec_id").alias("a"), "x", "y", (60 + 5 * F.col("label")).alias("cap"))
    right = p.where("vec_id % 2 = 1").select(F.col("vec_id").alias("b"), "x", "y")
    return spatial.best_nearby(left, right).select("a", "b", F.col("score").cast("int").alias("score"), F.round("meters", 6).alias("meters"))


@query(f"SELECT vec_id AS id, round(sqrt((x - 100) * (x - 100) + (y + 50) * (y + 50)), 6) AS meters FROM ({_POINTS}) WHERE sqrt((x - 100) * (x - 100) + (y + 50) * (y + 50)) <= 1500 ORDER BY sqrt((x - 100) * (x - 100) + (y + 50) * (y + 50)), vec_id LIMIT 20")
def radius_search(t):
    found = spatial.radius_search(_points(t).withColumnRenamed("vec_id", "id"), [("x", "y")], 100.0, -50.0, 1500.0)
    return found.select("id", F.round("meters", 6).alias("meters"))


@query(f"SELECT label, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, round(avg(x), 1) AS mean_x, round(avg(y), 1) AS mean_y, count(*) AS n_points FROM ({_POINTS}) GROUP BY 1")
def footprints(t):
    return spatial.footprint(_points(t), ["label"], [("x", "y")])


@query(f"SELECT CASE WHEN m <= 100 THEN 'strong' WHEN m <= 200 THEN 'medium' WHEN m <= 500 THEN 'weak' ELSE 'none' END AS band, count(*) AS n FROM (SELECT sqrt(x * x + y * y) / 5 AS m FROM ({_POINTS})) GROUP BY 1")
def distance_bands(t):
    zero = F.lit(0.0)
    return tables.mix(_points(t).select(scores.distance_confidence(scores.distance(F.col("x"), F.col("y"), zero, zero) / 5).alias("band")), ["band"])


@query("""SELECT o_orderstatus, count(*) FILTER (o_totalprice > 200000) AS large, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice > 200000) AS both,
  count(*) AS n, round(100.0 * count(*) FILTER (o_totalprice > 200000) / count(*), 1) AS share FROM orders GROUP BY 1""")
def kpi_orders(t):
    big, urgent = F.col("o_totalprice") > 200000, F.col("o_orderpriority") == "1-URGENT"
    out = tables.kpis(t("orders"), {"large": big, "urgent": urgent, "both": big & urgent, "n": F.lit(True)}, ["o_orderstatus"])
    return out.withColumn("share", scores.ratio(F.col("large"), F.col("n")))


_PROFILED = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_nulls, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high,
  array_to_string(list_sort(list(DISTINCT CAST({c} AS VARCHAR)))[1:5], '|') AS samples FROM customer""" for c in _PROFILED))
def column_profile(t):
    return tables.profile(t("customer").select(*_PROFILED)).withColumn("samples", F.array_join("samples", "|"))


@query("""SELECT 'nation' AS table_name, count(*) AS n_rows, CAST(sum(CAST(('0x' || substr(sha256(array_to_string(list_transform([CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)], lambda x: length(x) || ':' || x), '|')), 1, 12)) AS BIGINT)) AS VARCHAR) AS digest FROM nation""")
def table_digest(t):
    return tables.digest(t("nation").select("n_nationkey", "n_name", "n_regionkey"), "nation")


@query("""WITH s AS (SELECT event_id, user_id, event_type, CASE WHEN value > 50 THEN 'strong' ELSE 'weak' END AS strength, json_extract_string(props, '$.k') AS k FROM events),
n AS (SELECT user_id, event_type, count(DISTINCT k) AS n FROM s GROUP BY 1, 2)
SELECT event_id, k, CASE WHEN strength = 'strong' AND n > 1 THEN 'medium' ELSE strength END AS strength FROM s JOIN n USING (user_id, event_type)""")
def ambiguous_events(t):
    e = t("events").select("event_id", "user_id", "event_type", F.when(F.col("value") > 50, "strong").otherwise("weak").alias("strength"), F.get_json_object("props", "$.k").alias("k"))
    return tables.ambiguous(e, ["user_id", "event_type"], "k", "strength").select("event_id", "k", "strength")


@query(f"""WITH d AS (SELECT DISTINCT unnest({_tokens(_norm('text'))}) AS x FROM documents), b AS (SELECT DISTINCT unnest({_tokens(_norm('text'))}) AS x FROM benchmark)
SELECT 'both' AS side, count(*) AS n FROM (FROM d INTERSECT FROM b) UNION ALL SELECT 'documents', count(*) FROM (FROM d EXCEPT FROM b) UNION ALL SELECT 'any', count(*) FROM (FROM d UNION FROM b)""")
def token_sets(t):
    tokens = lambda n: t(n).select(F.explode(F.array_distinct(F.filter(text.words(text.norm_text(F.col("text"))), lambda x: F.length(x) >= 4))).alias("x")).distinct()
    d, b = tokens("documents"), tokens("benchmark")
    count = lambda n, df: df.agg(F.lit(n).alias("side"), F.count("*").alias("n"))
    return count("both", d.intersect(b)).union(count("documents", d.exceptAll(b))).union(count("any", d.union(b).distinct()))


@query("""WITH s AS (SELECT o_custkey, o_orderstatus, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS review_types FROM orders GROUP BY 1, 2)
SELECT *, CAST(floor((row_number() OVER (PARTITION BY o_orderstatus, review_types ORDER BY o_custkey) - 1) / 10) AS INT) AS batch FROM s""")
def review_batches(t):
    grouped = tables.review_batches(t("orders"), "o_custkey", ["o_orderstatus"], "o_orderpriority")
    return ranking.batches(grouped, ["o_orderstatus", "review_types"], ["o_custkey"], 10)


@query("""WITH s AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS k, bool_or(l_suppkey % 5 = 0) AS z, bool_or(l_suppkey % 7 = 0) AS a, min(l_quantity) * 20 AS m, count(DISTINCT l_linestatus) AS e, count(*) AS l FROM lineitem GROUP BY 1),
c AS (SELECT l_orderkey, least(20, 8 * k) + CASE WHEN z THEN 35 ELSE 0 END + CASE WHEN a THEN 25 ELSE 0 END + CASE WHEN m <= 100 THEN 25 WHEN m <= 300 THEN 15 WHEN m <= 800 THEN 6 ELSE 0 END + least(20, 10 * e) + least(10, 2 * l) AS score FROM s)
SELECT l_orderkey, CAST(score AS INT) AS score, CASE WHEN score >= 70 THEN 'strong' WHEN score >= 35 THEN 'medium' ELSE 'weak' END AS band FROM c""")
def route_coherence(t):
    s = t("lineitem").groupBy("l_orderkey").agg(
        F.count_distinct("l_partkey").alias("k"), F.bool_or(F.col("l_suppkey") % 5 == 0).alias("z"), F.bool_or(F.col("l_suppkey") % 7 == 0).alias("a"),
        (F.min("l_quantity") * 20).alias("m"), F.count_distinct("l_linestatus").alias("e"), F.count("*").alias("l"),
    )
    score = scores.coherence(*map(F.col, "kzamel"))
    return s.select("l_orderkey", score.alias("score"), scores.coherence_band(score).alias("band"))


_NATURES = "CASE WHEN o_orderkey % 4 = 0 THEN 'Hebergement' WHEN o_orderkey % 4 = 1 THEN 'IRU FON' ELSE 'Lan To Lan' END"
_KINDS = ["contract_party", "final_party", "site_a", "site_z", "optical", "network"]


def _evidence(t):
    """Lines as evidence of what their number stands for; those beyond the sixth are further network
    evidence, so several lines of an order compete, and some tie."""
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), F.least(F.col("l_linenumber"), F.lit(len(_KINDS))))
    return t("lineitem").select(
        F.col("l_orderkey").alias("service_id"), kind.alias("kind"), F.col("l_partkey").cast("string").alias("target"), (F.col("l_quantity").cast("int") * 2).alias("score")
    )


_GOLD = f"""e AS (SELECT l_orderkey AS service_id, CASE least(l_linenumber, 6) {' '.join(f"WHEN {i + 1} THEN '{k}'" for i, k in enumerate(_KINDS))} END AS kind, CAST(l_partkey AS VARCHAR) AS target,
  CAST(l_quantity AS INT) * 2 AS score FROM lineitem),
b AS (SELECT service_id, kind, max(score) AS score, arg_min(target, (-score, target)) AS target FROM e GROUP BY 1, 2),
g AS (SELECT o_orderkey AS service_id, {_NATURES} AS nature_service, {', '.join(f"coalesce(max(b.score) FILTER (b.kind = '{k}'), 0) AS {k}_score, max(b.target) FILTER (b.kind = '{k}') AS {k}_id" for k in _KINDS)}
  FROM orders LEFT JOIN b ON b.service_id = o_orderkey GROUP BY 1, 2),
n AS (SELECT service_id, count(*) AS evidence_count, count(*) FILTER (score >= 90) AS strong_evidence_count FROM e GROUP BY 1)"""


def _heads(t):
    return t("orders").select(F.col("o_orderkey").alias("service_id"), F.expr(_NATURES).alias("nature_service"))


def _golden(t):
    return publication.gold(_heads(t), _evidence(t))


@query(f"""WITH {_GOLD} SELECT g.service_id, {', '.join(f'{k}_score, {k}_id' for k in _KINDS)}, coalesce(evidence_count, 0) AS evidence_count, coalesce(strong_evidence_count, 0) AS strong_evidence_count,
  CASE WHEN greatest({', '.join(f'{k}_score' for k in _KINDS)}) >= 80 THEN 'medium' ELSE 'low' END AS confidence_band FROM g LEFT JOIN n USING (service_id)""")
def gold_services(t):
    return _golden(t).select("service_id", *(f"{k}_{x}" for k in _KINDS for x in ("score", "id")), "evidence_count", "strong_evidence_count", "confidence_band")


_TESTS = {
    "missing_contract_party": "contract_party_id IS NULL", "missing_final_party": "final_party_id IS NULL", "missing_site_z": "site_z_score < 60 AND nature_service <> 'Hebergement'",
    "missing_network_support": "network_score < 72 AND nature_service = 'Lan To Lan'", "missing_optical_support": "optical_score < 80 AND nature_service IN ('IRU FON', 'Location FON')", "manual_review": "true",
}


@query(f"WITH {_GOLD} " + " UNION ALL ".join(f"SELECT service_id, '{k}' AS review_type, '{publication.REVIEWS[k][0]}' AS severity, 'RVW-' || {_hash16('CAST(service_id AS VARCHAR)', repr(k), repr(publication.REVIEWS[k][1]))} AS review_id FROM g WHERE {c}" for k, c in _TESTS.items()))
def review_queue(t):
    golden = _golden(t).withColumn("service_id", F.col("service_id").cast("string"))
    return publication.review_queue(golden).select(F.col("service_id").cast("long").alias("service_id"), "review_type", "severity", "review_id")


@query(f"""WITH {_GOLD}, r AS (SELECT o_orderkey AS service_id, o_orderstatus = 'F' AS ok, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'V1' END AS v FROM orders),
p AS (SELECT g.service_id, nature_service, ok, CASE WHEN ok THEN 'P1' ELSE final_party_id END AS final_party, CASE WHEN ok THEN 'agent' WHEN final_party_id IS NOT NULL THEN 'gold' ELSE 'missing' END AS final_party_source,
  CASE WHEN ok THEN 'S1' ELSE site_a_id END AS site_a, CASE WHEN ok THEN 'S2' ELSE site_z_id END AS site_z, optical_id AS optical, CASE WHEN ok AND v IS NOT NULL THEN v ELSE network_id END AS network FROM g JOIN r USING (service_id)),
f AS (SELECT *, list_filter([CASE WHEN ok AND network IS NULL THEN 'agent_hint_unmapped' END, CASE WHEN final_party IS NULL THEN 'missing_final_party' END, CASE WHEN network IS NULL THEN 'missing_network_support' END,
  CASE WHEN optical IS NULL THEN 'missing_optical_support' END, CASE WHEN site_a IS NULL THEN 'missing_site_a' END, CASE WHEN site_z IS NULL THEN 'missing_site_z' END], lambda x: x IS NOT NULL) AS gaps FROM p)
SELECT service_id, final_party_source, final_party AS published_final_party, site_a AS published_site_a, site_z AS published_site_z, optical AS published_optical, network AS published_network, array_to_string(gaps, ',') AS gap_flags,
  CASE WHEN final_party IS NULL OR site_a IS NULL OR (site_z IS NULL AND nature_service <> 'Hebergement') OR (network IS NULL AND nature_service = 'Lan To Lan') OR (optical IS NULL AND nature_service = 'IRU FON') THEN 'needs_review'
    WHEN ok THEN 'published_validated' ELSE 'published_from_gold' END AS publication_status FROM f""")
def published_services(t):
    log = t("orders").select(
        F.col("o_orderkey").alias("service_id"), F.expr("if(o_orderstatus = 'F', 'validated', 'rejected')").alias("status"), F.lit("P1").alias("final_party"), F.lit("S1").alias("site_a"),
        F.lit("S2").alias("site_z"), F.lit(" ").alias("optical"), F.expr("if(o_orderpriority = '1-URGENT', null, 'V1')").alias("network"), F.lit("some-device").alias("network_hint"),
    )
    out = publication.publish(_heads(t), _golden(t), log)
    return out.select("service_id", "final_party_source", *(f"published_{c}" for c in ("final_party", "site_a", "site_z", "optical", "network")), F.array_join("gap_flags", ",").alias("gap_flags"), "publication_status")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events),
s AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Lan To Lan' ELSE 'IRU FON' END AS nature, event_type IN ('view', 'purchase', 'click') AND event_type IS NOT NULL AS route, coalesce(event_type = 'click', false) AS vlan,
  coalesce(event_type = 'error', false) AS gap, coalesce(value > 50, false) AS dev FROM customer LEFT JOIN l ON user_id = c_custkey AND r = 1)
SELECT count(*) FILTER (nature = 'Lan To Lan') AS l2l_total, count(*) FILTER (nature = 'Lan To Lan' AND route) AS l2l_route, count(*) FILTER (nature = 'Lan To Lan' AND vlan) AS l2l_vlan,
  count(*) FILTER (nature = 'Lan To Lan' AND route AND vlan) AS l2l_dual, count(*) FILTER (nature = 'Lan To Lan' AND route AND vlan AND dev) AS l2l_triplet, count(*) FILTER (nature = 'Lan To Lan' AND gap) AS l2l_declared_gap,
  count(*) FILTER (nature = 'IRU FON') AS fon_total, count(*) FILTER (nature = 'IRU FON' AND route) AS fon_route, count(*) FILTER (nature = 'IRU FON' AND gap) AS fon_declared_gap FROM s""")
def resolution_scorecard(t):
    heads = t("customer").select(F.col("c_custkey").alias("service_id"), F.expr("if(c_custkey % 2 = 0, 'Lan To Lan', 'IRU FON')").alias("nature_service"))
    log = t("events").select(
        F.col("user_id").alias("service_id"), F.col("ts").alias("created_at"), F.col("event_id").alias("resolution_id"), F.expr("if(event_type in ('view', 'purchase', 'click'), 'R1', ' ')").alias("route_ref"),
        F.expr("if(event_type = 'click', 'V', null)").alias("network_vlan_id"), F.expr("if(value > 50, 'C', '')").alias("cpe_id"), F.lit(None).cast("string").alias("network_interface_id"),
        F.expr("if(event_type = 'error', 'declared_gap', null)").alias("resolution_status"), F.lit("x").alias("nature_service"),
    )
    return resolutions.scorecard(heads, log)


@query("""WITH l AS (SELECT conv_id, turn, role, sum(CASE WHEN role = 'user' OR length(text) < 40 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block, role = 'user' AS start, length(text) < 40 AS stop FROM conversations)
SELECT conv_id, turn, block, bool_or(start) OVER (PARTITION BY conv_id, block) AND (start OR NOT stop) AS in_block FROM l""")
def turn_sessions(t):
    rows = t("conversations").select("conv_id", "turn", "role", F.length("text").alias("n"))
    out = netconfig.sessions(rows, ["conv_id"], "turn", F.col("role") == "user", F.col("n") < 40)
    return out.select("conv_id", "turn", "block", "in_block")


@query("SELECT conv_id, turn, m AS is_match FROM (SELECT conv_id, turn, m, bool_or(m) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM (SELECT *, regexp_matches(text, '(?i)le la') AS m FROM conversations)) WHERE near")
def grep_context(t):
    return netconfig.grep(t("conversations"), ["conv_id"], "turn", "text", "(?i)le la").select("conv_id", "turn", "is_match")


_RANGE = "'switchport trunk allowed vlan add ' || p_size || '-' || (p_size + p_partkey % 5) || ',' || p_size || ', 7to9,900-1'"


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(range(p_size, p_size + p_partkey % 5 + 1), [7, 8, 9]))), ',') AS vlans FROM part")
def vlan_lists(t):
    listed = F.array_sort(references.line_vlans(F.expr(_RANGE)))
    return t("part").select("p_partkey", F.array_join(listed.cast("array<string>"), ",").alias("vlans"))


_ADDRESS = "CASE s_suppkey % 5 WHEN 0 THEN s_suppkey || ' rue de Morienval Pierrefonds' WHEN 1 THEN 'Mairie de Senlis, 3 avenue Foch 60300 St Senlis' WHEN 2 THEN 'Chambre NRA ' || s_suppkey WHEN 3 THEN 'TOIP ' || s_suppkey ELSE '60200 Compiègne' END"


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'postal_address_precise' WHEN 1 THEN 'mixed_site_address' WHEN 2 THEN 'technical_site_anchor' WHEN 3 THEN 'route_or_service_reference' ELSE 'postcode_city' END AS kind,
  CASE s_suppkey % 5 WHEN 0 THEN 100 WHEN 1 THEN 95 WHEN 2 THEN 82 WHEN 3 THEN 70 ELSE 55 END AS score, CASE s_suppkey % 5 WHEN 0 THEN 'PIERREFONDS' WHEN 1 THEN 'SAINT SENLIS' WHEN 2 THEN 'CHAMBRE NRA ' || s_suppkey WHEN 3 THEN 'TOIP ' || s_suppkey ELSE 'COMPIEGNE' END AS city FROM supplier""")
def signal_kinds(t):
    s = address.classify_signal(F.expr(_ADDRESS))
    return t("supplier").select("s_suppkey", s["kind"].alias("kind"), s["score"].alias("score"), address.parse_address(F.expr(_ADDRESS))["city"].alias("city"))


@query("""WITH m AS (SELECT DISTINCT o_orderkey AS id, o_custkey AS c, o_orderstatus AS s, regexp_replace(cast(o_orderkey % 9 AS VARCHAR) || '-' || o_custkey || '.2', '[.-][0-9]+$', '') AS k FROM orders WHERE o_orderstatus <> 'P'),
h AS (SELECT c, k, count(DISTINCT id) AS n, min(id) AS p FROM m WHERE s = 'O' GROUP BY 1, 2), f AS (SELECT id, p, k FROM m JOIN h USING (c, k) WHERE m.s = 'F' AND n = 1)
SELECT id AS maintenance_service_id, p AS principal_service_id, 'command_base' AS strategy, k AS match_detail FROM f""")
def maintenance_matches(t):
    members = t("orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("service_id"), F.col("o_custkey").alias("client"), F.expr("if(o_orderstatus = 'O', 'principal', 'maintenance')").alias("role"),
        F.expr("concat(o_orderkey % 9, '-', o_custkey, '.2')").alias("command"), F.lit(None).cast("string").alias("contract"), F.lit("").alias("endpoint_a"), F.lit(None).cast("string").alias("endpoint_z"),
    )
    return services.maintenance_matches(members)


@query("""WITH old AS (SELECT o_custkey, o_orderstatus FROM orders), new AS (SELECT o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT side, count(*) AS n FROM ((SELECT 'old' AS side, * FROM (FROM old EXCEPT ALL FROM new)) UNION ALL (SELECT 'new', * FROM (FROM new EXCEPT ALL FROM old))) GROUP BY 1""")
def build_difference(t):
    rows = t("orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    new = rows.withColumn("o_orderstatus", F.expr("if(o_orderpriority = '1-URGENT', 'F', o_orderstatus)"))
    return tables.mix(tables.difference(rows.drop("o_orderpriority"), new.drop("o_orderpriority")), ["side"])


_REF_SERVICES = "SELECT o_orderkey AS service_id, ['S' || o_custkey % 40, 'S' || o_orderkey % 30] AS refs FROM orders"


@query(f"""WITH s AS (SELECT DISTINCT service_id, unnest(refs) AS ref FROM ({_REF_SERVICES}))
SELECT DISTINCT service_id, 'route' AS kind, 'R' || s_suppkey AS target, 'route_ref_exact' AS rule_name, 100 AS score FROM s JOIN supplier ON ref = 'S' || s_suppkey
UNION ALL SELECT DISTINCT service_id, 'housing', 'H' || p_partkey, 'housing_route_ref_exact', 82 FROM s JOIN part ON ref = 'S' || p_size""")
def reference_supports(t):
    heads = t("orders").select(F.col("o_orderkey").alias("service_id"), F.expr("array(concat('S', o_custkey % 40), concat('S', o_orderkey % 30))").alias("refs"))
    routes = t("supplier").select(F.expr("concat('S', s_suppkey)").alias("ref"), F.expr("concat('R', s_suppkey)").alias("target"))
    housings = t("part").select(F.expr("concat('S', p_size)").alias("ref"), F.expr("concat('H', p_partkey)").alias("target"))
    return candidates.supports_by_reference(heads, "refs", {"route": routes, "housing": housings})


_SITE_VALUE = "CASE WHEN p_partkey % 3 = 0 THEN 'site ' || n.n_name WHEN p_partkey % 3 = 1 THEN p_name || ' ' || p_type || ' near' ELSE NULL END"


@query(f"""WITH v AS (SELECT p_partkey AS value_id, {_norm(_SITE_VALUE)} AS v FROM part LEFT JOIN nation n ON n.n_nationkey = p_partkey % 30),
s AS (SELECT n_nationkey AS site_id, {_norm("'site ' || n_name")} AS a, {_norm("CASE n_nationkey % 3 WHEN 0 THEN 'economy' WHEN 1 THEN 'small' ELSE 'promo' END || ' ring widget bolt ' || n_name")} AS b FROM nation),
e AS (SELECT value_id, min(site_id) AS site_id FROM v JOIN s ON v <> '' AND (v = a OR v = b) GROUP BY 1),
k AS (SELECT value_id, site_id, len(list_intersect({_tokens('v')}, list_distinct(list_concat(string_split(a, ' '), string_split(b, ' '))))) AS n FROM v, s WHERE v <> '' AND value_id NOT IN (SELECT value_id FROM e))
SELECT value_id, site_id, 100 AS score, 'site_exact' AS rule_name FROM e UNION ALL SELECT value_id, site_id, CAST(least(85, 20 * n) AS INT), 'site_token_overlap' FROM k WHERE n >= 2
QUALIFY row_number() OVER (PARTITION BY value_id ORDER BY least(85, 20 * n) DESC, site_id) = 1""")
def endpoint_sites(t):
    values = t("part").join(t("nation").withColumnRenamed("n_nationkey", "k"), F.col("k") == F.col("p_partkey") % 30, "left")
    values = values.select(F.col("p_partkey").alias("value_id"), F.expr(_SITE_VALUE.replace("n.n_name", "n_name")).alias("text"))
    names = F.expr("array(concat('site ', n_name), concat(case n_nationkey % 3 when 0 then 'economy' when 1 then 'small' else 'promo' end, ' ring widget bolt ', n_name))")
    sites = t("nation").select(F.col("n_nationkey").alias("site_id"), F.col("n_nationkey").alias("ordinal"), names.alias("names"))
    return candidates.site_matches(values, sites)


@query("""WITH s AS (SELECT user_id AS service_id, event_type AS device, CAST(user_id % 20 AS VARCHAR) AS label, CAST(value AS INT) % 6 AS vlan_id, CASE WHEN event_id % 4 = 0 THEN 0 WHEN event_id % 4 = 1 THEN 1 ELSE 2 END AS p FROM events),
n AS (SELECT device, label, count(DISTINCT vlan_id) AS n FROM s GROUP BY 1, 2)
SELECT service_id, device, vlan_id, CASE min(CASE WHEN p = 0 AND n > 1 THEN 1 ELSE p END) WHEN 0 THEN 'strong' WHEN 1 THEN 'medium' ELSE 'weak' END AS proof, count(*) AS n_sources FROM s JOIN n USING (device, label) GROUP BY 1, 2, 3""".replace("CAST(value AS INT)", "CAST(floor(value) AS INT)"))
def vlan_hypotheses(t):
    return candidates.vlan_hypotheses(t("events").select(
        F.col("user_id").alias("service_id"), F.col("event_type").alias("device"), (F.col("user_id") % 20).cast("string").alias("label"), (F.floor("value").cast("int") % 6).alias("vlan_id"),
        F.expr("case event_id % 4 when 0 then 'strong' when 1 then 'medium' else 'weak' end").alias("proof"),
    ))


@query("""WITH d AS (SELECT l_orderkey AS service_id, l_suppkey AS route_ref FROM lineitem WHERE l_returnflag = 'R'), c AS (SELECT l_orderkey, l_suppkey FROM lineitem),
s AS (SELECT l_orderkey AS service_id, l_suppkey AS route_ref, CAST(max(l_quantity) * 2 AS INT) AS coherence FROM lineitem GROUP BY 1, 2),
o AS (SELECT service_id, route_ref, min(r) AS r FROM (SELECT *, 0 AS r FROM d UNION ALL SELECT *, 1 FROM c) GROUP BY 1, 2)
SELECT service_id, route_ref, CAST(row_number() OVER (PARTITION BY service_id ORDER BY r, coalesce(coherence, 0) DESC, route_ref) AS INT) AS place, CASE WHEN r = 0 THEN 'direct' ELSE 'context' END AS evidence, coalesce(coherence, 0) AS coherence,
  CASE WHEN coherence >= 70 THEN 'strong' WHEN coherence >= 35 THEN 'medium' ELSE 'weak' END AS band FROM o LEFT JOIN s USING (service_id, route_ref)""")
def route_candidates(t):
    pairs = t("lineitem").select(F.col("l_orderkey").alias("service_id"), F.col("l_suppkey").alias("route_ref"), "l_returnflag", "l_quantity")
    marks = pairs.groupBy("service_id", "route_ref").agg((F.max("l_quantity") * 2).cast("int").alias("coherence"))
    return candidates.route_candidates(pairs.where("l_returnflag = 'R'"), pairs, marks)

# Registered by their import.
from skein import bundle_queries, final_queries, hunt_queries, plant_queries, rule_queries  # noqa: E402, F401
