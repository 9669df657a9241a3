"""Queries over all rows against plain Python over the tables."""

from collections import Counter, defaultdict

import duckdb

from skein import queries
from skein.plans import bundles

SF = "/root/testdata/sf0.001"


def table(name, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{SF}/{name}.parquet'").fetchall()


def rows(spark, name):
    return sorted(tuple(r) for r in queries.QUERIES[name](spark, SF).collect())


def test_reference_supports_has_all_parts(spark):
    refs = {o: {f"S{c % 40}", f"S{o % 30}"} for o, c in table("orders", "o_orderkey", "o_custkey")}
    by_ref = defaultdict(set)
    for s, *_ in table("supplier", "s_suppkey"):
        by_ref[f"S{s}"].add(("route", f"R{s}", "route_ref_exact", 100))
    for p, size in table("part", "p_partkey", "p_size"):
        by_ref[f"S{size}"].add(("housing", f"H{p}", "housing_route_ref_exact", 82))
    assert rows(spark, "reference_supports") == sorted({(o, *x) for o, rs in refs.items() for r in rs for x in by_ref[r]})


def test_sorted_pairs_of_all_lines(spark):
    orders, parts = defaultdict(set), defaultdict(set)
    for o, p, s in table("lineitem", "l_orderkey", "l_partkey", "l_suppkey"):
        orders[o].add(s)
        parts[p].add(s)
    ends = lambda xs: (min(xs), max(xs)) if len(xs) > 1 else None
    want = sorted((o, p) for o, a in orders.items() for p, b in parts.items() if ends(a) and ends(a) == ends(b))
    assert rows(spark, "sorted_pairs") == want


def test_gold_counts_all_lines(spark):
    lines, best = Counter(), defaultdict(int)
    for o, n, q in table("lineitem", "l_orderkey", "l_linenumber", "l_quantity"):
        lines[o] += 1
        if n >= 6:
            best[o] = max(best[o], int(q) * 2)
    got = queries.QUERIES["gold_services"](spark, SF).collect()
    assert {r.service_id: (r.evidence_count, r.network_score) for r in got} == {o: (lines[o], best[o]) for o, *_ in table("orders", "o_orderkey")}


def test_validated_services_of_all_orders(spark):
    got = queries.QUERIES["published_services"](spark, SF).where("final_party_source = 'agent'").collect()
    assert {r.service_id for r in got} == {o for o, s in table("orders", "o_orderkey", "o_orderstatus") if s == "F"}


def test_route_candidates_score_all_lines(spark):
    best = defaultdict(int)
    for o, s, q in table("lineitem", "l_orderkey", "l_suppkey", "l_quantity"):
        best[o, s] = max(best[o, s], int(q * 2))
    got = queries.QUERIES["route_candidates"](spark, SF).collect()
    assert {(r.service_id, r.route_ref): r.coherence for r in got} == best


def test_builds_of_all_orders(spark):
    orders = table("orders", "o_custkey", "o_orderstatus", "o_orderpriority")
    old, new = Counter((c, s) for c, s, _ in orders), Counter((c, "F" if p == "1-URGENT" else s) for c, s, p in orders)
    assert dict(rows(spark, "build_difference")) == {"old": (old - new).total(), "new": (new - old).total()}


def test_route_supports_are_not_moved_once_found(spark):
    plan = queries.QUERIES["route_supports"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "service_id" in plan and not [line for line in plan.splitlines() if "hashpartitioning(" in line and "service_id" in line and "target" in line]


def test_optical_bundles_upper_letter_by_letter(spark, tmp_path):
    for name in ("documents", "conversations", "pages"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    duckdb.sql(f"COPY (SELECT 900 AS item_id, 'a b straßen' AS text UNION ALL SELECT 901, 'a b strassen') TO '{tmp_path}/benchmark.parquet'")
    (tmp_path / "documents.parquet").unlink()
    duckdb.sql(f"COPY (SELECT doc_id, 'w w w Strassen w w' AS text, lang, source, n_chars FROM '{SF}/documents.parquet' LIMIT 3) TO '{tmp_path}/documents.parquet'")
    assert {r.nearby_cables for r in queries.QUERIES["optical_bundles"](spark, str(tmp_path)).collect()} == {"901"}


def test_optical_bundles_are_whole(spark):
    rows = lambda n, *columns: spark.range(n).selectExpr(*columns)
    services = rows(2, "id as service_id", "if(id = 0, 'Senlis Gare', null) as site_a_name", "'Beauvais senlis' as site_z_name")
    # Of service 0: 30 supports of each kind, and 30 leases with two ends each.
    supports = rows(120, "0L as service_id", "element_at(array('route', 'lease', 'cable', 'housing'), cast(id % 4 + 1 as int)) as support_type", "lpad(id div 4, 3, '0') as support_id", "if(id % 4 = 0, 'R1', null) as route_ref", "'r' as rule_name", "cast(id as int) as score")
    tables = {
        "logical_routes": rows(40, "lpad(id, 3, '0') as logical_route_id", "'R1' as route_ref", "'l' as source_layer"), "lease_ends": rows(60, "lpad(id div 2, 3, '0') as optical_lease_id", "if(id % 2 = 0, 'A', 'Z') as endpoint_label", "'S' as site_id"),
        "cables": rows(60, "lpad(id, 3, '0') as cable_id", "'x' as reference", "'y' as userreference", "cast(12 as int) as number_of_fibers", "array('SENLIS', if(id < 50, 'BEAUVAIS', 'x')) as site_tokens"),
        "housings": rows(30, "lpad(id, 3, '0') as housing_id", "'t' as housing_type", "'r' as reference", "'S' as site_id"), "stops": rows(70, "concat('R', lpad(id, 3, '0')) as route_ref", "if(id < 40, 'pop SENLIS', 'xbeauvaisx') as site"),
    }
    got = {r.service_id: r for r in bundles.bundle(services, bundles.optical_parts(services, supports, tables)).collect()}
    ids = lambda xs: [x.id for x in xs]
    some = lambda *ns: [f"{i:03}" for i in ns]
    one, two = got[0], got[1]
    assert [x.score for x in one.optical_hints] == list(range(119, -1, -1)) and [x.logical_route_id for x in one.logical_routes] == some(*range(40))
    assert [(x.id, x.endpoint_label) for x in one.lease_ends] == [(f"{i:03}", e) for i in range(30) for e in "AZ"] and ids(one.cables) == ids(one.housings) == some(*range(30))
    # Its own cables are none of those nearby.
    assert ids(one.nearby_cables) == some(*range(30, 60)) and ids(two.nearby_cables) == some(*range(60)) and two.cables == []
    assert [x.route_ref for x in one.stops] == [f"R{i}" for i in some(*range(70))] and [x.route_ref for x in two.stops] == [f"R{i}" for i in some(*range(40, 70), *range(40))]
