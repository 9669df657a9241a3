"""What moves between tasks grows with the rows, not with their pairs or with the square of a group."""

from collections import Counter

from pyspark.sql import functions as F

from skein.operators import matching, spatial, substrings
from skein.plans import bundles, candidates, plant, reconcile, reporting, route_hunt, signals, validation, vlan_hunt


def moved(spark, rows) -> int:
    """How many rows the stages shuffle that rows() runs."""
    context = spark.sparkContext
    lists, store = spark._jvm.java.util.ArrayList, context._jsc.sc().statusStore()
    none = context._gateway.new_array(spark._jvm.double, 0)

    def written():
        context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(lists(), False, False, none, lists())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = written()
    rows()
    return written() - before


def test_equipment_by_tokens_moves_no_pairs(spark):
    n = 400
    services = spark.range(n).selectExpr("cast(id as string) as service_id", "'Lan To Lan' as nature_service", "concat('alpha bravos ', 'client', id % 50, ' town', id % 7) as client_final", "'' as endpoint_z_raw", "'' as endpoint_a_raw")
    cpes = spark.range(n).selectExpr("lpad(id, 4, '0') as cpe_id", "concat('ALPHA-Bravos.client', id % 60, ' town', id % 5, ' ', id) as hostname", "cast(id % 9 as int) as ordinal")
    found = []
    count = moved(spark, lambda: found.extend(reconcile.cpe_overlap(services, services.select("service_id").limit(0), cpes).collect()))
    got = {}
    for r in found:
        got.setdefault(r.service_id, []).append((r.target, r.score))
    hosts = [(i % 9, f"{i:04d}", {"ALPHA", "BRAVOS", f"CLIENT{i % 60}", f"TOWN{i % 5}"}) for i in range(n)]
    for s in range(n):
        mine = {"ALPHA", "BRAVOS", f"CLIENT{s % 50}", f"TOWN{s % 7}"}
        best = sorted((-min(85, 20 * len(mine & ts)), o, c) for o, c, ts in hosts)[:5]
        assert sorted(got[str(s)]) == sorted((c, -score) for score, _, c in best)
    # All pairs share two words.
    assert count < n * n / 4


def test_best_of_block_in_runs(spark):
    import numpy as np
    import pandas as pd

    draw = np.random.default_rng(3)
    sets = lambda n: [np.sort(draw.choice(30, draw.integers(2, 8), replace=False)) for _ in range(n)]
    left, right = pd.DataFrame({"i": range(100, 160), "ns": sets(60)}), pd.DataFrame({"at": draw.permutation(90), "ns": sets(90)})
    want = []
    for i, ns in zip(left["i"], left["ns"]):
        every = sorted((-min(4, len({*ns} & {*x})), at) for at, x in zip(right["at"], right["ns"]) if len({*ns} & {*x}) >= 2)
        want += [(i, at, -s) for s, at in every[:3]]
    for at_once in (1, 200, 10**6):
        got = matching._best_of_block(left, right, 3, 4, at_once)
        assert Counter(map(tuple, got[["i", "at", "shared"]].to_numpy().tolist())) == Counter(want)
    assert not len(matching._best_of_block(left[:0], right, 3, 4)) and not len(matching._best_of_block(left, right[:0], 3, 4))


def test_nearest_moves_few_of_dense_points(spark):
    # Points as dense as 1,600 in a cell of 300 metres, copies, and objects with several points.
    left = spark.range(800).selectExpr("id as a", "cast(id * 7 % 293 as double) as x", "cast(id * 11 % 281 as double) as y").unionByName(spark.createDataFrame([(9000, 5000.0, 5000.0), (9001, 5200.0, 5000.0)], "a long, x double, y double"))
    right = spark.range(1600).selectExpr("id div 2 as b", "cast(id * 13 % 299 as double) + 0.5 as x", "cast(id * 17 % 277 as double) as y").unionByName(spark.createDataFrame([(i, 5000.0, 5100.0) for i in range(70)], "b long, x double, y double"))
    found, ask, have = [], left.collect(), right.collect()
    count = moved(spark, lambda: found.extend(spatial.nearest(left, right, 300.0, 3).collect()))
    got = {}
    for r in found:
        got.setdefault(r.a, []).append((round(r.meters, 6), r.b))
    for p in ask:
        best = {}
        for q in have:
            m = ((p.x - q.x) ** 2 + (p.y - q.y) ** 2) ** 0.5
            if m <= 300:
                best[q.b] = min(m, best.get(q.b, m))
        assert sorted(got.get(p.a, [])) == sorted((round(m, 6), b) for m, b in sorted((m, b) for b, m in best.items())[:3])
    assert count < 800 * 100
    scored = spatial.best_nearby(left.limit(50).withColumn("cap", F.lit(80)), right)
    assert {r.a: (r.b, r.score) for r in scored.collect()} == {a: (min(rows)[1], 80) for a, rows in got.items() if a < 50}


def test_circles_end_when_nothing_is_settled(spark):
    up = spark.range(3, 3000).selectExpr("cast(id as string) as child", "cast(id div 3 as string) as parent").unionByName(spark.createDataFrame([("x", "y"), ("y", "x"), ("z", "x")], "child string, parent string"))
    known, found = spark.createDataFrame([("1", "S1")], "node string, site_id string"), []
    count = moved(spark, lambda: found.extend(plant.reached(up, known).collect()))
    got = {r.node: r for r in found}
    assert got["2187"].site_id == "S1" and got["2187"].steps == 7 and got["1"].steps == 0
    assert {got[n].state for n in "xyz"} == {"cycle"} and got["2186"].state == "none" and len(got) == 3002
    assert count < 50_000


def test_ends_without_label_are_dealt_out(spark):
    label = "case when id % 4 = 0 then 'nation 7' when id % 401 = 1 then 'Nation-8' end"
    ends = spark.range(4000).selectExpr("cast(id as string) as lease_id", "'L1' as endpoint_label", "'a' as housing_type", "cast(id as string) as housing_oid", "'b' as object_type", "cast(id as string) as object_oid", f"{label} as reference_label")
    links = spark.createDataFrame([("b", "5", "S5", "n", "gdb_relation", 100)], "object_type string, object_oid string, site_id string, site_name string, rule_name string, score int")
    sites = spark.createDataFrame([("S7", 1, ["Nation 7"]), ("S8", 2, ["NATION 8"])], "site_id string, ordinal int, names array<string>")
    set_to = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in set_to.items():
        spark.conf.set(k, v)
    try:
        got = plant.end_sites(ends, links, sites).withColumn("at", F.spark_partition_id()).collect()
    finally:
        for k in set_to:
            spark.conf.unset(k)
    want = {str(i): "S5" if i == 5 else "S7" if i % 4 == 0 else "S8" if i % 401 == 1 else None for i in range(4000)}
    assert {r.lease_id: r.site_id for r in got} == want and len(got) == 4000
    assert max(Counter(r.at for r in got).values()) < 2400


def test_stops_of_a_route_are_compared_once(spark):
    rows = spark.range(200).selectExpr("id as resolution_id", "'R1' as route_ref", "concat('site ', id % 3) as site_a", "'le SITE 1 nord' as site_z")
    routes = spark.createDataFrame([("R1", "TOIP 1")], "route_id string, route_ref string")
    stops = spark.range(20_000).selectExpr("'R1' as route_id", "concat('Site ', id % 2) as site", "if(id % 2 = 0, 'depart', 'passage') as step_type")
    found = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count = moved(spark, lambda: found.extend(validation.route_checks(rows, routes, stops).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Site 0 is an end, site 1 a stop, site 2 neither; site Z holds site 1.
    assert {(r.resolution_id % 3, r.score) for r in found} == {(0, 78), (1, 60), (2, 45)} and len(found) == 200
    assert count < 10_000


def test_addresses_of_a_street_are_joined_once(spark):
    addresses = spark.range(20_000).selectExpr("lpad(id, 6, '0') as ban_id", "cast(id % 50 + 1 as string) as house_number", "'LYON' as normalized_city", "'RUE A' as normalized_street_name", "'RUE A LYON' as normalized_label", "'69001' as postcode", "1D as x_l93", "2D as y_l93", "1 as reuse_count", "'precise' as reuse_class", "100 as reuse_score")
    parsed = spark.createDataFrame([("a", "rue a", "Lyon", "7", None), ("b", "rue a", "Lyon", "777", None), ("c", "rue a", "Lyon", None, None), ("RUE A LYON", "", "", None, None), ("", "", "Lyon", None, "69001"), ("", "", "Lyon", "3", None)], "normalized_value string, street string, city string, house_number string, postcode string")
    found = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count = moved(spark, lambda: found.extend(signals.address_matches(parsed, addresses).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {(r.normalized_value, r.house_number_hint): (r.match_score, r.ban_id, r.x) for r in found}
    assert got == {("a", "7"): (98, "000006", 1.0), ("b", "777"): (90, "000000", 1.0), ("c", None): (90, "000000", 1.0), ("RUE A LYON", None): (94, "000000", 1.0), ("", None): (45, "000000", None), ("", "3"): (35, "000000", None)}
    assert count < 5000


def test_cables_by_places_move_no_pairs(spark):
    n = 400
    services = spark.range(n).selectExpr("cast(id as string) as service_id", "concat('alpha bravos client', id % 50) as client_final", "concat('town', id % 7) as endpoint_z_raw", "'' as endpoint_a_raw", "'' as principal_external_ref")
    tokens = "array('ALPHA', 'BRAVOS', concat('CLIENT', id % 60), concat('TOWN', id % 5), concat('X', id))"
    cables = spark.range(n).selectExpr("lpad(id, 4, '0') as cable_id", "if(id % 3 = 0, null, cast(id % 40 as int)) as number_of_fibers", f"{tokens} as site_tokens", *(f"cast(null as double) as geom_{e}_{c}" for e in ("centroid", "start", "end") for c in "xy"))
    seeds = spark.createDataFrame([], "service_id string, source_column string, signal_kind string, semantic_strength string, source_priority int, match_score int, pick int, x double, y double, reuse_score int, reuse_class string, reuse_count int")
    signals, found = spark.createDataFrame([], "service_id string, signal_kind string, site_tokens array<string>"), []
    count = moved(spark, lambda: found.extend(reconcile.place_cables(services, signals, seeds, cables).collect()))
    mine = [{"ALPHA", "BRAVOS", f"CLIENT{i % 50}", f"TOWN{i % 7}"} for i in range(n)]
    theirs = [{"ALPHA", "BRAVOS", f"CLIENT{i % 60}", f"TOWN{i % 5}"} for i in range(n)]
    want = {(str(i), f"{j:04d}"): (len(a & b), 96 if j % 3 and j % 40 <= 24 else 92) for i, a in enumerate(mine) for j, b in enumerate(theirs)}
    assert {(r.service_id, r.cable_id): (r.overlap, r.score) for r in found} == want and len(found) == n * n
    assert count < n * n / 4


def test_counted_pairs_over_a_grid(spark):
    left = spark.range(60).selectExpr("id", "explode(array_distinct(array('a', concat('b', id % 3), concat('c', id % 4), concat('d', id)))) as token")
    right = spark.range(50).selectExpr("id div 2 as of", "if(id < 6, null, id) as other", "explode(array_distinct(array('a', concat('b', id % 5), concat('c', id % 2)))) as token").distinct()
    side = lambda i: {"a", f"b{i % 3}", f"c{i % 4}"}
    have = {}
    for r in right.collect():
        have.setdefault((r["of"], r.other), set()).add(r.token)
    want = {(i, *k): len(side(i) & ts) for i in range(60) for k, ts in have.items()}
    for of in (1, 7, 1000):
        got = matching.counted_pairs(left, right, of).collect()
        assert {(r.id, r["of"], r.other): r.shared for r in got} == want and len(got) == len(want)
    assert not matching.counted_pairs(left, right.limit(0)).collect()


def test_housings_of_sites_move_no_pairs(spark):
    n, sites, each = 3000, 30, 40
    ends = spark.range(n).selectExpr("cast(id as string) as service_id", f"concat('S', id % {sites}) as matched_site_id")
    housings = spark.range(sites * each).selectExpr("cast(id as string) as housing_id", f"concat('S', id % {sites}) as site_id", "if(id = 0, 10.0D, null) as geom_x", "if(id = 0, 10.0D, null) as geom_y")
    seeds = spark.createDataFrame([("30", "c", "city_only", "strong", 1, 90, 1, 10.0, 20.0, 100, "precise", 1)], "service_id string, source_column string, signal_kind string, semantic_strength string, source_priority int, match_score int, pick int, x double, y double, reuse_score int, reuse_class string, reuse_count int")
    found = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        count = moved(spark, lambda: found.extend(reconcile.site_housings(ends, seeds, housings).select("service_id", "housing_id", "score", "spatial_distance").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len({(r.service_id, r.housing_id) for r in found}) == len(found) == n * each
    assert all(int(r.service_id) % sites == int(r.housing_id) % sites for r in found)
    assert [(r.service_id, r.housing_id, r.score, r.spatial_distance) for r in found if r.score != 78 or r.spatial_distance is not None] == [("30", "0", 90, 10.0)]
    assert count < n * each / 4


def test_letters_that_fold_to_several_are_sought_fast(spark):
    import time

    from skein.functions import text

    rows = spark.range(0, 60, 1, 1).select(F.concat(F.repeat(F.lit("lorem ipsum dolor sit amet "), 4000), F.lit("é"), F.col("id").cast("string")).alias("t"))

    def seconds(pattern):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            assert rows.where(F.col("t").rlike(pattern)).count() == 0
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds(text._LONG) < 0.7 * seconds(text._ranges(text._SEVERAL))
    assert spark.createDataFrame([("\ufb01bre",), ("\U0001f130 x \U0001f100",), ("é",)], "t string").select(F.col("t").rlike(text._LONG).alias("x")).collect() == [(True,), (True,), (False,)]


def test_published_rows_are_made_once(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    final = spark.range(2000).selectExpr("id as service_id", "if(id % 3 = 0, null, concat('s', id % 2)) as publication_status", "concat('t', id % 4) as selected_truth_source", "if(id % 5 = 0, 'P', ' ') as final_party_id", "'S' as site_a_id", "'' as site_z_id")
    tables = {n: none("service_id long") for n in ("lines", "optical", "network", "parties", "devices", "vlans")} | {
        "services": none("nature_service string"), "endpoints": none("service_id long, matched_site_id string"), "evidence": none("service_id long, score int, evidence_type string"),
        "gold": none("match_state string"), "queue": none("current_state string"), "final": final.repartition(3),
    }
    found = []
    count = moved(spark, lambda: found.extend(reporting.figures(tables).collect()))
    got = {(r.section, r.name): r.value for r in found if r.section.startswith("Final")}
    want = {("Final publication", n): v for n, v in (("Published rows", 2000), ("Rows with final party", 400), ("Rows with site A", 2000), ("Rows with site Z", 0), ("Rows with network support", 0), ("Rows with optical support", 0), ("Rows with usable spatial evidence", 0))}
    want |= {("Final truth sources", f"t{i}"): 500 for i in range(4)} | {("Final publication statuses", s): n for s, n in ((None, 667), ("s0", 666), ("s1", 667))}
    assert got == want
    assert count < 3000


def test_signals_of_several_parts_move_as_one_row(spark):
    # Every signal stands in three parts; service 0 has 4,000 of them, the others 10 each.
    n, hot = 300, 4000
    services = spark.range(n).selectExpr("id as service_id", "cast(null as string) as principal_client", "cast(null as string) as client_final")
    signals = spark.range(hot + 10 * (n - 1)).selectExpr(
        f"if(id < {hot}, 0, 1 + (id - {hot}) div 10) as service_id", "lpad(id, 6, '0') as source_column", "'v' || id as raw_value", "if(id % 2 = 0, 'postal_address_precise', 'mixed_site_address') as signal_kind", "0 as signal_score", "1 as source_priority", "false as is_noise"
    )
    none = lambda columns: spark.createDataFrame([], columns)
    parties, aliases = none("party_id string, canonical_name string"), none("party_id string, alias_value string, normalized_alias string")
    given, seeds = none("service_id long, role_name string, party_id string, rule_name string, score int"), none("service_id long, source_column string, raw_value string, match_rule string, match_score int, seed_priority int")
    evidence = none("service_id long, target_table string, target_id string, distance_meters double, adjusted_score int, rule_name string")
    found = []
    count = moved(spark, lambda: found.extend(bundles.decision_pack(services, given, aliases, parties, signals, seeds, evidence).collect()))
    got = {r.service_id: r for r in found}
    told = lambda xs: [x.raw_value for x in xs]
    assert told(got[0].signals) == [f"v{i}" for i in range(40)] and told(got[0].site_signals) == told(got[0].address_signals) == [f"v{i}" for i in range(5)] and got[0].seeds == []
    assert told(got[7].signals) == [f"v{hot + 60 + i}" for i in range(10)] and told(got[7].address_signals) == [f"v{hot + 60 + i}" for i in range(5)] and len(got) == n
    # Twice each signal of the others, and services; of service 0 no more than 40 of each kind from a task.
    assert count < 2 * 10 * n + 8 * n


def test_supports_by_reference_move_no_pairs(spark, monkeypatch):
    # Each service has references of its own choice, which all meet many targets; every third target has two.
    n, m = 300, 3000
    monkeypatch.setattr(candidates, "PIECE", 100)
    services = spark.range(n).selectExpr("id as service_id", "array(concat('S', id % 3), concat('S', 3 + id % 5), concat('T', id), null, concat('S', id % 3)) as refs")
    ref = "explode(if(id % 3 = 0, array(concat('S', id % 8), concat('S', id * 7 % 8)), array(concat('S', id % 8), null))) as ref"
    routes, housings = (spark.range(m).selectExpr(ref, f"concat('{k}', id) as target") for k in "RH")
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        count = moved(spark, lambda: found.extend(candidates.supports_by_reference(services, "refs", {"route": routes, "housing": housings}).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    of = lambda i: {i % 8, i * 7 % 8} if i % 3 == 0 else {i % 8}
    want = sorted((s, k, f"{t}{i}", rule, score) for s in range(n) for i in range(m) if of(i) & {s % 3, 3 + s % 5} for k, t, rule, score in (("route", "R", "route_ref_exact", 100), ("housing", "H", "housing_route_ref_exact", 82)))
    assert sorted(tuple(r) for r in found) == want
    assert count < 12 * (n + m)


def test_vlan_hunt_moves_services_once(spark):
    n = 400
    none = "cast(null as string)"
    services = spark.range(n).selectExpr("id as service_id", f"{none} as client_final", f"{none} as principal_client", "'OPE7/L2L9' as principal_external_ref", "array() as service_refs", f"{none} as endpoint_a_raw", f"{none} as endpoint_z_raw", f"{none} as site_a_name", f"{none} as site_z_name")
    lines = spark.range(2).selectExpr("concat('i', id) as interface_id", "concat('dev', id) as device_name", "'Gi' as interface_name", "concat('vers ope7/l2l9 /', 77 + id) as description", "array() as service_refs", "array() as vlan_ids")
    tables = {
        "signals": spark.createDataFrame([], "service_id long, route_refs array<string>"), "subinterfaces": spark.createDataFrame([], "device_name string, interface_name string, vlan_id int, site_code string, xconnect_circuit_id string"),
        "interfaces": lines, "swag": lines.limit(0).withColumnRenamed("device_name", "hostname"), "cpes": spark.createDataFrame([], "service_id long, hostname string"),
        "vlans": spark.range(40).selectExpr("concat('V', lpad(id, 2, '0')) as network_vlan_id", "cast(77 + id % 2 as int) as vlan_id", "'z' as device_name", "concat('label ', id) as label"),
    }
    found = []
    count = moved(spark, lambda: found.extend(vlan_hunt.hunt(services, tables).collect()))
    want = [(s, str(77 + i), f"V{2 * k + i:02}") for s in range(n) for i in range(2) for k in range(8)]
    assert sorted((r.service_id, r.vlan_id, r.network_vlan_id) for r in found) == sorted(want)
    # 16 rows a service are found.
    assert count < 16 * n


def test_route_hunt_moves_services_once(spark):
    n, m = 400, 30
    none = "cast(null as string)"
    services = spark.range(n).selectExpr("id as service_id", "'Norbert' as client_final", *(f"{none} as {c}" for c in ("principal_client", "principal_external_ref", "endpoint_a_raw", "endpoint_z_raw", "site_a_id", "site_a_name", "site_z_id", "site_z_name")))
    empty = lambda schema: spark.createDataFrame([], schema)
    tables = {
        "signals": empty("service_id long, route_refs array<string>"), "lease_ends": empty("optical_lease_id string, endpoint_label string, site_id string"), "stops": empty("route_ref string, step_no int, site string"),
        "leases": spark.range(m).selectExpr("lpad(id, 2, '0') as optical_lease_id", "concat('R', id) as ref_exploit", f"{none} as reference", f"{none} as client", f"{none} as lessee", "'pour norbert' as comments"),
        "housings": empty("housing_id string, migration_oid string, site_id string, site_name string"), "connections": empty("housing_oid string, obj1_type string, obj1_oid string, obj2_type string, obj2_oid string"),
        "cables": empty("cable_id string, cable_oid string, reference string, userreference string"),
    }
    marks = spark.range(n).selectExpr("id as service_id", "'R3' as route_ref", "70 as coherence")
    found = []
    count = moved(spark, lambda: found.extend(route_hunt.hunt(services, tables, marks).collect()))
    got = sorted((r.service_id, r.candidate, r.lease_id, r.source, r.coherence) for r in found)
    assert got == sorted((s, f"R{i}", f"{i:02}", "lease_comment_token_match", 70 if i == 3 else 0) for s in range(n) for i in range(12))
    # 12 rows a service are found.
    assert count < 24 * n


def test_common_words_move_few_texts(spark):
    n, most = 4000, 3
    texts = spark.range(n).selectExpr("id as text_id", "concat('alpha bravo charlie delta, ', array_join(split(id, ''), ' ')) as text")
    patterns = spark.createDataFrame([("alpha",), ("rav",), ("elta,",), ("pha br",)], "pattern string")
    found = []
    count = moved(spark, lambda: found.extend(substrings.contained(patterns, texts, [], most).collect()))
    assert sorted((r.pattern, r.text_id) for r in found) == sorted((p, i) for p in ("alpha", "rav", "elta,", "pha br") for i in range(most))
    # Texts move where a pattern has a blank, once to count its grams and once to compare.
    assert count < 2 * n + 1000
