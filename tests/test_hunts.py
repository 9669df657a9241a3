"""Hunts, bundles, the plant and the published table on small tables with results known beforehand."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from skein.functions import geometry
from skein.operators import spatial, substrings
from skein.plans import bundles, candidates, final_table, plant, reporting, route_hunt, vlan_hunt
from skein.sources import layers

NONE = "cast(null as string)"


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_contained_is_every_part(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("ab é\n") for _ in range(n))
    texts = [(rng.choice("xy"), i, word(rng.randrange(0, 30))) for i in range(60)] + [("x", 100 + i, "abab aéa") for i in range(30)] + [("x", 200, None), ("y", 201, "𝄞𝄞ab")]
    patterns = [(rng.choice("xy"), word(rng.randrange(0, 7))) for _ in range(80)] + [("x", None), ("x", ""), ("y", "𝄞ab"), ("x", "a"), ("y", "abab aé")]
    got = substrings.contained(table(spark, "k string, pattern string", *patterns), table(spark, "k string, text_id int, text string", *texts), ["k"])
    want = {(k, p, i) for k, p in patterns if p for k2, i, t in texts if k == k2 and t is not None and p in t}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert substrings.contained(table(spark, "pattern string"), table(spark, "text_id int, text string"), []).count() == 0


def test_contained_keeps_the_least_of_a_pattern(spark):
    texts = [("x", i, f"the same {w} t{i:03}") for i in range(300) for w in ("word", "swords")]
    patterns = [("x", "word"), ("x", "same"), ("x", "same sword"), ("y", "word")]
    got = substrings.contained(table(spark, "k string, pattern string", *patterns), table(spark, "k string, text_id int, text string", *texts), ["k"], 3)
    assert sorted((r.pattern, r.text_id) for r in got.collect()) == [(p, i) for p in ("same", "same sword", "word") for i in range(3)]


def test_nearest_by_rings(spark):
    rng = random.Random(9)
    left = [(i, rng.uniform(-900, 900), rng.uniform(-900, 900)) for i in range(40)] + [(90, None, 0.0), (91, 5e6, 5e6)]
    # A dense spot, and objects of several points.
    right = [(i % 70, rng.uniform(-900, 900), rng.uniform(-900, 900)) for i in range(140)] + [(100 + i, rng.gauss(0, 20), rng.gauss(0, 20)) for i in range(60)]
    got = spatial.nearest(table(spark, "a int, x double, y double", *left), table(spark, "b int, x double, y double", *right), 300.0, 5).collect()
    for a, x, y in left:
        best = {}
        if x is not None:
            for b, u, v in right:
                if math.hypot(x - u, y - v) <= 300:
                    best[b] = min(best.get(b, 1e9), math.hypot(x - u, y - v))
        want = sorted((round(m, 6), b) for b, m in best.items())[:5]
        assert sorted((round(r.meters, 6), r.b) for r in got if r.a == a) == want


def test_parents_reach_their_site(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(700)] + [("c1", "c2"), ("c2", "c3"), ("c3", "c1"), ("d", "c1"), ("s1", "s2"), ("s2", "s1"), ("e", "n5"), ("e", "a-first"), (None, "x"), ("y", None)]
    got = {r.node: (r.site_id, r.steps, r.state) for r in plant.reached(table(spark, "child string, parent string", *chain), table(spark, "node string, site_id string", ("n700", "TOP"), ("n3", "LOW"), ("s1", "S"), ("alone", "A"))).collect()}
    assert got["n0"] == ("LOW", 3, "site") and got["n3"] == ("LOW", 0, "site") and got["n4"] == ("TOP", 696, "site") and got["alone"] == ("A", 0, "site")
    assert got["c2"] == (None, None, "cycle") and got["d"][2] == "cycle" and got["s2"] == ("S", 1, "site") and got["e"] == (None, None, "none") and got["x"][2] == "none" and "y" not in got


def _point(x, y, order="<"):
    return struct.pack(order + "BIdd", order == "<", 1, x, y)


def _line(points, order="<"):
    return struct.pack(order + "BII", order == "<", 2, len(points)) + b"".join(struct.pack(order + "dd", *p) for p in points)


def test_well_known_binary(spark):
    ps = [(652381.123456, 6862047.5), (-1e-310, 1 / 3), (0.0, 1.5e300)]
    shapes = {
        "point": (_point(1 / 3, -2 / 7), [(1 / 3, -2 / 7)]), "big": (_point(1e9, 0.1, ">"), [(1e9, 0.1)]), "z": (struct.pack("<BIddd", 1, 1001, 5.5, 6.5, 9.0), [(5.5, 6.5)]), "line": (_line(ps), ps),
        "lines": (struct.pack("<BII", 1, 5, 2) + _line(ps[:2]) + _line(ps[1:], ">"), ps[:2] + ps[1:]), "points": (struct.pack(">BII", 0, 4, 2) + _point(1, 2, ">") + _point(3, 4), [(1, 2), (3, 4)]),
        "ring": (struct.pack("<BIII", 1, 3, 1, 3) + b"".join(struct.pack("<dd", *p) for p in ps), ps), "srid": (struct.pack("<BII", 1, 0x20000001, 2154) + struct.pack("<dd", 7, 8), [(7, 8)]),
        "other": (struct.pack("<BII", 1, 7, 0), None), "short": (b"\1", None), "null": (None, None),
    }
    got = table(spark, "n string, g binary", *((n, g) for n, (g, _) in shapes.items())).select("n", geometry.points(F.col("g")).alias("p")).collect()
    assert {r.n: None if r.p is None else [(p.x, p.y) for p in r.p] for r in got} == {n: p for n, (_, p) in shapes.items()}


def _lambert2(lon, lat):
    """Degrees on the newer datum to the older conic, by textbook formulas the other way round."""
    a80, e80 = 6378137.0, 2 / 298.257222101 - 1 / 298.257222101**2
    lam, phi = math.radians(lon), math.radians(lat)
    n = a80 / math.sqrt(1 - e80 * math.sin(phi) ** 2)
    x, y, z = n * math.cos(phi) * math.cos(lam) + 168, n * math.cos(phi) * math.sin(lam) + 60, n * (1 - e80) * math.sin(phi) - 320
    a, f = 6378249.2, 1 / 293.4660212936269
    e2 = 2 * f - f * f
    e, p = math.sqrt(e2), math.hypot(x, y)
    lat2 = math.atan2(z, p * (1 - e2))
    for _ in range(20):
        lat2 = math.atan2(z + e2 * a / math.sqrt(1 - e2 * math.sin(lat2) ** 2) * math.sin(lat2), p)
    iso = lambda v: math.log(math.tan(math.pi / 4 + v / 2) * ((1 - e * math.sin(v)) / (1 + e * math.sin(v))) ** (e / 2))
    lat0 = math.radians(52 * 0.9)
    k = math.sin(lat0)
    r0 = 0.99987742 * a / math.sqrt(1 - e2 * k * k) / math.tan(lat0)
    r = r0 * math.exp(-k * (iso(lat2) - iso(lat0)))
    turn = k * (math.atan2(y, x) - math.radians(2.33722916666666667))
    return 600000 + r * math.sin(turn), 2200000 + r0 - r * math.cos(turn)


def test_older_projection(spark):
    places = [(2.2945, 48.8583), (2.3365, 46.8), (-4.4, 48.4), (7.75, 48.58), (5.37, 43.3), (2.08, 49.43)]
    rows = [(i, *_lambert2(*p)) for i, p in enumerate(places)]
    got = table(spark, "i int, x double, y double", *rows).select("i", geometry.from_lambert2(F.col("x"), F.col("y")).alias("d"), geometry.to_metres(F.col("x"), F.col("y"), F.lit("EPSG:27572")).alias("m")).collect()
    straight = table(spark, "i int, lon double, lat double", *((i, *p) for i, p in enumerate(places))).select("i", spatial.to_lambert93(F.col("lon"), F.col("lat")).alias("m"))
    want = {r.i: r.m for r in straight.collect()}
    for r in got:
        assert abs(r.d.lon - places[r.i][0]) < 1e-8 and abs(r.d.lat - places[r.i][1]) < 1e-8
        assert math.hypot(r.m.x - want[r.i].x, r.m.y - want[r.i].y) < 0.01
    # The centre of the older conic lies on the older meridian of Paris at 52 grades, some metres off on the newer datum.
    centre = table(spark, "x double, y double", (600000.0, 2200000.0)).select(geometry.from_lambert2(F.col("x"), F.col("y")).alias("d")).first().d
    assert abs(centre.lon - 2.3372) < 0.001 and abs(centre.lat - 46.8) < 0.001


def test_layers_become_tables(spark, tmp_path):
    names = "MIGRATION_OID string, REFERENCE string, USERREFERENCE string, COMMENTS string, geometry binary, crs string"
    for n in layers.HOUSINGS:
        table(spark, names, (f"M-{n} ", "POP Senlis", None, None, bytearray(_point(650000.0, 6900000.0)), "EPSG:2154"), (" ", "x", None, None, None, None)).write.parquet(f"{tmp_path}/{n}")
    old = bytearray(_line([(600000.0, 2200000.0), (600100.0, 2200000.0)]))
    table(spark, names, ("C1", "Senlis 24 FO Creil", None, None, old, "NTF (Paris) / Lambert II"), ("C2", None, "usr", None, None, None)).write.parquet(f"{tmp_path}/Fiber_Cable")
    for n in layers.RELATIONS:
        kind = layers.COLUMNS[n]
        table(spark, f"{kind['object_oid']} string, {kind['hubsite_oid']} string", ("o1 ", "h1")).write.parquet(f"{tmp_path}/{n}")
    found = layers.housings(spark, str(tmp_path)).collect()
    assert sorted(r.migration_oid for r in found) == sorted(f"M-{n}" for n in layers.HOUSINGS) and {(r.geom_x, r.geom_y, r.srid) for r in found} == {(650000.0, 6900000.0, "EPSG:2154")}
    cable = {r.cable_oid: r for r in layers.cables(spark, str(tmp_path)).collect()}
    assert cable["C1"].number_of_fibers == 24 and cable["C1"].site_tokens == ["SENLIS", "CREIL"] and cable["C1"].srid == "EPSG:27572"
    assert abs(math.dist((cable["C1"].geom_start_x, cable["C1"].geom_start_y), (cable["C1"].geom_end_x, cable["C1"].geom_end_y)) - 100) < 0.2
    assert cable["C2"].geom_start_x is None and cable["C2"].normalized_ref == "USR"
    assert sorted(tuple(r) for r in layers.relations(spark, str(tmp_path)).collect()) == [("Chamber", "o1", "h1"), ("SupportStructure", "o1", "h1")]


def test_vlan_hunt(spark):
    services = table(spark, "service_id string, client_final string, principal_client string, principal_external_ref string, service_refs array<string>, endpoint_a_raw string, endpoint_z_raw string, site_a_name string, site_z_name string",
        ("s1", "Norbert Dentressangle", None, "OPE7/L2L9", None, None, None, "POP Compiegne", None), ("s2", "Ville de Creil", None, None, None, None, "Zygomorphe 12", None, None), ("s3", None, None, None, None, None, None, None, None))
    tables = {
        "signals": table(spark, "service_id string, route_refs array<string>", ("s1", ["TOIP 2079"]), ("s3", ["TOIP 1"])),
        "subinterfaces": table(spark, "device_name string, interface_name string, vlan_id int, site_code string, xconnect_circuit_id string", ("COM1-CO-1", "Gi0.511", 511, "60cml1", "2079"), ("COM1-CO-1", "Gi0.77", 77, None, "9")),
        "interfaces": table(spark, "interface_id string, device_name string, interface_name string, description string, service_refs array<string>, vlan_ids array<string>", ("i1", "com1-sw-1", "Gi1", "vers ope7/l2l9 /77", None, None), ("i2", "x", "Gi2", "Client ZYGOMORPHE vlan 2024 et 33", None, ["44"])),
        "swag": table(spark, "interface_id string, hostname string, interface_name string, description string, service_refs array<string>"),
        "vlans": table(spark, "network_vlan_id string, vlan_id int, device_name string, label string", ("V1", 511, "COM1-SW-1", "DENTRESSANGLE"), ("V2", 77, "com1-sw-1", "DENTRESSANGLE"), ("V3", 900, "z", "VREG_ZYGOMORPHE")),
        "cpes": table(spark, "service_id string, hostname string"),
    }
    got = vlan_hunt.hunt(services, tables).collect()
    of = lambda s, **k: [r for r in got if r.service_id == s and all(r[c] == v for c, v in k.items())]
    circuit = of("s1", network_vlan_id="V1")[0]
    # Its circuit and its label speak for 511; on another device the label names 77, so they do not compete.
    assert circuit.sources == ["toip_xconnect", "label_match"] and circuit.proof_level == "strong" and circuit.place == 1 and "circuit:2079 COM1-CO-1 Gi0.511" in circuit.evidence_for and circuit.competing is None
    by_ref = of("s1", network_vlan_id="V2")[0]
    assert by_ref.sources == ["service_ref_interface", "label_match"] and by_ref.evidence_for[-1] == "active:COM1"
    pool = of("s2", network_vlan_id="V3")[0]
    assert pool.proof_level == "weak" and pool.evidence_against == ["pool:"]
    named = {r.vlan_id: r for r in of("s2", device_name="x")}
    assert set(named) == {"44", "33"} and all(r.proof_level == "weak" and r.evidence_against == [f"no_row:{v}"] for v, r in named.items())
    assert not of("s3")


def test_route_hunt_folds_sources(spark):
    fields = ["client_final", "principal_client", "principal_external_ref", "endpoint_a_raw", "endpoint_z_raw", "site_a_id", "site_a_name", "site_z_id", "site_z_name"]
    services = table(spark, "service_id string, " + ", ".join(f"{c} string" for c in fields), ("s1", "Norbert Dentressangle", None, "TOIP 7", None, None, "A", "Creil Nord", "Z", "Senlis Gare"), ("s2", *[None] * 9))
    leases = table(spark, "optical_lease_id string, ref_exploit string, reference string, client string, lessee string, comments string", ("L1", "TOIP 7", None, None, None, "pour NORBERT x dentressangle"), ("L2", "toip 71", None, None, None, None), ("L3", None, None, None, None, "norbert seul"))
    tables = {
        "signals": table(spark, "service_id string, route_refs array<string>", ("s1", ["TOIP 7"])), "leases": leases,
        "lease_ends": table(spark, "optical_lease_id string, endpoint_label string, site_id string", ("L1", "A", "A"), ("L1", "Z", "Z"), ("L2", "A", "Z")),
        "stops": table(spark, "route_ref string, step_no int, site string", ("FREE 1", 1, "pop senlis"), ("FREE 2", 1, "SENLIS gare"), ("FREE 2", 2, "Creil")),
        "housings": table(spark, "housing_id string, migration_oid string, site_id string, site_name string", ("H1", "M1", "Z", None)),
        "connections": table(spark, "housing_oid string, obj1_type string, obj1_oid string, obj2_type string, obj2_oid string", ("M1", "Fiber_Cable", "K1", "Rack", "M9")), "cables": table(spark, "cable_id string, cable_oid string, reference string, userreference string", ("C1", "K1", " ", "U1")),
    }
    marks = table(spark, "service_id string, route_ref string, coherence int", ("s1", "toip 71", 80))
    got = {r.candidate: r for r in route_hunt.hunt(services, tables, marks).collect()}
    whole = got["TOIP 7"]
    assert whole.sources == ["ref_exploit_exact", "toip_lease", "lease_endpoint", "lease_site_pair_view", "site_z_lease_presence", "lease_comment_token_match"]
    assert (whole.evidence, whole.proof_level, whole.source, whole.lease_id, whole.place) == ("direct", "strong", "ref_exploit_exact", "L1", 2)
    other = got["toip 71"]
    assert (other.source, other.band, other.place, other.sources) == ("toip_lease", "strong", 1, ["toip_lease", "lease_endpoint", "site_z_lease_presence"])
    assert (got["LEASE:L3"].evidence, got["FREE 1"].source, got["FREE 2"].source, got["FREE 2"].proof_level) == ("context", "parcours_site_z", "parcours_site_pair", "medium")
    assert got["HOUSING:H1"].facts == ["cables:U1"] and {r.service_id for r in got.values()} == {"s1"}


def test_groups_replace_whole(spark):
    blank = dict.fromkeys(["party_final_id", "resolved_site_a_id", "resolved_site_z_id", "site_a", "site_z", *final_table.OPTICAL, *final_table.AGENT_NETWORK, "inferred_vlans", "optical_support_ref", "network_support_id"])
    schema = "service_id string, status string, " + ", ".join(f"{c} string" for c in blank)
    res = lambda s, status="validated", **k: (s, status, *(blank | k).values())
    log = table(spark, schema, res("s1", cable_id="C9", network_vlan_id="V9", site_a="POP creil", site_z="twice"), res("s2", optical_support_ref=" LS1 ", site_a="nowhere", network_support_id="dev"), res("s3", "rejected", route_ref="X"), res("s4", optical_support_ref="unknown", inferred_vlans="[5]"))
    supports = ", ".join(f"{c} string" for c in final_table.OPTICAL)
    row = lambda s, score, **k: (s, score, *(dict.fromkeys(final_table.OPTICAL) | k).values())
    optical = table(spark, f"service_id string, score int, {supports}", row("s1", 100, route_ref="R1", route_id="RT1", lease_id="L1"), row("s2", 90, route_ref="R2"), row("s2", 60, lease_id="LS1", housing_id="H1"), row("s3", 80, cable_id="C3"))
    network = table(spark, "service_id string, score int, " + ", ".join(f"{c} string" for c in final_table.NETWORK), ("s1", 90, "IF1", "NI1", None, None, None), ("s4", 90, "IF4", None, None, "CPE4", None))
    services = table(spark, "service_id string, nature_service string", ("s1", "Lan To Lan"), ("s2", "IRU FON"), ("s3", "IRU FON"), ("s4", "Hebergement"), ("s5", "Hebergement"))
    golden = table(spark, "service_id string, match_state string, contract_party_id string, final_party_id string, site_a_id string, site_z_id string", *((s, "auto_valid", "P1", "P2", "S1", None) for s in ("s1", "s3", "s4")), ("s2", "review_required", "P1", " ", None, "S2"))
    sites = table(spark, "site_id string, site_name string, names array<string>", ("S1", "One", ["Pop Créil", "TWICE"]), ("S2", "Two", ["twice", "other"]))
    got = {r.service_id: r for r in final_table.publish(services, golden, optical, network, log, sites, table(spark, "party_id string, canonical_name string", ("P2", "Beta")), table(spark, "service_id string, line_ids array<string>", ("s1", ["L"]), ("s3", ["L"]), ("s4", ["L"]))).collect()}
    a = got["s1"]
    # The resolution names a cable alone: route and lease of the consolidated row go. Its network group keeps the equipment's interface.
    assert (a.cable_id, a.route_ref, a.route_id, a.lease_id, a.optical_source, a.spatial_best_object_id) == ("C9", None, None, None, "agent_validated", "C9")
    assert (a.interface_id, a.network_interface_id, a.network_vlan_id, a.network_source) == ("IF1", None, "V9", "agent_validated")
    assert (a.published_site_a_id, a.site_a_source, a.published_site_z_id, a.site_z_source) == ("S1", "agent_validated", None, "agent_hint_unmapped") and "missing_logical_route_ref" in a.gap_flags
    b = got["s2"]
    assert (b.lease_id, b.housing_id, b.route_ref, b.optical_source, b.network_source, b.site_a_source, b.published_site_z_name) == ("LS1", "H1", None, "agent_validated", "agent_hint_unmapped", "agent_hint_unmapped", "Two") and b.publication_status == "needs_review"
    assert (got["s3"].optical_source, got["s3"].cable_id, got["s3"].selected_truth_source) == ("missing", "C3", "gold_auto_valid")
    assert (got["s4"].cpe_id, got["s4"].interface_id, got["s4"].network_source, got["s4"].optical_source) == (None, "IF4", "agent_validated", "agent_hint_unmapped")
    assert got["s5"].selected_truth_source == "fallback_bss_only" and len(got) == 5


def test_bundles_are_cut_in_order(spark):
    services = table(spark, "service_id int, principal_client string, client_final string", (1, "ACME!", "Beta"), (2, None, None))
    signals = table(spark, "service_id int, source_column string, raw_value string, signal_kind string, signal_score int, source_priority int, is_noise boolean", *((1, f"c{i:03}", f"v{i}", "city_only" if i % 2 else "technical_site_anchor", i, 1, i == 7) for i in range(100)))
    evidence = table(spark, "service_id int, target_table string, target_id string, distance_meters double, adjusted_score int, rule_name string", (1, "ref_sites", "far", 900.0, 90, "r"), (1, "ref_sites", "near", 9.5, 90, "r"), (1, "ref_optical_cable", "best", 50.0, 99, "r"))
    seeds = table(spark, "service_id int, source_column string, raw_value string, match_rule string, match_score int, seed_priority int")
    aliases = table(spark, "party_id string, alias_value string, normalized_alias string", ("P1", "Acme", "ACME"), ("P0", "ACME sa", "ACME"))
    given = table(spark, "service_id int, role_name string, party_id string, rule_name string, score int", (1, "final_party", "P1", "a", 80), (1, "final_party", "P0", "b", 95), (3, "final_party", "P0", "b", 95))
    got = {r.service_id: r for r in bundles.decision_pack(services, given, aliases, table(spark, "party_id string, canonical_name string", ("P1", "Z"), ("P0", "A")), signals, seeds, evidence).collect()}
    one = got[1]
    assert [x.raw_value for x in one.address_signals] == ["v99", "v97", "v95", "v93", "v91"] and [x.raw_value for x in one.technical_signals] == ["v98", "v96", "v94", "v92", "v90"] and [x.raw_value for x in one.noise_signals] == ["v7"]
    assert len(one.signals) == bundles.LIMITS["signals"] and one.seeds == [] and [p.party_id for p in one.final_parties] == ["P0", "P1"] and [p.party_id for p in one.principal_aliases] == ["P0", "P1"] and one.final_aliases == []
    assert [x.target_id for x in one.site_candidates] == ["near", "far"] and one.best_spatial_evidence.target_id == "best" and [x.target_id for x in one.cable_candidates] == ["best"]
    assert set(got) == {1, 2} and got[2].signals == [] and got[2].best_spatial_evidence is None


def test_versions_of_the_log(spark, tmp_path):
    fields = "service_id string, created_at int, resolution_id string, status string, confidence string, party_final_id string"
    folder = f"{tmp_path}/log"
    reporting.append_version(table(spark, fields, ("a", 1, "r1", "proposed", "low", None), ("b", 1, "r2", "validated", "high", "P")), folder, 1)
    reporting.append_version(table(spark, fields, ("a", 2, "r3", "validated", "high", "P"), ("z", 9, "r9", "rejected", "low", None)), folder, 3)
    with pytest.raises(Exception, match="exists"):
        reporting.append_version(table(spark, fields, ("a", 5, "r5", "rejected", "low", None)), folder, 3)
    assert reporting.as_of(spark, folder, 2).count() == 2 and reporting.as_of(spark, folder, 3).count() == 4
    got = {r.version: r for r in reporting.benchmark(reporting.as_of(spark, folder, 3), table(spark, "service_id string", ("a",), ("b",), ("c",), ("a",)), [0, 1, 3]).collect()}
    assert [(got[v].services_targeted, got[v].services_touched, got[v].services_validated, got[v].services_proposed, got[v].party_final_gaps) for v in (0, 1, 3)] == [(3, 0, 0, 0, 3), (3, 2, 1, 1, 2), (3, 2, 2, 0, 1)]
    assert got[0].party_final_coverage == 0 and abs(got[3].party_final_coverage - 200 / 3) < 1e-9


def test_report_and_exports(spark, tmp_path):
    rows = table(spark, "section string, name string, value long", ("Service mix", "small", 1), ("Service mix", "large", 9), ("Scope", "Active lines loaded", 4), ("Final truth sources", "b", 1), ("Final truth sources", "a", 2))
    text = reporting.markdown(rows)
    assert text.index("Scope") < text.index("Service mix") and text.index("large: 9") < text.index("small: 1") and text.index("a: 2") < text.index("b: 1")
    queue = table(spark, "review_id int, severity string, service_id string, review_type string", *((i, ["high", "medium"][i % 2], f"s{i % 5}", f"t{i}") for i in range(40)))
    reporting.export({"service_review_queue": queue, "party_master": table(spark, "party_id string, canonical_name string", ("P", "x"))}, str(tmp_path))
    files = sorted((tmp_path / "service_review_queue").glob("part-*.csv"))
    lines = [line.split(",") for f in files for line in f.read_text().splitlines()[1:]]
    assert len(lines) == 40 and [x[1:] for x in lines] == sorted((x[1:] for x in lines), key=lambda x: (-ord(x[0][0]), x[1], x[2]))
    assert (tmp_path / "party_master").exists()


def test_cables_of_sites(spark):
    sites = table(spark, "site_id string, geom_x double, geom_y double", ("linked", 0.0, 0.0), ("near", 0.0, 0.0), ("far", 9e6, 0.0), ("nowhere", None, None))
    housings = table(spark, "site_id string, housing_id string, housing_oid string", ("linked", "H", "h"))
    connections = table(spark, "housing_oid string, obj1_type string, obj1_oid string, obj2_type string, obj2_oid string", ("h", "Rack", "r", "fiber_cable", "c1"))
    points = {f"geom_{e}_{c}": "double" for e in ("start", "end", "centroid") for c in "xy"}
    cables = table(spark, "cable_id string, cable_oid string, " + ", ".join(f"{n} {t}" for n, t in points.items()), ("C1", "c1", 500.0, 0.0, 900.0, 0.0, 300.0, 0.0), ("C2", "c2", 0.0, 300.1, None, None, None, None), ("C3", "c3", None, None, 30.0, 40.0, None, None))
    got = {tuple(r) for r in candidates.site_cables(sites, housings, connections, cables).collect()}
    assert got == {("linked", "C1", "connection", None), ("near", "C1", "nearby", 300.0), ("near", "C3", "nearby", 50.0)}
