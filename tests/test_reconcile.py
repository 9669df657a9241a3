"""From contract lines to published rows on a small corpus, with rules and scores known beforehand."""

import json

import pytest
from pyspark.sql import functions as F

from skein.plans import hunts, netconfig, parties, publication, reconcile, resolutions, services, signals, validation
from skein.operators.ranking import stored
from skein.sources import files

CONFIGS = [
    ("d/COM1_CO_1.txt", "hostname com1-co-1\ninterface GigabitEthernet0/0/0.2255\n description Vers TOIP 0181 60cml1\n encapsulation dot1Q 2256\n xconnect 10.0.0.1 181 encapsulation mpls\n!\n"),
    ("d/sw.txt", "hostname sen1-sw-1\ninterface Gi0/1\n description CLIENT-LAN2LAN/Norbert Dentressangle/511\n!\nvlan 511\n name CLIENT-LAN2LAN/Norbert Dentressangle\n!\nvlan 7\n name Zygomorphe\n!\ninterface Gi0/2\n description OPE12-L2L7 Mairie Senlis\n!\n"),
]


def line(i, offer, client="ACME", **k):
    base = dict(command_external="", contract_file="", endpoint_a_raw="", endpoint_z_raw="", client_final="", command_internal=f"{i}", client_contractant=client, offer_label=offer)
    return base | {"lea_line_id": i} | k


LINES = [
    line("L1", "lien ethernet - 1-100 mbits", command_external="OPE12/L2L7", endpoint_a_raw="POP Senlis Gare", endpoint_z_raw="Mairie de Senlis 3 rue Foch Senlis", client_final="Mairie Senlis"),
    line("L2", "fibre-metro-iru", contract_file="c1.pdf", command_external="TOIP 181", endpoint_a_raw="POP Creil Nord", endpoint_z_raw="POP Senlis Gare", client_final="Beta"),
    line("L3", "fibre-metro-location", contract_file="c2.pdf", command_external="TOIP 999", endpoint_a_raw="POP Creil Nord", endpoint_z_raw="POP Senlis Gare"),
    line("L4", "lien ethernet - 1-100 mbits", contract_file="c3.pdf", client_final="Norbert Dentressangle", endpoint_z_raw="Norbert Dentressangle"),
    line("L5", "lien ethernet - 1-100 mbits", contract_file="c4.pdf", client_final="Societe Zygomorphe", endpoint_z_raw="12 rue Foch Senlis"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    lines = services.enriched(spark.createDataFrame(LINES))
    made, links = services.service_master(lines)
    made, links = stored(made), stored(links)
    of = {r.principal_line_id: r.service_id for r in made.collect()}
    raw = df(
        [("B1", "3", "rue Foch", "60300", "Senlis", "650000", "6900000"), ("B2", "12", "rue Foch", "60300", "Senlis", "650010", "6900000"), ("B3", None, "rue Bas", "60100", "Creil", "660000", "6900000"), ("B1", "9", "rue Foch", "60300", "Senlis", "1", "1")],
        "id string, numero string, nom_voie string, code_postal string, nom_commune string, x string, y string",
    ).coalesce(1).withColumn("__row", F.monotonically_increasing_id())
    addresses = stored(files.addresses(raw))
    sites = df([("S1", 1, ["POP Senlis Gare"], 650020.0, 6900000.0, "POP Senlis Gare"), ("S2", 2, ["POP Creil Nord"], 660000.0, 6900500.0, "POP Creil Nord"), ("COM1", 3, ["Local com1"], None, None, "Local com1")], "site_id string, ordinal int, names array<string>, geom_x double, geom_y double, reference string")
    net = {k: stored(v) for k, v in netconfig.network(df(CONFIGS, "source_file string, payload string")).items()}
    none = lambda schema: df([], schema)
    t = {
        "sites": sites, "interfaces": net["interfaces"], "devices": net["devices"], "vlans": net["vlans"],
        "routes": df([("R1", "TOIP 181")], "logical_route_id string, route_ref string"), "leases": df([("LS1", "toip 555", "POP Senlis Gare", "POP Creil Nord"), ("LS2", "TOIP 181", "x", None)], "lease_id string, ref_exploit string, reference_l1 string, reference_l2 string"),
        "lease_ends": df([("LS2", "L1", "S1")], "optical_lease_id string, endpoint_label string, site_id string"), "fiber_leases": none("lease_id string, ref_exploit string"), "isp_leases": df([("I1", "TOIP 181")], "lease_id string, ref_exploit string"),
        "cables": df([("C1", "CABLE TOIP 181", None, None, 24, ["SENLIS", "CREIL"], 650000.0, 6900030.0), ("C2", "other", None, None, 144, ["CREIL"], None, None)], "cable_id string, reference string, userreference string, comments string, number_of_fibers int, site_tokens array<string>, geom_centroid_x double, geom_centroid_y double").withColumns({c: F.lit(None).cast("double") for c in ("geom_start_x", "geom_start_y", "geom_end_x", "geom_end_y")}),
        "housings": df([("H1", "S1", "CH TOIP 181", 650000.0, 6900000.0), ("H2", "S2", "CH 2", None, None)], "housing_id string, site_id string, reference string, geom_x double, geom_y double").withColumns({c: F.lit(None).cast("string") for c in ("userreference", "description", "comments")}),
        "swag": df([("IF1", ["OPE12/L2L7"])], "interface_id string, service_refs array<string>"), "configs": none("config_id string, hostname string, route_refs array<string>, service_refs array<string>, vlans array<int>"),
        "cpes": df([("CPE1", "sen1-sw-1", 1), ("CPE2", "societe-zygomorphe-9", 2)], "cpe_id string, hostname string, ordinal int"),
    }
    said = signals.service_signals(made, links, lines, addresses.select(F.col("normalized_city").alias("city")))
    said = stored(said)
    seeds = stored(signals.seeds(said, addresses))
    names = parties.names(lines, sites, net["devices"], net["interfaces"], net["vlans"])
    master, aliases = map(stored, parties.build(stored(names)))
    done = {k: stored(v) for k, v in reconcile.reconcile(made, said, seeds, t, aliases).items()}
    return dict(of=of, services=made, lines=lines, t=t, signals=said, seeds=seeds, master=master, aliases=aliases, net=net, **done)


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_signals_and_seeds(corpus):
    of = corpus["of"]
    kinds = {(r.service_id, r.source_column): r.signal_kind for r in corpus["signals"].collect()}
    assert kinds[of["L1"], "endpoint_z_raw"] == "mixed_site_address" and kinds[of["L1"], "endpoint_a_raw"] == "technical_site_anchor"
    assert kinds[of["L5"], "endpoint_z_raw"] == "postal_address_precise" and kinds[of["L2"], "principal_external_ref"] == "route_or_service_reference"
    got = {(r.service_id, r.source_column): (r.ban_id, r.match_rule, r.raw_match_score, r.match_score) for r in corpus["seeds"].collect()}
    # The house number of the one is not at the start of its text; that of the other is.
    assert got[of["L1"], "endpoint_z_raw"][1:] == ("ban_street_city", 90, 90)
    assert got[of["L5"], "endpoint_z_raw"] == ("B2", "ban_street_city", 98, 98)


def test_endpoints(corpus):
    of = corpus["of"]
    got = {(r.service_id, r.endpoint_label): r for r in corpus["endpoints"].collect()}
    assert len(got) == 2 * len(LINES)
    a, z = got[of["L1"], "A"], got[of["L1"], "Z"]
    assert (a.matched_site_id, a.score, a.rule_name) == ("S1", 100, "site_exact")
    # Any signal that names a site exactly counts for both ends.
    assert (z.matched_site_id, z.score, z.rule_name, z.signal_value) == ("S1", 100, "site_exact", "POP Senlis Gare")
    near = got[of["L5"], "Z"]
    assert (near.matched_site_id, near.rule_name, near.score, near.spatial_distance) == ("S1", "site_spatial_proximity", 98, 10.0)
    # Of two exact names the one in an end's own column counts for that end.
    assert [got[of["L2"], e].matched_site_id for e in "AZ"] == ["S2", "S1"]


def test_spatial_evidence(corpus):
    of = corpus["of"]
    found = {(r.service_id, r.evidence_type, r.target, json.loads(r.context).get("endpoint_label")): r for r in corpus["spatial"].collect()}
    site = found[of["L5"], "site_spatial", "S1", "Z"]
    assert (site.source_table, site.seed_type, site.spatial_distance, site.spatial_adjusted_score, site.rule_name, site.seed_discriminance) == ("ref_sites", "postal_address_precise", 10.0, 98, "site_spatial_proximity", 100)
    assert json.loads(site.context) == {"endpoint_label": "Z", "seed_discriminance_score": 100, "seed_precision": "precise", "seed_same_xy_count_in_city": 1}
    cable = found[of["L1"], "optical_spatial", "C1", None]
    assert (cable.source_table, cable.rule_name, json.loads(cable.context)) == ("ref_optical_cable", "address_to_cable_endpoint", {"reference": "CABLE TOIP 181"}) and cable.seed_discriminance == 100


def test_optical_supports(corpus):
    of = corpus["of"]
    got = rows(corpus["optical"].where(F.col("service_id") == of["L2"]), "kind", "target", "rule_name", "score")
    assert {("route", "R1", "route_ref_exact", 100), ("lease", "LS2", "lease_ref_exact", 95), ("isp_lease", "I1", "isp_lease_ref_exact", 95), ("cable", "C1", "cable_route_ref_exact", 95), ("housing", "H1", "housing_route_ref_exact", 82)} <= got
    assert ("cable", "C1", "cable_site_token_overlap", 96) in got and ("cable", "C2", "cable_site_token_overlap", 80) in got
    other = rows(corpus["optical"].where(F.col("service_id") == of["L3"]), "kind", "target", "rule_name", "score")
    assert ("route", None, "route_ref_exact", 0) in other
    assert ("lease", "LS1", "lease_site_pair_match", 85) in other


def test_leases_between_two_sites(spark):
    """In either order, for services whose routes nothing knows; one site at both ends is a pair as well."""
    made = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "service_id string")
    ends = spark.createDataFrame([(s, e, x) for s, a, z in (("a", "S1", "S2"), ("b", "S2", "S1"), ("c", "S1", None), ("d", "S3", "S3")) for e, x in zip("AZ", (a, z))], "service_id string, endpoint_label string, matched_site_id string")
    leases = spark.createDataFrame([("L1", " toip 5 "), ("L2", None), ("L3", "x")], "lease_id string, ref_exploit string")
    of = spark.createDataFrame([("L1", "S2", "S1"), ("L2", "S3", "S3"), ("L3", "S1", "S3")], "lease_id string, site_l1 string, site_l2 string")
    known = spark.createDataFrame([("b", "route", 100), ("a", "route", 0)], "service_id string, kind string, score int")
    got = reconcile.pair_leases(made, known, ends, leases, of).collect()
    assert {(r.service_id, r.lease_id, r.route_ref, r.score) for r in got} == {("a", "L1", "TOIP 5", 85), ("d", "L2", "", 85)}


def test_network_supports(corpus):
    of = corpus["of"]
    got = rows(corpus["network"].where(F.col("service_id") == of["L1"]), "kind", "target", "rule_name", "score")
    ids = {r.interface_name: r.network_interface_id for r in corpus["net"]["interfaces"].collect()}
    vlan = {r.vlan_id: r.network_vlan_id for r in corpus["net"]["vlans"].collect()}
    assert {("swag", "IF1", "service_ref_exact", 100), ("interface", ids["Gi0/2"], "network_interface_service_ref_exact", 95)} <= got
    device = {r.target: r for r in corpus["network"].where(F.col("service_id") == of["L1"]).where("kind = 'device'").collect()}
    assert [(r.rule_name, r.cpe_id, r.cpe_score) for r in device.values()] == [("network_device_service_ref_exact", "CPE1", 90)]
    label = rows(corpus["network"].where(F.col("service_id") == of["L4"]), "kind", "target", "rule_name", "score")
    assert {("vlan", vlan[511], "vlan_label_match", 96), ("interface", ids["Gi0/1"], "network_interface_label_match", 96)} <= label
    last = rows(corpus["network"].where(F.col("service_id") == of["L5"]), "kind", "target", "rule_name", "score")
    assert ("vlan", vlan[7], "network_vlan_token_fallback", 68) in last and ("cpe", "CPE2", "cpe_token_overlap", 40) in last


def test_parties_and_evidence(corpus):
    of = corpus["of"]
    names = {r.party_id: r.canonical_name for r in corpus["master"].collect()}
    got = {(r.service_id, r.role_name, names[r.party_id], r.rule_name, r.score) for r in corpus["parties"].collect()}
    assert (of["L1"], "contract_party", "ACME", "party_exact", 100) in got and (of["L1"], "final_party", "Mairie Senlis", "party_exact", 95) in got
    assert (of["L4"], "final_party", "Norbert Dentressangle", "network_vlan_label", 96) in got
    evidence = corpus["evidence"].collect()
    assert len({r.evidence_id for r in evidence}) == len(evidence)
    assert {"site", "party", "optical_route", "optical_lease", "optical_cable", "network_vlan", "cpe"} <= {r.evidence_type for r in evidence}


def test_published(spark, corpus):
    of = corpus["of"]
    golden = stored(publication.gold(corpus["services"], reconcile.links(corpus["endpoints"], corpus["parties"], corpus["optical"], corpus["network"])))
    row = {r.service_id: r for r in golden.collect()}
    assert row[of["L1"]].network_score == 100 and row[of["L1"]].network_id == "IF1" and row[of["L2"]].optical_id == "R1"
    log = spark.createDataFrame([(of["L5"], "validated", "P9", "S1", "S2", None, None, "dev-1"), (of["L4"], "rejected", "P8", "x", "y", None, None, None)], "service_id string, status string, final_party string, site_a string, site_z string, optical string, network string, network_hint string")
    bare = golden.where(F.col("service_id") != of["L4"])
    out = {r.service_id: r for r in publication.publish(corpus["services"], bare, log, corpus["lines"].select(F.lit(of["L1"]).alias("service_id"))).collect()}
    assert len(out) == len(LINES)
    agent, lost = out[of["L5"]], out[of["L4"]]
    assert (agent.selected_truth_source, agent.published_final_party, agent.final_party_source, agent.published_site_z) == ("agent_validated", "P9", "agent", "S2")
    assert "missing_bss_link" in agent.gap_flags and agent.publication_status == "needs_review" and "missing_bss_link" not in out[of["L1"]].gap_flags
    assert lost.selected_truth_source == "fallback_bss_only" and lost.publication_status == "needs_review" and "missing_optical_support" in lost.gap_flags and "missing_optical_support" not in lost.critical_gaps


def test_status_without_critical_gaps(spark):
    df = spark.createDataFrame([("fallback_bss_only", ["missing_optical_support"], "Lan To Lan"), ("agent_validated", [], "IRU FON"), ("gold_auto_valid", ["missing_site_z"], "Hebergement"), ("agent_validated", ["missing_site_z"], "IRU FON")], "s string, g array<string>, n string")
    got = df.select(publication.publication_status(F.col("s"), publication.critical_gaps(F.col("n"), F.col("g"))).alias("x")).collect()
    assert [r.x for r in got] == ["published_with_gaps", "published_validated", "published_from_gold", "needs_review"]


def test_anchors_topology_coherence(spark, corpus):
    of = corpus["of"]
    anchors = hunts.site_anchors(corpus["services"], corpus["endpoints"], corpus["seeds"], corpus["signals"], corpus["network"], corpus["spatial"], corpus["t"]["sites"])
    anchors = stored(anchors)
    got = {r.service_id: r for r in anchors.collect()}
    assert got[of["L2"]].recommended_entry_point == "route_ref_first" and got[of["L2"]].anchor_source == "site_gdb"
    assert got[of["L4"]].recommended_entry_point == "network_anchor_first" and got[of["L4"]].site_anchor_quality == "low"
    assert got[of["L1"]].device_prefixes == ["NAN1", "FTC1", "NET1"]
    stops = spark.createDataFrame([("TOIP 181", "RT1", 1, "DEPART", "POP Senlis Gare", "B1", None, "C-1"), ("TOIP 181", "RT1", 2, "ARRIVEE", "POP Creil Nord", None, "C-1", " ")], "route_ref string, route_id string, step_no int, step_type string, site string, bpe string, cable_in string, cable_out string")
    leases = spark.createDataFrame([("LS2", "TOIP 181 et TOIP 182"), ("LS3", "toip 181")], "optical_lease_id string, ref_exploit string")
    cables = spark.createDataFrame([("C1", "C-1", None, 650000.0, 6900000.0)], "cable_id string, reference string, userreference string, geom_centroid_x double, geom_centroid_y double").withColumns({c: F.lit(None).cast("double") for c in ("geom_start_x", "geom_start_y", "geom_end_x", "geom_end_y")})
    top = hunts.topology(spark.createDataFrame([("RT1", "TOIP 181")], "route_id string, route_ref string"), stops, leases, corpus["t"]["lease_ends"], cables)
    r = {x.route_ref: x for x in top["routes"].collect()}["TOIP 181"]
    assert (r.site_labels, r.bpe_refs, r.cable_refs, r.end_labels, r.n_leases) == (["POP Creil Nord", "POP Senlis Gare"], ["B1"], ["C-1"], ["POP Creil Nord", "POP Senlis Gare"], 2)
    assert rows(top["lease_sites"], "route_ref", "site_id") >= {("TOIP 181", "S1")}
    score = hunts.coherences(spark.createDataFrame([(of["L1"], "TOIP 181")], "service_id string, route_ref string"), anchors, top).first()
    # Tokens SENLIS, GARE and FOCH, of which two are stops: 16; lease at sites Z and A: 60; 20 m: 25; ends: 20; leases: 4.
    assert (score.coherence, score.best_distance_meters) == (16 + 60 + 25 + 20 + 4, 20.0)


def test_tokens_and_references(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(hunts.client_tokens(F.lit("Ville de Senlis 2024"), F.lit("Societe ACME Senlis"))) == ["SENLIS", "ACME"]
    assert get(hunts.site_tokens(F.lit("POP Senlis Gare"))) == ["SENLIS", "GARE"]
    assert get(hunts.tool_refs(F.array(F.lit(" ope1/l2l2 ")), F.lit("x OPE1/L2L2 locfon12"))) == ["OPE1/L2L2", "LOCFON12"]
    assert get(hunts.bare_route(F.lit("TOIP 181"))) == "181" and get(hunts.truthy(F.lit(" Yes "))) and not get(hunts.truthy(F.lit(None)))
    assert get(validation.pop_code(F.lit("bea1-co-1"))) == "BEA1" and get(validation.pop_code(F.lit("x-1"))) == ""
    assert set(get(validation.codes_in(F.lit("xCOM12 a")))) == {"XCOM1", "COM1", "OM1", "M1", "XCOM12", "COM12", "OM12", "M12"}


def test_vlan_lookup_and_circuits(spark, corpus):
    vlans = spark.createDataFrame([("V1", 5, "bea1-sw-1"), ("V2", 5, "bea1-sw-2"), ("V3", 5, "com1-sw-1"), ("V4", 5, "zzz"), ("V5", 6, "bea1-sw-1")], "network_vlan_id string, vlan_id int, device_name string")
    wanted = spark.createDataFrame([("q", 5, "bea1-sw-2", ["com1"])], "lookup_id string, vlan_id int, device_name string, prefixes array<string>")
    got = [(r.network_vlan_id, r.source) for r in hunts.vlan_lookups(wanted, vlans).orderBy("source", "ordinal", "network_vlan_id").collect()]
    assert got == [("V2", 0), ("V1", 1), ("V3", 2), ("V4", 3)]
    found = hunts.circuit_services(spark.createDataFrame([("s", "TOIP 181")], "service_id string, route_ref string"), corpus["net"]["subinterfaces"]).collect()
    assert [(r.service_id, r.interface_name, r.vlan_id, r.site_code) for r in found] == [("s", "GigabitEthernet0/0/0.2255", 2256, "60cml1")]


def test_validation(spark, corpus):
    sites = corpus["t"]["sites"]
    checks = {r.value: (r.site_id, r.score, r.passed) for r in validation.site_checks(spark.createDataFrame([("S1",), ("POP CREIL NORD",), ("Creil Nord",), ("nowhere",), (" ",)], "value string"), sites).collect()}
    assert checks == {"S1": ("S1", 100, True), "POP CREIL NORD": ("S2", 100, True), "Creil Nord": ("S2", 96, True), "nowhere": (None, 0, False)}
    rows_ = spark.createDataFrame([(1, "com1-co-1", "COM1", ""), (2, "com1-co-1", "S1", "S2"), (3, "xyz9-co-1", "S1", None), (4, "router", "S1", None), (5, "com1-co-1", None, None)], "resolution_id int, device_name string, site_a string, site_z string")
    assert {r.resolution_id: r.score for r in validation.pop_checks(rows_, sites).collect()} == {1: 85, 2: 30, 3: 0, 4: 0, 5: 0}
    routes = spark.createDataFrame([("RT1", "TOIP 181"), ("RT2", "x TOIP 7 y")], "route_id string, route_ref string")
    stops = spark.createDataFrame([("RT1", "POP Senlis Gare", "DEPART"), ("RT1", "Relais", "PASSAGE"), ("RT1", "POP Creil Nord", "ARRIVEE")], "route_id string, site string, step_type string")
    ask = [(1, "RT1", "Senlis Gare", "Creil Nord"), (2, "TOIP 181", "Senlis Gare", "Relais"), (3, "TOIP 181", "Senlis Gare", None), (4, "TOIP 181", "Relais", None), (5, "TOIP 181", "xx", "yy"), (6, "TOIP 7", "xx", "yy"), (7, "none", "xx", "yy")]
    got = validation.route_checks(spark.createDataFrame(ask, "resolution_id int, route_ref string, site_a string, site_z string"), routes, stops).collect()
    assert {r.resolution_id: (r.score, r.passed) for r in got} == {1: (97, True), 2: (78, True), 3: (72, True), 4: (45, True), 5: (20, False), 6: (60, True), 7: (0, False)}
    fields = "resolution_id string, nature_service string, resolution_status string, data_gap_reason string, site_a string, site_z string, network_support_id string, route_ref string, optical_support_ref string, party_final_id string, network_vlan_id string, network_interface_id string, cpe_id string, inferred_vlans array<string>"
    cases = {
        "ok": ("Lan To Lan", None, None, "S1", "S2", None, "RT1", None, None, "V1", None, None, None), "loop": ("IRU FON", None, None, "s1 ", "S1", None, "RT1", None, None, None, None, None, None),
        "gap": ("Lan To Lan", "declared_gap", "why", None, None, None, None, None, None, None, None, None, None), "bad gap": ("Lan To Lan", "declared_gap", " ", None, None, None, None, None, None, None, None, None, None),
        "no vlan": ("Lan To Lan", None, None, "S1", "S2", None, "RT1", None, None, None, None, None, None), "unknown": ("Hebergement", None, None, "nowhere", None, "no-device", None, None, "P?", None, None, None, None),
        "several": ("Lan To Lan", None, None, "S1", "S2", None, "RT1", None, None, "V1", None, None, ["V1", "V2"]),
    }
    named = stops.replace({"POP Senlis Gare": "S1", "POP Creil Nord": "S2"}, subset=["site"])
    t = {"sites": sites, "devices": corpus["net"]["devices"], "interfaces": corpus["net"]["interfaces"], "routes": routes, "stops": named, "parties": corpus["master"]}
    out = {r.resolution_id: r for r in validation.validate(spark.createDataFrame([(k, *v) for k, v in cases.items()], fields), t).collect()}
    assert {k: r.status for k, r in out.items()} == {"ok": "validated", "loop": "rejected", "gap": "declared_gap", "bad gap": "rejected", "no vlan": "rejected", "unknown": "needs_review", "several": "needs_review"}
    assert out["loop"].errors == ["self_loop"] and set(out["unknown"].warnings) == {"site_a_unknown", "device_unknown", "party_unknown"}


def test_resolution_log(spark, corpus):
    of, made = corpus["of"], corpus["services"]
    now = F.lit("2024-05-01 00:00:00").cast("timestamp")
    log = spark.createDataFrame([("r0", of["L1"], "high", "validated", None)], "resolution_id string, service_id string, confidence string, status string, party_final_id string").withColumn("created_at", F.lit("2024-04-01").cast("timestamp"))
    new = spark.createDataFrame([("r1", of["L2"], "low", "because"), ("r2", "none", "low", "because")], "resolution_id string, service_id string, confidence string, justification string")
    log = resolutions.appended(log, new, made, spark.createDataFrame([("r1",), ("r2",)], "resolution_id string"), now)
    assert rows(log, "resolution_id", "status") == {("r0", "validated"), ("r1", "proposed")}
    assert [r.resolution_id for r in resolutions.listed(log, made, client="acm").collect()] == ["r1", "r0"]
    assert [r.resolution_id for r in resolutions.listed(log, made, nature="lan", status="validated").collect()] == ["r0"]
    assert rows(resolutions.unresolved(made, log), "service_id") == {(of[k],) for k in ("L3", "L4", "L5")}
    queue = made.select("service_id", F.lit("manual_review").alias("review_type"))
    assert rows(resolutions.queue_summary(queue, made, log), "nature_service", "review_type", "cnt") == {("Lan To Lan", "manual_review", 2), ("Location FON", "manual_review", 1)}
    gap = lambda s, a, k, j: (s, a, ["x"], k, None, j)
    declared = spark.createDataFrame([gap(of["L3"], "both", "label_absent", "j"), gap(of["L3"], "vlan", "", "j"), gap(of["L3"], "both", "odd", "j"), gap("none", "both", "", "j"), gap(of["L3"], "both", "", " ")], "service_id string, missing_attribute string, searched_sources array<string>, observed_gap_type string, next_best_hint string, justification string")
    assert sorted(str(r.problem) for r in resolutions.gaps(declared, made, now).collect()) == ["None", "no justification", "unknown attribute", "unknown kind of gap", "unknown service"]
    told = {r.service_id: r.reasons for r in resolutions.party_gaps(log, made, corpus["parties"], corpus["aliases"]).collect()}
    assert told[of["L1"]] == ["pipeline_final_party", "client_final_raw", "principal_alias"]
    blocked = resolutions.complete(spark.createDataFrame([(of["L1"], None, "TOIP 1"), (of["L2"], None, "TOIP 1"), (of["L3"], None, None)], "service_id string, network_vlan_id string, route_ref string"), made)
    assert rows(blocked, "service_id", "blocked") == {(of["L1"], "network_vlan_id"), (of["L2"], None), (of["L3"], "route_ref")}
