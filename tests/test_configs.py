"""Router configurations: blocks, VLANs, devices, search; the log as a stream."""

from skein.plans import netconfig
from skein.streaming import resolutions as stream

CISCO = """hostname com1-co-1
snmp-server location Senlis
interface GigabitEthernet0/0/0.2255
 encapsulation dot1Q 2255
 description Vers TOIP 0181 60cml1
 description second
 xconnect 10.0.0.1 181 encapsulation mpls
!
interface Gi0/1
 switchport trunk allowed vlan 578-580,598
vlan 99
 switchport access vlan 7
!
vlan 12
 name CLIENT-LAN2LAN/Mairie/12
#
vlan 13
"""
RAD = 'announcement \'ETX\'\nname "rad-7"\nCLIENT : Acme SITE : SENLISDSP : x\nethernet 1\n name "port OPE1-L2L2"\nexit\n'


HUAWEI = """# RANCID-CONTENT-TYPE: huawei
header shell information "CLIENT : Acme SITE : SENLIS DSP : x"
sysname sen1-sws-1
interface Eth-Trunk1
 description first
exit-address-family
 port trunk allow-pass vlan 5 to 7
# not an end
 name "quoted"
#
vlan 30
 description old
 name new
interface Gi0/9
 snmp-agent location "Rue Foch"
"""
RAD_TEXT = "announcement '-----CPE L2 RAD dev-1 Beta Corp--SITE Creil Nord--'\n" + "x\n" * 400


def table(spark):
    files = [("d/a_CO_1.txt", CISCO), ("d/b.txt", RAD), ("d/empty.txt", ""), ("d/h.txt", HUAWEI), ("d/late.txt", "z\n" * 400 + RAD_TEXT)]
    return spark.createDataFrame(files, "source_file string, payload string")


def test_blocks(spark):
    lines = netconfig.lines(table(spark))
    got = {(r.source_file, r.interface_name): r for r in netconfig.interfaces(lines).collect()}
    sub = got["d/a_CO_1.txt", "GigabitEthernet0/0/0.2255"]
    assert (sub.description, sub.route_refs, sub.normalized_label) == ("Vers TOIP 0181 60cml1 | second", ["TOIP 0181"], "60CML1 SECOND")
    assert got["d/a_CO_1.txt", "Gi0/1"].vlan_ids == [7, 578, 579, 580, 598] and got["d/a_CO_1.txt", "Gi0/1"].normalized_label == "GI0 1"
    assert got["d/b.txt", "ethernet 1"].service_refs == ["OPE1/L2L2"]
    # Only a line that is an end ends a block.
    trunk = got["d/h.txt", "Eth-Trunk1"]
    assert (trunk.description, trunk.vlan_ids) == ("first | quoted", [5, 7])
    assert sorted((r.source_file, r.vlan_id, r.label) for r in netconfig.vlans(lines).collect()) == [("d/a_CO_1.txt", 12, "CLIENT-LAN2LAN/Mairie/12"), ("d/a_CO_1.txt", 13, ""), ("d/h.txt", 30, "new")]


def test_subinterfaces(spark):
    only = netconfig.network(table(spark))["subinterfaces"].collect()
    assert [(r.interface_name, r.parent_interface, r.vlan_id, r.description, r.site_code, r.xconnect_ip, r.xconnect_circuit_id) for r in only] == [("GigabitEthernet0/0/0.2255", "GigabitEthernet0/0/0", 2255, "second", "", "10.0.0.1", "181")]
    assert only[0].co_subif_id.startswith("CSI-000001-") and only[0].device_name == "com1-co-1"


def test_devices_and_search(spark):
    got = {r.source_file: r for r in netconfig.devices(table(spark)).collect()}
    a, b, h, late = (got[f"d/{x}.txt"] for x in ("a_CO_1", "b", "h", "late"))
    assert (a.device_name, a.vendor, a.source_family, a.location, a.vlans) == ("com1-co-1", "cisco", "co", "", [7, 12, 13, 99, 578])
    # A name counts where it is the whole file, a header where it is announced as one.
    assert (b.device_name, b.vendor, b.source_family, b.client_hint, b.site_hint) == ("b", "rad", "config", "", "")
    assert (h.device_name, h.vendor, h.source_family, h.client_hint, h.site_hint, h.location) == ("sen1-sws-1", "huawei", "sws", "Acme", "SENLIS", "Rue Foch")
    assert (late.vendor, late.client_hint, late.site_hint) == ("rad", "Beta Corp", "Creil Nord")
    assert got["d/empty.txt"].device_name == "empty" and got["d/empty.txt"].vendor == "unknown"
    hits = netconfig.grep(netconfig.lines(table(spark)), ["source_file"], "line_no", "line", "xconnect")
    assert sorted((r.line_no, r.is_match) for r in hits.collect()) == [(5, False), (6, False), (7, True), (8, False), (9, False)]
    found = netconfig.search(table(spark), "(?i)description", device="com1")
    assert sorted((r.line_no, r.is_match) for r in found.collect()) == [(3, False), (4, False), (5, True), (6, True), (7, False), (8, False)]
    assert netconfig.search(table(spark), "(?i)description", limit=1).where("is_match").count() == 1
    assert [r.line_no for r in netconfig.read_config(table(spark), "d/b.txt", 2).collect()] == [1, 2]
    config = {r.file_name: r for r in netconfig.cpe_configs(table(spark)).collect()}
    assert (config["b.txt"].hostname, config["h.txt"].hostname, config["h.txt"].header_info) == ("", "sen1-sws-1", "CLIENT : Acme SITE : SENLIS DSP : x")


def test_stream(spark, tmp_path):
    fields = "service_id string, created_at timestamp, resolution_id string"
    rows = lambda *x: spark.sql(" union all ".join(f"select '{a}' service_id, timestamp '{b}' created_at, '{c}' resolution_id" for a, b, c in x))
    rows(("s1", "2024-01-01", "r1"), ("s2", "2024-01-01", "r2")).coalesce(1).write.parquet(f"{tmp_path}/in/1")
    spark.sql("set spark.sql.streaming.schemaInference=true")
    for i, new in enumerate([None, rows(("s1", "2024-01-02", "r3"), ("s1", "2024-01-02", "r4"))]):
        if new is not None:
            new.coalesce(1).write.parquet(f"{tmp_path}/in/2")
        q = stream.start(spark, f"{tmp_path}/in/*", fields, f"{tmp_path}/latest", f"{tmp_path}/check")
        q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/latest/version=1")
    assert sorted((r.service_id, r.resolution_id) for r in got.collect()) == [("s1", "r4"), ("s2", "r2")]
