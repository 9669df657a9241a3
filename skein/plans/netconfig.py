"""Router configurations as tables: devices, interface and VLAN blocks, sub-interfaces, search.

A file is exploded to lines; a running count of block starts and ends numbers the blocks; the rest
are aggregates by file and block. A file is one device's configuration, which bounds a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.functions.references import line_vlans, route_refs, service_refs
from skein.functions.text import clean_label, first_filled, hash16, norm_text
from skein.operators.ranking import numbered

# The lines that begin and end a block, and what is read from them. `(?i)` stands for
# the flag that ignores case; nothing else differs.
INTERFACE_START = r"(?i)^interface\s+(.+)$"
ETHERNET_START = r"(?i)^ethernet\s+(\d+)$"
VLAN_START = r"(?i)^vlan\s+(\d+)$"
BLOCK_ENDS = ["#", "!", "exit"]
DESCRIPTION = r'(?i)^(?:description\s+|name\s+")(.+?)(?:"$)?$'
ANNOUNCEMENT = r"(?i)announcement\s+'([^']+)'"
LOCATION = r'(?i)location\s+"([^"]+)"'
RAD_SYSTEM_NAME = r'(?i)^name\s+"([^"]+)"$'
HOSTNAME = r"(?i)\bsysname\s+([^\s]+)|\bhostname\s+([^\s]+)"
HEADER = r'(?i)header shell information\s+"([^"]+)"'
HEADER_CLIENT_SITE = r"(?i)CLIENT\s*:\s*(.*?)\s+SITE\s*:\s*(.*?)\s+DSP\s*:"
ANNOUNCED_SITE = r"(?i)SITE\s+(.+?)--"
ANNOUNCED_CLIENT = r"(?i)L2 RAD\s+\S+\s+(.+?)--SITE"
VLAN_IN_TEXT = r"(?i)\bvlan\s+(\d+)\b"
SUBINTERFACE = r"^(\S+)\.(\d+)$"
DOT1Q = r"(?i)encapsulation\s+dot1[qQ]\s+(\d+)"
XCONNECT = r"(?i)xconnect\s+(\S+)\s+(\d+)"
SITE_CODE = r"(?i)((?:60|80)[a-z]{2,4}\d)"
#: By file name and by device name, the first that fits.
FAMILIES = [("co", "_CO_", "-CO-"), ("sws", "_SWS_", "-SWS-"), ("sw", "_SW_", "-SW-"), ("sec", "_SEC_", "-SEC-"), ("cpe_example", "EXEMPLE", None)]
_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85]"


def lines(files: DataFrame) -> DataFrame:
    """(source_file, line_no from 1, line) of (source_file, payload)."""
    return files.select("source_file", F.posexplode(F.split("payload", _LINE_END)).alias("i", "line")).select("source_file", (F.col("i") + 1).alias("line_no"), "line")


def sessions(rows: DataFrame, keys: list[str], order: str, start: Column, end: Column) -> DataFrame:
    """rows with block, the number of the block they are in, and in_block. A block goes from a start
    to the next start or end."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("__start", F.coalesce(start, F.lit(False))).withColumn("__edge", F.col("__start") | F.coalesce(end, F.lit(False)))
    out = out.withColumn("block", F.count_if(F.col("__edge")).over(w))
    inside = F.max("__start").over(Window.partitionBy(*keys, "block"))
    return out.withColumn("in_block", inside & (~F.col("__edge") | F.col("__start"))).drop("__start", "__edge")


def _strip(c: Column) -> Column:
    return F.trim(c, F.lit(_SPACE))


def _group(c, pattern: str, g: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, g), F.lit(""))


def _last(value: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), F.col("line_no")))


def _stripped(numbered_lines: DataFrame) -> DataFrame:
    return numbered_lines.withColumn("t", _strip(F.col("line")))


def _after(word: str) -> Column:
    """What follows this word and one space, null where the line does not begin so."""
    t = F.col("t")
    return F.when(F.lower(t).startswith(word + " "), _strip(F.substring(t, F.lit(len(word) + 2), F.length(t))))


def _label() -> Column:
    return F.coalesce(_after("description"), F.trim(_after("name"), F.lit('"')))


def interfaces(numbered_lines: DataFrame) -> DataFrame:
    """One row per interface block: interface_name, description (all descriptions and names in it),
    vlan_ids, references of both and normalized_label."""
    t = F.col("t")
    start = t.rlike(INTERFACE_START) | t.rlike(ETHERNET_START)
    in_blocks = sessions(_stripped(numbered_lines), ["source_file"], "line_no", start, t.isin(BLOCK_ENDS)).where("in_block")
    first = F.col("line_no") == F.min("line_no").over(Window.partitionBy("source_file", "block"))
    in_blocks = in_blocks.withColumn("__first", first)
    text = F.when(~F.col("__first"), F.coalesce(_label(), _strip(_group("t", DESCRIPTION))))
    ordered = lambda value: F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull() & (value != ""), F.struct("line_no", value.alias("v"))))), lambda s: s["v"])
    name = F.when(F.col("__first"), F.coalesce(_strip(_group("t", INTERFACE_START)), F.concat(F.lit("ethernet "), _group("t", ETHERNET_START))))
    blocks = in_blocks.groupBy("source_file", "block").agg(
        F.max(name).alias("interface_name"), F.array_join(ordered(text), " | ").alias("description"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(~F.col("__first"), line_vlans(t)))))).alias("vlan_ids"),
    )
    both = [F.col("interface_name"), F.col("description")]
    return blocks.select(
        "source_file", "block", "interface_name", "description", "vlan_ids", route_refs(*both).alias("route_refs"), service_refs(*both).alias("service_refs"),
        clean_label(first_filled(F.col("description"), F.col("interface_name"))).alias("normalized_label"),
    )


def vlans(numbered_lines: DataFrame) -> DataFrame:
    """One row per VLAN block outside interface blocks: vlan_id, label (its last description or name),
    references and normalized_label."""
    t = F.col("t")
    start = t.rlike(INTERFACE_START) | t.rlike(ETHERNET_START)
    marked = sessions(_stripped(numbered_lines), ["source_file"], "line_no", start, t.isin(BLOCK_ENDS))
    # Interface blocks are taken out; what follows one is the line that ends it, and ends a VLAN block too.
    outside = marked.where("not in_block").drop("block", "in_block")
    blocks = sessions(outside, ["source_file"], "line_no", t.rlike(VLAN_START), t.isin(BLOCK_ENDS)).where("in_block")
    label = F.coalesce(_last(_label()), F.lit(""))
    out = blocks.groupBy("source_file", "block").agg(F.max(_group("t", VLAN_START)).cast("int").alias("vlan_id"), label.alias("label"))
    named = F.col("label")
    return out.select("source_file", "block", "vlan_id", "label", route_refs(named).alias("route_refs"), service_refs(named).alias("service_refs"), clean_label(named).alias("normalized_label"))


def subinterfaces(numbered_lines: DataFrame) -> DataFrame:
    """One row per block of a sub-interface: interface_name, parent_interface, vlan_id (the last
    encapsulation, else the number in the name), description (the last), site_code, xconnect_ip,
    xconnect_circuit_id and route_refs. The caller passes the files of one family."""
    t = F.col("t")
    in_blocks = sessions(_stripped(numbered_lines), ["source_file"], "line_no", t.rlike(INTERFACE_START), t.isin(BLOCK_ENDS)).where("in_block")
    blocks = in_blocks.groupBy("source_file", "block").agg(
        F.max(_strip(_group("t", INTERFACE_START))).alias("interface_name"), F.coalesce(_last(_after("description")), F.lit("")).alias("description"),
        _last(_group("t", DOT1Q)).alias("dot1q"), _last(_group("t", XCONNECT)).alias("xconnect_ip"), _last(_group("t", XCONNECT, 2)).alias("xconnect_circuit_id"),
    )
    name = F.col("interface_name")
    return blocks.where(name.rlike(SUBINTERFACE)).select(
        "source_file", "block", "interface_name", _group(name, SUBINTERFACE).alias("parent_interface"), F.coalesce("dot1q", _group(name, SUBINTERFACE, 2)).cast("int").alias("vlan_id"),
        "description", F.lower(F.regexp_extract("description", SITE_CODE, 1)).alias("site_code"), "xconnect_ip", "xconnect_circuit_id", route_refs(F.col("description")).alias("route_refs"),
    )


def vendor(payload: Column) -> Column:
    head, whole = F.upper(F.substring(payload, 1, 500)), F.upper(payload)
    has = lambda c, x: F.contains(c, F.lit(x))
    return (
        F.when(has(head, "RANCID-CONTENT-TYPE: HUAWEI") | has(head, "HWTACACS"), "huawei").when(head.startswith("VERSION ") | has(head, "HOSTNAME "), "cisco")
        .when(has(whole, "ANNOUNCEMENT '-----CPE L2 RAD") | has(head, "ETX"), "rad").otherwise("unknown")
    )


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def family(source_file: Column, device_name: Column) -> Column:
    name, device = F.upper(_file_name(source_file)), F.upper(device_name)
    out = None
    for kind, in_name, in_device in FAMILIES:
        test = F.contains(name, F.lit(in_name))
        test = test if in_device is None else test | F.contains(device, F.lit(in_device))
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("config")


def devices(files: DataFrame) -> DataFrame:
    """One row per file: device_name, vendor, source_family, announcement, header_info, location,
    client_hint, site_hint, references, vlans and normalized_label."""
    stem = F.regexp_replace(_file_name(F.col("source_file")), r"\.[^.]*$", "")
    name = F.coalesce(_group("payload", HOSTNAME), _group("payload", HOSTNAME, 2), _group("payload", RAD_SYSTEM_NAME), stem)
    empty = lambda c: F.coalesce(c, F.lit(""))
    read = files.select(
        "source_file", "payload", name.alias("device_name"), empty(_strip(_group("payload", ANNOUNCEMENT))).alias("announcement"),
        empty(_strip(_group("payload", HEADER))).alias("header_info"), empty(_strip(_group("payload", LOCATION))).alias("location"),
    )
    header = lambda g: _strip(F.regexp_extract("header_info", HEADER_CLIENT_SITE, g))
    announced = lambda p: _strip(F.regexp_extract("announcement", p, 1))
    texts = [F.col(c) for c in ("payload", "announcement", "header_info")]
    return read.select(
        "source_file", "device_name", vendor(F.col("payload")).alias("vendor"), family(F.col("source_file"), F.col("device_name")).alias("source_family"), "announcement", "header_info", "location",
        empty(first_filled(header(1), announced(ANNOUNCED_CLIENT))).alias("client_hint"), empty(first_filled(header(2), F.col("location"), announced(ANNOUNCED_SITE))).alias("site_hint"),
        route_refs(*texts).alias("route_refs"), service_refs(*texts).alias("service_refs"),
        _vlan_numbers().alias("vlans"),
        norm_text(F.concat_ws(" ", "device_name", "announcement", "header_info", "location")).alias("normalized_label"),
    )


def _vlan_numbers() -> Column:
    found = F.transform(F.regexp_extract_all("payload", F.lit(VLAN_IN_TEXT), F.lit(1)), lambda v: v.try_cast("int"))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def cpe_configs(files: DataFrame) -> DataFrame:
    """One row per equipment file: config_id, file_name, hostname (empty if none is named), header_info,
    references, vlans and normalized_payload, the first 2,000 characters normalised."""
    name = _file_name(F.col("source_file"))
    host = F.coalesce(_group("payload", HOSTNAME), _group("payload", HOSTNAME, 2), F.lit(""))
    return files.select(
        F.concat(F.lit("CFG-"), hash16(name, host)).alias("config_id"), name.alias("file_name"), host.alias("hostname"), F.regexp_extract("payload", HEADER, 1).alias("header_info"),
        service_refs(F.col("payload")).alias("service_refs"), route_refs(F.col("payload")).alias("route_refs"), _vlan_numbers().alias("vlans"), norm_text(F.substring("payload", 1, 2000)).alias("normalized_payload"),
    )


def with_ids(rows: DataFrame, order: list[str], prefix: str, width: int, hashed: list[str], out: str) -> DataFrame:
    """rows with an id from their number in this order and a hash of these columns."""
    ids = numbered(rows, order, out, prefix, width)
    return ids.withColumn(out, F.concat_ws("-", out, hash16(*(F.col(c).cast("string") for c in hashed))))


def network(files: DataFrame) -> dict[str, DataFrame]:
    """devices, interfaces, vlans and subinterfaces of (source_file, payload), with ids in the order of
    files and lines. Sub-interfaces are read from the files of the family `co`."""
    device = with_ids(devices(files), ["source_file"], "NDV-", 6, ["source_file", "device_name"], "device_id")
    head = device.select("source_file", "device_id", "device_name", "source_family")
    rows = lines(files)
    of = lambda df: df.join(head, "source_file")
    core = rows.join(head.where("source_family = 'co'").select("source_file"), "source_file", "left_semi")
    order = ["source_file", "block"]
    return {
        "devices": device,
        "interfaces": with_ids(of(interfaces(rows)), order, "NIF-", 7, ["device_id", "interface_name", "description"], "network_interface_id").drop("block"),
        "vlans": with_ids(of(vlans(rows)), order, "NVL-", 7, ["device_id", "vlan_id", "label"], "network_vlan_id").drop("block"),
        "subinterfaces": with_ids(of(subinterfaces(core)), order, "CSI-", 6, ["device_id", "interface_name"], "co_subif_id").drop("block"),
    }


def grep(rows: DataFrame, keys: list[str], order: str, line: str, pattern: str, context: int = 2) -> DataFrame:
    """Lines that match, and those up to context lines away, with is_match."""
    found = rows.withColumn("is_match", F.col(line).rlike(pattern))
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-context, context)
    return found.withColumn("__near", F.max("is_match").over(w)).where("__near").drop("__near")


def search(files: DataFrame, pattern: str, device: str = "", vendor_name: str = "", limit: int = 50) -> DataFrame:
    """The first matches, in order of files and lines, with two lines of context: source_file, line_no,
    line, is_match. device and vendor_name narrow the files; limit counts matches."""
    known = devices(files).where(F.contains(F.upper("device_name"), F.lit(device.upper())))
    if vendor_name:
        known = known.where(F.col("vendor") == vendor_name.lower())
    rows = lines(files.join(known.select("source_file"), "source_file", "left_semi"))
    hits = rows.where(F.col("line").rlike(pattern)).select("source_file", "line_no").orderBy("source_file", "line_no").limit(limit)
    near = hits.select("source_file", F.explode(F.sequence(F.col("line_no") - 2, F.col("line_no") + 2)).alias("line_no"), F.col("line_no").alias("hit"))
    marks = near.groupBy("source_file", "line_no").agg(F.max(F.col("line_no") == F.col("hit")).alias("is_match"))
    return rows.join(F.broadcast(marks), ["source_file", "line_no"])


def read_config(files: DataFrame, source_file: str, limit: int = 5000) -> DataFrame:
    """The first lines of one file."""
    return lines(files.where(F.col("source_file") == source_file)).where(F.col("line_no") <= limit).orderBy("line_no")


# What a file's name says of its vendor, the first that fits.
NAME_VENDORS = [("RAD", ["rad"]), ("Cisco", ["co-", "sec-", "bas-"]), ("Huawei", ["sw-", "sws-"]), ("Huawei", ["3328", "5328", "5624"])]


def _base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def vendor_of_name(path: Column) -> Column:
    """The vendor that the name of a file hints at, else `unknown`."""
    name, out = F.lower(_base_name(path)), F.lit("unknown")
    for vendor_name, parts in reversed(NAME_VENDORS):
        out = F.when(name.rlike("|".join(parts)), vendor_name).otherwise(out)
    return out


def device_of_name(path: Column) -> Column:
    """The host in the name of a collected file (`..._rancidIP_bea1-co-1.teloise...`), else the name
    without its last suffix."""
    stem = F.regexp_replace(_base_name(path), r"(?<=.)\.[^.]*$", "")
    host = F.regexp_extract(stem, r"rancidIP_([^.]+)\.teloise", 1)
    return F.when(host != "", host).otherwise(stem)
