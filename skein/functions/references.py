"""References in free text: routes, services, fibres, VLANs, offers, groups of contract lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skein.functions.text import hash16, norm_text, ordered_union

# The reference formats and the offers' (nature, role).
ROUTE = r"(?i)\b(TOIP\s*\d+|00FT\s*\d+|FREE\s*\d+|SFRH\d+|OPSC\s*\d+|9CIP\s*\d+|COMP\s*\d+|BOUY\s*\d+)\b"
SERVICE = r"(?i)\b((?:OPE|PE)\s*\d+)\s*[/_-]?\s*(L2L\s*\d+)\b"
FIBERS = r"(?i)\b(\d{1,3})\s*FO\b"
OFFERS = {
    "fibre-longue distance-iru": ("IRU FON", "principal"),
    "fibre-longue distance-maintenance": ("IRU FON", "maintenance"),
    "fibre-metro-iru": ("IRU FON", "principal"),
    "fibre-metro-maintenance": ("IRU FON", "maintenance"),
    "fibre-longue distance-location": ("Location FON", "principal"),
    "fibre-metro-location": ("Location FON", "principal"),
    "fibre-metro-location escomptee": ("Location FON", "principal"),
    "lien ethernet - 1-100 mbits": ("Lan To Lan", "principal"),
    "lien sdh - e1 (2 mbits)": ("Lan To Lan", "principal"),
    "netcenter lan - divers": ("Lan To Lan", "annexe"),
    "netcenter lan - extra works": ("Lan To Lan", "frais_acces"),
    "emplacement baie - 48v - 1, 3 ou 5 ans": ("Hebergement", "principal"),
    "netcenter baie - divers": ("Hebergement", "annexe"),
    "fibre - extra works": ("Hebergement", "frais_acces"),
}
VLAN_LINES = [
    "switchport trunk allowed vlan", "port trunk allow-pass vlan", "port hybrid tagged vlan", "port hybrid untagged vlan",
    "port hybrid pvid vlan", "port default vlan", "port access vlan",
]
WIDEST_RANGE = 512


def route_refs(*texts: Column) -> Column:
    """Distinct route references in order, upper case, inner space as one space."""
    found = [F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(ROUTE), F.lit(1)) for t in texts]
    return F.array_distinct(F.transform(F.concat(*found), lambda r: F.upper(F.regexp_replace(r, r"\s+", " "))))


def service_refs(*texts: Column) -> Column:
    """Distinct `LEFT/RIGHT` service references in order, without inner space."""
    bare = lambda c: F.upper(F.regexp_replace(c, r"\s+", ""))
    pick = lambda t, g: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(SERVICE), F.lit(g))
    each = [F.zip_with(pick(t, 1), pick(t, 2), lambda a, b: F.concat(bare(a), F.lit("/"), bare(b))) for t in texts]
    return ordered_union(*each)


def fiber_count(*texts: Column) -> Column:
    """The first number of fibres named in the texts, null if none is."""
    return F.coalesce(*(F.expr("try_cast(null as int)") if t is None else F.nullif(F.regexp_extract(F.coalesce(t, F.lit("")), FIBERS, 1), F.lit("")).cast("int") for t in texts))


def vlan_list(text: Column) -> Column:
    """Distinct numbers of a list such as `vlan 578-584,598`; ranges wider than WIDEST_RANGE are left out."""
    cleaned = F.replace(F.regexp_replace(text, r"(?i).*?vlan(?:\s+add)?\s+", ""), F.lit("to"), F.lit("-"))
    low = lambda t: F.regexp_extract(t, r"^(\d{1,9})(?:-\d{1,9})?$", 1).cast("int")
    high = lambda t: F.regexp_extract(t, r"^(?:\d{1,9}-)?(\d{1,9})$", 1).cast("int")
    parts = F.filter(F.split(cleaned, r"[,\s]+"), lambda t: t.rlike(r"^\d{1,9}(-\d{1,9})?$"))
    fit = F.filter(parts, lambda t: (low(t) <= high(t)) & (high(t) - low(t) <= WIDEST_RANGE))
    return F.array_distinct(F.flatten(F.transform(fit, lambda t: F.sequence(low(t), high(t)))))


def line_vlans(line: Column) -> Column:
    """VLANs of a configuration line, empty unless the line is one that assigns VLANs."""
    assigns = F.lower(line).rlike("|".join(VLAN_LINES))
    return F.when(assigns, vlan_list(line)).otherwise(F.array().cast("array<int>"))


def text_vlans(text: Column) -> Column:
    """VLAN numbers that a label may name; years (four digits from 20) are left out."""
    t = F.coalesce(text, F.lit(""))
    found = [F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in (r"/(\d{2,4})\b", r"(?i)\bVLAN[ _-]?(\d{2,4})\b", r"\b(\d{2,4})\b")]
    return F.filter(ordered_union(*found), lambda v: ~v.rlike(r"^20\d\d$"))


def classify_offer(label: Column, offers: dict[str, tuple[str, str]] = OFFERS) -> Column:
    """struct(nature, role): known offers by label, others by what their label contains."""
    as_struct = lambda nature, role: F.struct(F.lit(nature).alias("nature"), F.lit(role).alias("role"))
    known = F.create_map(*(x for k, (n, r) in offers.items() for x in (norm_text(F.lit(k)), as_struct(n, r))))
    normed = norm_text(label)
    other = (
        F.when(F.contains(normed, F.lit("MAINTENANCE")), as_struct("IRU FON", "maintenance"))
        .when(F.contains(normed, F.lit("EXTRA WORKS")), as_struct("Lan To Lan", "frais_acces"))
        .otherwise(as_struct("A qualifier", "principal"))
    )
    return F.coalesce(F.try_element_at(known, normed), other)


def grouping_key(client, nature, role, routes, services, end_a, end_z, final, contract, command) -> Column:
    """Which lines form one service: by service reference, route, contract file, or what is left."""
    party = norm_text(client)
    by_ref = lambda kind, refs: F.concat_ws("|", F.lit(kind), F.get(refs, 0), party, nature)
    return (
        F.when(F.size(services) > 0, by_ref("SVCREF", services))
        .when(F.size(routes) > 0, by_ref("ROUTE", routes))
        .when(norm_text(contract) != "", F.concat(F.lit("CONTRACT|"), hash16(client, contract, nature)))
        .when(role != "principal", F.concat(F.lit("AUX|"), hash16(client, nature, end_a, end_z, final)))
        .otherwise(F.concat(F.lit("FALLBACK|"), hash16(client, nature, end_a, end_z, final, command)))
    )


def without_suffix(text: Column) -> Column:
    """A number without its last `.3` or `-3`."""
    return F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"^(.+)[.\-]\d+$", "$1")


def contract_base(file: Column) -> Column:
    return F.trim(without_suffix(F.regexp_replace(F.trim(F.coalesce(file, F.lit(""))), r"(?i)\.pdf$", "")))
