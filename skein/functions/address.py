"""Addresses in free text, and what kind of hint a text is about where a service ends."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skein.functions.references import route_refs, service_refs
from skein.functions.text import let, norm_text, place_tokens, text_list, words

# Word lists and patterns.
ADDRESS_NOISE = [
    "CLIENT", "CLIENTS", "SITE", "SITES", "BATIMENT", "BAT", "BATI", "SERVICE", "SERVICES", "LIGNE", "LIGNES", "TELOISE", "ADISTA", "FRANCE",
]
STREET_TYPES = [
    "RUE", "AVENUE", "BD", "BOULEVARD", "CHEMIN", "IMPASSE", "ALLEE", "ALL", "ROUTE", "PLACE", "VOIE", "SENTE", "SQUARE", "QUAI", "COUR",
    "FAUBOURG", "RTE",
]
CITY_WORDS = {"ST": "SAINT", "STE": "SAINTE", "MT": "MONT", "GD": "GRAND", "PT": "PETIT"}
TECHNICAL = ["POP", "CHAMBRE", "BPE", "INTERCO", "NRA", "BAIE", "SHELTER", "PM"]
SITE_WORDS = ["MAIRIE", "COLLEGE", "LYCEE", "INSTITUT", "HOPITAL", "CLINIQUE", "CENTRE", "CROIX", "ROUGE", "ECOLE", "GYMNASE", "MUSEE", "CMA"]
NOISE_LABELS = ["GAR", "PASS1", "PASS2", "PASS1 ET 2", "PASS 1 ET 2", "PASS 1", "PASS 2", "N C", "NC"]
KNOWN_CITIES = [
    "AMIENS", "BEAUVAIS", "COMPIEGNE", "SENLIS", "CREIL", "NOYON", "CHANTILLY", "CLERMONT", "MERU", "LAON", "PLAILLY", "THOUROTTE", "CHAMBLY",
    "RANTIGNY", "JAUX", "GOUVIEUX", "PIERREFONDS", "RIBECOURT", "FORMERIE", "GRANDVILLIERS", "BRETEUIL", "SAINT QUENTIN", "SOISSONS", "VILLERS COTTERETS",
]
REFERENCE_WORDS = r"(?i)\b(?:TOIP|L2L|OPE|INTX|WF)\b"
#: Five digits, unless a text begins with them and a street follows (a house number) or ends with them behind
#: a technical or reference word (the number of that).
POSTCODE = rf"(?!^\d{{5}} (?:{'|'.join(STREET_TYPES)})\b)(?!(?<=\b(?:{'|'.join([*TECHNICAL, 'TOIP', 'L2L', 'OPE', 'INTX', 'WF'])}) )\d{{5}}$)\b\d{{5}}\b"
UPPER_LABEL = r"^[A-ZÀ-ÿ' -]{3,}$"
ADDRESS_START = r"(?i)\s+\d+\s+(?:rue|av(?:enue)?|route|boulevard|impasse|all[eé]e|chemin|place|r\.)\b|\s+\d{5}\s"

#: By kind: score, strength, and whether it may name an address, a site, an optical end, a route.
KINDS = {
    "mixed_site_address": (95, "strong", 1, 1, 1, 0),
    "postal_address_precise": (100, "strong", 1, 1, 0, 0),
    "postal_address_partial": (85, "medium", 1, 1, 0, 0),
    "postcode_city": (55, "weak", 1, 0, 0, 0),
    "technical_site_anchor": (82, "strong", 0, 1, 1, 0),
    "route_or_service_reference": (70, "medium", 0, 0, 1, 1),
    "site_label_business": (78, "medium", 0, 1, 1, 0),
    "city_only": (35, "weak", 1, 0, 0, 0),
    "weak_business_label": (25, "weak", 0, 0, 0, 0),
    "noise": (0, "weak", 0, 0, 0, 0),
}


def normalize_city(tokens: Column) -> Column:
    """A city's tokens without noise and with short forms written out, as text."""
    full = F.create_map(*(F.lit(x) for kv in CITY_WORDS.items() for x in kv))
    kept = F.filter(tokens, lambda t: ~t.isin(ADDRESS_NOISE))
    return F.array_join(F.transform(kept, lambda t: F.coalesce(F.try_element_at(full, t), t)), " ")


def _street_at(tokens: Column) -> Column:
    """The place of the first street word, from 1; 0 if there is none."""
    return F.array_position(F.transform(tokens, lambda t: t.isin(STREET_TYPES)), True).cast("int")


def parse_address(text: Column) -> Column:
    """struct(normalized, house_number, street_name, city, postcode). A street begins at a street
    word; the city is what follows the postcode, or the last word after a street, or the whole."""
    return let(norm_text(text), lambda normed: let(words(normed), lambda tokens: _parsed(normed, tokens)))


def _parsed(normed: Column, tokens: Column) -> Column:
    first = F.coalesce(F.get(tokens, 0), F.lit(""))
    house = F.when(first.rlike(r"^\d{1,5}[A-Z]?$"), first).otherwise("")
    rest = F.when(house != "", F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))).otherwise(tokens)
    postcode = F.regexp_extract(normed, POSTCODE, 0)
    street = lambda r: F.when(_street_at(r) > 0, F.slice(r, F.greatest(_street_at(r), F.lit(1)), F.size(r))).otherwise(F.array().cast("array<string>"))
    parts = F.struct(house.alias("house"), rest.alias("rest"), street(rest).alias("street"), postcode.alias("postcode"))
    return let(parts, lambda p: let(_city(normed, tokens, p), lambda city: _address(normed, p, city)))


def _city(normed: Column, tokens: Column, p: Column) -> Column:
    behind = words(F.regexp_extract(normed, POSTCODE + "(.*)$", 1))
    last = F.slice(p["rest"], F.greatest(F.size(p["rest"]), F.lit(1)), 1)
    length = F.size(p["street"])
    of = F.when(p["postcode"] != "", behind).when(length >= 2, last).when(length == 0, tokens).otherwise(F.array().cast("array<string>"))
    return normalize_city(of)


def _address(normed: Column, p: Column, city: Column) -> Column:
    street = p["street"]
    of_city = words(city)
    name = F.when(p["postcode"] != "", F.filter(street, lambda t: (t != p["postcode"]) & ~F.array_contains(of_city, t))).otherwise(
        F.slice(street, 1, F.greatest(F.size(street) - 1, F.lit(0)))
    )
    street_name = F.array_join(F.filter(name, lambda t: ~t.isin(ADDRESS_NOISE)), " ")
    return F.struct(normed.alias("normalized"), p["house"].alias("house_number"), street_name.alias("street_name"), city.alias("city"), p["postcode"].alias("postcode"))


def business_before_street(text: Column) -> Column:
    return let(words(norm_text(text)), _business_before_street)


def _business_before_street(tokens: Column) -> Column:
    at = _street_at(tokens)
    before = F.filter(F.slice(tokens, 1, F.greatest(at - 1, F.lit(0))), lambda t: ~t.isin(ADDRESS_NOISE))
    first = F.coalesce(F.get(before, 0), F.lit(""))
    one = (F.size(before) == 1) & (F.length(first) >= 5) & ~first.rlike("^[0-9]+$")
    return (at > 1) & ((F.size(before) >= 2) | one | F.arrays_overlap(before, text_list(*SITE_WORDS)))


def noise_label(text: Column) -> Column:
    return let(norm_text(text), _noise_label)


def _noise_label(n: Column) -> Column:
    return (F.length(n) <= 3) | n.isin(NOISE_LABELS) | n.rlike("^[0-9]+$")


def classify_signal(text: Column, known_cities: list[str] = KNOWN_CITIES) -> Column:
    """struct(kind, score, strength, is_ban, is_site, is_optical, is_route): the first kind whose
    test holds. Here known cities are a short list; where a gazetteer names them, a join says whether
    the city is known, and kind_of() takes its answer."""
    return let(parse_address(text), lambda a: signal_of(kind_of(text, a, a["city"].isin(known_cities))))


def signal_of(kind: Column) -> Column:
    return let(kind, signal_of_kind)


def kind_of(text: Column, a: Column, known_city: Column) -> Column:
    """The kind of a text with the parsed address a."""
    street, city, house, postcode = (a[k] for k in ("street_name", "city", "house_number", "postcode"))
    tokens = words(a["normalized"])
    raw = F.coalesce(text, F.lit(""))
    return (
        F.when(noise_label(text), "noise")
        .when((street != "") & (city != "") & business_before_street(text), "mixed_site_address")
        .when((street != "") & (city != "") & (house != ""), "postal_address_precise")
        .when((street != "") & ((city != "") | (house != "")), "postal_address_partial")
        .when((postcode != "") & (city != ""), "postcode_city")
        .when(F.arrays_overlap(tokens, text_list(*TECHNICAL)), "technical_site_anchor")
        .when((F.size(route_refs(text)) > 0) | (F.size(service_refs(text)) > 0) | raw.rlike(REFERENCE_WORDS), "route_or_service_reference")
        .when(F.arrays_overlap(tokens, text_list(*SITE_WORDS)), "site_label_business")
        .when(known_city & (city != "") & (street == ""), "city_only")
        .when(F.trim(raw).rlike(UPPER_LABEL) | (F.size(place_tokens(text)) > 0), "weak_business_label")
        .otherwise("noise")
    )


def signal_of_kind(kind: Column) -> Column:
    names = ["score", "strength", "is_ban", "is_site", "is_optical", "is_route"]
    table = F.create_map(*(x for k, v in KINDS.items() for x in (F.lit(k), F.struct(*(F.lit(y).alias(n) for n, y in zip(names, v))))))
    found = F.element_at(table, kind)
    return F.struct(kind.alias("kind"), *(found[n].alias(n) for n in names))


def without_last_cities(text: Column) -> Column:
    """Normalised text without the known cities it ends with, word by word."""
    one_word = "|".join(c for c in KNOWN_CITIES if " " not in c)
    return F.trim(F.regexp_replace(norm_text(text), rf"(?:(?:^| )(?:{one_word}))+$", ""))


def client_of_endpoint(text: Column) -> Column:
    """The client before an address."""
    head = F.get(F.split(F.trim(F.coalesce(text, F.lit(""))), ADDRESS_START, 2), 0)
    return without_last_cities(head)


def client_of_pop(text: Column) -> Column:
    """The client in `POP CLIENT CITY (CITY)`, empty for other names."""
    raw = F.trim(F.coalesce(text, F.lit("")))
    name = F.regexp_replace(F.regexp_replace(raw, "(?s)^.{4}", ""), r"\s*\([^)]*\)\s*$", "")
    return F.when(F.upper(raw).startswith("POP "), without_last_cities(name)).otherwise("")
