"""Scalar functions against known pairs and against plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from skein.functions import address, references, scores, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


def plain_norm(x):
    x = "".join(c for c in unicodedata.normalize("NFKD", x or "") if not unicodedata.combining(c)).upper()
    return re.sub(" +", " ", re.sub("[^A-Z0-9]+", " ", x)).strip()


def test_norm_text(spark):
    rng = random.Random(1)
    rows = ["Collège Jules-Michelet", "", None, "ÀÉÎ õ ß", *("".join(rng.choice("aZ9 -éÈüç_\n.ñŁ") for _ in range(30)) for _ in range(200))]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = df.select(text.norm_text(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == [plain_norm(r) for r in rows]


def test_norm_text_of_every_character(spark):
    points = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    rows = ["a" + "b".join(points[i : i + 200]) + "z" for i in range(0, len(points), 200)] + ["nº2 m² ﬁbre Nguyễn № Ĳ ｆｕｌｌ ½ a\u20d0b"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r.x for r in df.select(text.norm_text(F.col("t")).alias("x")).collect()]
    wrong = [(a, b) for a, b in zip(" ".join(got).split(), " ".join(map(plain_norm, rows)).split()) if a != b]
    assert not wrong, wrong[:20]
    assert got[-1] == "NO2 M2 FIBRE NGUYEN NO IJ FULL 1 2 AB"


def test_labels(spark):
    assert one(spark, "CLIENT-LAN2LAN/OPE1214-L2L240 - Norbert Dentressangle/511", text.clean_label) == "NORBERT DENTRESSANGLE"
    assert one(spark, None, text.clean_label) == ""
    assert one(spark, "POP Senlis Gare 12345 4FO AB", text.place_tokens) == ["SENLIS", "GARE"]
    score = lambda a, b, n: spark.range(1).select(text.label_score(F.lit(a), F.lit(b), F.lit(n)).alias("x")).first().x
    assert [score("A B", "A B", 0), score("AA BB", "AA BB CC", 2), score("x", "y", 3), score("x", "y", 4), score("x", "y", 2), score("x", "y", 1), score("", "y", 9)] == [96, 90, 74, 88, 72, 0, 0]


def test_references(spark):
    assert one(spark, "toip  2505 x FREE12, TOIP 2505", references.route_refs) == ["TOIP 2505", "FREE12"]
    assert one(spark, "OPE 12-l2l 7 pe3_L2L4", references.service_refs) == ["OPE12/L2L7", "PE3/L2L4"]
    assert one(spark, "cable 144 FO", references.fiber_count) == 144
    assert one(spark, "none", references.fiber_count) is None
    assert one(spark, "vlan 578-584,598,615", references.vlan_list) == [*range(578, 585), 598, 615]
    assert one(spark, "vlan 5 to 7", references.vlan_list) == [5, 7]
    assert one(spark, "description vlan 5", references.line_vlans) == []
    assert one(spark, "CLIENT/511 VLAN_12 2024", references.text_vlans) == ["511", "12"]
    assert one(spark, "A-12.3", references.without_suffix) == "A-12"
    assert one(spark, "C-77.pdf", references.contract_base) == "C"
    assert tuple(one(spark, "Fibre-Metro-IRU", references.classify_offer)) == ("IRU FON", "principal")
    assert tuple(one(spark, None, references.classify_offer)) == ("A qualifier", "principal")


def test_addresses(spark):
    a = one(spark, "114 RUE DE MORIENVAL PIERREFONDS", address.parse_address)
    assert (a.house_number, a.street_name, a.city, a.postcode) == ("114", "RUE DE MORIENVAL", "PIERREFONDS", "")
    a = one(spark, "3 avenue Foch 60300 St Senlis", address.parse_address)
    assert (a.house_number, a.street_name, a.city, a.postcode) == ("3", "AVENUE FOCH ST", "SAINT SENLIS", "60300")  # a short form stays in the street
    kinds = {
        "114 RUE DE MORIENVAL PIERREFONDS": "postal_address_precise", "PASS 1": "noise", None: "noise", "Senlis": "city_only", "POP Creil": "technical_site_anchor",
        "TOIP 12": "route_or_service_reference", "Mairie de Noyon": "site_label_business", "Mairie de Noyon 3 rue Foch Noyon": "mixed_site_address",
        "60200 Compiegne": "postcode_city", "Dupont": "weak_business_label",
    }
    for value, kind in kinds.items():
        got = one(spark, value, address.classify_signal)
        assert (value, got.kind, got.score) == (value, kind, address.KINDS[kind][0])
    assert one(spark, "ACME SENLIS 12 rue Foch 60300 Senlis", address.client_of_endpoint) == "ACME"
    assert one(spark, "POP ACME CREIL (CREIL)", address.client_of_pop) == "ACME"
    assert one(spark, "ACME", address.client_of_pop) == ""


def test_noise_and_cities(spark):
    assert one(spark, "60300 12345", address.noise_label) is False and one(spark, "60300", address.noise_label) is True
    parsed = lambda t, known: spark.range(1).select(address.signal_of(address.kind_of(F.lit(t), address.parse_address(F.lit(t)), F.lit(known)))["kind"].alias("x")).first().x
    assert (parsed("Villeneuve", True), parsed("Villeneuve", False), parsed("60300 12345", False)) == ("city_only", "weak_business_label", "postcode_city")


def test_numbers_of_five_digits_that_are_no_postcodes(spark):
    told = lambda t: (one(spark, t, address.classify_signal).kind, *(one(spark, t, address.parse_address)[k] for k in ("house_number", "city", "postcode")))
    assert told("10000 rue de Morienval Pierrefonds") == ("postal_address_precise", "10000", "PIERREFONDS", "")
    assert told("Chambre NRA 10002") == ("technical_site_anchor", "", "CHAMBRE NRA 10002", "")
    assert told("TOIP 10003") == ("route_or_service_reference", "", "TOIP 10003", "")
    assert told("Chambre NRA 60300 Senlis")[2:] == ("SENLIS", "60300") and told("60300 Senlis")[2:] == ("SENLIS", "60300")


def test_scores(spark):
    row = spark.range(1).select(
        *(scores.distance_score(F.lit(float(m))) for m in (0, 50, 51, 200, 500, 501)), scores.cable_place_score(F.lit(2), F.lit(24), F.lit(None).cast("int")),
        scores.cable_place_score(F.lit(1), F.lit(48), F.lit(97)), scores.overlap_score(F.lit(9)),
    ).first()
    assert list(row) == [98, 98, 94, 88, 75, 0, 96, 97, 85]
