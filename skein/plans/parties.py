"""Parties: every source of names of clients as one table, clustered by normalised name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.address import client_of_endpoint, client_of_pop
from skein.functions.text import clean_label, first_filled, is_blank, norm_text
from skein.operators.ranking import max_row_per_key
from skein.operators.tables import party_aliases, party_clusters


def names(lines: DataFrame, sites: DataFrame, devices: DataFrame, interfaces: DataFrame, vlans: DataFrame) -> DataFrame:
    """(name, alias, party_type, source_table), each once: clients of contract lines, what an endpoint
    of a Lan To Lan line says before its address, clients in names of POPs, hints of devices, and
    labels of VLANs and interfaces."""

    def of(df: DataFrame, alias: str, party_type: str, table: str, name: Column | None = None, least: int = 1) -> DataFrame:
        value = F.col(alias)
        rows = df.where(~is_blank(value)).select((value if name is None else name).alias("name"), value.alias("alias"))
        return rows.where(F.length("name") >= least).distinct().select("name", "alias", F.lit(party_type).alias("party_type"), F.lit(table).alias("source_table"))

    every = [
        of(lines, "client_contractant", "contractant", "lea_active_lines"),
        of(lines, "client_final", "client_final", "lea_active_lines"),
        of(vlans, "label", "network_vlan", "ref_network_vlans", clean_label(F.col("label"))),
        of(interfaces, "description", "network_interface", "ref_network_interfaces", clean_label(F.col("description"))),
        of(devices, "client_hint", "device_client_hint", "ref_network_devices", first_filled(clean_label(F.col("client_hint")), F.col("client_hint"))),
        of(lines.where("nature_service = 'Lan To Lan'"), "endpoint_z_raw", "endpoint_client_hint", "lea_active_lines", client_of_endpoint(F.col("endpoint_z_raw")), 3),
        of(sites.where("reference ilike 'POP %'"), "reference", "site_client_hint", "ref_sites", client_of_pop(F.col("reference")), 3),
    ]
    return reduce(DataFrame.unionByName, every)


def build(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(party_master, party_alias) of names()."""
    return party_clusters(every), party_aliases(every)


def by_label(labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """labels (label, and others) with the party whose alias the label is, or else its business part;
    labels without one go. Where an alias belongs to several parties the greatest id counts. Labels
    are looked up once each, however many rows have them."""
    key = aliases.where("normalized_alias <> ''").groupBy("normalized_alias").agg(F.max("party_id").alias("party_id"))
    distinct = labels.where("label is not null").select("label").distinct()
    exact, cleaned = key.toDF("k0", "p0"), key.toDF("k1", "p1")
    found = distinct.withColumns({"n0": norm_text(F.col("label")), "n1": clean_label(F.col("label"))})
    found = found.join(exact, F.col("n0") == F.col("k0"), "left").join(cleaned, F.col("n1") == F.col("k1"), "left")
    found = found.select("label", F.coalesce("p0", "p1").alias("party_id")).where("party_id is not null")
    return labels.join(found, "label")


def best(rows: DataFrame) -> DataFrame:
    """Of (service_id, role_name, party_id, rule_name, score, ...): the best of each service and role."""
    return max_row_per_key(rows, ["service_id", "role_name"], F.struct("score", "party_id", "rule_name"), ["party_id", "rule_name", "score"])
