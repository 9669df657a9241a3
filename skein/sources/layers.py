"""Layers of the plant's geodatabase, exported to Parquet one folder a layer, as tables of the data model.

A layer has its columns by the names they have there, a column `geometry` of well-known binary and a
column `crs`; what a layer lacks is null. Points are moved to metres of the newer conic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.functions import geometry
from skein.functions.references import fiber_count
from skein.functions.text import hash16, is_blank, norm_text, place_tokens
from skein.sources.files import column_or_null

# Layers by what they hold, and their columns by the names here.
HOUSINGS = ["Rack", "OptPatchPanel", "Room", "Chamber", "Enclosure", "Pedestal", "ISPEnclosure", "ISPManifold"]
_NAMED = {"migration_oid": "MIGRATION_OID", "reference": "REFERENCE", "userreference": "USERREFERENCE", "comments": "COMMENTS", "location": "LOCATION"}
COLUMNS = {
    **dict.fromkeys(HOUSINGS, _NAMED | {"description": "DESCRIPTION"}),
    "Fiber_Cable": _NAMED | {"migration_id": "MIGRATION_ID", "labeltext": "LABELTEXT", "cabletype": "CABLETYPE", "network": "RESEAU", "project": "CODE_PROJET", "status": "STATUS"},
    "IMPORT_ISP_TEMPLATE": {"child": "ISPMIGOID", "parent": "PARENTMIGOID", "parent_type": "PARENTTYPE"},
    "Chamber__Hubsite": {"object_oid": "CHAMBER_MIGRATION_OID", "hubsite_oid": "HUBSITE_MIGRATION_OID"},
    "SupportStructure__Hubsite": {"object_oid": "SUPPORTSTRUCTURE_MIGRATION_OID", "hubsite_oid": "HUBSITE_MIGRATION_OID"},
    "CONNEXION_TEMPLATE": {"housing_type": "HOUSING_TYPE", "housing_oid": "HOUSINGMIGOID", "obj1_type": "OBJ1_TYPE", "obj1_oid": "OBJ1_MIGOID", "obj2_type": "OBJ2_TYPE", "obj2_oid": "OBJ2_MIGOID"},
    "LEASE_TEMPLATE": {
        "ref_exploit": "REF_EXPLOIT", "network": "RESEAU", "lessee": "LESSEE", "client": "CLIENTS", "comments": "COMMENTS",
        **{f"{n}_{e}": f"{c}{e.upper()}" for e in ("l1", "l2") for n, c in (("housing_type", "HOUSINGTYPE"), ("housing_oid", "HOUSINGMIGOID"), ("object_type", "TYPE"), ("object_oid", "MIGOID"), ("reference_label", "REFERENCE"))},
    },
    "Fiber_Lease": {"source_oid": "MIGRATION_OID", "ref_exploit": "REF_EXPLOIT", "reference": "REFERENCE", "path_id": "PATHID", "pair_oid": "PAIROID", "network": "RESEAU", "client": "CLIENT", "lessee": "LESSEE", "status": "STATUS", "comments": "COMMENTS"},
    "ISPLease": {"source_oid": "MIGRATION_OID", "ref_exploit": "REF_EXPLOIT", "reference": "REFERENCE", "path_id": "PATHID", "pair_oid": "PAIROID", "network": "RESEAU", "client": "CLIENT", "lessee": "LESSEE", "status": "STATUS", "comments": "COMMENTS"},
}
RELATIONS = {"Chamber__Hubsite": "Chamber", "SupportStructure__Hubsite": "SupportStructure"}


def layer(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The columns of a layer by their names here, trimmed, and object_type, start, end, centre, srid."""
    df = spark.read.parquet(f"{folder}/{name}")
    at = geometry.placed(column_or_null(df, "geometry", "binary").cast("binary"), column_or_null(df, "crs", "string"))
    rows = df.withColumn("__at", at)
    held = [F.trim(column_or_null(df, c, "string").cast("string")).alias(n) for n, c in COLUMNS[name].items()]
    return rows.select(F.lit(name).alias("object_type"), *held, *(F.col(f"__at.{c}").alias(c) for c in ("start", "end", "centre", "srid")))


def housings(spark: SparkSession, folder: str, names: list[str] = HOUSINGS) -> DataFrame:
    """All housings with a migration_oid, with geom_x and geom_y."""
    every = reduce(DataFrame.unionByName, (layer(spark, folder, n) for n in names)).where(~is_blank(F.col("migration_oid")))
    return every.select("object_type", *COLUMNS["Rack"], F.col("centre.x").alias("geom_x"), F.col("centre.y").alias("geom_y"), "srid")


def cables(spark: SparkSession, folder: str) -> DataFrame:
    """Cables with a migration_oid: cable_id, cable_oid, texts, number_of_fibers, site_tokens and the points
    of their start, end and centre."""
    rows = layer(spark, folder, "Fiber_Cable").where(~is_blank(F.col("migration_oid")))
    text = {c: F.coalesce(c, F.lit("")) for c in ("reference", "userreference", "comments", "labeltext", "location")}
    rows = rows.withColumns(text)
    points = [F.col(f"{e}.{c}").alias(f"geom_{n}_{c}") for e, n in (("start", "start"), ("end", "end"), ("centre", "centroid")) for c in "xy"]
    filled = F.coalesce(*(F.when(~is_blank(F.col(c)), F.col(c)) for c in ("reference", "userreference", "comments")))
    return rows.select(
        F.concat(F.lit("CAB-"), hash16(*map(F.col, ("migration_oid", "reference", "userreference")))).alias("cable_id"), F.col("migration_oid").alias("cable_oid"), *text,
        fiber_count(*map(F.col, ("reference", "userreference", "comments", "labeltext"))).alias("number_of_fibers"), norm_text(filled).alias("normalized_ref"),
        place_tokens(F.concat_ws(" ", "reference", "userreference", "comments")).alias("site_tokens"), *points, "srid",
    )


def relations(spark: SparkSession, folder: str) -> DataFrame:
    """object_type, object_oid, hubsite_oid of the relation layers."""
    each = [layer(spark, folder, n).select(F.lit(kind).alias("object_type"), "object_oid", "hubsite_oid") for n, kind in RELATIONS.items()]
    return reduce(DataFrame.unionByName, each)


def lease_ends(templates: DataFrame) -> DataFrame:
    """The two ends of lease templates with lease_id: endpoint_label and what the end is."""
    fields = ("housing_type", "housing_oid", "object_type", "object_oid", "reference_label")
    end = lambda e: F.struct(F.lit(e.upper()).alias("endpoint_label"), *(F.col(f"{c}_{e}").alias(c) for c in fields))
    return templates.select("lease_id", F.explode(F.array(end("l1"), end("l2"))).alias("e")).select("lease_id", "e.*")
