"""Readers: delimited files with aliases of headers, text files, layers, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skein.functions.references import route_refs, service_refs
from skein.functions.text import first_filled, hash16, norm_text
from skein.operators.ranking import best_per_key
from skein.operators.spatial import to_lambert93, with_reuse

# Headers by which address files name a field.
ADDRESS_HEADERS = {
    "ban_id": ["id", "ban_id"], "house_number": ["numero", "house_number"], "street_name": ["nom_voie", "street_name"], "postcode": ["code_postal", "postcode"],
    "insee_code": ["code_insee", "insee_code"], "city": ["nom_commune", "city", "commune"], "department_code": ["code_departement", "department_code"],
    "full_label": ["label", "full_label"], "lon": ["lon", "longitude"], "lat": ["lat", "latitude"], "x": ["x", "x_l93"], "y": ["y", "y_l93"],
}


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """df's column, or null where this file has none."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def delimiter(spark: SparkSession, path: str, default: str = ";") -> str:
    """`,` or `;`, whichever the first line has more of."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    commas, semicolons = line.count(","), line.count(";")
    return default if commas == semicolons else "," if commas > semicolons else ";"


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """The file's columns and `__row`, which grows from row to row; a missing file has neither."""
    raw = spark.read.csv(path, header=True, sep=delimiter(spark, path))
    return raw.withColumn("__row", F.monotonically_increasing_id())


def addresses(raw: DataFrame) -> DataFrame:
    """Address rows of a delimited file: the first per id, with normalised texts, points in metres and
    how far points are shared."""
    named = raw.select(*(first_filled(*(column_or_null(raw, h) for h in [h for h in heads if h in raw.columns] or heads[:1])).alias(n) for n, heads in ADDRESS_HEADERS.items()), column_or_null(raw, "__row", "long").alias("__row"))
    number = lambda c: F.expr(f"try_cast({c} as double)")
    projected = to_lambert93(number("lon"), number("lat"))
    placed = named.where("ban_id is not null").select(
        *(c for c in named.columns if c not in ("x", "y")), F.coalesce(number("x"), projected["x"]).alias("x_l93"), F.coalesce(number("y"), projected["y"]).alias("y_l93"),
        norm_text(F.col("city")).alias("normalized_city"), norm_text(F.col("street_name")).alias("normalized_street_name"),
    )
    label = first_filled(F.col("full_label"), F.concat_ws(" ", "house_number", "street_name", "postcode", "city"))
    placed = placed.withColumn("full_label", label).withColumn("normalized_label", norm_text(label))
    once = best_per_key(placed, ["ban_id"], [F.col("__row"), F.col("full_label")]).drop("__row")
    return with_reuse(once, "normalized_city", "x_l93", "y_l93")


def config_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(source_file, payload) of all *.txt below a folder, read as Latin-1."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select(F.col("path").alias("source_file"), F.decode("content", "ISO-8859-1").alias("payload"))


def layer(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A layer exported to Parquet, with the columns named (name: type); those it lacks are null, as
    geometry is in layers that were exported without."""
    df = spark.read.parquet(path)
    return df.select(*(column_or_null(df, c, t).cast(t).alias(c) for c, t in columns.items()))


def contract_lines(raw: DataFrame, active: str = "40") -> DataFrame:
    """Lines of the contract sheet that are active, from a table of its columns by their names here."""
    return raw.where(F.trim("status_code") == active)


# Inventories that are read by the position of their columns, as their headers differ from file to file.


def by_position(raw: DataFrame, places: dict[str, int]) -> DataFrame:
    """Columns of raw by their place, from 0, as trimmed text, empty where a cell or the column is."""
    known = [c for c in raw.columns if c != "__row"]
    cell = lambda i: F.coalesce(F.col(f"`{known[i]}`").cast("string"), F.lit("")) if i < len(known) else F.lit("")
    return raw.select(*(cell(i).alias(n) for n, i in places.items()))


# Where the fields stand.
INTERFACE_PLACES = {"hostname": 0, "interface_name": 1, "admin_status": 3, "oper_status": 4, "description": 5, "speed": 6}
CPE_PLACES = {"first": 0, "hostname": 2, **{f"field_{i}": i for i in (3, 4, 5, 6, 8, 9, 10)}}


def interface_inventory(raw: DataFrame) -> DataFrame:
    """Inventoried interfaces with interface_id, the references in their descriptions and the normalised
    description. Rows stay as they are; equal host and interface names have one id."""
    rows = by_position(raw, INTERFACE_PLACES)
    text = F.col("description")
    return rows.select(
        F.concat(F.lit("IF-"), hash16(F.col("hostname"), F.col("interface_name"))).alias("interface_id"), *INTERFACE_PLACES, route_refs(text).alias("route_refs"), service_refs(text).alias("service_refs"),
        norm_text(text).alias("normalized_description"),
    )


def cpe_inventory(raw: DataFrame) -> DataFrame:
    """Inventoried equipment that has a host name, with cpe_id and the normalised name."""
    rows = by_position(raw, CPE_PLACES).where("hostname <> ''")
    return rows.select(F.concat(F.lit("CPE-"), hash16(F.col("hostname"), F.col("first"))).alias("cpe_id"), *CPE_PLACES, norm_text(F.col("hostname")).alias("normalized_hostname"))
