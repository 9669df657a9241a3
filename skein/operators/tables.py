"""Whole-table operators: clusters of names, profiles, digests, conditional counts, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.text import hash16, norm_text
from skein.operators.ranking import best_per_key

# Party types, the most trusted first, with their priority.
PARTY_TYPES = {
    "contractant": 100, "client_final": 95, "endpoint_client_hint": 80, "site_client_hint": 75, "device_client_hint": 75,
    "network_vlan": 70, "network_interface": 65,
}


def party_clusters(names: DataFrame, types: dict[str, int] = PARTY_TYPES) -> DataFrame:
    """Parties of names (name, party_type): one per normalised name, called by the name of the most
    trusted type, then of the higher priority; ties: the least name. An aggregate with a partial step."""
    order, weight = _type_order(types), _type_weight(types)
    known = names.withColumn("normalized_name", norm_text(F.col("name"))).where("normalized_name <> ''")
    rank = F.struct(order(F.col("party_type")).alias("r"), (-weight(F.col("party_type"))).alias("p"), F.col("name").alias("name"), F.col("party_type").alias("party_type"))
    best = known.groupBy("normalized_name").agg(F.min(rank).alias("b"), F.count_distinct("name").alias("n_aliases"))
    return best.select(
        party_id(F.col("normalized_name")).alias("party_id"), F.col("b.name").alias("canonical_name"), "normalized_name",
        F.col("b.party_type").alias("party_type"), (-F.col("b.p")).alias("source_priority"), "n_aliases",
    )


def party_id(name: Column) -> Column:
    return F.concat(F.lit("PTY-"), hash16(name))


def _type_order(types: dict[str, int]):
    table = F.create_map(*(x for i, t in enumerate(types) for x in (F.lit(t), F.lit(i))))
    return lambda c: F.coalesce(F.try_element_at(table, c), F.lit(99))


def _type_weight(types: dict[str, int]):
    table = F.create_map(*(x for t, p in types.items() for x in (F.lit(t), F.lit(p))))
    return lambda c: F.coalesce(F.try_element_at(table, c), F.lit(0))


def party_aliases(names: DataFrame) -> DataFrame:
    """One row per distinct alias of names (name, alias, party_type, source_table): party_id,
    alias_value, normalized_alias, source_table, alias_type."""
    return names.where(norm_text(F.col("name")) != "").select(
        party_id(F.col("name")).alias("party_id"), F.col("alias").alias("alias_value"), norm_text(F.col("alias")).alias("normalized_alias"), "source_table", F.col("party_type").alias("alias_type")
    ).distinct()


def kpis(df: DataFrame, tests: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """How many rows pass each test, 0 where there are none."""
    return df.groupBy(*(keys or [])).agg(*(F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()))


def mix(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: column_name, n_rows, n_nulls, n_distinct, low, high and five samples, the
    least distinct values. Rows become (column, value) pairs, which are counted per value before
    anything is shuffled, so a column is a group and a hot value one row per task."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in df.columns)))
    values = df.select(pairs.alias("p")).select("p.*").groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    of = values.groupBy("column_name").agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_nulls"), F.count("v").alias("n_distinct"))
    known = values.where("v is not null").select("column_name", "v")
    samples = best_per_key(known, ["column_name"], [F.col("v")], 5).groupBy("column_name").agg(F.array_sort(F.collect_list("v")).alias("samples"))
    edges = df.agg(*(f(f"`{c}`").cast("string").alias(f"{k}{i}") for i, c in enumerate(df.columns) for k, f in (("low", F.min), ("high", F.max))))
    ends = edges.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"low{i}").alias("low"), F.col(f"high{i}").alias("high")) for i, c in enumerate(df.columns)))).alias("e")).select("e.*")
    joined = ends.join(of, "column_name", "left").join(samples, "column_name", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return joined.select("column_name", zero("n_rows"), zero("n_nulls"), zero("n_distinct"), "low", "high", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def digest(df: DataFrame, name: str) -> DataFrame:
    """A digest that does not depend on the order of rows: table_name, n_rows, digest."""
    # Each cell with its length, or a mark without one, so that no two rows read alike.
    text = lambda c: F.col(f"`{c}`").cast("string")
    cell = lambda c: F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("null"))
    row = F.sha2(F.concat_ws("|", *map(cell, df.columns)), 256)
    part = F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.coalesce(F.sum(part), F.lit(0)).cast("string").alias("digest"))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, as often as it lacks them, with `side`."""
    same = new.select(*old.columns)
    return old.exceptAll(same).withColumn("side", F.lit("old")).union(same.exceptAll(old).withColumn("side", F.lit("new")))


def ambiguous(df: DataFrame, keys: list[str], value: str, strength: str) -> DataFrame:
    """df with strong rows made medium where their key has more than one value."""
    several = df.groupBy(*keys).agg(F.count_distinct(value).alias("__n"))
    weaker = F.when((F.col(strength) == "strong") & (F.col("__n") > 1), "medium").otherwise(F.col(strength))
    return df.join(several, keys).withColumn(strength, weaker).drop("__n")


def review_batches(queue: DataFrame, service: str, groups: list[str], review_type: str) -> DataFrame:
    """Services with their distinct review types, in order, as one text."""
    kinds = F.array_join(F.array_sort(F.collect_set(review_type)), ",").alias("review_types")
    return queue.groupBy(service, *groups).agg(kinds)


def schema_summary(named: dict[str, DataFrame]) -> DataFrame:
    """table_name, n_rows and columns (`name type, ...`) of each table: one count a table."""
    parts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"), F.lit(", ".join(f"{c} {t}" for c, t in df.dtypes)).alias("columns")) for n, df in named.items()]
    return reduce(DataFrame.unionByName, parts)
