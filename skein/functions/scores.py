"""Scores and bands. Every threshold and score of this module."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _bands(value: Column, bands, other) -> Column:
    out = None
    for limit, result in bands:
        test = value <= limit
        out = F.when(test, result) if out is None else out.when(test, result)
    return out.otherwise(other)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def distance_score(meters: Column) -> Column:
    return _bands(meters, [(50, 98), (100, 94), (200, 88), (500, 75)], 0)


def distance_confidence(meters: Column) -> Column:
    return _bands(meters, [(100, "strong"), (200, "medium"), (500, "weak")], "none")


def reuse_class(count: Column) -> Column:
    return F.when(count >= 10, "weak_reused_point").when(count >= 2, "shared").otherwise("precise")


def reuse_score(count: Column) -> Column:
    return F.when(count >= 10, 30).when(count >= 5, 55).when(count >= 2, 75).otherwise(100)


def overlap_score(shared: Column) -> Column:
    """Of two token sets that share two tokens or more."""
    return F.least(F.lit(85), 20 * shared).cast("int")


def strength_rank(strength: Column) -> Column:
    s = F.lower(F.coalesce(strength, F.lit("")))
    return F.when(s == "strong", 3).when(s == "medium", 2).when(s == "weak", 1).otherwise(0)


def cable_place_score(shared: Column, fibers: Column, spatial: Column) -> Column:
    """Of a cable that shares place names with a service; thin cables are likelier."""
    base = F.when(shared >= 2, 92).when(shared >= 1, 80).otherwise(0)
    thin = F.when((base > 0) & (fibers <= 24), F.least(F.lit(96), base + 4)).otherwise(base)
    return F.least(F.lit(98), F.greatest(thin, F.coalesce(spatial, F.lit(0)))).cast("int")


def coherence(tokens, site_z, site_a, meters, ends, leases) -> Column:
    """How well a route fits a service: shared stops, its sites among the ends, distance, leases."""
    near = F.when(meters <= 100, 25).when(meters <= 300, 15).when(meters <= 800, 6).otherwise(0)
    flag = lambda c, n: F.when(c, n).otherwise(0)
    return (
        F.least(F.lit(20), 8 * tokens) + flag(site_z, 35) + flag(site_a, 25) + near
        + F.least(F.lit(20), 10 * ends) + F.least(F.lit(10), 2 * leases)
    ).cast("int")


def coherence_band(score: Column) -> Column:
    return F.when(score >= 70, "strong").when(score >= 35, "medium").otherwise("weak")


def ratio(part: Column, whole: Column) -> Column:
    """A percentage to one decimal, 0 where there is nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(100.0 * part / whole, 1))
