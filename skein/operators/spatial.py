"""Points in metres: projection, proximity joins over grid cells, radius search, footprints, reuse."""

from __future__ import annotations

from math import cos, e, log, pi, radians, sin, sqrt, tan

from pyspark.sql import Column, DataFrame, functions as F

from skein.functions.scores import distance, distance_score, reuse_class, reuse_score
from skein.operators.ranking import best_per_key, stored

# The Lambert-93 conic on GRS80.
_A, _F_INV = 6378137.0, 298.257222101
_LAT0, _LAT1, _LAT2, _LON0 = radians(46.5), radians(44.0), radians(49.0), radians(3.0)
_X0, _Y0 = 700000.0, 6600000.0
_E = sqrt(2 / _F_INV - 1 / _F_INV**2)


def _iso(lat: float) -> float:
    return log(tan(pi / 4 + lat / 2) * ((1 - _E * sin(lat)) / (1 + _E * sin(lat))) ** (_E / 2))


def _normal(lat: float) -> float:
    return _A / sqrt(1 - (_E * sin(lat)) ** 2)


_N = log(_normal(_LAT2) * cos(_LAT2) / (_normal(_LAT1) * cos(_LAT1))) / (_iso(_LAT1) - _iso(_LAT2))
_C = _normal(_LAT1) * cos(_LAT1) / _N * e ** (_N * _iso(_LAT1))
_R0 = _C * e ** (-_N * _iso(_LAT0))


def to_lambert93(lon: Column, lat: Column) -> Column:
    """struct(x, y) in metres of degrees, null where either is null or no latitude."""
    lon, lat = lon.cast("double"), lat.cast("double")
    phi = F.radians(lat)
    s = F.lit(_E) * F.sin(phi)
    iso = F.ln(F.tan(F.lit(pi / 4) + phi / 2) * F.pow((1 - s) / (1 + s), F.lit(_E / 2)))
    r = F.lit(_C) * F.exp(F.lit(-_N) * iso)
    turn = F.lit(_N) * (F.radians(lon) - F.lit(_LON0))
    xy = F.struct((F.lit(_X0) + r * F.sin(turn)).alias("x"), (F.lit(_Y0 + _R0) - r * F.cos(turn)).alias("y"))
    return F.when((F.abs(lat) < 90) & lon.isNotNull(), xy)


def neighbours(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Pairs of left (columns a, x, y) and right (b, x, y) within radius: (a, b, meters). Points meet in
    grid cells as wide as the radius; the left side goes to its cell and the eight around it. Equal
    points are one class on each side while distances are measured. A cell's rows meet in an
    equality join, which Spark splits where a cell is hot."""
    cell = lambda c: F.floor(F.col(c) / radius)
    near = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    points = lambda df: df.where("x is not null and y is not null").select("x", "y").distinct()
    l = points(left).select(F.col("x").alias("lx"), F.col("y").alias("ly"), (cell("x")).alias("cx"), cell("y").alias("cy"))
    l = l.withColumn("dx", near).withColumn("dy", near).select("lx", "ly", (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy"))
    r = points(right).select(F.col("x").alias("rx"), F.col("y").alias("ry"), cell("x").alias("cx"), cell("y").alias("cy"))
    meters = distance(F.col("lx"), F.col("ly"), F.col("rx"), F.col("ry"))
    met = l.join(r, ["cx", "cy"]).withColumn("meters", meters).where(F.col("meters") <= radius)
    a = left.select("a", F.col("x").alias("lx"), F.col("y").alias("ly"))
    b = right.select("b", F.col("x").alias("rx"), F.col("y").alias("ry"))
    return met.join(a, ["lx", "ly"]).join(b, ["rx", "ry"]).select("a", "b", "meters")


def best_nearby(left: DataFrame, right: DataFrame, radius: float = 500.0) -> DataFrame:
    """For each left row (a, x, y, cap) its best right row within radius: by score, which the distance
    gives and cap limits, then by distance, then by b. Scores of 0 do not count. A nearer row never
    scores less, so the best is the nearest."""
    near = nearest(left.select("a", "x", "y"), right, radius, 1).join(left.select("a", "cap"), "a")
    scored = near.withColumn("score", F.least(distance_score(F.col("meters")), F.col("cap"))).where("score > 0")
    return best_per_key(scored.drop("cap"), ["a"], [F.desc("score"), F.col("meters"), F.col("b")])


# Points a cell may hold where the densest are, and how often a radius is halved for that.
PER_CELL, HALVINGS = 64, 20


def _widths(points: DataFrame, radius: float) -> list[float]:
    """Widths of cells from fine to coarse, each twice the one before, the last as wide as the radius. In
    the finest no cell holds more than PER_CELL points."""
    halved = 0
    while halved < HALVINGS:
        cell = lambda c: F.floor(F.col(c) / (radius / 2**halved))  # noqa: B023, E731
        most = points.groupBy(cell("rx"), cell("ry")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= PER_CELL:
            break
        # As many halvings more as there would be if the points spread evenly.
        halved = min(HALVINGS, halved + next(i for i in range(1, 64) if most <= PER_CELL // 2 * 4**i))
    return [radius / 2**i for i in range(halved, -1, -1)]


def nearest(left: DataFrame, right: DataFrame, radius: float, k: int) -> DataFrame:
    """(a, b, meters) of the k nearest right objects (b, with a row x, y for each of their points) within
    radius of each left point (a, x, y); ties: the least b.

    Left points meet the points of their own cell and the eight around it, so they know all that is
    nearer than a cell is wide. Cells begin so narrow that the densest hold few points. Where fewer
    than k objects are as near as that, cells twice as wide follow, up to the radius; so a point
    meets few more than it keeps, however dense the points are. Equal points of one side are one
    while distances are measured, and of the objects at one point k stay.
    """
    known = lambda df, key, x, y: df.where("x is not null and y is not null").select(key, F.col("x").alias(x), F.col("y").alias(y)).distinct()
    mine = stored(known(left, "a", "lx", "ly"))
    objects = stored(best_per_key(known(right, "b", "rx", "ry"), ["rx", "ry"], [F.col("b")], k))
    points = stored(objects.select("rx", "ry").distinct())
    found, open_ = None, mine.select("lx", "ly").distinct()
    widths = _widths(points, radius)
    ring = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    for width in widths:
        cell = lambda c: F.floor(F.col(c) / width)  # noqa: B023, E731
        around = open_.withColumn("o", ring).select("lx", "ly", (cell("lx") + F.col("o.i")).alias("cx"), (cell("ly") + F.col("o.j")).alias("cy"))
        meters = distance(F.col("lx"), F.col("ly"), F.col("rx"), F.col("ry"))
        # Short of the width by far more than cells are rounded, so none that is as near is in a cell beyond.
        sure = radius if width == radius else width * (1 - 1e-6)
        near = around.join(points.select("rx", "ry", cell("rx").alias("cx"), cell("ry").alias("cy")), ["cx", "cy"]).withColumn("meters", meters).where(F.col("meters") <= sure)
        met = near.join(objects, ["rx", "ry"]).groupBy("lx", "ly", "b").agg(F.min("meters").alias("meters"))
        best = stored(best_per_key(met, ["lx", "ly"], [F.col("meters"), F.col("b")], k))
        if width < radius:
            done = best.groupBy("lx", "ly").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("lx", "ly")
            open_ = stored(open_.join(done, ["lx", "ly"], "left_anti"))
            best = best.join(done, ["lx", "ly"], "left_semi")
        found = best if found is None else found.unionByName(best)
        if width < radius and open_.isEmpty():
            break
    # A left object may have several points.
    out = mine.join(found, ["lx", "ly"]).groupBy("a", "b").agg(F.min("meters").alias("meters"))
    return best_per_key(out, ["a"], [F.col("meters"), F.col("b")], k)


def radius_search(objects: DataFrame, points: list[tuple[str, str]], x: float, y: float, radius: float = 300.0, limit: int = 20) -> DataFrame:
    """Objects any of whose points lies within radius of (x, y), nearest first: id, meters. Boxes are
    compared first, which the scan can push down."""
    inside = None
    for px, py in points:
        box = F.col(px).between(x - radius, x + radius) & F.col(py).between(y - radius, y + radius)
        inside = box if inside is None else inside | box
    each = [F.coalesce(distance(F.col(px), F.col(py), F.lit(x), F.lit(y)), F.lit(9e18)) for px, py in points]
    meters = F.least(*each) if len(each) > 1 else each[0]
    return objects.where(inside).withColumn("meters", meters).where(F.col("meters") <= radius).orderBy("meters", "id").limit(limit)


def footprint(df: DataFrame, keys: list[str], points: list[tuple[str, str]]) -> DataFrame:
    """Per key the box around all points and their mean, to one decimal."""
    each = F.explode(F.array(*(F.struct(F.col(px).cast("double").alias("x"), F.col(py).cast("double").alias("y")) for px, py in points)))
    flat = df.select(*keys, each.alias("p")).where("p.x is not null and p.y is not null")
    box = [f(f"p.{c}").alias(f"{n}_{c}") for c in "xy" for f, n in ((F.min, "min"), (F.max, "max"))]
    return flat.groupBy(*keys).agg(*box, F.round(F.avg("p.x"), 1).alias("mean_x"), F.round(F.avg("p.y"), 1).alias("mean_y"), F.count("*").alias("n_points"))


def with_reuse(addresses: DataFrame, city: str, x: str, y: str) -> DataFrame:
    """addresses with how many rows of the city share the point, 0 where a part is missing, and what
    that says of the point. Counted by an aggregate and joined back, so a hot point is a sum."""
    known = F.col(city).isNotNull() & (F.col(city) != "") & F.col(x).isNotNull() & F.col(y).isNotNull()
    counts = addresses.where(known).groupBy(city, x, y).agg(F.count("*").cast("int").alias("reuse_count"))
    out = addresses.join(counts, [city, x, y], "left").withColumn("reuse_count", F.coalesce("reuse_count", F.lit(0)))
    return out.withColumn("reuse_class", reuse_class(F.col("reuse_count"))).withColumn("reuse_score", reuse_score(F.col("reuse_count")))


def line_points(points: Column) -> Column:
    """Of an array of struct(x, y): first, last and mean point."""
    mean = lambda f: F.aggregate(F.transform(points, lambda p: p[f]), F.lit(0.0), lambda a, v: a + v) / F.size(points)
    last = F.try_element_at(points, F.lit(-1))
    return F.when(F.size(points) > 0, F.struct(F.get(points, 0).alias("start"), last.alias("end"), F.struct(mean("x").alias("x"), mean("y").alias("y")).alias("centre")))


def srid_label(crs: Column) -> Column:
    """Names of the reference systems that occur."""
    c = F.upper(F.coalesce(crs, F.lit("")))
    return F.when(c.rlike("2154|LAMBERT.?93"), "EPSG:2154").when(c.rlike("27572|LAMBERT II"), "EPSG:27572").when(c.rlike("4326|WGS.?84"), "EPSG:4326").otherwise("unknown")
