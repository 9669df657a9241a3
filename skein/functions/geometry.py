"""Geometry as column expressions: well-known binary to points, and the older projection to the newer."""

from __future__ import annotations

from math import exp, log, pi, radians, sin, sqrt, tan

from pyspark.sql import Column, functions as F

from skein.functions.text import let
from skein.operators.spatial import line_points, srid_label, to_lambert93

# The older conic on its ellipsoid, its meridian, and the shift of the datum in metres.
_A, _INV = 6378249.2, 293.4660212936269
_LAT0, _K0, _X0, _Y0 = radians(46.8), 0.99987742, 600000.0, 2200000.0
_PARIS = radians(2.0 + 20.0 / 60 + 14.025 / 3600)
_SHIFT = (-168.0, -60.0, 320.0)
_A80, _INV80 = 6378137.0, 298.257222101

_E2 = 2 / _INV - 1 / _INV**2
_E = sqrt(_E2)
_E280 = 2 / _INV80 - 1 / _INV80**2
_N = sin(_LAT0)
_R0 = _K0 * _A / sqrt(1 - _E2 * _N**2) / tan(_LAT0)
_C = _R0 * exp(_N * (log(tan(pi / 4 + _LAT0 / 2)) - _E / 2 * log((1 + _E * _N) / (1 - _E * _N))))
#: Each round gains more than two digits.
_ROUNDS = 6


def from_lambert2(x: Column, y: Column) -> Column:
    """struct(lon, lat) in degrees on the newer datum of metres in the older, extended conic."""
    dx, dy = x.cast("double") - _X0, F.lit(_R0 + _Y0) - y.cast("double")
    lam = F.atan2(dx, dy) / _N + _PARIS
    grown = F.pow(F.lit(_C) / F.hypot(dx, dy), F.lit(1 / _N))  # e to the isometric latitude

    def closer(phi: Column) -> Column:
        s = F.sin(phi) * _E
        return F.atan(F.pow((1 + s) / (1 - s), F.lit(_E / 2)) * grown) * 2 - pi / 2

    phi = F.atan(grown) * 2 - pi / 2
    for _ in range(_ROUNDS):
        phi = let(phi, closer)
    point = F.struct(lam.alias("lam"), phi.alias("phi"))

    def moved(p: Column) -> Column:
        n = F.lit(_A) / F.sqrt(1 - F.pow(F.sin(p["phi"]), 2) * _E2)
        gx = n * F.cos(p["phi"]) * F.cos(p["lam"]) + _SHIFT[0]
        gy = n * F.cos(p["phi"]) * F.sin(p["lam"]) + _SHIFT[1]
        gz = n * (1 - _E2) * F.sin(p["phi"]) + _SHIFT[2]
        return F.struct(gx.alias("x"), gy.alias("y"), gz.alias("z"))

    def degrees(g: Column) -> Column:
        flat = F.hypot(g["x"], g["y"])
        lat = F.atan2(g["z"], flat * (1 - _E280))
        for _ in range(_ROUNDS):
            lat = let(lat, lambda v: F.atan2(g["z"] + F.lit(_A80 * _E280) * F.sin(v) / F.sqrt(1 - F.pow(F.sin(v), 2) * _E280), flat))
        return F.struct(F.degrees(F.atan2(g["y"], g["x"])).alias("lon"), F.degrees(lat).alias("lat"))

    return F.when(x.isNotNull() & y.isNotNull(), let(let(point, moved), degrees))


def to_metres(x: Column, y: Column, srid: Column) -> Column:
    """struct(x, y) in the newer conic of a point in any of the systems that srid_label() names; points of
    an unknown one are taken as they are."""
    degrees = let(from_lambert2(x, y), lambda d: to_lambert93(d["lon"], d["lat"]))
    own = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    out = F.when(srid == "EPSG:27572", degrees).when(srid == "EPSG:4326", to_lambert93(x, y)).otherwise(own)
    return F.when(x.isNotNull() & y.isNotNull(), out)


# Well-known binary, as upper-case hex


def _bytes(hex_: Column, at: Column, n: int, little: Column) -> Column:
    """n bytes from place at as hex, the most significant first."""
    part = lambda i: F.substring(hex_, at * 2 + 1 + 2 * i, F.lit(2))
    straight = F.substring(hex_, at * 2 + 1, F.lit(2 * n))
    return F.when(little, F.concat(*(part(i) for i in reversed(range(n))))).otherwise(straight)


def _whole(hex_: Column) -> Column:
    return F.conv(hex_, 16, 10).cast("long")


def _double(hex_: Column) -> Column:
    """The double of eight bytes: sign, exponent and fraction are whole numbers, so nothing is rounded."""

    def value(h: Column) -> Column:
        head, fraction = _whole(F.substring(h, 1, 3)), _whole(F.substring(h, 4, 13))
        power = head % 2048
        size = F.when(power == 0, fraction * F.pow(F.lit(2.0), F.lit(-1074))).otherwise((fraction + (1 << 52)) * F.pow(F.lit(2.0), power - 1075))
        return F.when(power == 2047, None).otherwise(F.when(head >= 2048, -size).otherwise(size))

    return let(hex_, value)


def _header(h: Column, at: Column) -> Column:
    """struct(little, kind, size of a point, first byte after the head) of the geometry at a place."""
    little = F.substring(h, at * 2 + 1, F.lit(2)) == "01"

    def told(code: Column) -> Column:
        extended = F.shiftrightunsigned(code, 28)
        z, m, srid = (extended.bitwiseAND(b) > 0 for b in (8, 4, 2))
        plain = code.bitwiseAND((1 << 28) - 1)
        more = F.when(plain >= 3000, 2).when(plain >= 1000, 1).otherwise(0) + z.cast("int") + m.cast("int")
        return F.struct(little.alias("little"), (plain % 1000).alias("kind"), (16 + 8 * more).cast("int").alias("size"), (at + 5 + 4 * srid.cast("int")).cast("int").alias("body"))

    return let(_whole(_bytes(h, at + 1, 4, little)), told)


def _run(h: Column, g: Column, at: Column, n: Column) -> Column:
    """n points from a place on."""
    point = lambda i: F.struct(_double(_bytes(h, at + (i - 1) * g["size"], 8, g["little"])).alias("x"), _double(_bytes(h, at + (i - 1) * g["size"] + 8, 8, g["little"])).alias("y"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), point)).otherwise(F.array().cast("array<struct<x:double,y:double>>"))


def _count(h: Column, g: Column, at: Column) -> Column:
    return _whole(_bytes(h, at, 4, g["little"])).cast("int")


def points(wkb: Column) -> Column:
    """array of struct(x, y) of a geometry's points: a point, a line, the outer ring of a polygon, or all
    points of several points or lines; null for null and other kinds. Z and M values are passed over."""

    def read(h: Column) -> Column:
        def told(g: Column) -> Column:
            start = {"struct": "struct<at:int,ps:array<struct<x:double,y:double>>>"}["struct"]
            n = _count(h, g, g["body"])
            parts = F.aggregate(
                F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                F.struct((g["body"] + 4).cast("int").alias("at"), F.array().cast("array<struct<x:double,y:double>>").alias("ps")).cast(start),
                lambda s, _: let(_header(h, s["at"]), lambda p: let(F.when(p["kind"] == 1, 1).otherwise(_count(h, p, p["body"])), lambda k: let(
                    p["body"] + F.when(p["kind"] == 1, 0).otherwise(4),
                    lambda first: F.struct((first + k * p["size"]).cast("int").alias("at"), F.concat(s["ps"], _run(h, p, first, k)).alias("ps")).cast(start),
                ))),
            )
            return (
                F.when(g["kind"] == 1, _run(h, g, g["body"], F.lit(1))).when(g["kind"] == 2, _run(h, g, g["body"] + 4, n))
                .when(g["kind"] == 3, F.when(n > 0, _run(h, g, g["body"] + 8, _count(h, g, g["body"] + 4)))).when(g["kind"].isin(4, 5) & (n > 0), parts["ps"])
            )

        return let(_header(h, F.lit(0)), told)

    return F.when(F.length(wkb) >= 9, let(F.hex(wkb), read))


def placed(wkb: Column, crs: Column) -> Column:
    """struct(start, end, centre, srid) of a geometry in metres of the newer conic; null without points."""
    srid = srid_label(crs)
    moved = F.filter(F.transform(points(wkb), lambda p: to_metres(p["x"], p["y"], srid)), lambda p: p.isNotNull())
    ends = let(moved, line_points)
    return F.when(ends.isNotNull(), F.struct(ends["start"].alias("start"), ends["end"].alias("end"), ends["centre"].alias("centre"), srid.alias("srid")))
