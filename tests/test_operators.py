"""Operators against brute force, on small tables with nulls, ties and repeats."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skein.operators import matching, ranking, spatial, tables
from skein.plans import resolutions, services, sql_guard
from skein import sinks
from skein.sources import files


def test_shared_tokens_with_copies(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(12)]
    left = [(i, rng.sample(words, rng.randint(0, 5))) for i in range(40)] + [(100 + i, ["word1", "word2", "word3"]) for i in range(30)]
    right = [(i, rng.sample(words, rng.randint(0, 5))) for i in range(20)]
    got = matching.shared_tokens(spark.createDataFrame(left, "a int, t array<string>"), "a", "t", spark.createDataFrame(right, "b int, t array<string>"), "b", "t")
    want = {(a, b, len(set(x) & set(y))) for a, x in left for b, y in right if len(set(x) & set(y)) >= 2}
    assert {tuple(r) for r in got.collect()} == want


def test_neighbours(spark):
    rng = random.Random(5)
    point = lambda: (rng.uniform(-2000, 2000), rng.uniform(-2000, 2000))
    left, right = [(i, *point()) for i in range(60)] + [(99, 0.0, 0.0), (98, None, 1.0)], [(i, *point()) for i in range(60)] + [(99, 0.0, 500.0)]
    got = spatial.neighbours(spark.createDataFrame(left, "a int, x double, y double"), spark.createDataFrame(right, "b int, x double, y double"), 500.0)
    want = {(a, b) for a, x, y in left for b, u, v in right if x is not None and math.hypot(x - u, y - v) <= 500}
    assert {(r.a, r.b) for r in got.collect()} == want


def test_projection(spark):
    x = spark.range(1).select(spatial.to_lambert93(F.lit(3.0), F.lit(46.5)).alias("p")).first().p
    assert abs(x.x - 700000) < 0.01 and abs(x.y - 6600000) < 0.01
    # Paris, from published tables.
    x = spark.range(1).select(spatial.to_lambert93(F.lit(2.3522), F.lit(48.8566)).alias("p")).first().p
    assert abs(x.x - 652469) < 2 and abs(x.y - 6862035) < 2


def test_numbered_and_batches(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("k"))
    rows = ranking.numbered(df, ["k"], "n").collect()
    assert sorted((r.k, r.n) for r in rows) == [(i, i + 1) for i in range(1000)]
    got = ranking.batches(df.withColumn("g", F.lit(1)), ["g"], ["k"], 300).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in got) == [(0, 300), (1, 300), (2, 300), (3, 100)]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbered_wide_rows(spark, adaptive):
    # More bytes beside the key than adaptive execution leaves in one partition.
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        for k, v in zip(was, (adaptive, "32", "1m")):
            spark.conf.set(k, v)
        df = spark.range(0, 30000, numPartitions=6).select((F.col("id") * 7919 % 30000).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 8).alias("wide"))
        got = ranking.numbered(df, ["k"], "n").agg(F.count("*").alias("c"), F.count_if(F.col("n") == F.col("k") + 1).alias("right"), F.count_distinct("wide").alias("w")).first()
        assert (got.c, got.right, got.w) == (30000, 30000, 30000)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_tables(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    assert {r.column_name: (r.n_rows, r.n_nulls, r.n_distinct, r.low, r.high, r.samples) for r in tables.profile(df).collect()} == {"x": (3, 0, 2, "1", "2", ["1", "2"]), "y": (3, 1, 1, "a", "a", ["a"])}
    assert [(r.n_rows, r.samples) for r in tables.profile(df.limit(0)).collect()] == [(0, []), (0, [])]
    pairs = [("a|1:b", "c"), ("a", "1:b|1:c"), ("~", None), (None, "~")]
    assert len({tables.digest(spark.createDataFrame([p], "x string, y string"), "t").first().digest for p in pairs}) == 4
    assert tables.digest(df, "t").first() == tables.digest(df.orderBy(F.desc("x")), "t").first()
    assert sorted((r.x, r.side) for r in tables.difference(df, df.where("x = 2").union(spark.createDataFrame([(9, "z")], df.schema))).collect()) == [(1, "old"), (1, "old"), (9, "new")]
    assert tables.kpis(df.limit(0), {"n": F.col("x") > 1}).first().n == 0


def test_services_and_merge(spark):
    base = dict(command_external="", contract_file="", endpoint_a_raw="", endpoint_z_raw="", client_final="", command_internal="", client_contractant="ACME", offer_label="")
    line = lambda i, **k: base | {"lea_line_id": i} | k
    rows = [
        line("L1", offer_label="fibre-metro-iru", contract_file="c1.pdf", command_internal="77.1"), line("L2", offer_label="fibre-metro-maintenance", contract_file="m.pdf", command_internal="77.2"),
        line("L3", offer_label="lien ethernet - 1-100 mbits", command_external="TOIP 5"), line("L4", offer_label="netcenter lan - divers", command_external="toip  5"),
        line("L5", offer_label="x", command_internal="old 3"),
    ]
    lines = services.enriched(spark.createDataFrame(rows))
    made, links = services.service_master(lines)
    by_nature = {r.nature_service: r for r in made.collect()}
    assert made.count() == 3 and links.count() == 4
    assert by_nature["Lan To Lan"].line_count == 2 and by_nature["Lan To Lan"].route_refs == ["TOIP 5"]
    members = links.join(lines.drop("role_ligne"), "lea_line_id").join(made.where("nature_service = 'IRU FON'").select("service_id", F.col("principal_client").alias("client")), "service_id")
    members = members.select("service_id", "client", F.col("role_ligne").alias("role"), F.col("command_internal").alias("command"), F.col("contract_file").alias("contract"), F.col("endpoint_a_raw").alias("endpoint_a"), F.col("endpoint_z_raw").alias("endpoint_z"))
    matches = services.maintenance_matches(members)
    assert [(r.strategy, r.match_detail) for r in matches.collect()] == [("command_base", "77")]
    merged, moved = services.merge_maintenance(made, links, matches)
    assert merged.count() == 2 and moved.count() == 4
    assert merged.where("nature_service = 'IRU FON'").first().line_count == 2


def test_resolutions(spark):
    proposed = spark.createDataFrame([("r1", "s1", "high", "x"), ("r2", "s9", "high", "x"), ("r3", "s1", "sure", "x"), ("r4", "s1", "low", " "), ("r5", "s1", "low", "x")], "resolution_id string, service_id string, confidence string, justification string")
    evidence = spark.createDataFrame([(f"r{i}",) for i in range(1, 5)], "resolution_id string")
    got = resolutions.checked(proposed, spark.createDataFrame([("s1",)], "service_id string"), evidence)
    assert {r.resolution_id: r.problem for r in got.collect()} == {"r1": None, "r2": "unknown service", "r3": "unknown confidence", "r4": "no justification", "r5": "no evidence"}


def test_sql_guard(spark):
    assert sql_guard.blocked("-- x\n/* y */ select 1", spark) is None
    assert sql_guard.blocked("with a as (select 1) select * from a", spark) is None
    assert sql_guard.blocked("explain select 1", spark) is None
    for bad in ("", "-- only", "drop table x", "/* a */ insert into x values (1)", "update x set a = 1"):
        assert sql_guard.blocked(bad, spark).startswith("BLOCKED")
    spark.range(3).createOrReplaceTempView("guarded")
    assert sql_guard.blocked("with a as (select 1 id) insert into guarded select * from a", spark).startswith("BLOCKED")
    assert sql_guard.query(spark, "select * from guarded").count() == 3


def test_fallback_with_nulls(spark):
    left = spark.createDataFrame([(1, None, "b"), (2, None, None), (2, None, None), (3, "a", "b"), (4, "x", "y")], "id int, k1 string, k2 string")
    right = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "key string, v int")
    got = matching.fallback_join(left, ["k1", "k2"], right, "key", "v").collect()
    assert sorted((r.id, r.v, r.matched_by) for r in got if r.v) == [(1, 20, "k2"), (3, 10, "k1")] and {r.id for r in got if r.v is None} == {2, 4}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None), (1, "a", 5)], "z int, a string, m int")
    sinks.write_table(df, f"{tmp_path}/t", ["a", "z"])
    sinks.write_table(df, f"{tmp_path}/t", ["a", "z"])
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["a", "z"] and spark.read.parquet(f"{tmp_path}/t").count() == 2
    sinks.write_suggestions(df, f"{tmp_path}/s")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/s").collect()) == ['{"a":"a","m":5,"z":1}', '{"a":"b","m":null,"z":2}']
    sinks.write_export(df, f"{tmp_path}/e", ["z"])
    assert [r.z for r in spark.read.csv(f"{tmp_path}/e", header=True).collect()] == ["1", "2"]
    text = sinks.report({"T": df}, limit=1)
    assert "more than 1 rows" in text and "more than" not in sinks.report({"T": df})


def test_geometry(spark):
    line = F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((0, 0), (2, 4), (4, 2))))
    p = spark.range(1).select(spatial.line_points(line).alias("p"), spatial.srid_label(F.lit("RGF93 / Lambert-93")).alias("s")).first()
    assert (p.p.start.x, p.p.end.x, p.p.centre.x, p.p.centre.y, p.s) == (0.0, 4.0, 2.0, 2.0, "EPSG:2154")


def test_addresses_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,numero,nom_voie,code_postal,nom_commune,lon,lat,x,y\nBAN-1,114,Rue de Morienval,60350,Pierrefonds,2.9801,49.3462,700000,6900000\nBAN-1,1,Rue A,60350,Pierrefonds,,,,\n,1,a,b,c,,,,\n")
    rows = files.addresses(files.read_delimited(spark, str(path))).collect()
    assert [(r.ban_id, r.house_number, r.reuse_count, r.reuse_class, r.x_l93) for r in rows] == [("BAN-1", "114", 1, "precise", 700000.0)]
