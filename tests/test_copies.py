"""Rows that lie on top of each other, sides that grow by exploding, and sums whose last digits depend on their order."""

from pyspark.sql import functions as F

from brookflow.operators import raster, spatial

LINES = "id long, code string, coords array<struct<x:double,y:double>>"


def test_resample_lays_out_no_grid(spark):
    """Only cells within old ones come back, however far apart these are."""
    cells = spark.createDataFrame([(0, 0, 8.0), (2, 0, 4.0), (10**9, 0, 1.0)], "r long, c long, v double")
    out = raster.resample(cells, 4.0, 2.0).collect()
    assert sorted({x.r for x in out}) == [0, 1, 4, 5, 2 * 10**9, 2 * 10**9 + 1] and len(out) == 12
    assert {x.v for x in out if x.r in (0, 1)} == {8.0}


def test_equally_near_segments_as_in_sql(spark):
    """Distances are taken from the segment's start as the SQL does; otherwise one of two equally near walls was lost."""
    x, y = 347 * 17 % 1000, 347 * 29 % 1000
    walls = [(k, float(k * 53 % 1000), float(k * 71 % 1000)) for k in range(1000)]

    def dist(ax, ay):
        share = max(0.0, min(1.0, ((x - ax) * 35 + (y - ay) * 21) / 1666.0))
        return ((x - ax - share * 35) ** 2 + (y - ay - share * 21) ** 2) ** 0.5

    least = min(dist(ax, ay) for _, ax, ay in walls)
    wanted = {k for k, ax, ay in walls if dist(ax, ay) == least}
    lines = spark.createDataFrame([(k, "", [(ax, ay), (ax + 35, ay + 21)]) for k, ax, ay in walls], LINES)
    points = spark.createDataFrame([(1, float(x), float(y))], "id long, x double, y double")
    assert len(wanted) > 1 and {r.r_id for r in spatial.nearest_segments(points, lines, 20.5).collect()} == wanted


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_sides_stay_off_the_driver(spark):
    points = spark.range(50).select("id", F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"))
    lines = spark.createDataFrame([(1, "a", [(0.0, 1.0), (49.0, 1.0)])], LINES)
    for df in (spatial.radius_pairs(points, points, 2.0), spatial.points_on_lines(points, lines, 2.0), spatial.nearest_segments(points, lines, 2.0), spatial.crossing_pairs(lines, lines)):
        assert "Broadcast" not in plan_of(df)
    assert spatial.points_on_lines(points, lines, 1.5).count() == 50


def test_copies_are_judged_once_and_all_named(spark):
    """Fifty walls and culverts on top of each other: one shape each, and the least code that isn't a culvert's own."""
    cut = [(k, f"W{k % 3}", [(0.0, -1.0), (0.0, 1.0)]) for k in range(50)]
    walls = spark.createDataFrame([(k, f"W{k}", [(-1.0, 0.0), (1.0, 0.0)]) for k in range(50)], LINES)
    culverts = spark.createDataFrame(cut, LINES).withColumn("dangling_code", F.lit("W1"))
    assert spatial._each(spatial._shapes(walls, "coords")).count() == 1
    assert spatial.crossing_pairs(culverts, walls).count() == 2500
    got = {r.id: r.crossing_code for r in spatial.first_crossing(culverts, walls).collect()}
    assert got == {k: "W10" if k % 3 == 0 else "W0" for k in range(50)}
    assert {r.crossing_code for r in spatial.first_crossing(culverts, walls, exempt=False).collect()} == {"W0"}


def test_nearest_of_copies(spark):
    a = spark.createDataFrame([(k, 0.0, 0.0) for k in range(20)], "id long, x double, y double")
    b = spark.createDataFrame([(k, 3.0, 4.0) for k in range(20)] + [(99, 30.0, 40.0)], "id long, x double, y double")
    one = spatial.nearest(a, b).collect()
    assert len(one) == 20 and {(r.r_id, r.dist) for r in one} == {(0, 5.0)}
    assert spatial.nearest(a, b, ties=True).count() == 400
    assert spatial.within_semi(a, b, 5.0).count() == 20


def test_longest_overlap_of_copies(spark):
    ring = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
    areas = spark.createDataFrame([(k, ring) for k in range(5)], "id long, rings array<array<struct<x:double,y:double>>>")
    lines = spark.createDataFrame([(k, "", [(1.0, 1.0), (1.0, 4.0)]) for k in range(7, 12)], LINES)
    assert {(r.area_id, r.line_id, r.overlap) for r in spatial.longest_overlap(areas, lines).collect()} == {(k, 7, 3.0) for k in range(5)}
    assert spatial.overlaps(areas, lines).count() == 25


def test_staged_tables_are_joined_by_shuffle(spark):
    from brookflow.runtime import staged

    one, other = staged(spark.range(30)), staged(spark.range(20).withColumnRenamed("id", "k"))
    joined = one.join(other.groupBy("k").count(), one["id"] == F.col("k"), "left")
    assert "Broadcast" not in plan_of(joined) and joined.count() == 30
    assert "Broadcast" in plan_of(one.join(F.broadcast(spark.range(3)), "id"))


def test_copies_of_a_polygon_are_united_once(spark, monkeypatch):
    from brookflow.operators import dissolve

    seen, bounds = [], dissolve._bounds_of
    monkeypatch.setattr(dissolve, "_bounds_of", lambda areas, key, precision: seen.append(areas.count()) or bounds(areas, key, precision))
    ring = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
    areas = spark.createDataFrame([(k, k % 2, ring) for k in range(20)], "id long, k long, rings array<array<struct<x:double,y:double>>>")
    assert sorted((r.k, r.area) for r in dissolve.dissolve(areas, "k").collect()) == [(0, 100.0), (1, 100.0)] and seen == [2]


def test_crowded_places_are_dealt_out(spark, monkeypatch):
    """Three hundred points in one place and a few around it: all pairs come, from many tasks, none of which has most of them."""
    monkeypatch.setattr(spatial, "PAIRS", 5000)
    points = spark.range(310).select("id", F.when(F.col("id") < 300, 1.0).otherwise(F.col("id") - 300.0).alias("x"), F.when(F.col("id") < 0, 1.0).otherwise(0.0).alias("y"))
    made = spatial.radius_pairs(points, points, 2.0).select("l_id", "r_id", F.spark_partition_id().alias("task")).collect()
    place = [1.0] * 300 + [float(k) for k in range(10)]
    want = {(i, j) for i, x in enumerate(place) for j, y in enumerate(place) if abs(x - y) <= 2}
    assert len(made) == len(want) and {(m.l_id, m.r_id) for m in made} == want
    tasks = [m.task for m in made]
    assert len(set(tasks)) > 6 and max(tasks.count(t) for t in set(tasks)) < len(made) / 3
    semi = spatial.within_semi(points, points.where("id >= 305"), 0.5)
    assert {r.id for r in semi.collect()} == set(range(305, 310))
