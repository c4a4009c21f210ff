"""The culvert workflow to its last layer, and crossing pairs against a test of all pairs."""

import random

import pytest

from brookflow.operators import spatial
from brookflow.plans.workflows import run_culverts

LINE = "code string, coords array<struct<x:double,y:double>>"


def layer(spark, **lines):
    return spark.createDataFrame([(c, [{"x": float(x), "y": float(y)} for x, y in p]) for c, p in lines.items()], LINE)


#: Cases far apart from each other, named by the last letter of their codes: lines of channels and of ditches.
CASES = {
    "a": ({"H": [(0, 0), (200, 0)]}, {"D": [(100, 120), (100, 20)]}),
    "b": ({"H": [(0, 0), (200, 0)]}, {"D": [(100, 120), (100, 20)], "S": [(160, 70), (100, 70)]}),
    "c": ({"H": [(0, 0), (200, 0)]}, {"D": [(100, 20), (100, 120)]}),
    "d": ({"H": [(0, 0), (200, 0)]}, {"D": [(230, 100), (200, 20)]}),
    "e": ({"H": [(0, 0), (400, 0)]}, {"E": [(100, 220), (100, 20)], "F": [(300, 120), (120, 120)]}),
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """All cases in one run: (layers, routed ditches by code as (coordinates, reversed, base code))."""
    def moved(side: int) -> dict:
        return {f"{c}{k}": [(x, y + 1000 * i) for x, y in p] for i, (k, case) in enumerate(CASES.items()) for c, p in case[side].items()}

    def made(**how):
        out = run_culverts(spark, {"hydroobject": layer(spark, **moved(0)), "overige_watergang": layer(spark, **moved(1))}, f"file://{tmp_path_factory.mktemp('culverts')}/out", **how)
        rows = {}
        for r in out["overige_watergang_processed_3"].collect():
            rows[r["code"]] = ([(p["x"], p["y"] - 1000 * list(CASES).index(r["code"][1])) for p in r["coords"]], r["reversed_direction"], r["base_code"])
        return out, rows

    return made


def test_ditches_reach_their_channels(run):
    made, got = run()
    assert got["Da"] == ([(100, 120), (100, 20), (100, 20), (100, 0)], False, "Da")
    assert {r["code"] for r in made["hydroobject_processed_0"].where("code like 'Ha%'").collect()} == {"Ha-0", "Ha-1"}
    assert [tuple(r) for r in made["outflow_nodes_overig"].where("dangling_code = 'Da'").select("x", "y").collect()] == [(100.0, 0.0)]
    nodes = {(r["x"], r["y"]): r["outflow_nodes_hydro_dist"] for r in made["overige_watergang_processed_3_nodes"].where("y < 500").collect()}
    assert nodes == {(100.0, 120.0): 120.0, (100.0, 0.0): 0.0}
    # D is cut by its side ditch while it is prepared; its lower part, Db-1, is the one with the culvert
    assert got["Db-1"] == ([(100, 70), (100, 20), (100, 20), (100, 0)], False, "Db-1")
    assert got["Db-0"][:2] == ([(100, 120), (100, 70)], False) and got["Sb"][:2] == ([(160, 70), (100, 70)], False)
    # drawn against the flow
    assert got["Dc"] == ([(100, 120), (100, 20), (100, 20), (100, 0)], True, "Dc")
    # nothing starts where the channel ends, so the check turns the culvert away from its ditch
    assert got["Dd"] == ([(230, 100), (200, 20), (200, 20), (200, 0)], False, "Dd")
    # F reaches E's middle, E the channel: E is cut where F's culvert ends
    assert got["Fe"][0] == [(300, 120), (120, 120), (120, 120), (100, 120)] and got["Ee-0"][0] == [(100, 220), (100, 120)]
    assert got["Ee-1"][0] == [(100, 120), (100, 20), (100, 20), (100, 0)] and len(got) == 9


def test_culverts_turned_away_may_stay_apart(run):
    assert "Dd" not in run(attach_rest=False)[1]


def plain_crossing(a, b):
    """Whether two segments cross inside both."""
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    return side(*a, b[0]) * side(*a, b[1]) < 0 and side(*b, a[0]) * side(*b, a[1]) < 0


@pytest.mark.parametrize(("long", "cell"), [(40, None), (900, None), (900, 7.0), (3, 500.0)])
def test_crossing_pairs_against_all_pairs(spark, long, cell):
    r = random.Random(long)

    def lines(n, size):
        ends = []
        for i in range(n):
            x, y = r.uniform(-500, 500), r.uniform(-500, 500)
            ends.append((i, [(x, y), r.choice([(x + r.uniform(-size, size), y + r.uniform(-size, size)), (x, y + size), (x + size, y)])]))
        return ends

    a, b = lines(80, 60), lines(90, long)
    frames = [spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in p]) for i, p in ls], "id long, coords array<struct<x:double,y:double>>") for ls in (a, b)]
    got = sorted(map(tuple, spatial.crossing_pairs(*frames, cell).collect()))
    assert got == sorted((i, j) for i, p in a for j, q in b if plain_crossing(p, q))


def test_long_segments_take_cells_by_length(spark):
    """A diagonal over a thousand cells each way is in about two thousand, not in a million."""
    seg = spark.createDataFrame([(0, 0.0, 0.0, 1000.0, 999.0), (1, 0.5, 1000.0, 0.5, 0.0), (2, 7.0, 3.0, 2.0, 3.0)], "id long, ax double, ay double, bx double, by double")
    counts = {r["id"]: r["count"] for r in spatial._spread(seg, 1.0).groupBy("id").count().collect()}
    assert 1990 < counts[0] < 3100 and counts[1] <= 3 * 1003 and counts[2] <= 3 * 8


def test_shortest_candidates_are_those_of_all_pairs(spark):
    """Random lines on a coarse grid, so that many vertices share a place or a distance; few candidates may be looked at."""
    from pyspark.sql import functions as F

    from brookflow.operators import culverts, windows
    from brookflow.operators import lines as ln

    rng = random.Random(7)
    rows = [(f"L{i}", [{"x": float(rng.randrange(0, 120, 4)), "y": float(rng.randrange(0, 120, 4))} for _ in range(2)]) for i in range(150)]
    lines = spark.createDataFrame([r for r in rows if r[1][0] != r[1][1]], LINE)
    v = ln.line_to_vertices(lines, 9.0).withColumn("id", F.concat_ws(":", "code", "line_type", F.round("distance_from_start", 3).cast("string")))
    v = v.withColumn("WaterLineType", F.when(F.crc32("code") % 4 == 0, "overige_watergang").otherwise("hydroobject")).withColumns({"crossings_nwb": F.lit(False), "crossings_peilgebied": F.lit(False)}).withColumn("score", culverts.score())
    ends = v.where("line_type <> 'other'")
    every = culverts.add_geometry(culverts.candidates(ends, v, 40.0).withColumns({"crossings_nwb": F.lit(False), "crossings_peilgebied": F.lit(False), "score": culverts.score()}), lines)
    least = windows.keep_first(every.where("fictive_length <= 40"), ["dangling_id", "score"], ["fictive_length", "unique_id"])
    made = culverts.add_geometry(culverts.shortest_candidates(ends, v, lines, 40.0), lines)
    columns = ["dangling_id", "dangling_code", "score", "unique_id", "code", "length", "fictive_length"]
    want = {tuple(r) for r in least.select(columns).collect()}
    assert {tuple(r) for r in made.select(columns).collect()} == want and len(want) > 500
    assert made.count() == len(want) < every.count() / 5


def test_candidates_behind_walls_are_left_out_before_they_are_tested(spark):
    """Random lines on a coarse grid, so that many share stretches or places: the same ones stay, and few of all pairs are tested against all walls."""
    from pyspark.sql import functions as F

    from brookflow.operators import culverts, windows
    from brookflow.operators import lines as ln

    rng = random.Random(11)
    bent = [(f"L{i}", [{"x": float(rng.randrange(0, 120, 4)), "y": float(rng.randrange(0, 120, 4))} for _ in range(rng.choice((2, 3)))]) for i in range(150)]
    lines = spark.createDataFrame([r for r in bent if r[1][0] != r[1][-1] and r[1][0] != r[1][1]], LINE)
    v = ln.line_to_vertices(lines, 9.0).withColumn("id", F.concat_ws(":", "code", "line_type", F.round("distance_from_start", 3).cast("string"))).withColumn("WaterLineType", F.lit("overige_watergang"))
    ends = windows.keep_unique(v.where("line_type <> 'other'"), ["x", "y"])
    walls = lines.select(F.lit("overige_watergang").alias("kind"), "code", "coords")

    def uncrossed(found):
        found = found.withColumn("id", F.concat_ws(">", "dangling_id", "unique_id"))
        hit = spatial.barrier_crossings(found.select("id", "coords", "code", "dangling_code"), walls, 40.0)
        return found.count(), {tuple(r) for r in found.join(hit, "id", "left_anti").select("dangling_id", "unique_id", "length").collect()}

    every, want = uncrossed(culverts.candidates(ends, v, 40.0))
    tested, got = uncrossed(culverts.candidates(culverts.walls_near(ends, walls, 40.0), v, 40.0))
    assert got == want and len(want) > 50
    assert tested < every / 3


def test_culverts_between_lines_that_touch_go_however_many_meet_there(spark):
    """Four lines meet in one place: no pair of them keeps a culvert, the line that is apart keeps its own."""
    from brookflow.operators import culverts

    lines = layer(spark, A=[(0, 0), (10, 0)], B=[(0, 0), (0, 10)], C=[(9, 9), (0, 0)], D=[(0, 0), (5, 9)], E=[(30, 0), (40, 0)], F=[(10, 0), (9, 9)])
    pairs = [("D", "C"), ("C", "B"), ("D", "A"), ("A", "E"), ("F", "C"), ("F", "B"), ("B", "B")]
    found = spark.createDataFrame([(a, b, f"{a}>{b}", "overige_watergang", 1.0, 1) for a, b in pairs], "dangling_code string, code string, unique_id string, WaterLineType string, fictive_length double, selected_score int")
    assert {(r["a"], r["b"]) for r in culverts.touching_pairs(found, lines).collect()} == {("D", "C"), ("C", "B"), ("D", "A"), ("F", "C")}
    assert {(r["dangling_code"], r["code"]) for r in culverts.post_process(found, culverts.touching_pairs(found, lines)).collect()} == {("A", "E"), ("F", "B"), ("B", "B")}


def test_culvert_pipeline_leaves_no_culvert_between_lines_that_touch(spark):
    """More than two lines meet at most nodes: all of their pairs are looked at, as a plain look at all ends shows."""
    import __spark_entry__
    from brookflow.plans.queries import net_lines

    sf = "/root/testdata/sf0.001"
    ends = {r["code"]: {(p["x"], p["y"]) for p in r["coords"]} for r in net_lines(spark, sf).collect()}
    made = __spark_entry__.queries()["culvert_pipeline"](spark, sf).collect()
    assert made and not [r for r in made if ends[r["dangling_code"]] & ends[r["code"]]]
