import math

import pytest
from pyspark.sql import functions as F

from brookflow.sources import gpkg, grid, layers, settings, xlsx


def test_geopackage_round_trip(spark, tmp_path):
    rows = [(1, "a", 2.5, [(0.0, 1.0), (2.0, 3.0)]), (2, None, None, [(5.0, 5.0), (6.0, 6.0), (7.0, 8.0)])]
    df = spark.createDataFrame(rows, "id long, code string, v double, coords array<struct<x:double,y:double>>")
    path = str(tmp_path / "x.gpkg")
    gpkg.write(df, path, "lines")
    got = [tuple(r)[:3] + ([tuple(p) for p in r["coords"]],) for r in layers.read_vector(spark, path, "lines").orderBy("id").collect()]
    assert got == rows
    assert layers.read_vector(spark, str(tmp_path / "none.gpkg")) is None


def test_geometry_blobs():
    import struct

    z = b"GP\x00\x01\x00\x00\x00\x00" + struct.pack("<BII", 1, 1002, 2) + struct.pack("<6d", 1, 2, 9, 3, 4, 9)
    assert gpkg.decode_line(z) == [(1, 2), (3, 4)]
    assert gpkg.decode_line(gpkg.encode_line([(1.5, 2.5), (3.0, 4.0)])) == [(1.5, 2.5), (3.0, 4.0)]
    assert gpkg.decode_line(None) is None
    ring = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (1.0, 2.0), (1.0, 1.0)]
    assert gpkg.decode(gpkg.encode_polygon([ring, hole])) == [[ring, hole]]
    piece = lambda n: struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", n, n, n + 1, n)
    multi = b"GP\x00\x01\x00\x00\x00\x00" + struct.pack("<BII", 1, 5, 2) + piece(1) + piece(7)
    assert gpkg.decode(multi) == [[(1, 1), (2, 1)], [(7, 7), (8, 7)]]
    with pytest.raises(ValueError):
        gpkg.decode_line(multi)
    with pytest.raises(ValueError):
        gpkg.decode(b"GP\x00\x01\x00\x00\x00\x00" + struct.pack("<BII", 1, 8, 0))


def test_polygons_and_multi_lines_of_a_geopackage(spark, tmp_path):
    import sqlite3
    import struct

    path = str(tmp_path / "p.gpkg")
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, [ring]), (2, None)], "id long, rings array<array<struct<x:double,y:double>>>")
    gpkg.write(df, path, "areas")
    gpkg.write(spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 1.0)])], "id long, coords array<struct<x:double,y:double>>"), path, "lines")
    got = gpkg.read(spark, path, "areas").orderBy("id").collect()
    assert [tuple(p) for p in got[0]["rings"][0]] == ring and got[1]["rings"] is None
    piece = lambda n: struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", n, n, n + 1, n)
    with sqlite3.connect(path) as db:
        db.execute("INSERT INTO lines VALUES (2, ?)", (b"GP\x00\x01\x00\x00\x00\x00" + struct.pack("<BII", 1, 5, 2) + piece(1) + piece(7),))
    assert sorted((r["id"], r["coords"][0]["x"]) for r in gpkg.read(spark, path, "lines").collect()) == [(1, 0.0), (2, 1.0), (2, 7.0)]


def test_settings_and_case(tmp_path):
    file = tmp_path / "s.toml"
    file.write_text('[case]\na = 1\ndir_resultaten = "r"\n[networkdata]\na = 2\nfile_name_lines = "l.gpkg"\n[gen]\nb = 3\n')
    s = settings.load_settings(str(file), "gen")
    assert (s["a"], s["b"], s["dir_results"], s.datasets()) == (2, 3, "r", {"lines": "l.gpkg"})
    with pytest.raises(KeyError):
        settings.load_settings(str(file), "other")
    with pytest.raises(ValueError):
        settings.check_case(str(tmp_path))
    (tmp_path / "0_basisdata").mkdir()
    assert settings.check_case(str(tmp_path))[1].is_dir()


def test_layers(spark, tmp_path):
    assert layers.write_layers({"x": spark.range(3), "y": None}, str(tmp_path)) == ["x"]
    assert set(layers.read_layers(spark, str(tmp_path), ["x", "y"])) == {"x"}
    with pytest.raises(ValueError):
        layers.write_layers({"z": 1}, str(tmp_path))


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([("a & b", 1.5, 2), ("c", float("inf"), None)], "name string, v double, n int")
    path = str(tmp_path / "t.xlsx")
    xlsx.write_tables(path, {"First": df, "Second": spark.createDataFrame([(1.0,)], "x double")})
    got = xlsx.read_table(spark, path, "First").collect()
    assert got[0]["name"] == "a & b" and got[0]["v"] == 1.5 and got[1]["v"] == pytest.approx(1.797e308, rel=1e-3) and got[1]["n"] is None
    assert set(xlsx.tables(path)) == {"First", "Second"} and math.isclose(xlsx.read_table(spark, path, "Second").first()["x"], 1.0)
    with pytest.raises(xlsx.TableNotFound):
        xlsx.read_table(spark, path, "Third")
    assert list(xlsx.sheets(path)) == ["First", "Second"] and xlsx.read_sheet(spark, path).columns == df.columns
    assert xlsx.read_sheet(spark, path, "Second").first()["x"] == 1.0
    for sheet, skip in (("Third", 0), ("Second", 2)):
        with pytest.raises(xlsx.TableNotFound):
            xlsx.read_sheet(spark, path, sheet, skip)


def test_grid_of_many_blocks(spark, tmp_path):
    """Rows keep their numbers however files are cut into blocks, and in whatever number of files they are."""
    cells = spark.createDataFrame([(r, c, float(100 * r + c)) for r in range(40) for c in range(5)], "r long, c long, v double")
    want = {(r, c): 100.0 * r + c for r in range(40) for c in range(5)}
    for files in (1, 4):
        grid.write_ascii(cells, str(tmp_path / f"g{files}"), 5, 40, 1.0, files=files)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128")
            back, head = grid.read_ascii(spark, str(tmp_path / f"g{files}"))
            assert {(x["r"], x["c"]): x["v"] for x in back.collect()} == want and head["nrows"] == 40
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_grid(spark, tmp_path):
    cells = spark.createDataFrame([(0, 0, 1.5), (1, 2, 2.5)], "r long, c long, v double")
    grid.write_ascii(cells, str(tmp_path / "g"), 3, 2, 2.0)
    back, head = grid.read_ascii(spark, str(tmp_path / "g"))
    assert sorted(map(tuple, back.collect())) == [(0, 0, 1.5), (1, 2, 2.5)] and head["ncols"] == 3
    with pytest.raises(ValueError):
        grid.read_ascii(spark, str(tmp_path / "g"), band=2)


def test_entry_schema(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["code", "total", "log_total"]
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and F is not None
