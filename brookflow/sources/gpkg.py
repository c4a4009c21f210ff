"""GeoPackage: a reader as a Spark data source over sqlite3, split by row id, and a writer.

Lines and points are arrays of x and y in the column coords, polygons arrays of such
rings in the column rings. A multi geometry gives a row per part.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import types as T

LINE = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
RINGS = T.ArrayType(LINE)
_KINDS = {"INTEGER": T.LongType(), "MEDIUMINT": T.LongType(), "INT": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType()}
#: Bytes of the envelope by its code in the header's flags.
_ENVELOPE = (0, 32, 48, 48, 64)
ROWS = 50_000


def _blob(srs: int, kind: int, body: bytes) -> bytes:
    """GeoPackage header without envelope and a little-endian geometry."""
    return b"GP\x00\x01" + struct.pack("<i", srs) + struct.pack("<BI", 1, kind) + body


def _encoded(points: list[tuple[float, float]]) -> bytes:
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def encode_line(points: list[tuple[float, float]], srs: int = 28992) -> bytes:
    return _blob(srs, 2, _encoded(points))


def encode_polygon(rings: list[list[tuple[float, float]]], srs: int = 28992) -> bytes:
    return _blob(srs, 3, struct.pack("<I", len(rings)) + b"".join(map(_encoded, rings)))


def decode(blob: bytes | None) -> list:
    """The parts of a geometry: vertices of points and lines, rings of polygons; further dimensions are dropped. None has one part, None."""
    if blob is None:
        return [None]
    parts: list = []

    def geometry(at: int) -> int:
        """Reads what begins at a byte and tells where it ends."""
        order = "<" if blob[at] else ">"
        code = struct.unpack_from(order + "I", blob, at + 1)[0]
        kind, thousands = (code & 0x0FFFFFFF) % 1000, (code & 0x0FFFFFFF) // 1000
        dims = 2 + (thousands in (1, 3) or bool(code & 0x80000000)) + (thousands in (2, 3) or bool(code & 0x40000000))
        at += 5

        def count() -> int:
            return struct.unpack_from(order + "I", blob, at)[0]

        def vertices(n: int, at: int) -> list[tuple[float, float]]:
            return [struct.unpack_from(order + "dd", blob, at + 8 * dims * i) for i in range(n)]

        if kind == 1:
            parts.append(vertices(1, at))
            return at + 8 * dims
        if kind == 2:
            parts.append(vertices(count(), at + 4))
            return at + 4 + 8 * dims * count()
        if kind == 3:
            rings, left = [], count()
            at += 4
            for _ in range(left):
                n = count()
                rings.append(vertices(n, at + 4))
                at += 4 + 8 * dims * n
            parts.append(rings)
            return at
        if 4 <= kind <= 7:
            left = count()
            at += 4
            for _ in range(left):
                at = geometry(at)
            return at
        raise ValueError(f"geometry type {kind} has no form here")

    geometry(8 + _ENVELOPE[blob[3] >> 1 & 7])
    return parts


def decode_line(blob: bytes | None) -> list[tuple[float, float]] | None:
    """Vertices of a geometry of one part."""
    parts = decode(blob)
    if len(parts) != 1:
        raise ValueError(f"a geometry of {len(parts)} parts isn't one line")
    return parts[0]


def _columns(path: str, layer: str | None) -> tuple[str, tuple[str, bool] | None, list[tuple[str, str]]]:
    """(layer, (geometry column, whether of polygons), [(column, type)])"""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        layer = layer or db.execute("SELECT table_name FROM gpkg_contents ORDER BY rowid LIMIT 1").fetchone()[0]
        geometry = db.execute("SELECT column_name, geometry_type_name LIKE '%POLYGON' FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()
        return layer, geometry and (geometry[0], bool(geometry[1])), [(r[1], r[2].split("(")[0].upper()) for r in db.execute(f'PRAGMA table_info("{layer}")')]


class GeoPackage(DataSource):
    """format("gpkg") with the options path and layer; the path must be one that executors can open."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> T.StructType:
        _, geometry, columns = _columns(self.options["path"], self.options.get("layer"))
        shape, polygons = geometry or (None, False)
        place = T.StructField("rings", RINGS) if polygons else T.StructField("coords", LINE)
        return T.StructType([place if n == shape else T.StructField(n, _KINDS.get(k, T.StringType())) for n, k in columns])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("layer"))


class _Reader(DataSourceReader):
    def __init__(self, path: str, layer: str | None) -> None:
        self.path, (self.layer, self.geometry, self.columns) = path, _columns(path, layer)

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            top = db.execute(f'SELECT coalesce(max(rowid), 0) FROM "{self.layer}"').fetchone()[0]
        return [InputPartition(x) for x in range(0, max(top, 1), ROWS)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at = [n for n, _ in self.columns].index(self.geometry[0]) if self.geometry else None
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for row in db.execute(f'SELECT * FROM "{self.layer}" WHERE rowid > ? AND rowid <= ?', (partition.value, partition.value + ROWS)):
                for part in [None] if at is None else decode(row[at]):
                    yield tuple(part if i == at else v for i, v in enumerate(row))


def read(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    open(path, "rb").close()
    spark.dataSource.register(GeoPackage)
    reader = spark.read.format("gpkg").option("path", path)
    return (reader.option("layer", layer) if layer else reader).load()


def write(df: DataFrame, path: str, layer: str) -> None:
    """Replace a layer (coords or rings) of a file for exchange with desktop programs. Rows stream through the driver, one partition at a time: for results of map size."""
    place, kind = ("rings", "POLYGON") if "rings" in df.columns else ("coords", "LINESTRING")
    names = [c for c in df.columns if c != place]
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "boolean": "BOOLEAN"}
    types = dict(df.dtypes)

    def points(line: list) -> list[tuple[float, float]]:
        return [(p["x"], p["y"]) for p in line]

    with sqlite3.connect(path) as db:
        db.executescript(
            "CREATE TABLE IF NOT EXISTS gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER);"
            "CREATE TABLE IF NOT EXISTS gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z TINYINT, m TINYINT);"
        )
        db.execute(f'DROP TABLE IF EXISTS "{layer}"')
        db.execute("DELETE FROM gpkg_contents WHERE table_name = ?", (layer,))
        db.execute("DELETE FROM gpkg_geometry_columns WHERE table_name = ?", (layer,))
        db.execute(f'CREATE TABLE "{layer}" (' + ", ".join([*(f'"{n}" {kinds.get(types[n], "TEXT")}' for n in names), f"geom {kind}"]) + ")")
        db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, 28992)", (layer, layer))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', ?, 28992, 0, 0)", (layer, kind))
        put = f'INSERT INTO "{layer}" VALUES ({", ".join("?" * (len(names) + 1))})'
        for r in df.toLocalIterator():
            blob = None
            if r[place] is not None:
                blob = encode_polygon([points(x) for x in r[place]]) if kind == "POLYGON" else encode_line(points(r[place]))
            db.execute(put, [*(r[n] for n in names), blob])
