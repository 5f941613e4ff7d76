"""Points, lines and areas in WKT: parsing, validity, containment, grid joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.skew import spread_join
from tidelog.sources.shared import written


def _numbers(text: Column) -> Column:
    """The ``x, y`` pairs of a list of coordinates."""
    number = lambda p, i: F.get(F.split(F.trim(p), r"\s+"), F.lit(i)).try_cast("double")
    return F.transform(F.split(text, ","), lambda p: F.struct(number(p, 0).alias("x"), number(p, 1).alias("y")))


def _lists(text: Column) -> Column:
    """The innermost lists of coordinates of a geometry's text."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"[^()]*[0-9][^()]*"), 0), _numbers)


def polygons(wkt: Column) -> Column:
    """The parts of a POLYGON or MULTIPOLYGON, each an array of rings (the first is the shell) of ``x, y``. Anything else has none."""
    inner = F.regexp_extract(wkt, r"(?is)^\s*(?:MULTI)?POLYGON\s*Z?\s*\(\s*(\(.*\))\s*\)\s*$", 1)
    parts = F.when(F.rlike(wkt, F.lit(r"(?i)^\s*MULTI")), F.split(inner, r"\)\s*\)\s*,\s*\(\s*\(")).otherwise(F.array(inner))
    return F.filter(F.transform(parts, _lists), lambda p: F.size(p) > 0)


def rings(wkt: Column) -> Column:
    """All rings of a POLYGON or MULTIPOLYGON as arrays of ``x, y``."""
    return F.flatten(polygons(wkt))


def lines(wkt: Column) -> Column:
    """The lines of a LINESTRING or MULTILINESTRING as arrays of ``x, y``."""
    return _lists(F.regexp_extract(wkt, r"(?is)^\s*(?:MULTI)?LINESTRING\s*Z?\s*(\(.*\))\s*$", 1))


def points(wkt: Column) -> Column:
    """The points of a POINT or MULTIPOINT as ``x, y``."""
    return F.flatten(_lists(F.regexp_extract(wkt, r"(?is)^\s*(?:MULTI)?POINT\s*Z?\s*(\(.*\))\s*$", 1)))


def point(wkt: Column) -> Column:
    """The ``x, y`` of a POINT; null for anything else."""
    number = lambda i: F.regexp_extract(wkt, r"(?i)^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$", i)
    return F.when(number(1) != "", F.struct(number(1).cast("double").alias("x"), number(2).cast("double").alias("y")))


def edges(polygon: Column) -> Column:
    """All edges of all rings as ``x1, y1, x2, y2``."""
    of_ring = lambda r: F.transform(F.sequence(F.lit(0), F.greatest(F.size(r) - 2, F.lit(0))), lambda i: F.struct(F.get(r, i)["x"].alias("x1"), F.get(r, i)["y"].alias("y1"), F.get(r, i + 1)["x"].alias("x2"), F.get(r, i + 1)["y"].alias("y2")))
    return F.flatten(F.transform(polygon, of_ring))


def _side(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _bound(value: Column, use) -> Column:
    """``use(value)``, the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _box(own: Column) -> dict[str, Column]:
    """The least and greatest coordinates of edges."""
    ends = lambda pick, a: F.transform(own, lambda v: pick(v[f"{a}1"], v[f"{a}2"]))
    return {f"low{a}": F.array_min(ends(F.least, a)) for a in "xy"} | {f"high{a}": F.array_max(ends(F.greatest, a)) for a in "xy"}


def _blocks(own: Column, size: int = 32) -> Column:
    """Edges in their order, ``size`` to a block, with the box of each block."""
    block = lambda e: F.struct(e.alias("e"), *[v.alias(n) for n, v in _box(e).items()])
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(own) - 1) / size).cast("int"))), lambda i: block(F.slice(own, i * size + 1, F.lit(size))))


def is_valid(polygon: Column, own: Column | None = None) -> Column:
    """Rings of at least four points that are closed, and no two edges that cross. ``own``: the edges, if there is a column of them.

    Edges of a ring lie near each other: only blocks of edges whose boxes meet are compared, so that long outlines take little more than their length.
    """
    closed = F.forall(polygon, lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.element_at(r, -1)))
    known = F.forall(polygon, lambda r: F.forall(r, lambda p: p["x"].isNotNull() & p["y"].isNotNull()))
    own = edges(polygon) if own is None else own
    differ = lambda a, b, c, d, e: _side(e, a, b) * _side(e, c, d) < 0
    cross = lambda e, o: differ(e["x1"], e["y1"], e["x2"], e["y2"], o) & differ(o["x1"], o["y1"], o["x2"], o["y2"], e)
    meet = lambda b, c: (b["lowx"] <= c["highx"]) & (c["lowx"] <= b["highx"]) & (b["lowy"] <= c["highy"]) & (c["lowy"] <= b["highy"])
    reaches = lambda e, c: (F.least(e["x1"], e["x2"]) <= c["highx"]) & (c["lowx"] <= F.greatest(e["x1"], e["x2"])) & (F.least(e["y1"], e["y2"]) <= c["highy"]) & (c["lowy"] <= F.greatest(e["y1"], e["y2"]))
    crossed = lambda b, c: F.exists(b["e"], lambda e: reaches(e, c) & F.exists(c["e"], lambda o: cross(e, o)))
    any_ = _bound(_bound(own, lambda e: _blocks(e)), lambda blocks: F.exists(blocks, lambda b: F.exists(blocks, lambda c: meet(b, c) & crossed(b, c))))
    return F.coalesce((F.size(polygon) > 0) & known & closed & ~any_, F.lit(False))


def contains(own: Column, x: Column, y: Column) -> Column:
    """Whether the point lies inside the polygon with the ``own`` edges; points on the boundary don't. Rays are cast to the right, so holes count as outside."""
    between = lambda v, a, b: (v >= F.least(a, b)) & (v <= F.greatest(a, b))
    on_edge = F.exists(own, lambda e: (_side(e, x, y) == 0) & between(x, e["x1"], e["x2"]) & between(y, e["y1"], e["y2"]))
    hits = F.filter(own, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])))
    return ~on_edge & (F.size(hits) % 2 == 1)


def _widest(own: Column) -> Column:
    """``w, x, y``: the middle of the widest span inside on the line at half height (a little off it where a corner lies there)."""
    box = _box(own)
    y = box["lowy"] + (box["highy"] - box["lowy"]) * 0.5000001
    cuts = F.array_sort(F.transform(F.filter(own, lambda e: (e["y1"] > y) != (e["y2"] > y)), lambda e: e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])))
    spans = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.size(cuts) / 2).cast("int") - 1)), lambda i: F.struct((F.get(cuts, 2 * i + 1) - F.get(cuts, 2 * i)).alias("w"), F.get(cuts, 2 * i).alias("a")))
    widest = F.array_max(spans)
    return F.struct(widest["w"].alias("w"), (widest["a"] + widest["w"] / 2).alias("x"), y.alias("y"))


def point_on_surface(parts: Column) -> Column:
    """A point inside an area (``polygons``): of its parts the one with the widest span decides."""
    best = F.array_max(F.transform(parts, lambda p: _bound(edges(p), lambda e: _widest(e))))
    return F.struct(best["x"].alias("x"), best["y"].alias("y"))


def _nearest(candidates: Column, x: Column, y: Column) -> Column:
    """The candidate nearest to a place, ties to the least."""
    found = F.array_min(F.transform(candidates, lambda p: F.struct(((p["x"] - x) * (p["x"] - x) + (p["y"] - y) * (p["y"] - y)).alias("d"), p["x"].alias("x"), p["y"].alias("y"))))
    return F.struct(found["x"].alias("x"), found["y"].alias("y"))


def point_on_lines(parts: Column) -> Column:
    """The inner corner of lines nearest to their middle; of lines without one, the nearest end."""
    own = F.flatten(F.transform(parts, lambda r: edges(F.array(r))))
    length = lambda e: F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])
    total = lambda value: F.aggregate(own, F.lit(0.0), lambda s, e: s + value(e))
    middle = lambda a: total(lambda e: length(e) * (e[f"{a}1"] + e[f"{a}2"]) / 2) / F.greatest(total(length), F.lit(1e-300))
    inner = F.flatten(F.transform(parts, lambda r: F.slice(r, F.lit(2), F.greatest(F.size(r) - 2, F.lit(0)))))
    return _nearest(F.when(F.size(inner) > 0, inner).otherwise(F.flatten(parts)), middle("x"), middle("y"))


def surface_point(wkt: Column) -> Column:
    """A point on any geometry's surface: inside a valid area, on a line, or one of the points. Null for all else."""
    mean = lambda single, a: F.aggregate(single, F.lit(0.0), lambda s, p: s + p[a]) / F.size(single)
    middle = lambda single: F.struct(mean(single, "x").alias("x"), mean(single, "y").alias("y"))
    of_area = lambda parts: F.when(is_valid(F.flatten(parts)), point_on_surface(parts))
    of_lines = lambda drawn: F.when(F.size(F.flatten(drawn)) > 1, point_on_lines(drawn))
    of_points = lambda single: F.when(F.size(single) > 0, _bound(middle(single), lambda m: _nearest(single, m["x"], m["y"])))
    kind = F.upper(F.ltrim(wkt))
    at = F.when(kind.contains("POLYGON"), _bound(polygons(wkt), of_area))
    at = at.when(kind.contains("LINESTRING"), _bound(lines(wkt), of_lines))
    return at.when(kind.contains("POINT"), _bound(points(wkt), of_points))


def once(value: Column) -> Column:
    """``value`` as a row of its own, so that what is asked of it later (filters above all) doesn't work it out again."""
    return F.explode(F.array(value))


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """``df`` dealt out to all tasks: geometries cost far more to work on than to read, and one small file is one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _cell(v: Column, cell: float, level: Column) -> Column:
    return F.floor(v / (cell * F.pow(F.lit(2.0), level))).cast("long")


def area_edges(dst: DataFrame, geo: Column) -> DataFrame:
    """``dst`` with its ``_edges`` and their number ``_area``, each valid area once, written to the shared folder; others are left out."""
    areas = dealt(dst).withColumn("_rings", once(rings(geo))).withColumn("_edges", once(edges(F.col("_rings")))).where(is_valid(F.col("_rings"), F.col("_edges")))
    return written(areas.drop("_rings").withColumn("_area", F.monotonically_increasing_id()), "areas")


def gridded(areas: DataFrame, cell: float) -> DataFrame:
    """``_area`` and the grid cells (``_level, _cx, _cy``) that each area covers, a row per cell.

    A cell of level ``l`` has the side ``cell * 2**l``. Each area is put on the level
    where it covers at most five cells a side, so none is repeated more than 25 times,
    however large it is; its edges aren't repeated.
    """
    boxes = areas.select("_area", *[v.alias(f"_{n}") for n, v in _box(F.col("_edges")).items()])
    extent = F.greatest(F.col("_highx") - F.col("_lowx"), F.col("_highy") - F.col("_lowy"))
    boxes = boxes.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(extent, F.lit(1e-300)) / (4 * cell)))).cast("int"))
    span = lambda a: F.sequence(_cell(F.col(f"_low{a}"), cell, F.col("_level")), _cell(F.col(f"_high{a}"), cell, F.col("_level")))
    return boxes.withColumn("_cx", F.explode(span("x"))).withColumn("_cy", F.explode(span("y"))).select("_area", "_level", "_cx", "_cy")


def located(src: DataFrame, geo: Column, cell: float, levels: list[int]) -> DataFrame:
    """``src`` with a point ``_p`` on each geometry's surface and its grid cell on each of ``levels``. Null and invalid geometries have no point and one row."""
    rows = dealt(src).withColumn("_p", once(surface_point(geo))).withColumn("_level", F.explode_outer(F.when(F.col("_p.x").isNotNull(), F.array(*map(F.lit, levels)).cast("array<int>"))))
    return rows.withColumns({"_cx": _cell(F.col("_p.x"), cell, F.col("_level")), "_cy": _cell(F.col("_p.y"), cell, F.col("_level"))})


def levels_of(grid: DataFrame) -> list[int]:
    """The levels in use: a few dozen numbers at most, as each doubles the cell."""
    return sorted(r["_level"] for r in grid.select("_level").distinct().collect())


def inside(src: DataFrame, dst: DataFrame, src_geo: Column, dst_geo: Column, cell: float) -> DataFrame:
    """``src`` with its point ``_p``, joined with the valid areas of ``dst`` that it lies in: columns ``_s`` and ``_d`` hold both whole rows.

    Cells that hold many points are split (``spread_join``), and so are areas: their
    candidates meet the edges by the area's number, so edges are moved once a piece
    and not once a cell.
    """
    areas = area_edges(dst.select(F.struct("*").alias("_d"), dst_geo.alias("_geo")), F.col("_geo")).drop("_geo")
    grid = written(gridded(areas, cell), "area-cells")
    rows = src.select(F.struct("*").alias("_s"), src_geo.alias("_geo"))
    points_ = written(located(rows, F.col("_geo"), cell, levels_of(grid)).where("_p.x IS NOT NULL").drop("_geo"), "located")
    near = spread_join(points_, grid, [(c, c) for c in ("_level", "_cx", "_cy")]).select("src._s", "src._p", "dst._area")
    met = spread_join(near, areas, [("_area", "_area")], residual=contains(F.col("dst._edges"), F.col("src._p.x"), F.col("src._p.y")))
    return met.select("src._s", "src._p", "dst._d")


def lies_in(src: DataFrame, dst: DataFrame, src_geo: str, dst_geo: str, cell: float) -> DataFrame:
    """Pairs ``src_id, dst_id`` where a point on the source's surface lies within the valid destination area.

    Areas go to the grid cells that their bounding box covers (``gridded``), sources
    to the cell of their point on each level in use; the join is on the cell, so nothing
    is compared with everything. A boundary point isn't inside. ``cell`` is best near
    the side of a small area.
    """
    found = inside(src.select(F.col("_id").alias("id"), F.col(src_geo).alias("geo")), dst.select(F.col("_id").alias("id"), F.col(dst_geo).alias("geo")), F.col("geo"), F.col("geo"), cell)
    return found.select(F.col("_s.id").alias("src_id"), F.col("_d.id").alias("dst_id"))


def union_points(df: DataFrame, key: str, geo: str) -> DataFrame:
    """``key, wkt``: the distinct points of each group (POINT or MULTIPOINT) as MULTIPOINT, in order of their coordinates."""
    found = df.select(key, F.explode(points(F.col(geo))).alias("p")).where("p.x IS NOT NULL AND p.y IS NOT NULL").distinct()
    text = F.transform(F.array_sort(F.collect_list("p")), lambda p: F.concat(F.lit("("), _number(p["x"]), F.lit(" "), _number(p["y"]), F.lit(")")))
    return found.groupBy(key).agg(F.concat(F.lit("MULTIPOINT ("), F.array_join(text, ", "), F.lit(")")).alias("wkt"))


def _number(v: Column) -> Column:
    return v.cast("decimal(18,3)").cast("string")


def overlaps(df: DataFrame, key: str, geo: str) -> DataFrame:
    """Groups with an edge that more than two areas share, which therefore overlap."""
    flat = df.select(key, F.explode(edges(rings(F.col(geo)))).alias("e"))
    end = lambda i: F.struct(F.col(f"e.x{i}").alias("x"), F.col(f"e.y{i}").alias("y"))
    ends = F.array_sort(F.array(end(1), end(2)))
    return flat.groupBy(key, ends.alias("e")).agg(F.count("*").alias("n")).where("n > 2").select(key).distinct()
