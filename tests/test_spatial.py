"""Geometry values, validity, joins by place, and unions by planar overlay."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidelog.functions import overlay, spatial
from tidelog.functions.skew import spread_join


def wkt(*rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x} {y}" for x, y in [*r, r[0]]) + ")" for r in rings) + ")"


def box(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d)]


def rings_of(text):
    return [[tuple(map(float, p.split())) for p in r.split(",")] for r in re.findall(r"[^()]*[0-9][^()]*", text)]


def covers(text, x, y):
    """Even-odd over all rings."""
    odd = False
    for r in rings_of(text):
        for (x1, y1), (x2, y2) in zip(r, r[1:], strict=False):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                odd = not odd
    return odd


def area(text):
    """Shells run clockwise, holes counterclockwise."""
    return sum(-sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False)) / 2 for r in rings_of(text))


def united(spark, groups):
    rows = [(k, g) for k, gs in groups.items() for g in gs]
    u = overlay.union_areas(spark.createDataFrame(rows, "k string, g string"), "k", "g")
    return {r.k: r.wkt for r in u.areas.collect()}, {(r.k, r.problem): r.n for r in u.problems.collect()}


def test_known_unions(spark):
    frame = [wkt(box(0, 0, 10, 3)), wkt(box(0, 7, 10, 10)), wkt(box(0, 0, 3, 10)), wkt(box(7, 0, 10, 10))]
    got, problems = united(spark, {
        "cross": [wkt(box(0, 0, 2, 2)), wkt(box(1, 1, 3, 3))], "same": [wkt(box(0, 0, 1, 1)), wkt(box(0, 0, 1, 1)[::-1])], "inside": [wkt(box(0, 0, 9, 9)), wkt(box(2, 2, 3, 3))],
        "corner": [wkt(box(0, 0, 1, 1)), wkt(box(1, 1, 2, 2))], "island": [*frame, wkt(box(4, 4, 6, 6))], "nested": [*frame, wkt(box(4, 4, 6, 6), box(4.5, 4.5, 5.5, 5.5))],
        "step": [wkt(box(0, 0, 2, 1)), wkt(box(0.5, 1, 1, 2)), wkt(box(1, 1, 1.5, 3))], "bad": ["POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))", "nonsense", wkt(box(0, 0, 1, 1))], "none": ["LINESTRING (0 0, 1 1)"],
    })
    assert got["cross"] == "POLYGON ((0.000 0.000, 0.000 2.000, 1.000 2.000, 1.000 3.000, 3.000 3.000, 3.000 1.000, 2.000 1.000, 2.000 0.000, 0.000 0.000))"
    assert got["same"] == "POLYGON ((0.000 0.000, 0.000 1.000, 1.000 1.000, 1.000 0.000, 0.000 0.000))"
    assert area(got["inside"]) == 81 and len(rings_of(got["inside"])) == 1
    assert got["corner"].startswith("MULTIPOLYGON (((0.000 0.000, ") and len(rings_of(got["corner"])) == 2
    assert area(got["island"]) == 84 + 4 and got["island"].count("((") == 2 and len(rings_of(got["island"])) == 3
    assert area(got["nested"]) == 84 + 3 and len(rings_of(got["nested"])) == 4
    assert area(got["step"]) == 3.5 and len(rings_of(got["step"])) == 1  # a corner on another's edge
    assert problems == {("bad", "not a valid area"): 2, ("none", "not a valid area"): 1} and set(got) == {"cross", "same", "inside", "corner", "island", "nested", "step", "bad"}


def test_random_unions_cover_what_their_parts_cover(spark):
    rng = random.Random(7)
    groups = {}
    for k in range(12):
        shapes = []
        for _ in range(rng.randint(2, 14)):
            cx, cy, r, n = rng.uniform(0, 20), rng.uniform(0, 20), rng.uniform(1, 8), rng.randint(3, 9)
            ring = [(cx + r * math.cos(2 * math.pi * i / n + k), cy + r * math.sin(2 * math.pi * i / n + k) * 0.7) for i in range(n)]
            shapes.append(wkt(ring if rng.random() < 0.5 else ring[::-1], *([[((x + cx) / 2, (y + cy) / 2) for x, y in ring]] if rng.random() < 0.3 else [])))
        groups[f"g{k}"] = shapes
    got, problems = united(spark, groups)
    assert not problems and set(got) == set(groups)
    for k, shapes in groups.items():
        for _ in range(300):
            x, y = rng.uniform(-8, 28), rng.uniform(-8, 28)
            assert covers(got[k], x, y) == any(covers(s, x, y) for s in shapes), (k, x, y)


def test_grids_of_tiles_and_thirds(spark):
    """Coordinates that aren't exact in binary, corners on edges, and tiles of two sizes."""
    tiles = [wkt(box(i / 3, j / 3, (i + 1) / 3, (j + 1) / 3)) for i in range(9) for j in range(6)] + [wkt(box(3 + i * 0.7, 0, 3.7 + i * 0.7, 2)) for i in range(5)]
    got, problems = united(spark, {"t": tiles})
    assert not problems and len(rings_of(got["t"])) == 1 and abs(area(got["t"]) - (3 * 2 + 3.5 * 2)) < 0.02


def test_a_long_ring_is_spread(spark):
    """One group whose outline has 6,000 edges: each step deals its rows evenly."""
    n = 3000
    angle = lambda i: F.lit(2 * math.pi / n) * i
    at = lambda r, i: F.concat((r * F.cos(angle(i))).cast("decimal(12,6)").cast("string"), F.lit(" "), (r * F.sin(angle(i))).cast("decimal(12,6)").cast("string"))
    tile = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", at(500, F.col("id")), at(500, F.col("id") + 1), at(400, F.col("id") + 1), at(400, F.col("id")), at(500, F.col("id"))), F.lit("))"))
    u = overlay.union_areas(spark.range(n).select(F.lit("ring").alias("k"), tile.alias("g")), "k", "g")
    row = u.areas.collect()[0]
    rings = rings_of(row.wkt)
    assert u.problems.count() == 0 and sorted(len(r) for r in rings) == [n + 1, n + 1] and row.wkt.startswith("POLYGON")
    links = spark.range(30_000).select(F.col("id").alias("piece"), ((F.col("id") + 1) % 30_000).alias("next"))
    ranked = overlay.ranked_cycles(links)
    assert ranked.where("leader <> 0 OR steps <> (30000 - piece) % 30000").count() == 0
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 2 * 30_000 / max(1, len(sizes))


def test_geometry_values(spark):
    cases = {
        "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5, 1 0.5, 1 1, 0.5 1, 0.5 0.5)), ((5 5, 9 5, 9 6, 5 6, 5 5)))": (2, (7.0, 5.5)), "POLYGON((0 0,4 0,4 4,0 4,0 0))": (1, (2.0, 2.0)),
        "LINESTRING (0 0, 1 1, 9 9)": (0, (1.0, 1.0)), "LINESTRING (0 0, 4 0)": (0, (0.0, 0.0)), "MULTILINESTRING ((0 0, 1 0), (5 0, 6 0, 7 0))": (0, (6.0, 0.0)), "MULTIPOINT ((0 0), (4 4), (5 5))": (0, (4.0, 4.0)),
        "MULTIPOINT (1 2, 1 2)": (0, (1.0, 2.0)), "point ( 3 4 )": (0, (3.0, 4.0)), "POLYGON EMPTY": (0, None), "MULTIPOLYGON (((0 0, 2 2, 2 0, 0 2, 0 0)))": (1, None), "LINESTRING (1 1)": (0, None), "x": (0, None), "POLYGON ((a b, c d, e f, a b))": (0, None),
    }
    df = spark.createDataFrame([(w,) for w in cases] + [(None,)], "w string")
    got = {r.w: (r.n, r.p and (round(r.p.x, 4), round(r.p.y, 4))) for r in df.select("w", F.size(spatial.polygons(F.col("w"))).alias("n"), spatial.surface_point(F.col("w")).alias("p")).collect()}
    assert got.pop(None)[1] is None
    assert {w: (n, p) for w, (n, p) in got.items()} == cases


def test_long_outlines_are_judged_quickly(spark):
    n = 10_000
    ring = [((2 + math.sin(i)) * math.cos(2 * math.pi * i / n) * 100, (2 + math.sin(i)) * math.sin(2 * math.pi * i / n) * 100) for i in range(n)]
    star = [(x, y) for x, y in ring]
    crossed = ring[: n // 2] + [ring[10], *ring[n // 2 :]]
    df = spark.createDataFrame([("good", wkt(star)), ("bad", wkt(crossed))], "k string, w string")
    start = time.time()
    got = {r.k: r.v for r in df.select("k", spatial.is_valid(spatial.rings(F.col("w"))).alias("v")).collect()}
    assert got == {"good": True, "bad": False} and time.time() - start < 60


def test_multi_part_areas_and_hot_cells(spark):
    dst = spark.createDataFrame([("two", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((50 50, 60 50, 60 60, 50 60, 50 50)))"), ("one", "POLYGON ((0.5 0.5, 3 0.5, 3 3, 0.5 3, 0.5 0.5))")], "_id string, g string")
    spots = spark.range(4000).select(F.col("id").cast("string").alias("_id"), F.when(F.col("id") % 2 == 0, "POINT (0.75 0.75)").when(F.col("id") % 4 == 1, "LINESTRING (54 54, 55 55, 56 56)").otherwise("POINT (2 2)").alias("g"))
    found = spatial.lies_in(spots, dst, "g", "g", 1.0)
    assert {(r.dst_id, r["count"]) for r in found.groupBy("dst_id").count().collect()} == {("two", 3000), ("one", 3000)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_values_are_split_and_lose_nothing(spark, how):
    left = spark.range(6000).select(F.col("id").alias("i"), F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.col("id") % 300).cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("1", 3), ("299", 4), (None, 5)], "c string, v int")
    plain = left.join(right, F.col("k") == F.col("c"), how).select("i", "k", "v")
    split = spread_join(left, right, [("k", "c")], how, pieces=16)
    assert sorted(map(str, split.select("src.i", "src.k", "dst.v").collect())) == sorted(map(str, plain.collect()))
    hot = split.where("src.k = 'hot'").groupBy("src._piece").count().collect()
    assert len(hot) == 16 and max(r["count"] for r in hot) < 2 * sum(r["count"] for r in hot) / 16


def test_one_file_is_worked_on_by_all_tasks(spark):
    """Geometries are dealt out before they are parsed, and a point is worked out once and not again in a filter."""
    rows = spark.range(400, numPartitions=1).select("id", F.concat(F.lit("POINT ("), "id", F.lit(" 1)")).alias("g"))
    found = spatial.located(rows, F.col("g"), 1.0, [0]).where("_p.x IS NOT NULL")
    assert found.count() == 400 and found.select(F.spark_partition_id()).distinct().count() == 4
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MULTI)?POINT") == 1
    squares = spark.range(400, numPartitions=1).select("id", F.lit(wkt(box(0, 0, 1, 1))).alias("g"))
    assert spatial.area_edges(squares, F.col("g")).select(F.input_file_name()).distinct().count() == 4


def test_problems_need_no_rings(spark, monkeypatch):
    rows = [("a", wkt(box(0, 0, 1, 1))), ("a", "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"), ("b", wkt(box(0, 0, 1, 1))), ("c", "nonsense")]
    df = spark.createDataFrame(rows, "k string, g string")
    want = sorted(map(tuple, overlay.union_areas(df, "k", "g").problems.collect()))
    monkeypatch.setattr(overlay, "ranked_cycles", None)
    assert sorted(map(tuple, overlay.union_problems(df, "k", "g").collect())) == want == [("a", "not a valid area", 1), ("c", "not a valid area", 1)]


def test_a_pair_of_edges_is_made_once(spark):
    """Edges that share many cells meet in the first of them, so no shuffle of pairs is needed to tell repeats apart."""
    rng = random.Random(3)
    rows = [(i, "g", *[round(rng.uniform(-4, 4), 6) for _ in range(4)]) for i in range(80)] + [(80, "g", -4.0, 1.0, 4.0, 1.0), (81, "g", 0.0, 1.0, 0.0, 2.0), (82, "h", -4.0, -4.0, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "edge long, key string, x1 double, y1 double, x2 double, y2 double")
    side = lambda r, x, y: (r[4] - r[2]) * (y - r[3]) - (x - r[2]) * (r[5] - r[3])
    cross = lambda a, b: side(a, *b[2:4]) * side(a, *b[4:]) < 0 and side(b, *a[2:4]) * side(b, *a[4:]) < 0
    want = {a[0]: n for a in rows[:80] if (n := sum(cross(a, b) for b in rows[:82] if b is not a))}
    found = overlay._meetings(df)
    got = {r.edge: len(r.cuts) for r in found.collect()}
    assert {k: v for k, v in got.items() if k < 80} == want and 82 not in got
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2  # a group's levels, an edge's cuts


def test_methods_of_the_edges_join_are_compiled(spark):
    """The JVM interprets methods of more than 8000 bytes of bytecode. (The join as it was in round 3 passes this too.)"""
    df = spark.createDataFrame([(0, "g", 0.0, 0.0, 1.0, 1.0)], "edge long, key string, x1 double, y1 double, x2 double, y2 double")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = overlay._meetings(df)._jdf.queryExecution()
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", query.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(sizes) > 3 and max(sizes) < 8000
