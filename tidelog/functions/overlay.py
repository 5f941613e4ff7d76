"""Unions of areas by planar overlay, spread over all tasks.

Rings are turned so that their inside lies on the left. Edges of a group meet in grid
cells of their own size, are cut where they cross or touch, and each piece gets the
number of areas on both its sides from the pieces that lie west of it in the same
band. Pieces with one covered side are the outline. Each piece knows its successor,
and pointer doubling gives every piece the least piece of its ring and the way to it;
so rings of any length are put in order without a task that follows them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.spatial import dealt, is_valid, once, polygons
from tidelog.sources.shared import written

#: The plane is sheared by this slope where sides are counted, so that no edge of ordinary data lies along a ray.
_SLOPE = 0.3819660112501051

#: Decimals of all coordinates here. Points nearer than two units of the last one to an edge lie on it.
DIGITS = 6
_NEAR = 2 * 10.0**-DIGITS


@dataclass
class Union:
    """``key, wkt`` of each group's united area; and what could not be united: ``key, problem, n``."""

    areas: DataFrame
    problems: DataFrame


def _point(x: str, y: str) -> Column:
    return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))


def _turned(ring: Column, hole: Column) -> Column:
    """The ring with its inside on the left: shells counterclockwise, holes clockwise."""
    n = F.size(ring)
    twice = F.aggregate(F.sequence(F.lit(0), n - 2), F.lit(0.0), lambda s, i: s + F.get(ring, i)["x"] * F.get(ring, i + 1)["y"] - F.get(ring, i + 1)["x"] * F.get(ring, i)["y"])
    return F.when((twice > 0) != hole, ring).otherwise(F.reverse(ring))


def _rounded(v: Column) -> Column:
    return F.rint(v * 10.0**DIGITS) / 10.0**DIGITS + 0.0  # no negative zero


def directed_edges(df: DataFrame, key: str, geo: str) -> tuple[DataFrame, DataFrame]:
    """``key, x1, y1, x2, y2`` of all valid areas, their inside on the left; and ``key, problem, n`` for all others.

    Equal areas of a group count once.
    """
    areas = dealt(df.where(F.col(geo).isNotNull()).select(F.col(key).alias("key"), F.col(geo).alias("geo")), "key", "geo").distinct()
    areas = areas.withColumn("parts", once(polygons(F.col("geo")))).withColumn("rings", once(F.flatten("parts")))
    areas = written(areas.select("key", "parts", is_valid(F.col("rings")).alias("valid")), "overlay-areas")
    valid = F.col("valid")
    bad = areas.where(~valid).groupBy("key").agg(F.count("*").alias("n")).select("key", F.lit("not a valid area").alias("problem"), "n")
    rings = areas.where(valid).select("key", F.explode("parts").alias("part")).select("key", F.posexplode("part").alias("nth", "ring"))
    turned = rings.select("key", _turned(F.col("ring"), F.col("nth") > 0).alias("r"))
    ends = turned.select("key", F.explode(F.arrays_zip(F.slice("r", 1, F.size("r") - 1).alias("a"), F.slice("r", 2, F.size("r") - 1).alias("b"))).alias("e"))
    flat = ends.select("key", *[_rounded(F.col(f"e.{end}.{a}")).alias(f"{a}{i}") for i, end in ((1, "a"), (2, "b")) for a in "xy"])
    return flat.where("x1 <> x2 OR y1 <> y2"), bad


def _level(extent: Column) -> Column:
    """The grid level whose cells (of side ``2**level``) are at least as large as an edge, which then lies in four of them at most."""
    return F.ceil(F.log2(F.greatest(extent, F.lit(1e-9)))).cast("int")


def _cells(df: DataFrame, level: Column) -> DataFrame:
    """``df`` with a row for each cell ``cx, cy`` of the ``level`` that an edge may lie in, the first of them being ``lowx, lowy``."""
    side = F.pow(F.lit(2.0), level)
    at = lambda v: F.floor(v / side).cast("long")
    low = {f"low{a}": at(F.least(f"{a}1", f"{a}2") - _NEAR) for a in "xy"}
    span = lambda a: F.sequence(F.col(f"low{a}"), at(F.greatest(f"{a}1", f"{a}2") + _NEAR))
    return df.withColumns({"level": level, **low}).withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y")))


def _apart(df: DataFrame, value: Column) -> DataFrame:
    """The fields of a struct as the only columns, worked out before what follows.

    Without this the filters that follow move into the join, and one generated method holds
    it all: beyond 8000 bytes of bytecode the JVM interprets a method and never compiles it.
    """
    return df.select(once(value).alias("one")).select("one.*")


def _both(s: str, o: str, names: tuple[str, ...]) -> Column:
    """Edge ``s`` as ``e`` and edge ``o`` as ``f``, side by side."""
    return F.struct(*[F.col(f"{a}.{c}").alias(f"{b}_{c}") for a, b in ((s, "e"), (o, "f")) for c in names])


def _meetings(edges: DataFrame) -> DataFrame:
    """``edge, cuts``: the points inside each edge at which others of its group cross or touch it, each once.

    Every edge lies in the cells of its own level and looks into those of each coarser level that its group uses.
    The cells that two edges share are a rectangle: they meet in its first cell only, so each pair is made once.
    The point of a crossing is worked out from both edges in one order, so that both are cut at the same numbers.
    """
    bounds = {f"least{a}": F.least(f"{a}1", f"{a}2") for a in "xy"} | {f"most{a}": F.greatest(f"{a}1", f"{a}2") + _NEAR for a in "xy"}
    own = edges.withColumns(bounds).withColumn("own", _level(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))))
    home = _cells(own, F.col("own"))
    levels = own.groupBy("key").agg(F.array_sort(F.collect_set("own")).alias("levels"))  # a few dozen at most
    looking = own.join(levels, "key").withColumn("look", F.explode(F.filter("levels", lambda v: v >= F.col("own")))).drop("levels")
    f, e = home.alias("f"), _cells(looking, F.col("look")).alias("e")
    same = [F.col(f"e.{c}") == F.col(f"f.{c}") for c in ("key", "level", "cx", "cy")]
    later = (F.col("f.own") > F.col("e.own")) | (F.col("f.edge") > F.col("e.edge"))
    first = [F.col(f"e.c{a}") == F.greatest(f"e.low{a}", f"f.low{a}") for a in "xy"]
    boxes = [F.col(f"{s}.most{a}") >= F.col(f"{o}.least{a}") for s, o in ("ef", "fe") for a in "xy"]
    names = ("edge", "x1", "y1", "x2", "y2")
    pairs = e.join(f, [*same, later, *first, *boxes])
    pairs = _apart(pairs, F.when(F.col("e.edge") < F.col("f.edge"), _both("e", "f", names)).otherwise(_both("f", "e", names)))
    side = lambda s, x, y: (F.col(f"{s}_x2") - F.col(f"{s}_x1")) * (F.col(y) - F.col(f"{s}_y1")) - (F.col(x) - F.col(f"{s}_x1")) * (F.col(f"{s}_y2") - F.col(f"{s}_y1"))
    sides = {"f1": side("e", "f_x1", "f_y1"), "f2": side("e", "f_x2", "f_y2"), "e1": side("f", "e_x1", "e_y1"), "e2": side("f", "e_x2", "e_y2")}
    near = {f"near_{s}": _NEAR * F.hypot(F.col(f"{s}_x2") - F.col(f"{s}_x1"), F.col(f"{s}_y2") - F.col(f"{s}_y1")) for s in "ef"}
    pairs = _apart(pairs, F.struct(*pairs.columns, *[v.alias(n) for n, v in {**sides, **near}.items()]))
    # Not both ends of an edge lie clearly on one side of the line through the other.
    reached = [(F.least(f"{o}1", f"{o}2") <= F.col(f"near_{s}")) & (F.greatest(f"{o}1", f"{o}2") >= -F.col(f"near_{s}")) for s, o in ("ef", "fe")]
    pairs = pairs.where(reached[0] & reached[1])
    settled = {f"{o}{i}": F.when(F.abs(F.col(f"{o}{i}")) > F.col(f"near_{s}"), F.col(f"{o}{i}")).otherwise(0.0) for s, o in ("ef", "fe") for i in (1, 2)}
    ends = [c for c in pairs.columns if c not in {**settled, **near}]
    pairs = _apart(pairs, F.struct(*ends, *[v.alias(n) for n, v in settled.items()]))
    t = F.col("e1") / (F.col("e1") - F.col("e2"))
    cross = F.when((F.col("f1") * F.col("f2") < 0) & (F.col("e1") * F.col("e2") < 0), F.struct(_rounded(F.col("e_x1") + t * (F.col("e_x2") - F.col("e_x1"))).alias("x"), _rounded(F.col("e_y1") + t * (F.col("e_y2") - F.col("e_y1"))).alias("y")))
    between = lambda v, a, b: (F.col(v) >= F.least(a, b) - _NEAR) & (F.col(v) <= F.greatest(a, b) + _NEAR)

    def touches(s: str, o: str, i: int) -> Column:
        """End ``i`` of the other edge, where it lies inside edge ``s``."""
        x, y = f"{o}_x{i}", f"{o}_y{i}"
        is_end = ((F.col(x) == F.col(f"{s}_x1")) & (F.col(y) == F.col(f"{s}_y1"))) | ((F.col(x) == F.col(f"{s}_x2")) & (F.col(y) == F.col(f"{s}_y2")))
        return F.when((F.col(f"{o}{i}") == 0) & between(x, f"{s}_x1", f"{s}_x2") & between(y, f"{s}_y1", f"{s}_y2") & ~is_end, _point(x, y))

    points = [("e", cross), ("f", cross), *[(s, touches(s, o, i)) for s, o in (("e", "f"), ("f", "e")) for i in (1, 2)]]
    found = pairs.select(F.explode(F.array(*[F.struct(F.col(f"{s}_edge").alias("edge"), p.alias("at")) for s, p in points])).alias("m")).select("m.*")
    return found.where("at IS NOT NULL").groupBy("edge").agg(F.collect_set("at").alias("cuts"))  # the cuts of one edge


def pieces(edges: DataFrame) -> DataFrame:
    """``key, x1, y1, x2, y2, turn``: the edges cut at all meetings, each piece once and from its lower to its higher end in
    (x, y); ``turn`` is how many areas lie on its left more than on its right.
    """
    edges = written(edges.withColumn("edge", F.monotonically_increasing_id()), "overlay-edges")
    cuts = _meetings(edges)
    along = lambda p: F.struct(((p["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (p["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))).alias("t"), p["x"].alias("x"), p["y"].alias("y"))
    inner = F.transform(F.array_sort(F.transform(F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")), along)), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    line = edges.join(cuts, "edge", "left").withColumn("p", F.concat(F.array(_point("x1", "y1")), inner, F.array(_point("x2", "y2"))))
    ends = line.select("key", F.explode(F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p") - 1).alias("b"))).alias("e"))
    up = F.col("e.a") < F.col("e.b")
    sign = F.when(up, 1).otherwise(-1)
    low, high = F.least("e.a", "e.b"), F.greatest("e.a", "e.b")
    merged = ends.where("e.a <> e.b").select("key", low.alias("a"), high.alias("b"), sign.alias("s")).groupBy("key", "a", "b").agg(F.sum("s").alias("turn"))
    return merged.select("key", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), "turn")


def _sheared(df: DataFrame) -> DataFrame:
    return df.withColumns({f"v{i}": F.col(f"y{i}") + _SLOPE * F.col(f"x{i}") for i in (1, 2)})


def _banded(df: DataFrame) -> DataFrame:
    """``df`` with the height of a band in its group: about as many bands as the root of its rows."""
    low, high = F.least("v1", "v2"), F.greatest("v1", "v2")
    height = df.groupBy("key").agg(F.greatest((F.max(high) - F.min(low)) / F.ceil(F.sqrt(F.count("*"))), F.lit(1e-9)).alias("height"))
    return df.join(height, "key")


def _west(band_rows: DataFrame, asked: DataFrame) -> DataFrame:
    """For each of ``asked`` (``key, u, v, height``) the pieces of its group that cross its ray to the west, as ``piece`` columns."""
    low, high = F.least("v1", "v2"), F.greatest("v1", "v2")
    bands = F.sequence(F.floor(low / F.col("height")).cast("long"), F.floor(high / F.col("height")).cast("long"))
    pieces_ = band_rows.withColumn("band", F.explode(bands)).alias("p")
    ray = asked.withColumn("band", F.floor(F.col("v") / F.col("height")).cast("long")).alias("q")
    p_low, p_high = F.least("p.v1", "p.v2"), F.greatest("p.v1", "p.v2")
    at = F.col("p.x1") + (F.col("q.v") - F.col("p.v1")) / (F.col("p.v2") - F.col("p.v1")) * (F.col("p.x2") - F.col("p.x1"))
    crossed = (p_low <= F.col("q.v")) & (F.col("q.v") < p_high) & (at < F.col("q.u")) & (F.col("p.piece") != F.col("q.piece"))
    return ray.join(pieces_, (F.col("q.key") == F.col("p.key")) & (F.col("q.band") == F.col("p.band")) & crossed, "left").withColumn("at", at)


def outline(cut: DataFrame) -> DataFrame:
    """``key, piece, x1, y1, x2, y2``: the pieces with one covered side, which now lies on their left."""
    rows = _banded(_sheared(written(cut.where("turn <> 0").withColumn("piece", F.monotonically_increasing_id()), "overlay-pieces")))
    asked = rows.select("key", "piece", "turn", "height", ((F.col("x1") + F.col("x2")) / 2).alias("u"), ((F.col("v1") + F.col("v2")) / 2).alias("v"))
    # A piece that goes up has its left in the west: crossing it eastwards, its turn is lost.
    climbs = F.when(F.col("p.v2") > F.col("p.v1"), 1).otherwise(-1)
    west = _west(rows, asked).groupBy(F.col("q.piece").alias("piece")).agg(F.coalesce(F.sum(-climbs * F.col("p.turn")), F.lit(0)).alias("west"))
    sided = rows.join(west, "piece")
    up = F.col("v2") > F.col("v1")
    left = F.when(up, F.col("west")).otherwise(F.col("west") + F.col("turn"))
    right = F.when(up, F.col("west") - F.col("turn")).otherwise(F.col("west"))
    kept = sided.withColumns({"left": left > 0, "right": right > 0}).where("left <> right")
    end = lambda a, b: F.when(F.col("left"), F.col(a)).otherwise(F.col(b))
    return kept.select("key", "piece", end("x1", "x2").alias("x1"), end("y1", "y2").alias("y1"), end("x2", "x1").alias("x2"), end("y2", "y1").alias("y2"))


def successors(border: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, piece, next`` of an outline, and ``key, problem, n`` of groups whose outline has ends that don't meet.

    Where several rings touch in a point, a ring goes on with the sharpest turn to its
    left, so that each stays by itself. Only such a point's few pieces come together.
    """
    angle = lambda dy, dx: F.atan2(dy, dx)
    arriving = border.select("key", F.col("x2").alias("x"), F.col("y2").alias("y"), F.struct("piece", angle(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("back")).alias("e"))
    leaving = border.select("key", F.col("x1").alias("x"), F.col("y1").alias("y"), F.struct("piece", angle(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("on")).alias("e"))
    into = arriving.groupBy("key", "x", "y").agg(F.collect_list("e").alias("into"))
    out = leaving.groupBy("key", "x", "y").agg(F.collect_list("e").alias("out"))
    nodes = into.join(out, ["key", "x", "y"], "full_outer")
    fits = F.coalesce(F.size("into") == F.size("out"), F.lit(False))
    full = 6.283185307179586
    # Clockwise from the way back: the smallest angle is the sharpest turn to the left.
    turned = lambda e: F.transform("out", lambda o: F.struct(((e["back"] - o["on"] + 2 * full) % full).alias("a"), o["piece"].alias("piece")))
    found = nodes.where(fits).select("key", F.explode(F.transform("into", lambda e: F.struct(e["piece"].alias("piece"), F.array_min(turned(e))["piece"].alias("next")))).alias("s")).select("key", "s.*")
    open_ = nodes.where(~fits).groupBy("key").agg(F.count("*").alias("n")).select("key", F.lit("outline doesn't close").alias("problem"), "n")
    return found, open_


def ranked_cycles(links: DataFrame, item: str = "piece", following: str = "next") -> DataFrame:
    """``item, leader, steps`` of a table of cycles: the least item of its cycle and how many steps away that is.

    Pointer doubling: in each round an item learns what the item at twice the distance
    has found, so rounds grow with the logarithm of the longest cycle, and every round
    is one join of all items on even keys. Each is written to the shared folder.
    """
    state = links.select(F.col(item).alias("i"), F.col(following).alias("j"), F.col(item).alias("m"), F.lit(0).cast("long").alias("d"), F.lit(True).alias("moved"))
    reach = 1
    state = written(state, "cycles")
    while True:
        other = state.select(F.col("i").alias("j"), F.col("j").alias("j2"), F.col("m").alias("m2"), F.col("d").alias("d2"))
        less = F.col("m2") < F.col("m")
        state = written(state.join(other, "j").select("i", F.col("j2").alias("j"), F.least("m", "m2").alias("m"), F.when(less, F.col("d2") + reach).otherwise(F.col("d")).alias("d"), less.alias("moved")), "cycles")
        reach *= 2
        if state.where("moved").isEmpty():
            return state.select(F.col("i").alias(item), F.col("m").alias("leader"), F.col("d").alias("steps"))


def _ring_area(r: Column) -> Column:
    at = lambda i: F.get(r, i % F.size(r))
    return F.aggregate(F.sequence(F.lit(0), F.size(r) - 1), F.lit(0.0), lambda s, i: s + at(i)["x"] * at(i + 1)["y"] - at(i + 1)["x"] * at(i)["y"])


def _with_shells(rings: DataFrame, border: DataFrame) -> DataFrame:
    """``key, ring, shell``: the shell that each ring belongs to.

    West of a hole's corner the next piece of the outline bounds the same area: it is
    the shell's or another hole's, whose own shell is looked up in turn.
    """
    rows = _banded(_sheared(border))
    heights = rows.groupBy("key").agg(F.first("height").alias("height"))
    holes = rings.where("area < 0").join(heights, "key").select("key", "leader", F.lit(-1).cast("long").alias("piece"), F.col("low.x").alias("u"), (F.col("low.y") + _SLOPE * F.col("low.x")).alias("v"), "height")
    near = _west(rows, holes).where("p.ring <> q.leader").groupBy(F.col("q.leader").alias("ring")).agg(F.max_by("p.ring", "at").alias("of"))
    shells = rings.where("area > 0").select(F.col("leader").alias("ring"), F.col("leader").alias("of"))
    state = written(shells.unionByName(near), "holes")
    while True:
        up = state.select(F.col("ring").alias("of"), F.col("of").alias("of2"))
        state_ = written(state.join(up, "of").select("ring", F.col("of2").alias("of"), (F.col("of") != F.col("of2")).alias("moved")), "holes")
        state = state_.select("ring", "of")
        if state_.where("moved").isEmpty():
            return state


def _text(r: Column) -> Column:
    number = lambda v: v.cast("decimal(18,3)").cast("string")
    return F.concat(F.lit("("), F.array_join(F.transform(F.concat(r, F.array(F.get(r, F.lit(0)))), lambda p: F.concat(number(p["x"]), F.lit(" "), number(p["y"]))), ", "), F.lit(")"))


def _outlined(df: DataFrame, key: str, geo: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The outline of each group's union, the successors of its pieces, and ``key, problem, n`` of what can't be united."""
    edges, invalid = directed_edges(df, key, geo)
    border = written(outline(pieces(edges)), "overlay-border")
    links, open_ = successors(border)
    open_ = written(open_, "overlay-open")
    return border, links.join(open_.select("key"), "key", "left_anti"), invalid.unionByName(open_)


def union_problems(df: DataFrame, key: str, geo: str) -> DataFrame:
    """The ``problems`` of ``union_areas``: its outlines are made, but not put in order."""
    return _outlined(df, key, geo)[2].withColumnRenamed("key", key)


def union_areas(df: DataFrame, key: str, geo: str) -> Union:
    """The union of each group's areas (POLYGON or MULTIPOLYGON in WKT), overlapping, adjacent or apart.

    ``areas``: ``key, wkt``, a POLYGON or MULTIPOLYGON with every corner where inputs met. Rings
    start at their least corner, shells run clockwise and holes counterclockwise, and
    stand in order of that corner. Areas that aren't valid are left out and counted in
    ``problems``, as are groups whose outline doesn't close after cutting, which have no
    area. Null geometries are ignored. A finished ring is one row, the work before
    it is dealt out by edge, whatever the size of a group or ring.
    """
    border, links, problems = _outlined(df, key, geo)
    whole = written(links, "overlay-links")
    ranked = ranked_cycles(whole).withColumnRenamed("leader", "ring")
    placed = written(border.join(ranked, "piece"), "overlay-placed")
    rings = placed.groupBy("key", F.col("ring").alias("leader")).agg(F.array_sort(F.collect_list(F.struct(F.col("steps"), F.col("x1").alias("x"), F.col("y1").alias("y")))).alias("r"))
    # Steps count down to the leader: sorted by them a ring runs backwards, that is with its inside on the right.
    rings = rings.withColumn("r", F.transform("r", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))).withColumn("low", F.array_min("r"))
    at = F.array_position("r", F.col("low")).cast("int")
    rings = rings.withColumn("r", F.concat(F.slice("r", at, F.size("r")), F.slice("r", F.lit(1), at - 1))).withColumn("area", -_ring_area(F.col("r")))
    rings = written(rings, "overlay-rings")
    of = _with_shells(rings, placed)
    member = F.struct((F.col("area") < 0).alias("hole"), "low", _text(F.col("r")).alias("text"))
    polygons_ = rings.join(of, rings["leader"] == of["ring"]).groupBy("key", "of").agg(F.array_sort(F.collect_list(member)).alias("m"))
    polygons_ = polygons_.select("key", F.get("m", F.lit(0))["low"].alias("low"), F.concat(F.lit("("), F.array_join(F.transform("m", lambda m: m["text"]), ", "), F.lit(")")).alias("text"))
    parts = polygons_.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("low", "text"))).alias("p"))
    many = F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform("p", lambda p: p["text"]), ", "), F.lit(")"))
    wkt = F.when(F.size("p") == 1, F.concat(F.lit("POLYGON "), F.get("p", F.lit(0))["text"])).otherwise(many)
    return Union(parts.select(F.col("key").alias(key), wkt.alias("wkt")), problems.withColumnRenamed("key", key))
