"""Fill in values before rows are compared: issued ids, united geometries, and any registered function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.ranges import number_in_order
from tidelog.functions.overlay import union_areas, union_problems
from tidelog.functions.spatial import union_points
from tidelog.functions.temporal import latest_state
from tidelog.specs import AutoIdSpec

REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def enricher(name: str):
    """Register a function ``(df, column, **options) -> df`` that sets ``column``."""

    def add(function):
        REGISTRY[name] = function
        return function

    return add


def enrich(df: DataFrame, specs: list[dict], dry_run: bool = False) -> DataFrame:
    """Run enrichers in turn; each spec has ``name``, ``column`` and options.

    With ``dry_run`` nothing is set: the result is ``_id, column, value, proposed``
    for the values that would change.
    """
    out, proposals = df, None
    for spec in specs:
        options = {k: v for k, v in spec.items() if k not in ("name", "column")}
        column = spec["column"]
        changed = REGISTRY[spec["name"]](out, column, **options)
        if dry_run:
            now, then = df.select("_id", F.col(column).cast("string").alias("value")), changed.select(F.col("_id").alias("_pid"), F.col(column).cast("string").alias("proposed"))
            rows = now.join(then, now["_id"] == then["_pid"]).where(~F.col("value").eqNullSafe(F.col("proposed"))).select("_id", F.lit(column).alias("column"), "value", "proposed")
            proposals = rows if proposals is None else proposals.unionByName(rows)
        else:
            out = changed
    return proposals if dry_run and proposals is not None else out


def autoid(df: DataFrame, stored: DataFrame, spec: AutoIdSpec, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Give rows without ``spec.column`` an id; also a DataFrame of ``problem, key, value``, empty when all is well.

    A given value stays. Else the value stored for the same key is used again, else
    a new one is issued per distinct key: the largest stored or given value that fits
    the template, plus a number in order of the key, padded to the template's length.
    With ``source`` only that source's rows of ``stored`` (by ``_source``) count.
    Problems: a given value on several keys, a key with several stored values, and
    numbers beyond the template.
    """
    col, on = spec.column, spec.on
    digits = spec.template.count("X")
    prefix = spec.template[: len(spec.template) - digits]
    if spec.template != prefix + "X" * digits:
        raise ValueError("the X of a template must be at its end")
    fits = lambda c: F.regexp_like(c, F.lit(f"^{prefix}[0-9]{{{digits}}}$"))
    counter = lambda c: F.substring(c, len(prefix) + 1, digits).cast("long")
    stored = stored if source is None else stored.where(F.col("_source") == source)
    values = stored.where(F.col(col).isNotNull()).select(on, col)
    known = values.groupBy(on).agg(F.min(col).alias("_stored"), F.count_distinct(col).alias("_n"))
    last = values.unionByName(df.where(F.col(col).isNotNull()).select(on, col)).where(fits(F.col(col))).agg(F.coalesce(F.max(counter(F.col(col))), F.lit(-1)).alias("_last")).withColumn("_k", F.lit(1))

    missing = df.where(F.col(col).isNull()).select(on).distinct().join(known.select(on), on, "left_anti")
    ranked = number_in_order(missing, on)
    issued = ranked.withColumn("_k", F.lit(1)).join(F.broadcast(last), "_k").select(on, (F.col("_last") + F.col("_rn")).alias("_no"))  # one row
    full = F.concat(F.lit(prefix), F.lpad(F.col("_no").cast("string"), digits, "0"))
    issued = issued.select(on, full.alias("_issued"), "_no")
    joined = df.join(known, on, "left").join(issued, on, "left")
    result = joined.withColumn(col, F.coalesce(col, "_stored", "_issued")).select(*df.columns)

    taken = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count_distinct(on).alias("n"), F.min(on).cast("string").alias("key")).where("n > 1").select(F.lit("given to several keys").alias("problem"), "key", F.col(col).alias("value"))
    many = known.where("_n > 1").select(F.lit("several stored values").alias("problem"), F.col(on).cast("string").alias("key"), F.col("_stored").alias("value"))
    over = issued.where(F.length(F.col("_no").cast("string")) > digits).select(F.lit("beyond the template").alias("problem"), F.col(on).cast("string").alias("key"), F.col("_no").cast("string").alias("value"))
    return result, taken.unionByName(many).unionByName(over)


@enricher("autoid")
def _autoid(df: DataFrame, column: str, on: str, template: str, stored: DataFrame, source: str | None = None) -> DataFrame:
    return autoid(df, stored, AutoIdSpec(column, on, template), source)[0]


def _referenced(df: DataFrame, column: str, on: str, other: DataFrame, key: str, geo: str) -> DataFrame:
    """``_id, _geo``: the geometries that rows without one refer to."""
    latest = latest_state(other, [key]) if "seqnr" in other.columns else other
    pairs = df.where(F.col(column).isNull()).select("_id", F.explode(F.col(on)).alias("_ref")).distinct()
    return pairs.join(latest.select(F.col(key).alias("_ref"), F.col(geo).alias("_geo")), "_ref").select("_id", "_geo")


def geounion_problems(df: DataFrame, column: str, on: str, other: DataFrame, key: str, geo: str) -> DataFrame:
    """``_id, problem, n``: areas that ``geounion`` leaves out, and rows whose union it can't make."""
    return union_problems(_referenced(df, column, on, other, key, geo), "_id", "_geo")


@enricher("geounion")
def geounion(df: DataFrame, column: str, on: str, other: DataFrame, key: str, geo: str, kind: str = "points") -> DataFrame:
    """Set a missing geometry to the union of the referenced rows' geometries.

    ``on`` is an array of references (a path such as ``refs.value``), ``other`` has
    ``key``, ``geo`` and, with states, ``seqnr``: the latest state counts, deleted
    rows too. ``kind``: points, or coverage for areas, which may overlap, touch or lie
    apart; what couldn't be united is in ``geounion_problems``.
    """
    found = _referenced(df, column, on, other, key, geo)
    united = (union_points(found, "_id", "_geo") if kind == "points" else union_areas(found, "_id", "_geo").areas).select(F.col("_id").alias("_gid"), "wkt")
    return df.join(united, df["_id"] == united["_gid"], "left").withColumn(column, F.coalesce(column, "wkt")).select(*df.columns)
