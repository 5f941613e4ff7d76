"""Data quality: missing values, dangling and ambiguous references, broken keys.

Issues have one form: ``check, attribute, src_id, src_seqnr, value, source``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.specs import RelationSpec


def checked_applications(specs: list[RelationSpec]) -> list[str] | None:
    """The applications whose references must have a value; None where that is all of them, an empty list where it is none."""
    strict = [s.application for s in specs if not s.none_allowed]
    return None if len(strict) == len(specs) else strict


def _for_policy(df: DataFrame, specs: list[RelationSpec] | None, column: str = "_application") -> DataFrame:
    wanted = checked_applications(specs) if specs else None
    return df if wanted is None else df.where(F.col(column).isin(wanted))


def _issues(df: DataFrame, check: str, attribute: str, value: Column) -> DataFrame:
    seqnr = F.col("seqnr") if "seqnr" in df.columns else F.lit(None).cast("int")
    return df.select(F.lit(check).alias("check"), F.lit(attribute).alias("attribute"), F.col("_id").alias("src_id"), seqnr.alias("src_seqnr"), value.alias("value"), F.col("_source").alias("source"))


def missing_values(src: DataFrame, attribute: str, specs: list[RelationSpec] | None = None, many: bool = False) -> DataFrame:
    """Live source rows whose reference has no value; of a list, the elements without one."""
    rows = _for_policy(src.where("_date_deleted IS NULL"), specs)
    rows = rows.withColumn("_r", F.explode(attribute)) if many else rows.withColumn("_r", F.col(attribute))
    return _issues(rows.where("_r.value IS NULL"), "missing", attribute, F.lit(None).cast("string"))


def _relation_of(src: DataFrame, rel: DataFrame) -> Column:
    on = (src["_id"] == rel["src_id"]) & (src["_source"] == rel["src_source"])
    return on & src["seqnr"].eqNullSafe(rel["src_seqnr"]) if "seqnr" in src.columns else on


def dangling(src: DataFrame, rel: DataFrame, attribute: str, specs: list[RelationSpec] | None = None, many: bool = False) -> DataFrame:
    """References of live source rows with a value but no live relation to a destination: none at all, or one without destination."""
    rows = _for_policy(src.where("_date_deleted IS NULL"), specs)
    rows = (rows.withColumn("_r", F.explode(attribute)) if many else rows.withColumn("_r", F.col(attribute))).where("_r.value IS NOT NULL").withColumn("_value", F.col("_r.value"))
    live = rel.where("_date_deleted IS NULL AND dst_id IS NOT NULL").withColumnRenamed("value", "_rel_value")
    return _issues(rows.join(live, _relation_of(rows, live) & (rows["_value"] == live["_rel_value"]), "left_anti"), "dangling", attribute, F.col("_value"))


def historic_counts(issues: DataFrame, src: DataFrame) -> DataFrame:
    """``check, reported, historic``: issues on open rows are reported, those on ended rows only counted."""
    ended = src.select("_id", "_source", *(["seqnr"] if "seqnr" in src.columns else []), F.col("valid_to").isNotNull().alias("_ended"))
    on = (issues["src_id"] == ended["_id"]) & (issues["source"] == ended["_source"])
    if "seqnr" in src.columns:
        on &= issues["src_seqnr"].eqNullSafe(ended["seqnr"])
    joined = issues.join(ended, on)
    return joined.groupBy("check").agg(F.count_if(~F.col("_ended")).alias("reported"), F.count_if("_ended").alias("historic"))


def very_many_checks(src: DataFrame, rel: DataFrame, attribute: str, kind: str) -> DataFrame:
    """Checks of references that are kept in the relation table only.

    ``missing``: live source rows without a relation that has a value.
    ``dangling``: live relations with a value and no destination, one issue per source row and value.
    """
    live_src, live = src.where("_date_deleted IS NULL"), rel.where("_date_deleted IS NULL AND value IS NOT NULL")
    if kind == "missing":
        return _issues(live_src.join(live, _relation_of(live_src, live), "left_anti"), "missing", attribute, F.lit(None).cast("string"))
    bad = live.where("dst_id IS NULL").select("src_id", "src_source", *(["src_seqnr"] if "src_seqnr" in rel.columns else []), F.col("value").alias("_value")).distinct()
    return _issues(live_src.join(bad, _relation_of(live_src, bad)), "dangling", attribute, F.col("_value"))


def ambiguous(conflict_rows: DataFrame, attribute: str) -> DataFrame:
    """Issues from ``relate.conflicts`` (of a ``match`` with ``last`` the references needn't be expanded): one per reference that fits several destinations."""
    rows = conflict_rows.groupBy("src_id", "src_seqnr", "src_source", "value").agg(F.max("row_number").alias("n"))
    return rows.select(F.lit("ambiguous").alias("check"), F.lit(attribute).alias("attribute"), "src_id", "src_seqnr", "value", F.col("src_source").alias("source"), F.col("n").cast("long").alias("destinations"))


def check_relation(kind: str, src: DataFrame, rel: DataFrame, attribute: str, conflict_rows: DataFrame, specs: list[RelationSpec] | None = None) -> DataFrame:
    """All issues of a relation by its kind of reference: ``single``, ``many`` or ``very_many``."""
    if kind == "very_many":
        found = very_many_checks(src, rel, attribute, "missing").unionByName(very_many_checks(src, rel, attribute, "dangling"))
    else:
        found = missing_values(src, attribute, specs, kind == "many").unionByName(dangling(src, rel, attribute, specs, kind == "many"))
    return found.unionByName(ambiguous(conflict_rows, attribute).drop("destinations"))


def audit_relation(rel: DataFrame) -> DataFrame:
    """One row ``total, null_values, live_null_values``: relations that lost their source value."""
    return rel.agg(F.count("*").alias("total"), F.count_if(F.col("value").isNull()).alias("null_values"), F.count_if(F.col("value").isNull() & F.col("_date_deleted").isNull()).alias("live_null_values"))


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def current_entity(state: DataFrame, tid: str, with_deleted: bool = False) -> DataFrame:
    """The row of one tid; more than one is an error raised when the rows are read."""
    rows = state.where(F.col("_tid") == tid) if with_deleted else state.where((F.col("_tid") == tid) & F.col("_date_deleted").isNull())
    counted = rows.groupBy("_tid").agg(F.count("*").alias("_n"), F.first(F.struct(*state.columns)).alias("_row"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("several rows for "), F.col("_tid"))).cast("boolean")).otherwise(F.lit(True))
    return counted.where(checked).select("_row.*")


def orphan_references(df: DataFrame, column: str, other: DataFrame, key: str) -> DataFrame:
    """Values of ``column`` that aren't a ``key`` of ``other``, with the number of rows ``n``. Nulls refer to nothing."""
    return df.where(F.col(column).isNotNull()).join(other.select(F.col(key).alias("_k")).distinct(), F.col(column) == F.col("_k"), "left_anti").groupBy(column).agg(F.count("*").alias("n"))
