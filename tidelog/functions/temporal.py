"""Periods of validity and numbered states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def validity_match(src: str, dst: str, src_states: bool, dst_states: bool, as_of: Column | None = None) -> Column:
    """Which destination state goes with a source row; ``src`` and ``dst`` are aliases with ``valid_from``, ``valid_to``.

    Both with states: the destination is valid at the source's end. A null end is
    open. A source state of no length matches what begins no later than its end.
    Only the destination with states: it is still valid at ``as_of`` (default now).
    """
    sb, se, db, de = (F.col(f"{a}.{c}") for a in (src, dst) for c in ("valid_from", "valid_to"))
    if src_states and dst_states:
        ends = de.isNull() | (de >= se)
        length = F.coalesce(sb != se, F.lit(True))
        regular = length & (se.isNull() | (db < se)) & (de.isNull() | F.coalesce(de >= se, F.lit(False)))
        collapsed = F.coalesce(sb == se, F.lit(False)) & (db <= se) & ends
        return F.coalesce(regular, F.lit(False)) | F.coalesce(collapsed, F.lit(False))
    if dst_states:
        return de.isNull() | (de > (F.current_timestamp() if as_of is None else as_of))
    return F.lit(True)


def with_periods(src: DataFrame, dst: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_period``, to be equal where ``validity_match`` of two sides with states can hold.

    A destination state fits a source that ends within it: the source goes to the
    stretch of ``days`` that holds its end, the destination to each stretch that it
    covers. Sources without an end fit destinations without one, in a stretch of
    their own. So a source meets the states of its key around its end and not all of
    them; stretches near the usual length of a state are best.
    """
    at = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / (86_400_000_000 * days)).cast("long")
    none = F.lit(None).cast("long")
    last = src.agg(F.max(at(F.col("valid_to")))).first()[0]
    s = src.withColumn("_period", at(F.col("valid_to")))
    open_ = F.when(F.col("valid_to").isNull(), F.array(F.struct(none.alias("p")))).otherwise(F.array().cast("array<struct<p:bigint>>"))
    if last is None:
        return s, dst.withColumn("_p", F.explode(open_)).withColumn("_period", F.col("_p.p")).drop("_p")
    end = F.least(F.coalesce(at(F.col("valid_to")), F.lit(last)), F.lit(last))
    begin = at(F.col("valid_from"))
    covered = F.when(begin <= end, F.transform(F.sequence(begin, F.greatest(begin, end)), lambda p: F.struct(p.alias("p")))).otherwise(F.array().cast("array<struct<p:bigint>>"))
    return s, dst.withColumn("_p", F.explode(F.concat(covered, open_))).withColumn("_period", F.col("_p.p")).drop("_p")


def latest_state(df: DataFrame, key: list[str], seqnr: str = "seqnr") -> DataFrame:
    """The rows of each key's highest state number."""
    return df.withColumn("_latest", F.max(seqnr).over(W.partitionBy(*key))).where(F.col(seqnr) == F.col("_latest")).drop("_latest")


def islands(states: DataFrame, key: list[str]) -> DataFrame:
    """Add ``island_from``: where the unbroken run of states that a state belongs to begins.

    In order of ``seqnr`` (gaps allowed) a run continues where a state begins at the previous one's end.
    """
    order = W.partitionBy(*key).orderBy("seqnr")
    joined = F.coalesce(F.lag("valid_to").over(order) == F.col("valid_from"), F.lit(False))
    numbered = states.withColumn("_new", F.when(joined, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.withColumn("island_from", F.min("valid_from").over(W.partitionBy(*key, "_island"))).drop("_new", "_island")
