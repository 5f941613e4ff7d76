"""Joins in which a few values of the key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequent(df: DataFrame, key: Column, pieces: int) -> list[int]:
    """Hashes of the values of ``key`` that more than one in ``2 * pieces`` rows may have, by a sketch of that many counters; a few more may be among them."""
    return df.select(F.xxhash64(key).alias("h")).stat.freqItems(["h"], 1 / (2 * pieces)).first()[0]


def spread_join(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str = "inner", residual: Column | None = None, pieces: int | None = None, hot: list[int] | None = None) -> DataFrame:
    """``left`` joined with ``right`` where the pairs of columns in ``on`` are equal and ``residual`` holds, each aliased ``src`` and ``dst`` for it.

    Rows of ``left`` with a frequent value are dealt into ``pieces`` (the number of
    shuffle partitions) by a hash of the whole row, and the rows of ``right`` with that
    value repeated for each piece, so that no task gets more than a piece of one value.
    All other rows have one piece. ``how`` may be inner or left; what the values are is
    looked up in one pass over ``left``, unless ``hot`` names their hashes (of ``frequent``).
    """
    if how not in ("inner", "left"):
        raise ValueError("rows of the left side are split: only inner and left joins keep their meaning")
    pieces = pieces or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = lambda i: F.struct(*[F.col(pair[i]) for pair in on])
    hot = (frequent(left, key(0), pieces) if pieces > 1 else []) if hot is None else hot
    one = F.lit(0).cast("long")
    if not hot:
        s, d = left.withColumn("_piece", one), right.withColumn("_piece", one)
    else:
        among = lambda i: F.xxhash64(key(i)).isin(hot)
        s = left.withColumn("_piece", F.when(among(0), F.pmod(F.xxhash64(*left.columns), F.lit(pieces))).otherwise(one))
        d = right.withColumn("_piece", F.explode(F.when(among(1), F.sequence(one, F.lit(pieces - 1).cast("long"))).otherwise(F.array(one))))
    fits = F.col("src._piece") == F.col("dst._piece")
    for a, b in on:
        fits &= F.col(f"src.{a}") == F.col(f"dst.{b}")
    return s.alias("src").join(d.alias("dst"), fits if residual is None else fits & residual, how)
