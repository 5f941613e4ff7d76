"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import batch, lean, stage_table

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def least_members(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links ``a[i], b[i]`` that aren't the smallest of their component, and that smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, following = np.minimum(root[x], root[y]), root.copy()
        np.minimum.at(following, root[x], low)
        np.minimum.at(following, root[y], low)
        while (following != following[following]).any():
            following = following[following]
        if (following == root).all():
            return nodes[root < np.arange(len(nodes))], nodes[root[root < np.arange(len(nodes))]]
        root = following


def _stars(hold: int):
    """The links of a task as stars around the smallest nodes, worked out over about ``hold`` links at once."""

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append((b.column("a").to_numpy(), b.column("b").to_numpy()))
            n += b.num_rows
            if n >= hold:
                a, c = least_members(*(np.concatenate(x) for x in zip(*held, strict=True)))
                yield batch(_EDGE, a=a, b=c)
                held, n = [], 0
        if n:
            a, c = least_members(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield batch(_EDGE, a=a, b=c)

    return run


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _settled(edges: DataFrame) -> bool:
    """Whether all components are stars: no node has two centres, and no centre has one."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("leaf")), F.struct(F.col("b").alias("node"), F.lit(0).alias("leaf")))).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("leaf").alias("leaves"), F.min("leaf").alias("least"))
    return nodes.where("leaves > 1 OR leaves = 1 AND least = 0").isEmpty()


def components(edges: DataFrame, name: str = "components", hold: int = 1 << 18) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``: long); the component is its smallest node.

    Each task first turns its own links into stars, about ``hold`` at once, which
    leaves little of links that lie near each other. Then follow alternating
    large-star and small-star steps (Kiveris et al., 2014), each two grouped minima
    and joins: a node is linked to the smallest node among its neighbours until every
    component is a star around its smallest node. Rounds grow with the logarithm of a
    component's size. Each round is written to the shared folder. The links of one
    node meet in one task of a step, two numbers each.
    Edges with a null end and loops are left out.
    """
    edges = edges.where("a <> b").select("a", "b").mapInArrow(lean(_stars(hold)), "a long, b long").distinct()
    edges = stage_table(edges, name)
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least_neighbour(both).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.join(_least_neighbour(large), "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = stage_table(small, name)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
