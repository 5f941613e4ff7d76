"""Slim live projections of relation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def relation_view(rel: DataFrame, src_states: bool = False, dst_states: bool = False) -> DataFrame:
    """``id, src_id[, src_seqnr], dst_id[, dst_seqnr], valid_from, valid_to, value`` of the relations that aren't deleted."""
    columns = ["id", "src_id", *(["src_seqnr"] if src_states else []), "dst_id", *(["dst_seqnr"] if dst_states else []), "valid_from", "valid_to", "value"]
    return rel.where("_date_deleted IS NULL").select(*columns)


def refresh_views(relations: dict[str, tuple[DataFrame, bool, bool]], path: str | None = None, only: list[str] | None = None) -> dict[str, DataFrame]:
    """Make the views of the named relations (all by default), as temporary views ``mv_<name>``, written below ``path`` if given."""
    out = {}
    for name, (rel, src_states, dst_states) in relations.items():
        if only is not None and name not in only:
            continue
        view = relation_view(rel, src_states, dst_states)
        if path:
            view.write.mode("overwrite").parquet(f"{path}/mv_{name}")
            view = rel.sparkSession.read.parquet(f"{path}/mv_{name}")
        view.createOrReplaceTempView(f"mv_{name}")
        out[name] = view
    return out


def find_views(catalogue: dict[str, tuple[str, str, str]], collection: str | None = None, attribute: str | None = None, relation: str | None = None) -> list[str]:
    """The names of the views wanted; ``catalogue`` has each relation's name with its catalogue, collection and attribute.

    By relation name, or by collection (``catalogue:collection``) and attribute, or all of
    a collection. An attribute without its collection, or what isn't known, is an error.
    """
    if relation is not None:
        found = [n for n in catalogue if n == relation]
    elif attribute is not None and collection is None:
        raise ValueError("an attribute needs its collection")
    else:
        found = [n for n, (cat, coll, attr) in catalogue.items() if collection in (None, f"{cat}:{coll}") and attribute in (None, attr)]
    if not found:
        raise ValueError("no such relation")
    return [f"mv_{n}" for n in found]
