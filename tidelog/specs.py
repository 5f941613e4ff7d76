"""What a collection, a relation and an enrichment look like."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CollectionSpec:
    """A collection: its columns with Spark types, the column with an object's id, and whether objects have numbered states."""

    catalogue: str
    name: str
    version: str
    entity_id: str
    fields: dict[str, str] = field(hash=False)
    has_states: bool = False

    @property
    def table(self) -> str:
        return f"{self.catalogue}_{self.name}"


@dataclass(frozen=True)
class RelationSpec:
    """How the rows of one application refer to a destination.

    The destination's ``destination_attribute`` equals the source's
    ``source_attribute``, or the reference's own value where that is None. With method
    ``lies_in`` both are geometries in WKT, and a point on the source's surface lies in
    the destination; ``cell`` is the side of a typical destination. With
    ``multiple_allowed`` one value may lead to several destinations; with
    ``none_allowed`` a missing value is no issue.
    """

    application: str
    destination_attribute: str
    source_attribute: str | None = None
    multiple_allowed: bool = False
    none_allowed: bool = False
    method: str = "equals"
    cell: float = 1.0


@dataclass(frozen=True)
class AutoIdSpec:
    """Ids issued to rows without one: ``on`` is the key that shares an id, ``template`` has an X for each digit."""

    column: str
    on: str
    template: str


@dataclass(frozen=True)
class ColumnChange:
    """A schema change of one column: a new type and, optionally, a new name."""

    column: str
    type: str
    rename: str | None = None
