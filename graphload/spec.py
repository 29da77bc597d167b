"""What a load describes: the target graph, and how rows become vertices and edges."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .functions.hashing import check_id_type
from .functions.literals import check_type
from .functions.text import check_policy, quote_name

MODES = ("insert", "update", "delete", "upsert")

# Spark type -> target type, where no metadata says otherwise.
SPARK_TYPES = {
    "string": "STRING",
    "boolean": "BOOL",
    "tinyint": "INT8",
    "smallint": "INT16",
    "int": "INT32",
    "bigint": "INT64",
    "float": "FLOAT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "DATETIME",
    "timestamp": "TIMESTAMP",
}


def target_types(schema: T.StructType | dict[str, str]) -> dict[str, str]:
    """Property name -> target type. A field's ``graph_type`` metadata wins."""
    if isinstance(schema, dict):
        return {name: check_type(kind) for name, kind in schema.items()}
    return {
        f.name: check_type(f.metadata.get("graph_type")
                           or SPARK_TYPES.get(f.dataType.simpleString(), "UNKNOWN"))
        for f in schema.fields
    }


@dataclass(frozen=True)
class Label:
    """A vertex tag or an edge type of the target graph."""

    kind: str
    properties: dict[str, str]
    number: int = 0

    @staticmethod
    def of(kind: str, schema: T.StructType | dict[str, str], number: int = 0) -> "Label":
        if kind not in ("vertex", "edge"):
            raise ValueError(f"label kind must be vertex or edge, not {kind!r}")
        return Label(kind, target_types(schema), number)


@dataclass(frozen=True)
class GraphTarget:
    """Partition count, id type, id length and labels of the graph.

    ``empty_marker`` is the word a source uses for "empty text, not missing".
    """

    parts: int
    id_type: str = "STRING"
    id_len: int = 8
    labels: dict[str, Label] = field(default_factory=dict)
    empty_marker: str | None = None

    def __post_init__(self):
        check_id_type(self.id_type)
        if self.parts <= 0:
            raise ValueError("the graph needs at least one partition")

    def label(self, name: str, kind: str) -> Label:
        found = self.labels.get(name)
        if found is None:
            raise ValueError(f"label {name} does not exist")
        if found.kind != kind:
            raise ValueError(f"label {name} is not a {kind} label")
        return found


def _check_common(spec) -> None:
    if not spec.label.strip():
        raise ValueError("a label name is needed")
    if spec.mode not in MODES:
        raise ValueError(f"write mode {spec.mode!r} not supported; use one of {MODES}")
    if spec.targets is not None and len(spec.targets) != len(spec.fields):
        raise ValueError(f"{spec.label}: fields and target fields differ in number")


def _property_pairs(spec) -> list[tuple[str, str]]:
    targets = spec.fields if spec.targets is None else spec.targets
    return [(f, t) for f, t in zip(spec.fields, targets) if f.strip()]


@dataclass(frozen=True)
class VertexSpec:
    label: str
    id: str
    fields: tuple[str, ...] = ()
    targets: tuple[str, ...] | None = None
    policy: str | None = None
    prefix: str | None = None
    mode: str = "insert"
    ignore_index: bool = False
    delete_edge: bool = False

    def __post_init__(self):
        _check_common(self)
        check_policy(self.policy)
        if not self.id.strip():
            raise ValueError(f"{self.label}: the id field is blank")

    kind = "vertex"

    @property
    def properties(self) -> list[tuple[str, str]]:
        """(source field, target property); blank names are skipped."""
        return _property_pairs(self)

    @property
    def key_fields(self) -> list[str]:
        return [self.id]


@dataclass(frozen=True)
class EdgeSpec:
    label: str
    src: str
    dst: str
    rank: str | None = None
    fields: tuple[str, ...] = ()
    targets: tuple[str, ...] | None = None
    src_policy: str | None = None
    dst_policy: str | None = None
    src_prefix: str | None = None
    dst_prefix: str | None = None
    mode: str = "insert"
    ignore_index: bool = False

    def __post_init__(self):
        _check_common(self)
        check_policy(self.src_policy)
        check_policy(self.dst_policy)
        if not self.src.strip() or not self.dst.strip():
            raise ValueError(f"{self.label}: source and target fields must be named")
        if self.rank is not None and not self.rank.strip():
            raise ValueError(f"{self.label}: the rank field is blank")

    kind = "edge"

    @property
    def properties(self) -> list[tuple[str, str]]:
        return _property_pairs(self)

    @property
    def key_fields(self) -> list[str]:
        return [self.src, self.dst] + ([self.rank] if self.rank else [])


def bind_schema(spec: VertexSpec | EdgeSpec, target: GraphTarget) -> dict[str, str]:
    """Target property -> type, checked before any job runs."""
    for name in (spec.label, *(t for _, t in spec.properties)):
        quote_name(name)
    known = target.label(spec.label, spec.kind).properties
    missing = [t for _, t in spec.properties if t not in known]
    if missing:
        raise ValueError(f"{spec.label}: property {missing[0]} is not defined in the graph")
    return {t: known[t] for _, t in spec.properties}
