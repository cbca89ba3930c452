"""Index specifications: which cells matter, and how they become document fields.

A spec is plain configuration. It is read once on the driver and turned into
Column expressions by the operators; no data ever passes through it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

# The defaults users of a spec rely on.
DEFAULT_MAPPING = "row"
DEFAULT_READ_ROW = "dynamic"
DEFAULT_KEY_FIELD = "id"
DEFAULT_SOURCE = "value"
DEFAULT_FIELD_TYPE = "string"
DEFAULT_EXTRACT_TYPE = "application/octet-stream"


class SpecError(ValueError):
    """The spec cannot be used as written."""


@dataclass(frozen=True)
class Target:
    """The cells one definition reads: a whole column, or a range of qualifiers."""

    family: bytes
    qualifier: bytes
    prefix: bool

    @staticmethod
    def parse(expression: str, source: str = DEFAULT_SOURCE) -> "Target":
        family, colon, qualifier = expression.partition(":")
        if not colon:
            raise SpecError(f"'{expression}' is not of the form family:qualifier")
        prefix = qualifier.endswith("*")
        if source == "qualifier" and not prefix:
            raise SpecError(f"'{expression}' needs a trailing * to read qualifiers")
        return Target(family.encode(), (qualifier[:-1] if prefix else qualifier).encode(), prefix)


@dataclass(frozen=True)
class FieldSpec:
    """One document field fed from cell values or qualifiers."""

    name: str
    value: str
    source: str = DEFAULT_SOURCE
    type: str | Callable[..., Any] = DEFAULT_FIELD_TYPE
    params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        _one_of("source", self.source, ("value", "qualifier"))
        self.target  # fail early on a bad expression

    @property
    def target(self) -> Target:
        return Target.parse(self.value, self.source)


@dataclass(frozen=True)
class ExtractSpec:
    """Cells whose bytes are parsed as text documents into many fields."""

    value: str
    prefix: str = ""
    source: str = DEFAULT_SOURCE
    type: str = DEFAULT_EXTRACT_TYPE
    params: Mapping[str, str] = field(default_factory=dict)
    # None keeps all parsed fields; else only these names, and those whose suffix the index schema knows.
    schema_fields: tuple[str, ...] | None = None

    def __post_init__(self):
        _one_of("source", self.source, ("value", "qualifier"))
        if self.schema_fields is not None:
            object.__setattr__(self, "schema_fields", tuple(self.schema_fields))
        self.target

    @property
    def target(self) -> Target:
        return Target.parse(self.value, self.source)


@dataclass(frozen=True)
class IndexSpec:
    """A whole index: its table, mapping mode, key and field definitions."""

    table: str
    fields: tuple[FieldSpec, ...] = ()
    extracts: tuple[ExtractSpec, ...] = ()
    mapping: str = DEFAULT_MAPPING
    read_row: str = DEFAULT_READ_ROW
    key_field: str = DEFAULT_KEY_FIELD
    row_field: str | None = None
    family_field: str | None = None
    key_format: Any = "string"
    row_mapper: Any = None
    params: Mapping[str, Any] = field(default_factory=dict)
    # Set documents aside whose fields do not fit the types that their names stand for.
    check_schema: bool = False

    def __post_init__(self):
        if not self.table:
            raise SpecError("a spec needs a table")
        _one_of("mapping", self.mapping, ("row", "column"))
        _one_of("read_row", self.read_row, ("dynamic", "never"))
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "extracts", tuple(self.extracts))
        types: dict[str, Any] = {}
        for f in self.fields:
            if types.setdefault(f.name, f.type) != f.type:
                raise SpecError(f"field '{f.name}' is given two types")

    @staticmethod
    def from_dict(conf: Mapping[str, Any]) -> "IndexSpec":
        """Build a spec from plain nested dicts, such as parsed JSON."""
        conf = dict(conf)
        conf["fields"] = tuple(FieldSpec(**f) for f in conf.get("fields", ()))
        conf["extracts"] = tuple(ExtractSpec(**e) for e in conf.get("extracts", ()))
        return IndexSpec(**conf)

    def to_dict(self) -> dict[str, Any]:
        """The plain nested dict that ``from_dict`` reads; code of the user cannot be written down."""
        plain = asdict(self)
        for d in (*plain["fields"], *plain["extracts"]):
            if callable(d["type"]):
                raise SpecError("a value mapper of the user cannot be stored with a spec")
        if self.row_mapper is not None or not isinstance(self.key_format, str):
            raise SpecError("row mappers and key formats of the user cannot be stored with a spec")
        for params in (plain["params"], *(d["params"] for d in (*plain["fields"], *plain["extracts"]))):
            if any(callable(v) or isinstance(v, Mapping) for v in params.values()):
                raise SpecError("only plain parameters can be stored with a spec")
        return {k: list(v) if isinstance(v, tuple) else v for k, v in plain.items()}

    @property
    def targets(self) -> list[Target]:
        return [d.target for d in (*self.fields, *self.extracts)]

    @property
    def families(self) -> list[bytes]:
        """Families the spec reads, in definition order."""
        return list(dict.fromkeys(t.family for t in self.targets))

    @property
    def field_names(self) -> list[str]:
        return list(dict.fromkeys(f.name for f in self.fields))


def _one_of(what: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise SpecError(f"{what} must be one of {', '.join(allowed)}, not '{value}'")
