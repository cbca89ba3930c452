"""Document keys: formatting row, family and cell coordinates, and reading them back."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellindex.functions.decode import text
from cellindex.spec import SpecError

# The separator of cell keys, and how it is written inside a part.
SEPARATOR = "-"
ESCAPED = "\\-"
SPLIT_PATTERN = r"(?<!\\)-"


@dataclass(frozen=True)
class KeyFormat:
    """How bytes become key text. ``part`` functions apply inside a cell key.

    ``unwrite`` functions return NULL for text they cannot read.
    """

    write: Callable[[Column], Column]
    unwrite: Callable[[Column], Column]
    write_part: Callable[[Column], Column]
    unwrite_part: Callable[[Column], Column]

    def row(self, row_key: Column) -> Column:
        return self.write(row_key)

    def family(self, family: Column) -> Column:
        return self.write(family)

    def cell(self, row_key: Column, family: Column, qualifier: Column) -> Column:
        return F.concat_ws(SEPARATOR, *(self.write_part(c) for c in (row_key, family, qualifier)))

    def parse_row(self, key: Column) -> Column:
        return self.unwrite(key)

    def parse_cell(self, key: Column) -> Column:
        """STRUCT<row_key, family, qualifier> of a cell key, NULL if it is malformed."""
        parts = F.split(key, SPLIT_PATTERN, -1)
        read = [self.unwrite_part(parts[i]) for i in range(3)]
        whole = F.size(parts) == 3
        for r in read:
            whole = whole & r.isNotNull()
        return F.when(
            whole,
            F.struct(*(r.alias(n) for r, n in zip(read, ("row_key", "family", "qualifier")))),
        )

    def must_parse_cell(self, key: Column) -> Column:
        """As ``parse_cell``, but a malformed key fails the job."""
        return F.coalesce(
            self.parse_cell(key),
            F.raise_error(F.concat(F.lit("not a row, family and qualifier: "), key)),
        )


STRING = KeyFormat(
    write=text,
    unwrite=lambda k: k.cast("binary"),
    write_part=lambda b: F.replace(text(b), F.lit(SEPARATOR), F.lit(ESCAPED)),
    unwrite_part=lambda k: F.replace(k, F.lit(ESCAPED), F.lit(SEPARATOR)).cast("binary"),
)


def _from_hex(k: Column) -> Column:
    return F.when(F.length(k) % 2 == 0, F.unhex(k))


HEX = KeyFormat(
    write=lambda b: F.lower(F.hex(b)),
    unwrite=_from_hex,
    write_part=lambda b: F.lower(F.hex(b)),
    unwrite_part=_from_hex,
)

_FORMATS = {"string": STRING, "hex": HEX}


def key_format(of: str | KeyFormat, params: Mapping[str, Any] | None = None) -> KeyFormat:
    """A named format, or any object of the user's with the same methods.

    An object with a ``configure`` method is given the parameters of the spec, and
    what that returns is the format.
    """
    if isinstance(of, str):
        if of not in _FORMATS:
            raise SpecError(f"no key format is called '{of}'")
        return _FORMATS[of]
    return of.configure(dict(params or {})) if hasattr(of, "configure") else of
