"""Cells to documents: extraction, decoding and row assembly."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.functions.decode import decode
from cellindex.functions.keys import key_format
from cellindex.operators import select
from cellindex.operators.skew import MAX_GROUP_VALUES, collect_groups
from cellindex.operators.text import extract_entries
from cellindex.spec import ExtractSpec, FieldSpec, IndexSpec, Target

# Output column that holds the fields of parsed text documents.
TEXT_COLUMN = "text_fields"


def extract(cells: DataFrame, target: Target, source: str = "value") -> DataFrame:
    """The bytes one definition reads, one row per matching cell.

    Rows keep their qualifier: its byte order is the order of the values.
    """
    return cells.filter(select.matches(target)).select(
        "row_key", "qualifier", F.col(source).alias("bytes")
    )


def _values(definition: FieldSpec | ExtractSpec, chosen: Column) -> Column:
    """Decoded values of the cells that a definition reads, NULL for others."""
    source = F.col(definition.source)
    if isinstance(definition, ExtractSpec):
        # Python parsers run on all rows, so the others are blanked out first.
        return F.when(chosen, extract_entries(F.when(chosen, source), definition))
    return F.when(chosen, decode(source, definition.type, definition.params))


def _overlap(a: Target, b: Target) -> bool:
    """Some cell may lie in both targets."""
    if a.family != b.family:
        return False
    if a.prefix and b.prefix:
        return a.qualifier.startswith(b.qualifier) or b.qualifier.startswith(a.qualifier)
    if a.prefix or b.prefix:
        whole, piece = (a, b) if b.prefix else (b, a)
        return whole.qualifier.startswith(piece.qualifier)
    return a.qualifier == b.qualifier


def _runs(defs: list) -> list[list]:
    """Cut definitions of one field into runs that one decoder can serve.

    A run shares source, type and parameters, and no cell feeds it twice.
    """
    out: list[list] = []
    for i, d in defs:
        same = out and all(
            (e.source, e.type, e.params) == (d.source, d.type, d.params)
            and type(e) is type(d)
            and getattr(e, "prefix", None) == getattr(d, "prefix", None)
            and not _overlap(e.target, d.target)
            for _, e in out[-1]
        )
        if same:
            out[-1].append((i, d))
        else:
            out.append([(i, d)])
    return out


def _definitions(spec: IndexSpec) -> dict[str, list[tuple[int, FieldSpec | ExtractSpec]]]:
    """Output column -> its definitions, numbered in definition order."""
    out: dict[str, list] = {}
    for i, d in enumerate((*spec.fields, *spec.extracts)):
        out.setdefault(d.name if isinstance(d, FieldSpec) else TEXT_COLUMN, []).append((i, d))
    return out


def map_cells(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """Column mode: each cell's own document fields, added as array columns.

    Nothing is grouped; a field that the cell does not feed is an empty array. A
    row mapper of the user sees each cell as a row of its own.
    """
    if spec.row_mapper is not None:
        return spec.row_mapper.map_cells(cells, spec.params)
    return cells.withColumns(cell_fields(spec))


def cell_fields(spec: IndexSpec) -> dict[str, Column]:
    """Column mode: each field of a spec as an expression over one cell."""
    columns = {}
    for name, defs in _definitions(spec).items():
        pieces = []
        for run in _runs(defs):
            feeds = select.any_of(select.matches(d.target) for _, d in run)
            pieces.append(F.coalesce(_values(run[0][1], feeds), F.array()))
        columns[name] = F.concat(*pieces) if len(pieces) > 1 else pieces[0]
    return columns


def field_values(cells: DataFrame, spec: IndexSpec) -> DataFrame:
    """One row per (cell, definition it feeds), with the definition's number.

    A cell that feeds nothing stays, without a number: its row still becomes a
    document. Cells are multiplied only if definitions overlap.
    """
    targets = [d.target for d in (*spec.fields, *spec.extracts)]
    hits = [F.when(select.matches(t), F.lit(i)) for i, t in enumerate(targets)]
    if any(_overlap(a, b) for a, b in combinations(targets, 2)):
        return cells.withColumn("def", F.explode_outer(F.array_compact(F.array(*hits))))
    return cells.withColumn("def", F.coalesce(*hits, F.lit(None).cast("int")))


def map_rows(
    cells: DataFrame,
    spec: IndexSpec,
    max_values: int = MAX_GROUP_VALUES,
    keep: tuple[str, ...] = (),
    large: DataFrame | None = None,
) -> DataFrame:
    """Row mode: one document per row, fields as arrays in qualifier byte order.

    Fields that share a name append in definition order. Every document has
    every field, empty if the row feeds it nothing. A row with more than
    ``max_values`` values continues in further parts (column ``part``). The
    cells must hold one live put per coordinate. ``keep`` names columns that are
    the same for all cells of a row, ``large`` rows to be numbered over many tasks.
    """
    lists, values = {}, field_values(cells, spec)
    for name, defs in _definitions(spec).items():
        chosen = F.col("def").isin([i for i, _ in defs])
        value = F.coalesce(
            *[_values(run[0][1], F.col("def").isin([i for i, _ in run])) for run in _runs(defs)]
        )
        if name == TEXT_COLUMN:
            # Python parsers get the text cells alone; the others join them afterwards.
            texts = values.filter(chosen).withColumn("_texts", value)
            rest = values.filter(~chosen | F.col("def").isNull())
            values, value = rest.unionByName(texts, allowMissingColumns=True), F.col("_texts")
        lists[name] = (chosen, value)
    docs = collect_groups(
        values,
        ["row_key"],
        ["def", "qualifier"],
        lists,
        max_values,
        counted=F.col("def").isNotNull(),
        totals={k: F.max(k) for k in keep},
        size=F.length("qualifier") + F.coalesce(F.length("value"), F.lit(0)),
        large=large,
    )
    for name in lists:
        docs = docs.withColumn(name, F.flatten(name))
    return docs


def row_view(cells: DataFrame, max_values: int = MAX_GROUP_VALUES) -> DataFrame:
    """All cells of a row in family and qualifier order, as one sorted list."""
    cell = F.struct("family", "qualifier", "value")
    return collect_groups(
        cells.filter(select.is_put()),
        ["row_key"],
        ["family", "qualifier"],
        {"cells": (None, cell)},
        max_values,
        size=F.length("qualifier") + F.coalesce(F.length("value"), F.lit(0)),
    )


def add_key(docs: DataFrame, spec: IndexSpec, mapping: str | None = None) -> DataFrame:
    """Add the document id under the spec's key field."""
    keys = key_format(spec.key_format, spec.params)
    if (mapping or spec.mapping) == "row":
        key = keys.row(F.col("row_key"))
    else:
        key = keys.cell(F.col("row_key"), F.col("family"), F.col("qualifier"))
    return docs.withColumn(spec.key_field, key)


def add_row_and_family(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Column mode: add the row and family fields where the spec names them."""
    keys = key_format(spec.key_format, spec.params)
    if spec.row_field is not None:
        docs = docs.withColumn(spec.row_field, keys.row(F.col("row_key")))
    if spec.family_field is not None:
        docs = docs.withColumn(spec.family_field, keys.family(F.col("family")))
    return docs


def merge_documents(
    entries: DataFrame, max_values: int = MAX_GROUP_VALUES
) -> DataFrame:
    """Merge documents that share an id, field by field.

    ``entries`` holds one row per added value: id, prefix, field, value, boost,
    and (doc_ord, value_ord) for the order of adding. Values append; the boosts
    of a field multiply.
    """
    named = entries.withColumn("field", F.concat("prefix", "field"))
    # A field in parts has one boost, that of all its values: a number per field, whatever its parts hold.
    boosts = named.groupBy("id", "field").agg(F.product("boost").alias("boost"))
    merged = collect_groups(
        named,
        ["id", "field"],
        ["doc_ord", "value_ord"],
        {"values": (None, F.col("value"))},
        max_values,
        size=F.length("value"),
    )
    return merged.join(boosts, ["id", "field"])
