"""Text extraction: each cell is parsed into many fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellindex.functions import markup
from cellindex.functions.decode import text
from cellindex.operators.lookup import in_schema
from cellindex.spec import ExtractSpec

ENTRIES = "array<struct<field:string,value:string>>"
ERROR_FIELD = "parse_error"
UNKNOWN_TYPE = "application/octet-stream"

# How field names are rewritten when a spec gives no parameters.
DEFAULT_PARAMS = {
    "lowernames": "true",
    "fmap.content_encoding": "ignored_field",
    "fmap.content_type": "ignored_field",
}
IGNORED_FIELDS = ("ignored_field",)
# Possessive throughout, so that neither many comments nor long ones nest calls of the matcher.
OPENING = r"(?is)^\x{FEFF}?(?:\s++|<!--(?:[^-]|-(?!->))*+-->)*+"
MEDIA_TYPE = r"^[^/\s;,]+/[^/\s;,]+(\s*;.*)?$"


def media_type(declared: Column, content: Column) -> Column:
    """The declared type if it reads as one, else a type told from the content."""
    plain = F.lower(F.trim(F.regexp_replace(declared, ";.*$", "")))
    return F.when(declared.rlike(MEDIA_TYPE), plain).otherwise(sniff(content))


def sniff(content: Column) -> Column:
    """Tell HTML and XML by their opening markup; other readable text is plain.

    A byte order mark, white space and comments of any length may come first.
    """
    return (
        F.when(content.isNull() | (content == ""), F.lit(UNKNOWN_TYPE))
        .when(content.rlike(OPENING + r"<(!doctype\s+html|html|head|body)\b"), F.lit("text/html"))
        .when(content.rlike(OPENING + r"<\?xml\b"), F.lit("application/xml"))
        .when(content.contains("\x00"), F.lit(UNKNOWN_TYPE))
        .otherwise(F.lit("text/plain"))
    )


def normalise(field: Column, params: Mapping[str, str]) -> Column:
    """Rename a parsed field by the parameters; ignored fields become NULL."""
    name = field
    if params.get("lowernames") == "true":
        name = F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", "_"))
    renamed = F.lit(None).cast("string")
    maps = {k[len("fmap."):]: v for k, v in params.items() if k.startswith("fmap.")}
    for source, goal in maps.items():
        renamed = F.when(name == source, F.lit(goal)).otherwise(renamed)
    name = F.coalesce(renamed, name)
    return F.when(~name.isin(*IGNORED_FIELDS), name)


def effective_params(params: Mapping[str, str]) -> Mapping[str, str]:
    """Parameters of the user replace the defaults as a whole."""
    return params or DEFAULT_PARAMS


def parse_entries(content: Column, mime: Column, parsers: Mapping[str, markup.Parser]) -> Column:
    """Parsed (field, value) pairs of each text, through a UDF that gets a hundred rows at a time.

    Texts may be long, so a worker must not hold an Arrow batch of ten thousand. A parser that fails gives a single
    ``parse_error`` pair.
    """
    table = dict(parsers)

    def parse(body, kind):
        if body is None:
            return []
        try:
            pairs = table.get(kind, markup.parse_unknown)(body)
        except Exception as fault:  # a bad document must not fail the batch
            pairs = [(ERROR_FIELD, f"{type(fault).__name__}: {fault}")]
        return [(f, v) for f, v in pairs]

    return F.udf(parse, ENTRIES, useArrow=False)(content, mime)


def extract_entries(
    source: Column,
    spec: ExtractSpec,
    parsers: Mapping[str, markup.Parser] | None = None,
    declared: Column | None = None,
) -> Column:
    """ARRAY of (field, value) that an extract definition reads from cell bytes."""
    content = text(source)
    mime = media_type(F.lit(spec.type) if declared is None else declared, content)
    own = spec.params.get("parsers", {}) if parsers is None else parsers
    pairs = F.concat(
        F.array(F.struct(F.lit("content_type").alias("field"), mime.alias("value"))),
        parse_entries(content, mime, {**markup.PARSERS, **own}),
    )
    params = effective_params({k: v for k, v in spec.params.items() if k != "parsers"})
    renamed = F.transform(
        pairs,
        lambda e: F.struct(
            F.when(e["field"] == ERROR_FIELD, e["field"])
            .otherwise(F.concat(F.lit(spec.prefix), normalise(e["field"], params)))
            .alias("field"),
            e["value"].alias("value"),
        ),
    )
    kept = F.filter(renamed, lambda e: e["field"].isNotNull())
    if spec.schema_fields is None:
        return kept
    names = spec.schema_fields
    return F.filter(kept, lambda e: (e["field"] == ERROR_FIELD) | in_schema(e["field"], names))


def extract_fields(
    cells: DataFrame,
    spec: ExtractSpec,
    keys: tuple[str, ...] = ("row_key", "qualifier"),
    declared: Column | None = None,
) -> DataFrame:
    """Long form: one row per parsed (cell, field, value), in parse order."""
    entries = cells.select(*keys, extract_entries(F.col(spec.source), spec, declared=declared).alias("_e"))
    return entries.select(*keys, F.posexplode("_e").alias("ord", "_e")).select(
        *keys, "ord", "_e.field", "_e.value"
    )


def accepted(fields: DataFrame) -> DataFrame:
    return fields.filter(F.col("field") != ERROR_FIELD)


def rejected(fields: DataFrame) -> DataFrame:
    """Cells whose parser failed, with the fault: the quarantine of a text job."""
    return fields.filter(F.col("field") == ERROR_FIELD).drop("field", "ord")
