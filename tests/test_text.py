import pytest
from pyspark.sql import functions as F

from cellindex.functions import markup
from cellindex.operators import text
from cellindex.plans import build
from cellindex.spec import ExtractSpec, FieldSpec, IndexSpec

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><meta name="Author" content="me">
<style>p{x:1}</style><script>var t="</p>";</script></head><body><h1>Head</h1><p>one <b>two</b><br>three<div>four"""


def test_html_page():
    pairs = dict(markup.parse_html(PAGE))
    assert pairs == {"title": "A & B", "Author": "me", "content": "Head\none two\nthree\nfour"}


@pytest.mark.parametrize(
    "declared,content,expected",
    [
        ("text/plain", "<html>", "text/plain"),
        ("Text/HTML; charset=x", "", "text/html"),
        ("not a type", "  <!doctype HTML><p>", "text/html"),
        ("not a type", "<!-- c --> <html>", "text/html"),
        ("nothing", "<?xml version='1.0'?><a/>", "application/xml"),
        ("nothing", "\n<!DOCTYPE html>", "text/html"),
        ("nothing", "\ufeff<html>", "text/html"),
        ("nothing", "<!-- two\nlines -->\n<!-- more --> <HTML lang='x'>", "text/html"),
        ("nothing", "\n <?xml version='1.0'?><a/>", "application/xml"),
        ("nothing", "<!-- c -->" * 100_000 + "<html>", "text/html"),
        ("nothing", "\n<!--" + " -- > - " * 1_300_000 + "-->\n<?xml version='1.0'?>", "application/xml"),
        ("nothing", "<!-- never closed" * 20_000, "text/plain"),
        ("nothing", "<!--a--->x<!----><html>", "text/plain"),
        ("nothing", "<!----><!--a---><html>", "text/html"),
        ("nothing", "<htmlx>", "text/plain"),
        ("nothing", "words", "text/plain"),
        ("nothing", "", "application/octet-stream"),
        ("nothing", "a\x00b", "application/octet-stream"),
    ],
)
def test_media_types(spark, declared, content, expected):
    df = spark.createDataFrame([(declared, content)], "d string, c string")
    assert df.select(text.media_type(F.col("d"), F.col("c")).alias("m")).first().m == expected


def test_field_names(spark):
    df = spark.createDataFrame([("Content-Type",), ("X Parsed.By",), ("Title",)], "f string")
    names = lambda p: [r.n for r in df.select(text.normalise(F.col("f"), text.effective_params(p)).alias("n")).collect()]
    assert names({}) == [None, "x_parsed_by", "title"]
    assert names({"fmap.Title": "heading"}) == ["Content-Type", "X Parsed.By", "heading"]
    assert names({"lowernames": "true", "fmap.title": "ignored_field"}) == ["content_type", "x_parsed_by", None]


def fields(doc):
    return [(e.field, e.value) for e in doc.text_fields]


def test_extracts_in_both_modes(cells):
    log = cells(
        ("r", "d", "p1", PAGE, "Put"), ("r", "d", "p2", "<p>more", "Put"), ("r", "f", "q", "v", "Put")
    )
    extract = ExtractSpec("d:*", prefix="t_", type="text/html")
    expected = [("t_title", "A & B"), ("t_author", "me"), ("t_content", "Head\none two\nthree\nfour"), ("t_content", "more")]
    row = build.bulk_build(log, IndexSpec("table1", [FieldSpec("v", "f:*")], [extract])).first()
    assert (fields(row), list(row.v)) == (expected, ["v"])
    column = IndexSpec("table1", [FieldSpec("v", "f:*")], [extract], mapping="column")
    docs = {d.id: d for d in build.column_index(log, column).collect()}
    assert fields(docs["r-d-p1"]) == expected[:3] and fields(docs["r-d-p2"]) == expected[3:]
    assert fields(docs["r-f-q"]) == [] and list(docs["r-f-q"].v) == ["v"]


def test_own_parsers_and_faults(cells):
    def shout(body):
        if "bad" in body:
            raise ValueError("cannot read")
        return [("Loud", body.upper())]

    extract = ExtractSpec("d:*", type="x/shout", params={"parsers": {"x/shout": shout}, "lowernames": "true"})
    log = cells(("r", "d", "a", "hey", "Put"), ("r", "d", "b", "bad", "Put"))
    found = text.extract_fields(log, extract)
    assert {(r.field, r.value) for r in text.accepted(found).collect()} == {("loud", "HEY"), ("content_type", "x/shout")}
    assert [(bytes(r.qualifier), r.value) for r in text.rejected(found).collect()] == [(b"b", "ValueError: cannot read")]


def test_whole_text_is_kept(cells):
    body = "word " * 50_000
    found = text.extract_fields(cells(("r", "d", "a", body, "Put")), ExtractSpec("d:*", type="text/plain"))
    assert {r.field: r.value for r in found.collect()}["content"] == body


def test_few_texts_are_handed_over_at_once(spark):
    """An Arrow batch of ten thousand long texts may be larger than a worker."""
    found = text.extract_fields(spark.createDataFrame([(b"r", b"q", b"x")], "row_key binary, qualifier binary, value binary"), ExtractSpec("d:*"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
