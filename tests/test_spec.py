import pytest

from cellindex.spec import ExtractSpec, FieldSpec, IndexSpec, SpecError, Target


def test_defaults():
    spec = IndexSpec("table1", [FieldSpec("field1", "col:qual1")], [ExtractSpec("col:qual2")])
    assert (spec.mapping, spec.read_row, spec.key_field, spec.key_format) == ("row", "dynamic", "id", "string")
    assert (spec.row_field, spec.family_field, spec.row_mapper) == (None, None, None)
    assert (spec.fields[0].source, spec.fields[0].type) == ("value", "string")
    assert (spec.extracts[0].prefix, spec.extracts[0].type) == ("", "application/octet-stream")
    assert spec.families == [b"col"]


def test_from_dict():
    spec = IndexSpec.from_dict(
        {
            "table": "table1",
            "mapping": "column",
            "read_row": "never",
            "key_field": "custom-id",
            "row_field": "custom-row",
            "family_field": "custom-family",
            "key_format": "hex",
            "fields": [
                {"name": "field1", "value": "col:qual*", "source": "qualifier", "type": "float"},
                {"name": "field2", "value": "col:qual2", "type": "long", "params": {"a": "b"}},
            ],
            "extracts": [{"prefix": "p_", "value": "col:qual3", "type": "text/html"}],
        }
    )
    assert spec.fields[1].params == {"a": "b"}
    assert spec.extracts[0].prefix == "p_"
    assert spec.field_names == ["field1", "field2"]


@pytest.mark.parametrize(
    "text,source,expected",
    [
        ("cf:qual", "value", Target(b"cf", b"qual", False)),
        ("cf:a:b", "value", Target(b"cf", b"a:b", False)),
        ("cf:qu*", "value", Target(b"cf", b"qu", True)),
        ("cf:*", "qualifier", Target(b"cf", b"", True)),
    ],
)
def test_value_expressions(text, source, expected):
    assert Target.parse(text, source) == expected


@pytest.mark.parametrize("text,source", [("no-colon", "value"), ("cf:qual", "qualifier")])
def test_bad_value_expressions(text, source):
    with pytest.raises(SpecError):
        FieldSpec("f", text, source)


@pytest.mark.parametrize("bad", [{"mapping": "cell"}, {"read_row": "always"}])
def test_bad_choices(bad):
    with pytest.raises(SpecError):
        IndexSpec("t", **bad)


def test_empty_table_and_clashing_types():
    with pytest.raises(SpecError):
        IndexSpec("")
    with pytest.raises(SpecError):
        IndexSpec("t", [FieldSpec("f", "a:b"), FieldSpec("f", "a:c", type="int")])
