"""Contracts from JSON Schema."""

import json

from dropgate import model
from dropgate.operators import schema_import as S
from dropgate.plans import files as judge, verdict as V

DOCUMENT = {
    "type": "object",
    "required": ["id", "owner", "amount"],
    "properties": {
        "id": {"type": "string", "maxLength": 8, "x-primary-key": True},
        "amount": {"type": ["number", "null"], "multipleOf": 0.01},
        "rate": {"type": "number"},
        "owner": {
            "type": "object",
            "required": ["name", "home"],
            "properties": {
                "name": {"type": "string", "description": "full name"},
                "born": {"type": "string", "format": "date"},
                "home": {"type": ["object", "null"], "required": ["zip"], "properties": {"zip": {"type": "integer"}}},
            },
        },
        "tags": {"type": "array"},
        "seen": {"type": "string", "format": "date-time"},
        "open": {"type": "boolean"},
    },
}


def fields(spark, documents):
    texts = [(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in documents]
    return spark.createDataFrame(texts, "file_config_id int, document string")


def test_nested_fields(spark):
    got = S.contract_from_schemas(fields(spark, [(3, DOCUMENT)])).orderBy("field_position")
    assert [f.name for f in got.schema.fields] == [f.name for f in model.SEMANTIC_LAYER.fields]
    assert [(r.field_name, r.data_type, r.length, r.nullable, r.pk) for r in got.collect()] == [
        ("amount", "DECIMAL", "38,2", True, False),
        ("id", "varchar", "8", False, True),
        ("open", "boolean", None, True, False),
        ("owner.born", "DATE", None, True, False),
        ("owner.home.zip", "BIGINT", None, True, False),  # the object around it may be null
        ("owner.name", "varchar", None, False, False),
        ("rate", "DECIMAL", "38,18", True, False),
        ("seen", "TIMESTAMP", None, True, False),
        ("tags", "varchar", None, True, False),
    ]


def test_problems_leave_other_documents_alone(spark):
    good = {"properties": {"a": {"type": "integer"}}}
    documents = [
        (1, None), (2, "{bad"), (3, "[1]"), (4, {"type": "object"}), (5, good), (6, {"properties": {"a": {"type": "integer"}, "b": {"$ref": "#/x"}}}),
        (7, {"properties": {"a": {"type": ["integer", "string"]}}}), (8, {"properties": {}}), (9, ""),
    ]
    df = fields(spark, documents)
    bad = {(r.file_config_id, r.field_name, r.problem) for r in S.schema_fields(df).filter("problem IS NOT NULL").collect()}
    whole = {(i, None, S.NO_JSON) for i in (1, 2, 3, 4, 8, 9)}
    assert bad == whole | {(6, "b", S.NO_TYPE), (7, "a", S.NO_TYPE)}
    assert [r.file_config_id for r in S.contract_from_schemas(df).collect()] == [5]
    assert S.schema_fields(df.limit(0)).count() == 0


def test_deep_document(spark):
    node = {"type": "integer"}
    for i in range(40):
        node = {"type": "object", "required": ["n"], "properties": {"n": node}}
    (row,) = S.contract_from_schemas(fields(spark, [(1, node)])).collect()
    assert row.field_name == ".".join("n" * 40) and not row.nullable


def test_imported_contract_judges(spark):
    flat = {
        "required": ["id"],
        "properties": {"id": {"type": "integer", "x-primary-key": True}, "note": {"type": "string", "maxLength": 3}},
    }
    book = judge.Rulebook.from_table(S.contract_from_schemas(fields(spark, [(1, flat)])), business=())
    rows = spark.createDataFrame([("1", "abc"), ("2", "abcd")], "id string, note string")
    got = V.file_verdicts(rows, book.contracts[1], ()).first()
    assert (got.validation_flag, got.field_name) == ("37", "note")
