"""Column contracts from JSON Schema documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import model

# Problems of a document or field.
NO_JSON = "Not a JSON Schema"
NO_TYPE = "No single known type"

# every property of every object, level by level; an object is walked on and is no field itself
_WALK = """
WITH RECURSIVE walk(file_config_id, names, demanded, node) AS (
  SELECT file_config_id, CAST(array() AS ARRAY<STRING>), true, try_parse_json(document) FROM {documents}
  UNION ALL
  SELECT w.file_config_id, array_append(w.names, p.key),
    w.demanded AND coalesce(array_contains(try_variant_get(w.node, '$.required', 'array<string>'), p.key), false)
      AND NOT array_contains(coalesce(try_variant_get(w.node, '$.type', 'array<string>'), array()), 'null'),
    p.value
  FROM walk w, LATERAL variant_explode(try_variant_get(w.node, '$.properties', 'variant')) p
)
SELECT * FROM walk LIMIT ALL
"""


def schema_fields(documents: DataFrame) -> DataFrame:
    """Contract rows of JSON Schema texts, one document per profile (``file_config_id``, ``document``).

    Columns: those of ``model.SEMANTIC_LAYER`` and ``problem`` (null = usable).  Objects are walked to any depth, a nested
    field is named ``outer.inner``.  Properties have no order in JSON: positions follow the names, level by
    level, as Spark orders the columns of JSON files.

    string: varchar with maxLength, DATE or TIMESTAMP by its format; integer: BIGINT; number: DECIMAL, its scale from a power of
    ten in multipleOf, else 38,18; boolean: boolean; array: varchar.  A field may be null unless it and all objects around
    it are required and none of them admits the type null.  ``x-primary-key`` marks keys.  A text that is null, no JSON
    object or has no properties gives one row with the problem, so does a field without a type of its own (a reference
    or a choice of types).  No documents give no rows.
    """
    walked = documents.sparkSession.sql(_WALK, documents=documents.select("file_config_id", "document"))
    node = walked.selectExpr(
        "file_config_id", "names", "demanded",
        "coalesce(try_variant_get(node, '$.type', 'array<string>'), array(try_variant_get(node, '$.type', 'string'))) AS types",
        "try_variant_get(node, '$.properties', 'variant') AS inner_node",
        "try_variant_get(node, '$.format', 'string') AS format",
        "try_variant_get(node, '$.maxLength', 'bigint') AS widest",
        "try_variant_get(node, '$.multipleOf', 'string') AS step",
        "try_variant_get(node, '$.description', 'string') AS field_description",
        "coalesce(try_variant_get(node, '$[\"x-primary-key\"]', 'boolean'), false) AS pk",
    ).withColumn("has_fields", F.expr("coalesce(schema_of_variant(inner_node) NOT IN ('OBJECT<>', 'VOID'), false)"))
    leaves = node.filter(~F.col("has_fields")).selectExpr(
        "*",
        "filter(types, t -> t <> 'null') AS known",
        "try_cast(step AS DECIMAL(38,18)) AS exact_step",
    ).selectExpr(
        "*",
        "if(size(known) = 1, known[0], NULL) AS type",
        "if(exact_step IN (1, 0.1, 0.01, 0.001, 0.0001, 0.00001, 0.000001), CAST(round(-log10(exact_step)) AS INT), 18) AS scale",
    ).selectExpr(
        "*",
        """CASE WHEN type = 'string' AND format = 'date' THEN 'DATE' WHEN type = 'string' AND format = 'date-time' THEN 'TIMESTAMP'
          WHEN type IN ('string', 'array') THEN 'varchar' WHEN type = 'integer' THEN 'BIGINT' WHEN type = 'number' THEN 'DECIMAL'
          WHEN type = 'boolean' THEN 'boolean' END AS data_type""",
        f"CASE WHEN size(names) = 0 THEN '{NO_JSON}' END AS whole",
    )
    within = Window.partitionBy("file_config_id").orderBy("names")
    return leaves.select(
        F.lit(None).cast("int").alias("id"),
        F.row_number().over(within).alias("field_position"),
        F.when(F.col("whole").isNull(), F.concat_ws(".", "names")).alias("field_name"),
        "field_description",
        "pk",
        F.when(F.col("whole").isNull(), F.col("data_type")).alias("data_type"),
        F.expr(
            "CASE WHEN data_type = 'DECIMAL' THEN concat('38,', scale) WHEN data_type = 'varchar' AND type = 'string' THEN CAST(widest AS STRING) END"
        ).alias("length"),
        F.expr("NOT demanded OR array_contains(types, 'null')").alias("nullable"),
        F.lit(model.CONTRACT_DEFAULTS["decimal_symbol"]).alias("decimal_symbol"),
        "file_config_id",
        F.coalesce("whole", F.when(F.col("data_type").isNull(), F.lit(NO_TYPE))).alias("problem"),
    )


def contract_from_schemas(documents: DataFrame) -> DataFrame:
    """``model.SEMANTIC_LAYER`` rows of the documents without any problem; the others give none, so that their files are
    reported as having no contract instead of being judged by half of one."""
    whole = F.max(F.col("problem").isNotNull()).over(Window.partitionBy("file_config_id"))
    names = [f.name for f in model.SEMANTIC_LAYER.fields]
    return schema_fields(documents).withColumn("__bad", whole).filter(~F.col("__bad")).select(*names)
