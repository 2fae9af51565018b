"""Queries over nested JSON documents that Spark builds from the tables: schemas, walks, typed fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import variants
from millrace.plans.registry import query
from millrace.session import table

ORDER_SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "type": "object",
    "required": ["id", "status", "lines"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 0},
        "status": {"enum": ["F", "O"]},
        "priority": {"type": "string", "pattern": "^[1-3]-", "maxLength": 8},
        "total": {"type": "number", "maximum": 300000},
        "lines": {"type": "array", "minItems": 1, "maxItems": 5, "items": {"$ref": "#/$defs/line"}},
    },
    "$defs": {
        "line": {
            "type": "object",
            "required": ["flag"],
            "properties": {
                "qty": {"type": "integer", "exclusiveMinimum": 5},
                "disc": {"anyOf": [{"maximum": 0.03}, {"minimum": 0.07}]},
                "flag": {"oneOf": [{"const": "R"}, {"pattern": "^[AR]$"}]},
                "part": {"not": {"multipleOf": 7}},
            },
        }
    },
}


@query("""WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS part, l_quantity AS qty, l_discount AS disc, nullif(l_returnflag, 'N') AS flag FROM lineitem),
i AS (SELECT *, '/lines/' || (row_number() OVER (PARTITION BY k ORDER BY n, part, qty, disc, flag NULLS FIRST) - 1) AS p FROM l WHERE k IN (SELECT o_orderkey FROM orders)), c AS (SELECT k, count(*) AS n FROM l GROUP BY k)
SELECT o_orderkey, '/status' AS path, 'enum' AS rule FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT o_orderkey, '/priority', 'pattern' FROM orders WHERE left(o_orderpriority, 1) NOT IN ('1', '2', '3')
UNION ALL SELECT o_orderkey, '/priority', 'maxLength' FROM orders WHERE length(o_orderpriority) > 8
UNION ALL SELECT o_orderkey, '/total', 'maximum' FROM orders WHERE o_totalprice > 300000
UNION ALL SELECT o_orderkey, '/bonus', 'false' FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT o_orderkey, '/lines', 'minItems' FROM orders WHERE o_orderkey NOT IN (SELECT k FROM c)
UNION ALL SELECT o_orderkey, '/lines', 'maxItems' FROM orders JOIN c ON k = o_orderkey WHERE n > 5
UNION ALL SELECT k, p, 'required flag' FROM i WHERE flag IS NULL
UNION ALL SELECT k, p || '/flag', 'oneOf' FROM i WHERE flag = 'R'
UNION ALL SELECT k, p || '/qty', 'type integer' FROM i WHERE qty <> floor(qty)
UNION ALL SELECT k, p || '/qty', 'exclusiveMinimum' FROM i WHERE qty <= 5
UNION ALL SELECT k, p || '/disc', 'anyOf' FROM i WHERE disc > 0.03 AND disc < 0.07
UNION ALL SELECT k, p || '/part', 'not' FROM i WHERE part % 7 = 0""")
def schema_paths(spark, sf_dir):
    """Where orders with their lines, as nested documents, break a schema with references, alternatives and bounds."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("qty"), F.col("l_discount").alias("disc"), F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    # checks cost far more than their bytes tell, so the number of tasks is fixed here and not left to the sizes
    spread = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), line.alias("line")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    lines = spread.groupBy("o_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    # merged where the lines lie: a broadcast of them would leave all checks to the one task that reads the orders' file
    o = table(spark, sf_dir, "orders").join(lines.hint("merge"), "o_orderkey", "left")
    none = F.array().cast(lines.schema["lines"].dataType)
    document = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total"),
        F.when(F.col("o_totalprice") > 400000, F.lit(1)).alias("bonus"), F.coalesce("lines", none).alias("lines"),
    ))
    return variants.fault_rows(o.select("o_orderkey", document.alias("j")), ["o_orderkey"], "j", ORDER_SCHEMA)


@query("""WITH e AS (SELECT user_id, event_id, event_type, json_extract_string(props, '$.k') AS k, '$.seen[' || (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) || ']' AS p FROM events)
SELECT user_id, '$.user' AS path, 'user' AS name, 'integer' AS kind, user_id::VARCHAR AS value FROM e GROUP BY user_id
UNION ALL SELECT user_id, p || '.at[0]', 'at', 'integer', event_id::VARCHAR FROM e UNION ALL SELECT user_id, p || '.at[1]', 'at', 'string', event_type FROM e
UNION ALL SELECT user_id, p || '.props.k', 'k', 'integer', k FROM e WHERE k IS NOT NULL""")
def json_nodes(spark, sf_dir):
    """Every scalar of a user's events as one document, with properties nested in it, and its path."""
    seen = F.struct("event_id", F.concat(F.lit('{"at":['), F.col("event_id").cast("string"), F.lit(","), F.to_json(F.array("event_type")).substr(F.lit(2), F.char_length(F.to_json(F.array("event_type"))) - 1), F.lit(',"props":'), F.coalesce("props", F.lit("null")), F.lit("}")).alias("j"))
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(seen)).alias("s"))
    document = F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit(',"seen":['), F.array_join(F.transform("s", lambda x: x["j"]), ","), F.lit("]}"))
    return variants.scalars(users.select("user_id", document.alias("j")), ["user_id"], "j")


@query("""WITH o AS (SELECT o_custkey AS c_custkey, o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
SELECT c_custkey, '$.segment' AS path, 'segment' AS name, 'literal' AS tipo, c_mktsegment AS valor, NULL AS url FROM customer
UNION ALL SELECT c_custkey, '$.orders[' || i || '].status', 'status', 'inferido', o_orderstatus, 'https://orders.example/' || o_orderkey FROM o
UNION ALL SELECT c_custkey, '$.orders[' || i || '].status.from', 'from', 'literal', o_orderpriority, NULL FROM o WHERE o_orderstatus = 'F'""")
def typed_nodes(spark, sf_dir):
    """Typed fields at any depth of a customer's record, also those inside another one."""
    o = table(spark, sf_dir, "orders")
    inner = F.when(F.col("o_orderstatus") == "F", F.struct(F.lit("literal").alias("tipo"), F.col("o_orderpriority").alias("valor")))
    status = F.struct(F.lit("inferido").alias("tipo"), F.col("o_orderstatus").alias("valor"), F.concat(F.lit("https://orders.example/"), F.col("o_orderkey").cast("string")).alias("url"), inner.alias("from"))
    held = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), status.alias("status")))).alias("orders"))
    c = table(spark, sf_dir, "customer").join(held, "c_custkey", "left")
    segment = F.struct(F.lit("literal").alias("tipo"), F.col("c_mktsegment").alias("valor"))
    documents = c.select("c_custkey", F.to_json(F.struct(segment.alias("segment"), F.col("c_name").alias("name"), "orders")).alias("j"))
    return variants.typed_fields(documents, ["c_custkey"], "j", "tipo", ["tipo", "valor", "url"])
