"""Semi-structured data, arrays, and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions import udfs as U
from ..functions import variants as V
from ..functions.numbers import cents, dbl, money
from ..operators import joins as J
from .q_relational import REV, on_daily
from .registry import query
from .relations import sql_mean, sql_r, with_sql

query(
    "json_path_cast",
    with_sql("ev", "SELECT event_id, action, k, CAST(k AS DOUBLE) AS k_double FROM ev"),
)(
    lambda t: t.events.select("event_id", F.col("event_type").alias("action"), F.parse_json("props").alias("v")).select(
        "event_id", "action", V.at("v", "k", "int").alias("k"), V.at("v", "k", "double").alias("k_double")
    )
)


def _with(t, action):
    return t.events_json.where(V.at("event_data", "action") == action)


query(
    "json_nested_path",
    with_sql("ev", "SELECT event_id, username, 'City ' || (user_id % 10) AS city, k + 18 AS age FROM ev WHERE action = 'signup'"),
)(
    lambda t: _with(t, "signup").select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        V.at("event_data", "profile.city").alias("city"),
        V.at("event_data", "profile.age", "int").alias("age"),
    )
)

query(
    "json_array_index",
    with_sql(
        "ev_pages",
        "SELECT event_id, username, pages[1] AS first_page, pages[3] AS third_page, CAST(len(pages) AS INTEGER) AS num_pages FROM ev_pages",
    ),
)(
    lambda t: _with(t, "view").select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        V.at("event_data", "pages[0]").alias("first_page"),
        V.at("event_data", "pages[2]").alias("third_page"),
        V.array_size("event_data", "pages").alias("num_pages"),
    )
)

query("json_flatten", with_sql("ev_items", "SELECT event_id, username, item, price FROM ev_items"))(
    lambda t: V.flatten(_with(t, "purchase"), "event_data", "items").select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        V.at("f_value", "name").alias("item"),
        V.at("f_value", "price", "double").alias("price"),
    )
)

query(
    "json_flatten_outer",
    with_sql(
        "ev ev_items",
        "SELECT ev.event_id, ev.username, ev.action, item FROM ev LEFT JOIN ev_items ON ev.event_id = ev_items.event_id",
    ),
)(
    lambda t: V.flatten(t.events_json, "event_data", "items", outer=True).select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        V.at("event_data", "action").alias("action"),
        V.at("f_value", "name").alias("item"),
    )
)

query(
    "json_flatten_meta",
    with_sql(
        "ev_items",
        "SELECT event_id, username, CAST(array_position AS INTEGER) AS array_position, item AS item_name, 'items[' || array_position || ']' AS json_path FROM ev_items",
    ),
)(
    lambda t: V.flatten(_with(t, "purchase"), "event_data", "items").select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        F.col("f_index").alias("array_position"),
        V.at("f_value", "name").alias("item_name"),
        F.col("f_path").alias("json_path"),
    )
)

query(
    "json_flatten_nested",
    with_sql(
        "ev_items",
        """SELECT event_id, username, item AS item_name, tag FROM ev_items, UNNEST(tags) u(tag)
           UNION ALL SELECT event_id, username, item, NULL FROM ev_items WHERE tags IS NULL""",
    ),
)(
    lambda t: V.flatten(
        V.flatten(_with(t, "purchase"), "event_data", "items", prefix="i"), "i_value", "tags", outer=True, prefix="t"
    ).select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        V.at("i_value", "name").alias("item_name"),
        F.try_variant_get("t_value", "$", "string").alias("tag"),
    )
)

query(
    "json_flatten_object",
    with_sql(
        "ev",
        """SELECT event_id, username, 'age' AS profile_field, CAST(k + 18 AS VARCHAR) AS profile_value FROM ev WHERE action = 'signup'
           UNION ALL SELECT event_id, username, 'city', 'City ' || (user_id % 10) FROM ev WHERE action = 'signup'""",
    ),
)(
    lambda t: V.flatten(_with(t, "signup"), "event_data", "profile").select(
        "event_id",
        V.at("event_data", "user").alias("username"),
        F.col("f_key").alias("profile_field"),
        F.try_variant_get("f_value", "$", "string").alias("profile_value"),
    )
)

OBJECT_SQL = with_sql(
    "part_sales small_parts",
    """SELECT part_id, '{"part_id":' || part_id || CASE WHEN p_name IS NULL THEN '%s' ELSE ',"name":"' || p_name || '"' END
         || ',"lines":' || num_lines || '}' AS sale_json
       FROM part_sales LEFT JOIN small_parts ON part_id = p_partkey""",
)


def _objects(t, keep_null):
    rows = J.left_with_orphans(t.part_sales, t.small_parts)
    fields = {"part_id": "part_id", "name": "part_name", "lines": "num_lines"}
    return rows.select("part_id", V.build_object(fields, keep_null).alias("sale_json"))


query("json_object_construct", OBJECT_SQL % "")(lambda t: _objects(t, False))
query("json_object_keep_null", OBJECT_SQL % ',"name":null')(lambda t: _objects(t, True))

query(
    "arr_construct",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey || ',' || l_suppkey || ',' || l_linenumber AS keys FROM lineitem",
)(
    lambda t: t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat_ws(",", F.transform(F.array("l_partkey", "l_suppkey", "l_linenumber"), lambda x: x.cast("string"))).alias("keys"),
    )
)

def pages():
    return V.at("event_data", "pages", "array<string>")


query(
    "arr_contains",
    with_sql("ev_pages", "SELECT event_id, username, list_contains(pages, 'home') AS visited_home FROM ev_pages"),
)(
    lambda t: _with(t, "view").select(
        "event_id", V.at("event_data", "user").alias("username"), F.array_contains(pages(), "home").alias("visited_home")
    )
)

query(
    "arr_slice",
    with_sql(
        "ev_pages",
        "SELECT event_id, array_to_string(pages, ',') AS all_pages, array_to_string(pages[1:2], ',') AS first_two_pages FROM ev_pages",
    ),
)(
    lambda t: _with(t, "view").select(
        "event_id",
        F.concat_ws(",", pages()).alias("all_pages"),
        F.concat_ws(",", V.array_slice(pages(), 0, 2)).alias("first_two_pages"),
    )
)

query(
    "json_parse_print",
    """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS printed,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS parsed_k FROM events""",
)(
    # Every fifth text loses its closing brace, so that the tolerant parser has something to reject.
    lambda t: t.events.select(
        "event_id",
        F.to_json(F.parse_json("props")).alias("printed"),
        F.when(F.col("event_id") % 5 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props")).alias("dirty"),
    ).select("event_id", "printed", V.at(F.try_parse_json("dirty"), "k", "int").alias("parsed_k"))
)

query(
    "json_typeof",
    with_sql(
        "ev",
        """SELECT event_id, 'OBJECT' AS doc_type, 'VARCHAR' AS user_type,
             CASE WHEN action = 'purchase' AND k % 4 > 0 THEN 'ARRAY' END AS items_type,
             CASE WHEN action = 'signup' THEN 'OBJECT' END AS profile_type,
             CASE WHEN action = 'signup' THEN 'INTEGER' END AS age_type FROM ev""",
    ),
)(
    lambda t: t.events_json.select(
        "event_id",
        V.type_of("event_data").alias("doc_type"),
        V.type_of(V.at("event_data", "user", "variant")).alias("user_type"),
        V.type_of(V.at("event_data", "items", "variant")).alias("items_type"),
        V.type_of(V.at("event_data", "profile", "variant")).alias("profile_type"),
        V.type_of(V.at("event_data", "profile.age", "variant")).alias("age_type"),
    )
)


def json_report(events_json):
    """Items, spend and every item bought per user, in order of event and place in it.

    The list is one value of the result, as long as the user's purchases.
    """
    items = V.flatten(events_json.where(V.at("event_data", "action") == "purchase"), "event_data", "items").select(
        V.at("event_data", "user").alias("username"),
        F.struct("event_id", "f_index", V.at("f_value", "name").alias("item")).alias("entry"),
        cents(V.at("f_value", "price", "double")).alias("c"),
    )
    bought = F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["item"])
    return items.groupBy("username").agg(
        F.count(F.lit(1)).alias("num_items"),
        dbl(money(F.sum("c"))).alias("total_spent"),
        F.concat_ws(", ", bought).alias("items_bought"),
    )


query(
    "json_report",
    with_sql(
        "ev_items",
        """SELECT username, COUNT(*) AS num_items, CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
             string_agg(item, ', ' ORDER BY event_id, array_position) AS items_bought FROM ev_items GROUP BY 1""",
    ),
)(lambda t: json_report(t.events_json))

# --- user functions -------------------------------------------------------------------------

CLASS_SQL = (
    "CASE WHEN revenue_index >= 1.25 THEN 'HIGH' WHEN revenue_index >= 1 THEN 'MEDIUM' WHEN revenue_index >= 0.75 THEN 'LOW' ELSE 'VERY LOW' END"
)

query(
    "udf_scalar",
    with_sql("daily_indexed", f"SELECT sale_date, {REV}, {CLASS_SQL} AS class, {CLASS_SQL} AS class_udf FROM daily_indexed"),
)(
    lambda t: t.daily_indexed.select(
        "sale_date",
        dbl("daily_revenue").alias("daily_revenue"),
        U.classify_revenue("revenue_index").alias("class"),
        U.classify_revenue_udf("revenue_index").alias("class_udf"),
    )
)

MARGIN_SQL = sql_r("CAST(daily.daily_revenue AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(0.35 AS DOUBLE))")
query("udf_multi_arg", on_daily(f"SELECT sale_date, {REV}, {MARGIN_SQL} AS margin, {MARGIN_SQL} AS margin_udf FROM daily"))(
    lambda t: t.daily.select("sale_date", dbl("daily_revenue").alias("daily_revenue")).select(
        "*",
        U.margin("daily_revenue", F.lit(0.35)).alias("margin"),
        U.margin_udf("daily_revenue", F.lit(0.35)).alias("margin_udf"),
    )
)

ZS = sql_r(
    f"(CAST(daily.daily_revenue AS DOUBLE) - (SELECT {sql_mean('daily_revenue')} FROM daily)) "
    "/ NULLIF((SELECT stddev(CAST(daily_revenue AS DOUBLE)) FROM daily), 0)",
    6,
)
query("udf_vectorized", on_daily(f"SELECT sale_date, {REV}, num_orders, CAST(daily.daily_revenue AS DOUBLE) AS passed, {ZS} AS zscore FROM daily"))(
    lambda t: U.global_zscore(t.daily, "daily_revenue").select(
        "sale_date",
        dbl("daily_revenue").alias("daily_revenue"),
        "num_orders",
        U.identity_udf(dbl("daily_revenue")).alias("passed"),
        (F.floor(F.col("zscore") * 1e6 + 0.5) / 1e6).alias("zscore"),
    )
)

NORM = sql_r(
    "(CAST(daily.daily_revenue AS DOUBLE) - lo) / NULLIF(hi - lo, 0)", 4
)
query(
    "udf_normalize",
    on_daily(
        f"""SELECT sale_date, {REV}, num_orders, CASE WHEN hi = lo THEN 0 ELSE {NORM} END AS normalized
            FROM daily CROSS JOIN (SELECT CAST(MIN(daily_revenue) AS DOUBLE) AS lo, CAST(MAX(daily_revenue) AS DOUBLE) AS hi FROM daily)"""
    ),
)(lambda t: U.normalized(t.daily, "daily_revenue").withColumn("daily_revenue", dbl("daily_revenue")))

query(
    "udf_email_domain",
    r"""WITH words AS (SELECT doc_id, UNNEST(regexp_split_to_array(text, '[ \t\r\n]+')) AS word FROM documents)
        SELECT doc_id, word, CASE WHEN contains(word, '@') THEN lower(split_part(word, '@', 2)) END AS domain
        FROM words WHERE contains(word, '@')""",
)(
    lambda t: t.documents.where(F.contains("text", F.lit("@")))
    .select("doc_id", F.explode(F.split("text", r"[ \t\r\n]+")).alias("word"))
    .where(F.contains("word", F.lit("@")))
    .select("doc_id", "word", S.email_domain("word").alias("domain"))
)

SPLIT_SQL = """SELECT p_partkey, trim(item) AS item, CAST(i - 1 AS INTEGER) AS position
  FROM (SELECT p_partkey, UNNEST(string_split(p_name, ' ')) AS item, UNNEST(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM part)"""

query("udtf_split", SPLIT_SQL)(lambda t: U.split_rows(t.part.select("p_partkey", "p_name"), "p_name", " ").drop("p_name"))


def _lateral(t):
    U.register(t.spark)
    sql = "SELECT p.p_partkey, s.item, s.position FROM {part} p, LATERAL split_to_rows(p.p_name, ' ') s"
    return t.spark.sql(sql, part=t.part)


query("udtf_lateral", SPLIT_SQL)(_lateral)


def _table_function(t):
    U.register(t.spark)
    sql = "SELECT id AS p_partkey, item, position FROM split_table(TABLE(SELECT p_partkey, p_name FROM {part}), ' ')"
    return t.spark.sql(sql, part=t.part)


query("udtf_table", SPLIT_SQL)(_table_function)


def _sql_udf(t):
    U.register(t.spark)
    sql = "SELECT sale_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, revenue_tier(revenue_index) AS tier FROM {daily}"
    return t.spark.sql(sql, daily=t.daily_indexed)


query("sql_udf", with_sql("daily_indexed", f"SELECT sale_date, {REV}, {CLASS_SQL} AS tier FROM daily_indexed"))(_sql_udf)
