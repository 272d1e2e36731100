"""The relations the queries run on, once as DataFrames and once as SQL.

``Tables`` binds the operators to the Parquet tables; ``WITH`` holds the same definitions
as SQL common table expressions for the check queries.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import cents, money


class Tables:
    """Lazy access to the base tables of one folder and the relations derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.table("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def labels(self) -> DataFrame:
        return self.table("labels")

    @cached_property
    def conversations(self) -> DataFrame:
        return self.table("conversations")

    @cached_property
    def daily(self) -> DataFrame:
        """Daily sales: one row per calendar day with orders, so its size is bounded by the calendar."""
        return (
            self.orders.groupBy(F.col("o_orderdate").cast("date").alias("sale_date"))
            .agg(F.sum(cents("o_totalprice")).alias("_cents"), F.count(F.lit(1)).alias("num_orders"))
            .select("sale_date", money("_cents").alias("daily_revenue"), "num_orders")
        )

    @cached_property
    def daily_indexed(self) -> DataFrame:
        """``daily`` with each day's revenue as a multiple of the mean day."""
        return self.daily.withColumn("revenue_index", F.col("daily_revenue").cast("double") / self.daily_mean())

    @cached_property
    def cats(self) -> DataFrame:
        """Category dimension: the part types with a margin, the share of large parts among theirs."""
        margin = F.count_if(F.col("p_size") >= 35).cast("double") / F.count(F.lit(1))
        return self.part.groupBy(F.col("p_type").alias("category")).agg(margin.alias("margin_pct"))

    def _lines(self, part: DataFrame) -> DataFrame:
        by_part = self.lineitem.groupBy(
            F.col("l_shipdate").cast("date").alias("sale_date"), "l_partkey"
        ).agg(F.sum(cents("l_extendedprice")).alias("_cents"))
        return (
            by_part.join(part, by_part.l_partkey == part.p_partkey, "left")
            .groupBy("sale_date", F.col("p_type").alias("category"))
            .agg(F.sum("_cents").alias("_cents"))
            .select("sale_date", "category", money("_cents").alias("category_revenue"))
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Sales by day and category, summed to (day, part) before the join to the parts."""
        return self._lines(self.part.select("p_partkey", "p_type"))

    @cached_property
    def part_sales(self) -> DataFrame:
        """Sales per part: the fact side of the outer-join examples."""
        return (
            self.lineitem.groupBy(F.col("l_partkey").alias("part_id"))
            .agg(F.sum(cents("l_extendedprice")).alias("_cents"), F.count(F.lit(1)).alias("num_lines"))
            .select("part_id", money("_cents").alias("amount"), "num_lines")
        )

    @cached_property
    def small_parts(self) -> DataFrame:
        """Parts up to size 25 and announced ones without sales: either side of a join with the sales has rows without a match."""
        announced = self.part.where(F.col("p_size") == 1).select(
            (-F.col("p_partkey")).alias("p_partkey"), F.concat("p_name", F.lit(" (announced)")).alias("p_name"), "p_type"
        )
        return self.part.where(F.col("p_size") <= 25).select("p_partkey", "p_name", "p_type").unionByName(announced)

    @cached_property
    def events_json(self) -> DataFrame:
        """Events as JSON text: purchases carry items, views carry pages, signups a profile.

        Every document is built from the columns of its own row, so no shuffle is needed
        and no array can grow with the data.
        """
        k = F.get_json_object("props", "$.k").cast("int")
        n_items = k % 4
        items = F.transform(
            F.sequence(F.lit(1), n_items),
            lambda i: F.struct(
                F.concat(F.lit("item"), i.cast("string")).alias("name"),
                (F.floor(F.col("value") * 100.0 + 0.5) * i / 100.0).alias("price"),
                F.when(i > 1, F.array(F.lit("t1"), F.concat(F.lit("t"), i.cast("string")))).alias("tags"),
            ),
        )
        pages = F.when(k % 2 == 0, F.array(F.lit("home"), F.lit("cart"))).otherwise(
            F.array(F.lit("products"), F.concat(F.lit("page"), k.cast("string")), F.lit("cart"))
        )
        profile = F.struct(
            (k + 18).alias("age"),
            F.concat(F.lit("City "), (F.col("user_id") % 10).cast("string")).alias("city"),
        )
        action = F.col("event_type")
        doc = F.struct(
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
            action.alias("action"),
            F.when((action == "purchase") & (n_items > 0), items).alias("items"),
            F.when(action == "view", pages).alias("pages"),
            F.when(action == "signup", profile).alias("profile"),
        )
        return self.events.select("event_id", "ts", F.to_json(doc).alias("event_text")).select(
            "event_id", "ts", F.parse_json("event_text").alias("event_data")
        )

    @cached_property
    def customer_v2(self) -> DataFrame:
        """A later version of ``customer``: every 7th key gets a new segment, every 11th is gone, new keys arrive."""
        c = self.customer
        kept = c.where(F.col("c_custkey") % 11 != 0).withColumn(
            "c_mktsegment",
            F.when(F.col("c_custkey") % 7 == 0, F.lit("RENEWED")).otherwise(F.col("c_mktsegment")),
        )
        new = c.where(F.col("c_custkey") % 13 == 0).withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000_000)
        return kept.unionByName(new)

    @cached_property
    def tree(self) -> DataFrame:
        """Customers as branches of a binary tree: halving a key gives the branch it grows from, keys 0 and 1 are roots."""
        k = F.col("c_custkey")
        return self.customer.select(k.alias("branch"), F.col("c_name").alias("title"), F.when(k > 1, F.shiftright(k, 1)).alias("grows_from"))

    def daily_mean(self) -> Column:
        """Mean daily revenue as a scalar subquery."""
        return self.daily.select(F.sum("daily_revenue").cast("double") / F.count(F.lit(1))).scalar()


# The same relations as SQL.
WITH: dict[str, tuple[tuple[str, ...], str]] = {
    "daily": (
        (),
        """SELECT CAST(o_orderdate AS DATE) AS sale_date,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS daily_revenue, COUNT(*) AS num_orders
           FROM orders GROUP BY 1""",
    ),
    "daily_indexed": (
        ("daily",),
        """SELECT *, CAST(daily_revenue AS DOUBLE)
             / (SELECT CAST(SUM(daily_revenue) AS DOUBLE) / COUNT(*) FROM daily) AS revenue_index FROM daily""",
    ),
    "cats": (
        (),
        """SELECT p_type AS category, CAST(COUNT(CASE WHEN p_size >= 35 THEN 1 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS margin_pct
           FROM part GROUP BY 1""",
    ),
    "lines": (
        (),
        """SELECT CAST(l_shipdate AS DATE) AS sale_date, p_type AS category,
             SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS category_revenue
           FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    ),
    "part_sales": (
        (),
        """SELECT l_partkey AS part_id, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount, COUNT(*) AS num_lines
           FROM lineitem GROUP BY 1""",
    ),
    "small_parts": (
        (),
        """SELECT p_partkey, p_name, p_type FROM part WHERE p_size <= 25
           UNION ALL SELECT -p_partkey, p_name || ' (announced)', p_type FROM part WHERE p_size = 1""",
    ),
    "ev": (
        (),
        """SELECT event_id, ts, 'user' || user_id AS username, user_id, event_type AS action, value,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    ),
    "ev_items": (
        ("ev",),
        """SELECT event_id, username, action, i - 1 AS array_position, 'item' || i AS item, floor(value * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) * i / CAST(100 AS DOUBLE) AS price,
             CASE WHEN i > 1 THEN ['t1', 't' || i] END AS tags
           FROM (SELECT *, UNNEST(generate_series(1, k % 4)) AS i FROM ev WHERE action = 'purchase')""",
    ),
    "ev_pages": (
        ("ev",),
        """SELECT event_id, username,
             CASE WHEN k % 2 = 0 THEN ['home', 'cart'] ELSE ['products', 'page' || k, 'cart'] END AS pages
           FROM ev WHERE action = 'view'""",
    ),
    "customer_v2": (
        (),
        """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
             CASE WHEN c_custkey % 7 = 0 THEN 'RENEWED' ELSE c_mktsegment END AS c_mktsegment
           FROM customer WHERE c_custkey % 11 <> 0
           UNION ALL
           SELECT c_custkey + 1000000000000, c_name, c_nationkey, c_acctbal, c_mktsegment
           FROM customer WHERE c_custkey % 13 = 0""",
    ),
    "tree": (
        (),
        """SELECT c_custkey AS branch, c_name AS title, CASE WHEN c_custkey > 1 THEN c_custkey >> 1 END AS grows_from FROM customer""",
    ),
}


def with_sql(names: str, body: str) -> str:
    """``body`` below the named common table expressions and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in WITH[name][0]:
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    if not ordered:
        return body
    head = ",\n".join(f"{n} AS ({WITH[n][1]})" for n in ordered)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def sql_r(expr: str, digits: int = 2) -> str:
    """The rounding rule of ``round_half_up`` in SQL."""
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + CAST(0.5 AS DOUBLE)) / {scale})"


def sql_mean(expr: str) -> str:
    """The average rule of ``mean_of`` in SQL."""
    return f"(CAST(SUM({expr}) AS DOUBLE) / COUNT({expr}))"


def sql_d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


# Three-letter English day name; DuckDB's dayname is the full name.
def sql_dayname(expr: str) -> str:
    return f"left(dayname({expr}), 3)"
