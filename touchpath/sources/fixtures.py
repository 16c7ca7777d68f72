"""Input tables in the library's shape, derived from the given sales tables.

Every expression here has a plain SQL twin in ``touchpath.plans.oracle``; the
derivations read whole tables.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.functions.columns import padded, record_id_18
from touchpath.settings import ACTIVITY_TYPES, Settings

SETTINGS = Settings(
    as_of=dt.date(2001, 11, 4),
    year_floor=dt.date(1996, 1, 1),
    feature_floor=dt.date(1997, 12, 31),
    training_floor=dt.date(1998, 12, 31),
    score_floor=dt.date(2000, 3, 1),
    personnel_floor=dt.date(1997, 12, 31),
)

RAW_TYPES = tuple(name.replace(".", " ") for name in ACTIVITY_TYPES)
DETAILS = ("KIT", "PRO", "PR", "education-center", "webinars", "our-funds")
TASK_TYPES = {"VoiceMail": "Left Voicemail/Message with Assistant"}


@lru_cache(maxsize=256)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; its footer is read once per session."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def moved(key: str, modulus: int) -> Column:
    """Key with the multiples of ``modulus`` moved up by one, so that those stay without rows."""
    return F.col(key) + F.when(F.col(key) % modulus == 0, 1).otherwise(0)


def _customer_name(key: Column) -> Column:
    return F.concat(F.lit("Customer#"), padded(key.cast("string"), 9))


def _raw_type() -> Column:
    names = F.array(*[F.lit(name) for name in RAW_TYPES])
    kind = (F.col("l_partkey") % 32).cast("int")
    return (
        F.when(F.col("l_suppkey") % 29 == 0, "To-Do")
        .when(kind >= len(RAW_TYPES), "Sale")
        .otherwise(F.element_at(names, F.least(kind, F.lit(len(RAW_TYPES) - 1)) + 1))
    )


def _order_in_log() -> Column:
    """Unique sortable text per activity of a contact."""
    parts = (("l_orderkey", 13), ("l_linenumber", 1), ("l_partkey", 11), ("l_suppkey", 10))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws(
        "-",
        *[padded(F.col(name).cast("string"), width) for name, width in parts],
        padded(cents.cast("string"), 12),
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """The activity log without the demographics that ``people`` holds."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    details = F.array(*[F.lit(name) for name in DETAILS], F.lit(None), F.lit(None))
    link = F.when(F.col("l_orderkey") % 11 == 0, "https://www.example.com/learn/a").when(
        F.col("l_orderkey") % 11 == 1, "https://www.example.com/investments/b"
    )
    fund = F.when(F.col("l_partkey") % 7 == 0, "").otherwise(F.concat(F.lit("F"), F.col("l_partkey") % 7))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        moved("o_custkey", 10).alias("contact_id"),
        _customer_name(moved("o_custkey", 10)).alias("contact_name"),
        _raw_type().alias("activity_type"),
        F.col("l_shipdate").cast("date").alias("activity_date"),
        _order_in_log().alias("seq"),
        F.when(_raw_type() == "Sale", (F.col("l_extendedprice").cast("decimal(18,2)") * 4).cast("decimal(18,2)")).alias(
            "sales_amount"
        ),
        fund.alias("fund_code"),
        F.element_at(details, (F.col("l_suppkey") % 8 + 1).cast("int")).alias("additional_detail"),
        link.alias("link"),
        _order_in_log().alias("event_id"),
    )


def log_rows(spark: SparkSession, folder: str) -> int:
    """About how many rows the activity log has, from the footers of its table."""
    return table(spark, folder, "lineitem").count()


def raw_activity(spark: SparkSession, folder: str) -> DataFrame:
    """The log as untrusted text: dates in several forms, types in any case, and rows that cannot be read."""
    log = activity(spark, folder)
    contact, day, kind = F.col("contact_id"), F.col("activity_date"), F.col("activity_type")
    of_month, iso = F.dayofmonth(day), day.cast("string")
    form = (contact + F.dayofyear(day)) % 9
    date_text = (
        F.when(form == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(form == 1, F.date_format(day, "yyyyMMdd"))
        .when(form == 2, F.concat(iso, F.lit(" 10:20:30")))
        .when(form == 3, "soon")
        .when(form == 4, "2001-02-30")
        .when(form == 5, F.when(of_month % 2 == 0, "  "))
        .otherwise(iso)
    )
    spelling = (contact + F.month(day)) % 8
    type_text = (
        F.when(spelling == 0, F.upper(kind))
        .when(spelling == 1, F.lower(kind))
        .when(spelling == 2, F.concat(F.lit("  "), F.translate(kind, " ", "."), F.lit(" ")))
        .when(spelling == 3, "Unheard Of")
        .when(spelling == 4, F.lit(None))
        .otherwise(kind)
    )
    contact_text = F.when(of_month % 11 == 0, F.concat(F.lit("x"), contact)).when(of_month % 13 == 0, F.lit(None))
    return log.select(
        contact_text.otherwise(contact.cast("string")).alias("contact_text"),
        type_text.alias("type_text"),
        date_text.alias("date_text"),
        "seq",
    )


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Demographics, which belong on every row of the activity log."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("contact_id"),
        F.col("c_acctbal").alias("gdc"),
        (F.col("c_acctbal") * 100).alias("aum"),
        F.when(key % 7 != 0, (key % 50) / 50.0 - 0.1).alias("x_to_advisory"),
        F.when(key % 9 != 0, (key % 40) / 50.0 - 0.1).alias("x_to_alternatives"),
        (key % 80 - 5).cast("double").alias("age"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Broker Dealer").otherwise(F.col("c_mktsegment")).alias(
            "advisor_type"
        ),
    )


def _record_id_15(key: Column) -> Column:
    return F.translate(F.lpad(key.cast("string"), 15, "0"), "0123456789", "aBcDeFgHiJ")


def contact(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    sold = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.date_add(F.min("o_orderdate").cast("date"), 60).alias("first_sale"))
    )
    rated = F.element_at(F.array(F.lit("O"), F.lit("X"), F.lit(None), *[F.lit("A")] * 3), (key % 6 + 1).cast("int"))
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, folder, "customer")
        .join(sold, key == F.col("o_custkey"), "left")
        .join(nations, "c_nationkey", "left")
        .select(
            key.alias("contact_id"),
            F.col("c_name").alias("contact_name"),
            F.date_add(F.lit(dt.date(1995, 1, 1)), (key % 900).cast("int")).alias("created_date"),
            F.col("c_mktsegment").alias("contact_type"),
            F.when(key % 4 != 1, F.col("first_sale")).alias("first_sale_date_all"),
            F.when(key % 4 != 0, F.col("first_sale")).alias("first_sale_date_new"),
            rated.alias("rating"),
            F.when(key % 3 != 0, "y").otherwise("n").alias("approved"),
            F.when(key % 5 == 0, "Multi").otherwise("Single").alias("registration"),
            F.when(key % 17 != 0, (key % 13 * 5).cast("double")).alias("score_7_days_ago"),
            F.when(key % 19 == 0, "HOUSE").otherwise("A").alias("account_name"),
            F.when(key % 23 != 0, F.col("n_name")).alias("territory"),
            record_id_18(_record_id_15(key)).alias("record_id"),
        )
    )


def fund_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("F1", "FX"), ("F3", "FX"), ("F5", "F5")], "fund_code string, single_fund_code string"
    )


def score_history(spark: SparkSession, folder: str) -> DataFrame:
    """One score per contact and order day, from the largest order key."""
    return (
        table(spark, folder, "orders")
        .groupBy(moved("o_custkey", 13).alias("contact_id"), F.col("o_orderdate").cast("date").alias("process_date"))
        .agg((F.max("o_orderkey") % 101 / 100.0).alias("score"))
    )


def web_tracking(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.lit("content-"), F.regexp_extract("props", "([0-9]+)", 1))
    return table(spark, folder, "events").select(
        _record_id_15(F.col("user_id")).alias("contact_id_15"),
        F.col("user_id").cast("string").alias("visitor_key"),
        F.lpad(F.col("event_id").cast("string"), 15, "0").alias("session_key"),
        F.col("ts").alias("session_start_ts"),
        name.alias("event_name"),
        F.concat(F.lit("https://www.example.com/c/"), name).alias("event_url"),
        F.lit("example").alias("site_name"),
        F.lit("https://www.example.com").alias("site_url"),
        F.col("ts").alias("event_ts"),
    )


def content_catalog(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.lit("content-"), F.col("item_id"))
    return table(spark, folder, "benchmark").select(
        name.alias("event_name"),
        F.concat(F.lit("https://www.example.com/c/"), name).alias("event_url"),
        F.when(F.col("item_id") % 3 == 0, 0).otherwise(1).alias("level"),
    )


def old_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier recommendations: each order recommended one of forty items on its day."""
    item = F.concat(F.lit("content-"), F.col("o_orderkey") % 40)
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("contact_id"), item.alias("sku_next_content"))
        .agg(F.min("o_orderdate").cast("date").alias("recommendation_date"))
        .select(
            "contact_id",
            _customer_name(F.col("contact_id")).alias("contact_name"),
            F.lit("Level1").alias("engagement_level"),
            "sku_next_content",
            F.concat(F.lit("https://www.example.com/c/"), F.col("sku_next_content")).alias("url_next_content"),
            "recommendation_date",
        )
    )


def user(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("user_id"),
        F.col("s_name").alias("user_name"),
        F.when(F.col("s_suppkey") % 5 == 0, "False").otherwise("True").alias("is_active"),
    )


def territory(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("territory_name"),
        key.alias("internal_wholesaler"),
        F.when(key % 6 == 0, key).otherwise(key + 5).alias("sales_associate"),
    )


def task(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    profiles = F.array(*[F.lit(name) for name in (*SETTINGS.profiles, "Other")])
    kind = _raw_type()
    for plain, copy in TASK_TYPES.items():
        kind = F.when(kind == plain, copy).otherwise(kind)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        moved("o_custkey", 10).alias("who_id"),
        F.col("l_suppkey").alias("owner_id"),
        F.col("l_shipdate").cast("date").alias("activity_date"),
        kind.alias("activity_type"),
        F.element_at(profiles, F.col("l_linenumber") % 5 + 1).alias("profile"),
        F.when(F.col("l_quantity") >= 5, F.col("l_shipdate")).alias("completed_at"),
    )


def event(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        (F.col("o_orderkey") % 10).alias("owner_id"),
        F.col("o_orderdate").cast("date").alias("activity_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Meeting").otherwise("Call").alias("event_type"),
    )


def event_relation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), moved("o_custkey", 10).alias("contact_id")
    )


def dense_events(spark: SparkSession, folder: str) -> DataFrame:
    """Web events as an activity log with many rows per contact and day."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("contact_id"),
        F.col("event_type").alias("activity_type"),
        F.col("ts").cast("date").alias("activity_date"),
        F.lit(1).alias("branch"),
        F.lpad(F.col("event_id").cast("string"), 15, "0").alias("seq"),
        F.col("event_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
