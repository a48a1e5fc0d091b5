"""Builds all silver and gold tables from the landed folders, incrementally and in dependency order.

The silver tables, the facts and the customers' profiles are versioned tables (:mod:`tidemark.sinks.versioned`). Each says in its properties how far
it has read its sources: silver the newest landed timestamp, the others the versions of the tables they are built from. Rows and marks
change in one step, so a run that stops anywhere is simply repeated by the next. What happened in a source since that version is
read from its list of changes, rows before and after, so nothing that a row has left behind is forgotten: the order a payment was moved away from,
the day an order no longer belongs to, the customer who lost one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.operators.filters import instant, newest
from tidemark.plans import gold, silver
from tidemark.session import staged
from tidemark.sinks import versioned
from tidemark.sinks.incremental import replace_files
from tidemark.sources.extract import read_landed

ENTITIES = ["customers", "orders", "payments", "products", "shipments"]
FACT_SOURCES = ["orders", "payments", "shipments"]
# What the tables built on a table read of its changes; these lists are as long as the batch, before and after.
LISTED = {"stg_customers": ["customer_id"], "stg_orders": ["order_id"], "stg_payments": ["order_id"], "stg_products": ["product_id"], "stg_shipments": ["order_id"],
          "order_facts": ["customer_id", "payment_method", "shipping_carrier", "order_date", "total_amount", "order_date_partition"],
          "profile_parts": ["customer_id"], "customer_profiles": ["customer_id"]}
PROFILE_FOLDERS = 16  # of the profiles, by a hash of the customer


def refresh_silver(spark: SparkSession, bronze_root: str, warehouse: str, as_of: Column | None = None) -> dict[str, DataFrame]:
    """Merges what arrived since the last refresh; one row per key, also over several batches.

    Landing folders older than the newest row read so far are not read, and of the table itself only what may hold a new key.
    """
    tables = {}
    for entity in ENTITIES:
        name, path = f"stg_{entity}", f"{warehouse}/stg_{entity}"
        landed, at = read_landed(spark, bronze_root, entity), versioned.current(spark, path)
        if at is not None:
            mark = instant(at.properties["newest"])
            landed = landed.where((F.col("_ingestion_ts") > mark) & (F.col("ingestion_date") >= F.to_date(mark)))
        built = silver.stg_customers(landed, as_of) if entity == "customers" else silver.STAGING[entity](landed)
        versioned.merge(built, path, [checks.KEYS[name]], ["ingestion_date"], listed=LISTED[name],
                        properties=lambda new: {"newest": newest(new, "_ingestion_ts")})
        tables[name] = versioned.read(spark, path)
    return tables


def _versions(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    return {name: versioned.current(spark, path).number for name, path in paths.items()}


def refresh_order_facts(spark: SparkSession, warehouse: str, grain: str = "day") -> DataFrame:
    """Rebuilds the facts of the orders that are new or changed, or won or lost a payment or shipment.

    ``grain`` sets the width of a partition; choose month or year where a day holds too few orders for a file.
    """
    path, paths = f"{warehouse}/order_facts", {e: f"{warehouse}/stg_{e}" for e in FACT_SOURCES}
    at, seen = versioned.current(spark, path), _versions(spark, paths)
    if at is not None and at.properties["sources"] == seen:
        return versioned.read(spark, path)
    changed = [versioned.changes(spark, paths[e], at.properties["sources"][e]) if at else None for e in FACT_SOURCES]
    day = F.to_date(F.date_trunc(grain, "order_date"))
    if any(c is None for c in changed):
        facts = gold.order_facts(*[versioned.read(spark, p) for p in paths.values()]).withColumn("order_date_partition", day)
        versioned.replace(facts, path, ["order_id"], ["order_date_partition"], {"sources": seen})
        return versioned.read(spark, path)
    touched = reduce(DataFrame.unionAll, [c.select("order_id") for c in changed]).where("order_id is not null").distinct()
    with staged(touched, "touched") as orders:
        own = [versioned.rows_of(spark, paths["orders"], orders), *[versioned.read(spark, paths[e]).join(orders, "order_id", "left_semi") for e in FACT_SOURCES[1:]]]
        versioned.merge(gold.order_facts(*own).withColumn("order_date_partition", day), path, ["order_id"], ["order_date_partition"], properties={"sources": seen},
                        listed=LISTED["order_facts"])
    return versioned.read(spark, path)


def refresh_daily(spark: SparkSession, warehouse: str, as_of: Column | None = None) -> DataFrame:
    """Daily figures of the days that orders came to or left, and of the last days; the others stay. One row per day."""
    path, facts_path = f"{warehouse}/daily_metrics", f"{warehouse}/order_facts"
    at, facts, seen = versioned.current(spark, path), versioned.read(spark, facts_path), versioned.current(spark, facts_path).number
    images = versioned.changes(spark, facts_path, at.properties["facts"]) if at else None
    if images is None:
        versioned.replace(gold.daily_metrics(facts), path, ["day"], properties={"facts": seen})
        return versioned.read(spark, path)
    day = F.to_date("order_date")
    recent = gold.recent_days(facts, as_of).select(day.alias("_day"), "order_date_partition")
    days = images.select(day.alias("_day"), "order_date_partition").unionAll(recent).where("_day is not null").distinct()
    with staged(days, "days") as changed:
        again = facts.join(changed.withColumnRenamed("order_date_partition", "_part"), (day == F.col("_day")) & (F.col("order_date_partition") == F.col("_part")), "left_semi")
        old = versioned.read(spark, path)
        kept = old.join(changed, old["day"] == changed["_day"], "left_anti")
        versioned.replace(kept.unionByName(gold.daily_metrics(again)), path, ["day"], properties={"facts": seen})
    return versioned.read(spark, path)


def _folder() -> Column:
    return F.pmod(F.xxhash64("customer_id"), F.lit(PROFILE_FOLDERS)).cast("int").alias("folder")


PART_KEYS = ["customer_id", "level", "value"]


def refresh_profile_parts(spark: SparkSession, warehouse: str) -> None:
    """Counts per customer, payment method and carrier from what changed in the facts.

    Orders that are the same before and after, as far as profiles go, cancel. Customers who only won orders get theirs added; those who lost one
    are counted again from the facts, as no sum tells the next to first date. A part that lost all its orders stays with no uses.
    """
    path, facts_path = f"{warehouse}/profile_parts", f"{warehouse}/order_facts"
    at, seen = versioned.current(spark, path), versioned.current(spark, facts_path).number
    if at is not None and at.properties["facts"] == seen:
        return
    images = versioned.changes(spark, facts_path, at.properties["facts"]) if at else None
    if images is None:
        parts = gold.profile_parts(versioned.read(spark, facts_path))
        versioned.replace(parts.select("*", _folder()), path, PART_KEYS, ["folder"], {"facts": seen})
        return
    grain = ["customer_id", "payment_method", "shipping_carrier", "order_date", "total_amount"]
    sign = F.when(F.col(versioned.CHANGE) == "after", 1).otherwise(-1)
    net = images.groupBy(*grain).agg(F.sum(sign).alias("orders")).where("orders != 0")
    with staged(net, "net") as moved, staged(moved.where("orders < 0").select("customer_id").distinct(), "lost") as lost:
        facts, old = versioned.read(spark, facts_path), versioned.rows_of(spark, path, moved.select("customer_id").distinct()).drop("folder")
        gained = gold.profile_parts(moved.join(lost, moved["customer_id"].eqNullSafe(lost["customer_id"]), "left_anti"), F.col("orders"))
        again = gold.profile_parts(facts.join(lost, facts["customer_id"].eqNullSafe(lost["customer_id"]), "left_semi"))
        rows = _added_up(old, lost, gained.unionByName(again))
        versioned.merge(rows.select("*", _folder()), path, PART_KEYS, ["folder"], properties={"facts": seen}, listed=LISTED["profile_parts"])


def _added_up(old: DataFrame, lost: DataFrame, counted: DataFrame) -> DataFrame:
    """Parts that change: what was counted, added to the old ones; those of customers who lost an order start from no uses."""
    names = lost.select(F.col("customer_id").alias("_name"), F.lit(True).alias("_changes"))
    known = old.join(names, old["customer_id"].eqNullSafe(names["_name"]), "left").drop("_name")
    started = known.select(*PART_KEYS, *[F.when(F.col("_changes"), F.lit(0 if f.name == "uses" else None)).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
                                         for f in old.schema.fields if f.name not in PART_KEYS], F.coalesce("_changes", F.lit(False)).alias("_changes"))
    summed = started.unionByName(counted.withColumn("_changes", F.lit(True))).groupBy(*PART_KEYS).agg(
        F.min("first_use").alias("first_use"), F.max("latest_use").alias("latest_use"), F.sum("uses").alias("uses"),
        F.sum("amount").cast(old.schema["amount"].dataType).alias("amount"), F.bool_or("_changes").alias("_changes"))
    return summed.where("_changes").drop("_changes")


def refresh_profiles(spark: SparkSession, warehouse: str) -> DataFrame:
    """One row per customer with orders, folded anew from their parts where those changed."""
    path, parts_path = f"{warehouse}/customer_profiles", f"{warehouse}/profile_parts"
    at, seen = versioned.current(spark, path), versioned.current(spark, parts_path).number
    images = versioned.changes(spark, parts_path, at.properties["parts"]) if at else None
    if images is None:
        folded = gold.fold_profiles(versioned.read(spark, parts_path))
        versioned.replace(folded.select("*", _folder()), path, ["customer_id"], ["folder"], {"parts": seen})
    elif at.properties["parts"] != seen:
        with staged(images.select("customer_id").distinct(), "customers") as customers:
            folded = gold.fold_profiles(versioned.rows_of(spark, parts_path, customers))
            versioned.merge(folded.select("*", _folder()), path, ["customer_id"], ["folder"], properties={"parts": seen}, listed=LISTED["customer_profiles"])
    return versioned.read(spark, path).drop("folder")


def refresh_gold(spark: SparkSession, silver_tables: dict[str, DataFrame], warehouse: str, as_of: Column | None = None,
                 grain: str = "day") -> dict[str, DataFrame]:
    """Facts by order, daily figures by day, profiles by customer; what depends on the day of the run is written whole from those."""
    tables = {"order_facts": refresh_order_facts(spark, warehouse, grain)}
    tables["daily_metrics"] = refresh_daily(spark, warehouse, as_of)
    refresh_profile_parts(spark, warehouse)
    profiles = refresh_profiles(spark, warehouse)

    def replace(name: str, df: DataFrame) -> None:
        replace_files(df, f"{warehouse}/{name}")
        tables[name] = spark.read.parquet(f"{warehouse}/{name}")
    replace("customer_360", gold.customer_profiles(silver_tables["stg_customers"], profiles, as_of))
    replace("rfm_scores", gold.rfm_scores(tables["customer_360"]))
    source, seen = f"{warehouse}/product_catalog", versioned.current(spark, f"{warehouse}/stg_products").number
    at = versioned.current(spark, source)
    if at is None or at.properties["products"] != seen:
        versioned.replace(gold.product_catalog(silver_tables["stg_products"]), source, ["product_id"], properties={"products": seen})
    tables["product_catalog"] = versioned.read(spark, source)
    return tables


def refresh(spark: SparkSession, bronze_root: str, warehouse: str, as_of: Column | None = None,
            grain: str = "day") -> dict[str, DataFrame]:
    """All ten tables; run :func:`tidemark.operators.checks.run_checks` on the result."""
    tables = refresh_silver(spark, bronze_root, warehouse, as_of)
    return {**tables, **refresh_gold(spark, tables, warehouse, as_of, grain)}
