"""Bronze commerce tables projected from the star-schema tables.

The given tables hold no commerce entities, so each entity is a narrow, row-wise projection of one
of them (no shuffle). The projections vary case, padding, formats and missing values on purpose, and
re-deliver some rows in a second batch, so that cleaning and deduplication have real work:

* pending orders, ``AUTOMOBILE`` customers and large parts arrive twice;
* line items repeat (order, line) keys, so payments and shipments hold true duplicates;
* suppliers become customers who never order; a few orders and payments point to missing parents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.tables import StarTables

# The countries served, the carriers, the payment methods and the card brands.
COUNTRIES = ["United States", "Canada", "United Kingdom", "Germany", "France",
             "Italy", "Spain", "Japan", "Netherlands", "Australia"]
CARRIERS = ["UPS", "FedEx", "USPS", "DHL"]
METHODS = ["Credit_Card", "PayPal", "APPLE_PAY", "google_pay"]
BRANDS = ["Visa", "MasterCard", "AMEX", "Discover"]



def _pick(values: list[str], index: str) -> str:
    """The value at ``index`` modulo the list length."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} % {len(values)} + 1 as int))"


def _days(ts: str, n: str | int) -> str:
    return f"timestampadd(DAY, {n}, {ts})"


def _spaced(ts: str) -> str:
    """``yyyy-MM-dd HH:mm:ss``, which is how whole seconds print."""
    return f"cast({ts} as string)"


def _iso(ts: str) -> str:
    return f"replace({_spaced(ts)}, ' ', 'T')"


def _batch_ts(ts: str, version: str) -> str:
    """Yearly batches: rows of a year land together on the first days of the next one."""
    return f"make_timestamp(year({ts}) + 1, 1, {version}, 0, 0, 0)"


def _cents(c: str) -> str:
    return f"cast(cast({c} as decimal(12,2)) * 100 as bigint)"


def _share(money: str, rate: str) -> str:
    return f"cast(round({money} * cast('{rate}' as decimal(3,2)), 2) as decimal(12,2))"


def _audit(system: str, ts: str, load_type: str, hashed: str) -> dict[str, str]:
    return {"_ingestion_ts": ts, "_source_system": f"'{system}'", "_record_hash": f"md5(concat_ws('|', {hashed}))",
            "load_type": load_type, "ingestion_date": f"to_date({ts})"}


LOAD_TYPE = "if(v = 1, 'full', 'incremental')"


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} as `{name}`" for name, expr in columns.items()])


def _versions(df: DataFrame, twice: str) -> DataFrame:
    """Rows delivered twice carry ``v`` 1 and 2 and ``versions`` 2."""
    return (df.selectExpr("*", f"if({twice}, 2, 1) as versions")
            .selectExpr("*", "explode(sequence(1, versions)) as v"))


def _people(t: StarTables) -> DataFrame:
    """Customers and suppliers under one id space: even ids for customers, odd ids for suppliers."""
    buyers = t.read("customer").selectExpr(
        "c_custkey * 2 as id", "c_custkey as seq", "c_name as name", "c_nationkey as nationkey", "c_acctbal as balance",
        "c_mktsegment as seg")
    partners = t.read("supplier").selectExpr(
        "s_suppkey * 2 + 1 as id", "s_suppkey as seq", "s_name as name", "s_nationkey as nationkey", "s_acctbal as balance",
        "'PARTNER' as seg")
    people = buyers.unionByName(partners)
    nation = t.read("nation").select("n_nationkey", "n_name")
    return people.join(nation, people["nationkey"] == nation["n_nationkey"], "left")


def customers(t: StarTables) -> DataFrame:
    df = _versions(_people(t), "seg = 'AUTOMOBILE'").selectExpr(
        "*", "timestampadd(DAY, cast(seq * 13 % 2400 as int), timestamp '1994-06-01') as signup",
        "replace(name, '#', '.') as mailbox")
    return _select(df, {
        "customer_id": "id",
        "first_name": "split_part(name, '#', 1)",
        "last_name": "split_part(name, '#', 2)",
        "email": """case seg when 'HOUSEHOLD' then concat('  ', upper(mailbox), '@Example.COM ') when 'MACHINERY' then null
                    when 'FURNITURE' then name else concat(lower(mailbox), '@example.org') end""",
        "phone": "case when seg = 'MACHINERY' then '  ' when balance < 1000 then null else concat('+1-', seq) end",
        "country": f"if(seg = 'PARTNER', n_name, {_pick(COUNTRIES, 'nationkey')})",
        "city": "concat('City ', nationkey)",
        "state": "concat('S', nationkey % 5)",
        "postal_code": "lpad(cast(seq % 100000 as string), 5, '0')",
        "address": "concat(name, ' Street')",
        "signup_date": "signup", "created_at": "signup",
        "updated_at": _days("signup", "nationkey + v"),
        "customer_segment": """case when v < versions then 'New' when seg in ('AUTOMOBILE', 'BUILDING') then 'VIP'
                               when seg in ('FURNITURE', 'HOUSEHOLD') then 'Regular' else 'New' end""",
        "date_of_birth": "if(seg <> 'BUILDING', date_add(date '1950-01-01', cast(seq * 37 % 25000 as int)), null)",
        "gender": "case nationkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'Other' end",
        **_audit("rds", _batch_ts("signup", "v"), LOAD_TYPE, "id, seg, v"),
    })


def orders(t: StarTables) -> DataFrame:
    df = _versions(t.read("orders"), "o_orderstatus = 'P'").selectExpr(
        "*", "timestampadd(SECOND, cast(o_orderkey % 86400 as int), o_orderdate) as ordered",
        "cast(o_totalprice as decimal(12,2)) as total",
        """case when v < versions then 'PENDING' when o_orderstatus = 'F' then 'DELIVERED' when o_orderstatus = 'P' then 'Shipped'
           when o_orderpriority = '1-URGENT' then 'Processing' when o_orderpriority = '2-HIGH' then 'shipped'
           when o_orderpriority = '3-MEDIUM' then 'Cancelled' when o_orderpriority = '4-NOT SPECIFIED' then 'refunded'
           else 'pending' end as status""",
        """case when v < versions then 'Pending' when o_orderstatus = 'F' and o_orderpriority = '4-NOT SPECIFIED' then 'Refunded'
           when o_orderstatus in ('F', 'P') then 'COMPLETED' when o_orderpriority = '3-MEDIUM' then 'failed'
           when o_orderpriority = '5-LOW' then 'pending' else 'success' end as paid""",
    ).selectExpr("*", "lower(status) in ('shipped', 'delivered', 'refunded') as sent", "lower(paid) <> 'pending' as settled",
                 "cast(o_orderkey * 10 + 1 as decimal(38,0)) as ident")
    return _select(df, {
        "order_id": "o_orderkey",
        "customer_id": "if(total >= 490000, -1 - o_custkey, o_custkey * 2)",
        "order_date": "ordered",
        "payment_date": "if(settled, timestampadd(HOUR, 1, ordered), null)",
        "shipment_date": f"if(sent and o_orderpriority <> '2-HIGH', {_days('ordered', 1)}, null)",
        "delivered_date": f"if(o_orderstatus = 'F' and o_orderpriority <> '1-URGENT', {_days('ordered', 9)}, null)",
        "created_at": "ordered", "updated_at": _days("ordered", "v"),
        "order_status": "status", "payment_status": "paid",
        "subtotal": _share("total", "0.90"), "discount_amount": _share("total", "0.05"), "tax_amount": _share("total", "0.08"),
        "shipping_cost": "cast(o_orderkey % 20 as decimal(12,2))",
        "total_amount": """cast(if(o_orderstatus = 'O' and o_orderpriority = '4-NOT SPECIFIED' and total < 50000, -total, total)
                           as decimal(12,2))""",
        "payment_method": f"if(o_orderstatus = 'P' and o_orderpriority = '5-LOW', null, {_pick(METHODS, 'o_orderkey')})",
        "payment_id": "if(settled, ident, null)",
        "shipping_carrier": f"if(sent, {_pick(CARRIERS, 'o_custkey')}, null)",
        "tracking_number": "if(sent, ident, null)",
        "customer_segment_at_order": "if(o_orderpriority in ('1-URGENT', '2-HIGH'), 'VIP', 'Regular')",
        **_audit("rds", _batch_ts("ordered", "v"), LOAD_TYPE, "o_orderkey, o_orderstatus, o_orderpriority, v"),
    })


def _lines(t: StarTables) -> DataFrame:
    return t.read("lineitem").selectExpr("*", "timestampadd(SECOND, cast(l_partkey % 86400 as int), l_shipdate) as shipped")


def _line_audit() -> dict[str, str]:
    return _audit("api", _batch_ts("shipped", "1"), "'full'",
                  f"l_orderkey, l_linenumber, l_partkey, l_suppkey, {_cents('l_quantity')}, {_cents('l_extendedprice')}, "
                  "cast(to_date(l_shipdate) as string)")


def order_items(t: StarTables) -> DataFrame:
    return _select(_lines(t), {
        "order_item_id": "l_orderkey * 10 + l_linenumber",
        "order_id": "l_orderkey", "product_id": "l_partkey",
        "quantity": "cast(l_quantity as int)", "unit_price": "cast(l_extendedprice as decimal(12,2))",
        "line_total": "cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_quantity as int), 2) as decimal(16,2))",
        "created_at": "shipped",
    })


def payments(t: StarTables) -> DataFrame:
    """Hyphenated names and text dates in two formats, some missing, some junk."""
    return _select(_lines(t), {
        "payment-id": "l_orderkey * 10 + l_linenumber",
        "order-id": "if(l_quantity = 50, -1 - l_orderkey, l_orderkey)",
        "customer-id": "l_suppkey",
        "payment-method": _pick(METHODS, "l_linenumber"),
        "card-brand": f"if(l_linenumber % 4 = 0, {_pick(BRANDS, 'l_partkey')}, null)",
        "card-last-4": "if(l_linenumber % 4 = 0, lpad(cast(l_partkey % 10000 as string), 4, '0'), null)",
        "amount": "l_extendedprice",
        "payment-status": """case when l_returnflag = 'R' then 'Refunded' when l_returnflag = 'A' then 'COMPLETED'
                             when l_linestatus = 'F' then 'failed' else 'Pending' end""",
        "payment-date": f"""case when l_linenumber <= 3 then {_spaced('shipped')}
                            when l_linenumber <= 5 then {_iso('shipped')} when l_linenumber = 7 then '10:00:00' end""",
        "created-at": _spaced("shipped"),
        "updated-at": _iso(_days("shipped", 1)),
        **_line_audit(),
    })


def shipments(t: StarTables) -> DataFrame:
    return _select(_lines(t), {
        "tracking_number": "l_orderkey * 10 + l_linenumber",
        "tracking_code": "concat('TRK', l_orderkey * 10 + l_linenumber)",
        "order_id": "if(l_quantity = 49, -1 - l_orderkey, l_orderkey)",
        "shipping_carrier": _pick(CARRIERS, "l_linenumber"),
        "origin_country": "'United States'",
        "destination_country": _pick(COUNTRIES, "l_suppkey"),
        "destination_postal_code": "lpad(cast(l_suppkey % 100000 as string), 5, '0')",
        "status": """case when l_linestatus = 'F' then 'Delivered' when l_returnflag = 'R' then 'RETURNED'
                     when l_returnflag = 'A' then 'In_Transit' when l_linenumber = 7 then 'lost' else 'exception' end""",
        "shipping_cost": "l_tax * 100",
        "shipment-date": f"if(l_linenumber <> 5, {_spaced('shipped')}, null)",
        "estimated-delivery-date": _iso(_days("shipped", 5)),
        "actual-delivery-date": f"""case when l_quantity = 13 then 'soon'
                                    when l_linestatus = 'F' then {_spaced(_days('shipped', 4))} end""",
        "created-at": _spaced("shipped"),
        "updated-at": _iso(_days("shipped", 2)),
        **_line_audit(),
    })


def products(t: StarTables) -> DataFrame:
    df = _versions(t.read("part"), "p_size > 40").selectExpr(
        "*", "cast(p_retailprice as decimal(10,2)) as price",
        "timestampadd(DAY, cast(p_partkey % 2500 as int), timestamp '1994-01-01') as created")
    return _select(df, {
        "product_id": "p_partkey",
        "product_name": "concat('  ', p_name, ' ')",
        "category": "concat(p_type, ' ')",
        "sub_category": "concat(' ', upper(split_part(p_name, ' ', 2)))",
        "brand": "concat(' ', p_brand)",
        "price": "cast(if(v < versions, price + 1, price) as decimal(10,2))",
        "cost": "cast(round(price * cast('0.60' as decimal(3,2)), 2) as decimal(10,2))",
        "created_at": "created",
        "color": "concat(upper(split_part(p_name, ' ', 1)), ' ')",
        **_audit("rds", _batch_ts("created", "v"), LOAD_TYPE, "p_partkey, p_brand, v"),
    })


ENTITIES = {"customers": customers, "orders": orders, "order_items": order_items,
            "payments": payments, "shipments": shipments, "products": products}


class Lake:
    """Star tables plus the bronze entities built from them."""

    def __init__(self, spark, folder: str):
        self.spark, self.star = spark, StarTables(spark, folder)

    def table(self, name: str) -> DataFrame:
        return self.star.read(name)

    def bronze(self, entity: str) -> DataFrame:
        return ENTITIES[entity](self.star)
