"""One entry per operator: a Spark query over the given tables and its SQL twin."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartwright import schemas, sinks, sources
from cartwright.functions import money, nested, serialize, text, time
from cartwright.operators import analytics as A
from cartwright.operators import enrich as E
from cartwright.operators import gate
from cartwright.operators import generate as G
from cartwright.operators import items as I
from cartwright.operators import keys as K
from cartwright.operators import store as S
from cartwright.plans import jobs
from cartwright.session import scratch_path

from . import oracle as O
from . import views as V
from .views import AS_OF, SEED

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = O.sql(oracle)
        return fn

    return register


# ---- composed pipelines ---------------------------------------------------------


@query("c1_enrich_orders", f"SELECT {O.ENRICHED_COLUMNS} FROM v_enriched")
def _(spark, d):
    return V.enriched(spark, d)


@query("c1_enrich_carts", f"SELECT {O.ENRICHED_COLUMNS} FROM g_enriched")
def _(spark, d):
    return E.enrich_orders(V.generated_carts(spark, d), V.generated_users(spark, d), AS_OF)


@query("c2_order_analytics", f"SELECT {O.ORDER_COLUMNS} FROM v_order_table")
def _(spark, d):
    return V.order_table(spark, d)


@query("c3_customer_analytics", f"SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table")
def _(spark, d):
    return V.customer_table(spark, d)


@query("c3_customers_from_enriched", f"SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table")
def _(spark, d):
    return A.build_customer_analytics(V.enriched(spark, d), AS_OF)


def _landed_config(spark, d) -> jobs.JobConfig:
    """Seed users landed as JSON in a fresh shared folder; as many orders as given."""
    root = scratch_path(spark, "run")
    sinks.write_raw_json(V.seed_users(spark, d), f"{root}/raw/users")
    return jobs.JobConfig(
        root=root,
        as_of=AS_OF,
        n_orders=V.table(spark, d, "orders").count(),
        seed=SEED,
        seed_as_lines=True,
        namespace=root.rpartition("/")[2].replace("-", "_"),
    )


def _one_row(spark, result: dict) -> DataFrame:
    return spark.createDataFrame(
        [tuple(result.values())], ", ".join(f"{k} bigint" for k in result)
    )


_N_ORDERS = "(SELECT count(*) FROM orders)"
_N_USERS = "(SELECT least((SELECT count(*) FROM customer), (SELECT count(*) FROM orders)))"
_FIGURES = f"""{_N_USERS} AS customer_rows, {_N_USERS} AS unique_customers,
    {_N_ORDERS} AS order_rows, 0::bigint AS skipped_orders"""


@query(
    "c4_warehouse_run",
    f"""SELECT {_FIGURES},
    {_N_USERS} + {_N_ORDERS} AS items_total, {_N_USERS} + {_N_ORDERS} AS items_written,
    0::bigint AS items_failed""",
)
def _(spark, d):
    return _one_row(spark, jobs.run_warehouse(spark, _landed_config(spark, d)))


@query("c4_warehouse_customers", f"SELECT {O.CUSTOMER_COLUMNS} FROM r_customer_table")
def _(spark, d):
    cfg = _landed_config(spark, d)
    jobs.run_warehouse(spark, cfg)
    return spark.table(cfg.table("customer_analytics"))


@query("c4_warehouse_orders", f"SELECT {O.ORDER_COLUMNS} FROM r_order_table")
def _(spark, d):
    cfg = _landed_config(spark, d)
    jobs.run_warehouse(spark, cfg)
    return spark.table(cfg.table("order_analytics"))


@query(
    "c5_serving_run",
    f"""SELECT {_FIGURES}, 0::bigint AS broken_documents,
    {_N_USERS} AS customers_created, 0::bigint AS customers_updated, {_N_ORDERS} AS orders_created,
    0::bigint AS orders_updated, {_N_USERS} AS customer_docs, {_N_ORDERS} AS order_docs""",
)
def _(spark, d):
    return _one_row(spark, jobs.run_serving(spark, _landed_config(spark, d)))


@query(
    "c5_serving_again",
    f"""SELECT {O.CUSTOMER_COLUMNS}, TIMESTAMP '1998-01-01' AS created_at,
    cast({O.DAY} as timestamp) AS updated_at, 0::bigint AS created,
    {_N_USERS} AS updated FROM r_customer_table""",
)
def _(spark, d):
    """The store after a run on an earlier day and one as of now: all rows are replaced."""
    cfg = _landed_config(spark, d)
    jobs.run_serving(spark, dataclasses.replace(cfg, as_of="1998-01-01"))
    again = jobs.run_serving(spark, cfg)
    return (
        spark.table(cfg.table("customer_store"))
        .drop("_bucket")
        .withColumn("created", F.lit(again["customers_created"]).cast("bigint"))
        .withColumn("updated", F.lit(again["customers_updated"]).cast("bigint"))
    )


@query(
    "c6_isolated_run",
    f"""SELECT 'warehouse' AS branch, true AS done, {_N_USERS} AS customer_rows,
    {_N_ORDERS} AS order_rows
    UNION ALL SELECT 'serving', false, NULL, NULL""",
)
def _(spark, d):
    """The serving branch finds a table that is not its own and fails; the other goes on."""
    cfg = _landed_config(spark, d)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {cfg.namespace}")
    V.user_ids(spark, d).write.saveAsTable(cfg.table("order_batch"))
    try:
        results, failed = jobs.run(spark, cfg), {}
    except jobs.RunError as error:
        results, failed = error.results, error.errors
    rows = [(b, True, r["customer_rows"], r["order_rows"]) for b, r in results.items()]
    rows += [(b, False, None, None) for b in failed]
    return spark.createDataFrame(
        rows, "branch string, done boolean, customer_rows bigint, order_rows bigint"
    )


# ---- sources ---------------------------------------------------------------------

_G_LINES = """SELECT order_id, product_id, title, category, price_c / 100.0::double AS price,
    quantity, cast(pct as double) AS discount_percentage FROM g_lines"""


def _flat_products(carts: DataFrame) -> DataFrame:
    return E.explode_products(carts).select(
        F.col("orderId").alias("order_id"),
        F.col("id").alias("product_id"),
        "title",
        "category",
        "price",
        "quantity",
        F.col("discountPercentage").alias("discount_percentage"),
    )


@query("s1_read_carts", _G_LINES)
def _(spark, d):
    path = sinks.write_raw_json(V.generated_carts(spark, d), scratch_path(spark, "carts"))
    return _flat_products(sources.read_carts(spark, path, lines=True))


@query(
    "s1_read_users",
    "SELECT id, first_name, last_name, raw_email AS email, raw_city AS city FROM v_raw_users",
)
def _(spark, d):
    path = sinks.write_raw_json(V.users(spark, d), scratch_path(spark, "users"))
    return sources.read_users(spark, path, lines=True).select(
        "id",
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "email",
        F.col("address.city").alias("city"),
    )


_BROKEN_DOC = """'{"id": ' || c_custkey || ', "firstName": '"""


@query(
    "s1_broken_documents",
    f"""SELECT c_custkey AS id, NULL AS document, n, broken FROM customer, counts
    WHERE c_custkey % 50 <> 0
    UNION ALL SELECT NULL, {_BROKEN_DOC}, n, broken FROM customer, counts
    WHERE c_custkey % 50 = 0""".replace(
        "FROM customer, counts",
        """FROM customer, (SELECT count(*) AS n, count(*) FILTER (c_custkey % 50 = 0) AS broken
        FROM customer) counts""",
    ),
)
def _(spark, d):
    """Every 50th landed document stops in the middle."""
    key = F.col("id")
    cut = F.concat(F.lit('{"id": '), key.cast("string"), F.lit(', "firstName": '))
    texts = V.users(spark, d).select(
        F.when(key % 50 == 0, cut).otherwise(F.to_json(F.struct("*"))).alias("value")
    )
    path = scratch_path(spark, "landed")
    texts.write.text(path)
    landed = sources.read_landed(spark, path, schemas.USER)
    sound = scratch_path(spark, "sound")
    landed.documents.write.parquet(sound)
    seen = landed.seen.get
    ids = spark.read.parquet(sound).select("id", F.lit(None).cast("string").alias("document"))
    return ids.unionByName(landed.broken, allowMissingColumns=True).select(
        "id",
        "document",
        F.lit(seen["rows"]).cast("bigint").alias("n"),
        F.lit(seen["broken"]).cast("bigint").alias("broken"),
    )


@query(
    "s2_load_seed",
    """SELECT id, first_name, last_name, email, created_at, 0::bigint AS landed_carts FROM g_seed""",
)
def _(spark, d):
    """Users landed, carts did not: their folder is missing."""
    path = sinks.write_raw_json(V.seed_users(spark, d), scratch_path(spark, "seed"))
    carts, users = sources.load_seed(spark, scratch_path(spark, "never-landed"), path, lines=True)
    n_carts = carts.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _user_rows(users).drop("city").withColumn("landed_carts", n_carts)


@query(
    "s3_unwrap_envelope",
    """SELECT id, user_id, order_id, payment_method,
    (SELECT count(*) FROM g_lines l WHERE l.order_id = o.order_id)::integer AS n_products
    FROM g_orders o""",
)
def _(spark, d):
    """Documents ``{"carts": [...], "total": n}`` of up to a hundred carts each."""
    carts = V.generated_carts(spark, d)
    page = F.call_function("div", F.col("id"), F.lit(100))
    envelopes = carts.groupBy(page.alias("page")).agg(
        F.collect_list(F.struct(*schemas.CART.fieldNames())).alias("carts"),
        F.count(F.lit(1)).alias("total"),
    )
    path = sinks.write_raw_json(envelopes.drop("page"), scratch_path(spark, "envelopes"))
    shape = T.StructType().add("carts", T.ArrayType(schemas.CART)).add("total", T.LongType())
    return sources.unwrap_envelope(spark.read.schema(shape).json(path), "carts").select(
        "id",
        F.col("userId").alias("user_id"),
        F.col("orderId").alias("order_id"),
        F.col("paymentMethod").alias("payment_method"),
        F.size("products").alias("n_products"),
    )


@query(
    "s4_order_ids",
    "SELECT cast(row_number() OVER () as bigint) AS id FROM orders",
)
def _(spark, d):
    return sources.order_ids(spark, V.table(spark, d, "orders").count())


def _published(spark, df: DataFrame, label: str) -> str:
    root = scratch_path(spark, "tables")
    name = f"{label}_{root.rpartition('-')[2]}"
    sinks.publish_table(df, name, root)
    return name


@query("s6_read_table", f"SELECT {O.ORDER_COLUMNS} FROM v_order_table")
def _(spark, d):
    return sources.read_table(spark, _published(spark, V.order_table(spark, d), "orders"))


@query(
    "s7_sql_query",
    """SELECT payment_method, sum(final_amount)::decimal(24,2) AS revenue, count(*) AS total_orders
    FROM v_order_table GROUP BY payment_method""",
)
def _(spark, d):
    sources.register_views(V.customer_table(spark, d), V.order_table(spark, d))
    return spark.sql(
        "SELECT payment_method, sum(final_amount) AS revenue, count(*) AS total_orders "
        "FROM order_analytics GROUP BY payment_method"
    )


@query(
    "s7_sql_sample",
    f"SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table ORDER BY customer_id LIMIT 10",
)
def _(spark, d):
    sources.register_views(V.customer_table(spark, d), V.order_table(spark, d))
    return spark.sql("SELECT * FROM customer_analytics ORDER BY customer_id LIMIT 10")


def _kv_items(spark, d) -> DataFrame:
    """Items of both tables; the customers come from the stored orders, as in the job."""
    orders = spark.table(_published(spark, V.order_table(spark, d), "orders"))
    return I.to_kv_items(A.customers_from_orders(orders, V.users(spark, d), AS_OF), orders)


_ALL_IDS = """SELECT 'customer#' || customer_id AS record_id, {v} AS written FROM v_customer_table
    UNION ALL SELECT 'order#' || order_id, {v} FROM v_order_table"""


@query("s8_load_write_status", _ALL_IDS.format(v="true"))
def _(spark, d):
    path = scratch_path(spark, "status")
    sinks.write_kv(_kv_items(spark, d), lambda batch: None, path)
    return sources.load_write_status(spark, path)


# ---- generator -------------------------------------------------------------------


@query("g1_assign_users", "SELECT id, user_id FROM g_assigned")
def _(spark, d):
    return G.assign_users(V.generated_ids(spark, d), V.seed_users(spark, d)).select(
        "id", F.col("userId").alias("user_id")
    )


def _user_rows(users: DataFrame) -> DataFrame:
    return users.select(
        "id",
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "email",
        F.col("address.city").alias("city"),
        F.col("createdAt").alias("created_at"),
    )


@query("g2_complete_users", "SELECT id, first_name, last_name, email, city, created_at FROM g_users")
def _(spark, d):
    return _user_rows(G.complete_users(V.seed_users(spark, d), AS_OF, SEED))


@query(
    "g3_make_users",
    """SELECT id, first_name, last_name,
    lower(first_name) || '.' || lower(last_name) || number || '@' || domain AS email,
    city, created_at FROM g_made""",
)
def _(spark, d):
    return _user_rows(G.make_users(V.seed_users(spark, d), AS_OF, SEED))


@query("g4_sample_categories", "SELECT id, category FROM g_tickets")
def _(spark, d):
    ids = V.generated_ids(spark, d)
    count = G.category_count(G.digest(SEED, "order", F.col("id")))
    tickets = G.category_tickets(G.line_prefix(F.col("id"), SEED), count)
    drawn = ids.select("id", F.explode(tickets).alias("ticket"))
    return drawn.select("id", G.ticket_category(F.col("ticket")).alias("category"))


@query("g5_products", _G_LINES)
def _(spark, d):
    return _flat_products(V.generated_carts(spark, d))


@query(
    "g6_order_draws",
    """SELECT id, order_timestamp, payment_method, shipping_provider,
    ship_c / 100.0::double AS shipping_cost FROM g_orders""",
)
def _(spark, d):
    return V.generated_carts(spark, d).select(
        "id",
        F.col("orderTimestamp").alias("order_timestamp"),
        F.col("paymentMethod").alias("payment_method"),
        F.col("shippingProvider").alias("shipping_provider"),
        F.col("shippingCost").alias("shipping_cost"),
    )


@query("g7_order_ids", "SELECT id, order_id FROM g_orders")
def _(spark, d):
    return V.generated_carts(spark, d).select("id", F.col("orderId").alias("order_id"))


@query(
    "g8_synthesize_orders",
    """SELECT o.id, o.user_id, o.order_id, u.email, u.city,
    (SELECT count(*) FROM r_lines l WHERE l.order_id = o.order_id) AS n_products
    FROM r_orders o JOIN r_users u ON o.user_id = u.id""",
)
def _(spark, d):
    """As many orders as the given table has, over the given customers as seed."""
    n = V.table(spark, d, "orders").count()
    carts, users = G.synthesize_orders(spark, V.seed_users(spark, d), n, AS_OF, SEED)
    attributes = users.select(
        F.col("id").alias("userId"), "email", F.col("address.city").alias("city")
    )
    return carts.join(attributes, "userId").select(
        "id",
        F.col("userId").alias("user_id"),
        F.col("orderId").alias("order_id"),
        "email",
        "city",
        F.size("products").cast("bigint").alias("n_products"),
    )


# ---- projections and filters -------------------------------------------------------


@query(
    "p1_struct_star",
    "SELECT id, user_id, order_id, payment_method FROM g_orders",
)
def _(spark, d):
    packed = V.generated_carts(spark, d).select(F.struct("*").alias("cart"))
    return packed.select("cart.*").select(
        "id",
        F.col("userId").alias("user_id"),
        F.col("orderId").alias("order_id"),
        F.col("paymentMethod").alias("payment_method"),
    )


@query(
    "p2_enriched_projection",
    """SELECT order_id, customer_id, first_name, last_name, city, payment_method,
    shipping_provider FROM v_enriched""",
)
def _(spark, d):
    return V.enriched(spark, d).select(
        "order_id", "customer_id", "first_name", "last_name", "city", "payment_method",
        "shipping_provider",
    )


@query("p3_order_projection", f"SELECT {O.ORDER_COLUMNS} FROM g_order_table")
def _(spark, d):
    return jobs.order_table(V.generated_carts(spark, d), V.generated_users(spark, d), AS_OF)


@query("p4_customer_projection", f"SELECT {O.CUSTOMER_COLUMNS} FROM g_customer_table")
def _(spark, d):
    users = V.generated_users(spark, d)
    orders = jobs.order_table(V.generated_carts(spark, d), users, AS_OF)
    return A.customers_from_orders(orders, users, AS_OF)


@query("p5_drop_products", "SELECT id, order_id, shipping_provider FROM g_orders")
def _(spark, d):
    dropped = V.generated_carts(spark, d).drop("products", "orderTimestamp", "shippingCost")
    return dropped.drop("paymentMethod", "userId").withColumnsRenamed(
        {"orderId": "order_id", "shippingProvider": "shipping_provider"}
    )


@query(
    "p6_filter_eq",
    f"SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table WHERE customer_segment = 'High'",
)
def _(spark, d):
    return A.filter_eq(V.customer_table(spark, d), "customer_segment", "High")


def _status(spark, d) -> DataFrame:
    """A write status in which the pending orders failed."""
    return V.table(spark, d, "orders").select(
        text.record_key("order", F.col("o_orderkey")).alias("record_id"),
        (F.col("o_orderstatus") != "P").alias("written"),
    )


@query(
    "p7_failed_only",
    """SELECT 'order#' || o_orderkey AS record_id, false AS written FROM orders
    WHERE o_orderstatus = 'P'""",
)
def _(spark, d):
    return A.failed_only(_status(spark, d))


@query("p8_rank_filter", "SELECT order_id, dominant_category FROM v_dominant")
def _(spark, d):
    return E.dominant_category_window(V.lines(spark, d))


@query(
    "p9_facet",
    "SELECT customer_segment AS value, count(*) AS n FROM v_customer_table GROUP BY 1",
)
def _(spark, d):
    return A.facet(V.customer_table(spark, d), "customer_segment")


@query(
    "p9_apply_facets",
    f"""SELECT {O.ORDER_COLUMNS} FROM v_order_table
    WHERE dominant_category = 'PROMO' AND payment_method = '1-URGENT'""",
)
def _(spark, d):
    chosen = {"dominant_category": "PROMO", "payment_method": "1-URGENT"}
    return A.apply_facets(V.order_table(spark, d), chosen)


@query(
    "p10_search",
    f"""SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table
    WHERE (full_name ILIKE '%unknown%' OR email ILIKE '%unknown%' OR email_domain ILIKE '%unknown%'
           OR city ILIKE '%unknown%')
      AND (full_name ILIKE '%machinery%' OR email ILIKE '%machinery%'
           OR email_domain ILIKE '%machinery%' OR city ILIKE '%machinery%')""",
)
def _(spark, d):
    return A.search(
        V.customer_table(spark, d), "Unknown  machinery", A.CUSTOMER_SEARCH_FIELDS
    )


_ORPHANS = "SELECT order_id, user_id FROM v_orders WHERE user_id NOT IN (SELECT id FROM v_raw_users)"


@query("p11_orphan_count", f"SELECT count(*) AS skipped FROM ({_ORPHANS})")
def _(spark, d):
    lost = E.orphan_orders(V.orders(spark, d), V.user_ids(spark, d))
    return lost.agg(F.count(F.lit(1)).alias("skipped"))


# ---- joins -----------------------------------------------------------------------


@query(
    "j1_cart_user_inner",
    "SELECT order_id, id AS customer_id, email FROM v_orders JOIN v_users ON user_id = id",
)
def _(spark, d):
    headers = V.orders(spark, d).select(
        F.col("orderId").alias("order_id"), F.col("userId").alias("customer_id")
    )
    attributes = E.user_attributes(V.users(spark, d), AS_OF)
    return E.join_users(headers, attributes).select("order_id", "customer_id", "email")


@query("j2_orphan_orders", _ORPHANS)
def _(spark, d):
    return E.orphan_orders(V.orders(spark, d), V.user_ids(spark, d)).select(
        F.col("orderId").alias("order_id"), F.col("userId").alias("user_id")
    )


@query("j3_attach_dominant", "SELECT order_id, dominant_category FROM v_facts")
def _(spark, d):
    headers = V.orders(spark, d).select(F.col("orderId").alias("order_id"))
    return E.attach_dominant_category(headers, E.dominant_category_window(V.lines(spark, d)))


def _stored_balances(spark, d) -> DataFrame:
    """Stored table: all customers."""
    stamp = F.lit("1998-01-01").cast("timestamp")
    return (
        V.table(spark, d, "customer")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_acctbal").cast("decimal(14,2)").alias("balance"),
            F.lit(-1).cast("bigint").alias("version"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
        )
    )


def _incoming_balances(spark, d) -> DataFrame:
    """Incoming batch: one row per order, so customers repeat; the order key is the
    version. Orders that are not urgent come from customers not stored yet."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return (
        V.table(spark, d, "orders")
        .select(
            F.when(urgent, F.col("o_custkey")).otherwise(-F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderstatus").alias("name"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("balance"),
            F.col("o_orderkey").alias("version"),
        )
    )


_STORED = "(SELECT c_custkey AS k, * FROM customer)"
_INCOMING = """(SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -o_custkey END
    AS k, * FROM orders)"""


@query(
    "j4_key_match",
    f"""SELECT coalesce(s.k, i.k) AS customer_id, s.k IS NOT NULL AS stored,
    coalesce(i.n, 0) AS incoming_rows FROM {_STORED} s
    FULL JOIN (SELECT k, count(*) AS n FROM {_INCOMING} GROUP BY k) i ON s.k = i.k""",
)
def _(spark, d):
    return S.match_keys(_stored_balances(spark, d), _incoming_balances(spark, d), "customer_id")


@query(
    "j5_dedupe_users",
    """SELECT id, order_key FROM (SELECT o_custkey AS id, o_orderkey AS order_key,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1""",
)
def _(spark, d):
    versions = V.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("order_key"), "o_orderdate"
    )
    return K.dedupe_users(versions, "o_orderdate", "order_key").select("id", "order_key")


# ---- aggregations -----------------------------------------------------------------


@query(
    "a1_customer_rollup",
    """SELECT customer_id, count(DISTINCT order_id) AS total_orders,
    sum(final_amount)::decimal(24,2) AS total_spent FROM v_order_table GROUP BY customer_id""",
)
def _(spark, d):
    return A.customer_totals(V.known_amounts(spark, d))


@query(
    "a2_category_totals",
    """SELECT order_id, category, cast(cast(sum(amount_m) as decimal(20,0)) * 0.001 as decimal(20,4)) AS category_amount
    FROM v_amounts GROUP BY ALL""",
)
def _(spark, d):
    return E.category_totals(V.lines(spark, d))


def _dollars(cents):
    return money.from_units(cents, 2, "decimal(14,2)")


def _folded(name: str, flat_column: str, nested_expr: str, type_: str, fold) -> None:
    """A per-order total by both routes: grouped lines, and a fold over generated carts."""

    @query(name, f"SELECT order_id, {flat_column} AS value FROM v_sums")
    def _(spark, d):
        sums = E.line_sums(V.lines(spark, d))
        column = {
            "gross_amount": _dollars(money.amount_cents(F.col("gross"))),
            "discount_amount": _dollars(money.discount_cents(F.col("discount"))),
            "items": F.col("items"),
            "products": F.col("unique_products"),
        }[name.partition("_")[2]]
        return sums.select("order_id", column.alias("value"))

    @query(f"{name}_nested", f"SELECT order_id, {nested_expr} AS value FROM g_sums")
    def _(spark, d):
        value = fold(F.col("products")).cast(type_)
        return V.generated_carts(spark, d).select(
            F.col("orderId").alias("order_id"), value.alias("value")
        )


_CENTS = "decimal(14,2)"
_folded(
    "a3_gross_amount", O.money("gross_c"), O.money("gross_c"), _CENTS,
    lambda p: _dollars(money.amount_cents(nested.gross(p))),
)
_folded(
    "a4_discount_amount", O.money("disc_c"), O.money("disc_c"), _CENTS,
    lambda p: _dollars(money.discount_cents(nested.discount(p))),
)
_folded("a5_items", "items", "cast(items as bigint)", "bigint", nested.items)
_folded("a6_products", "uniq", "uniq", "bigint", nested.unique_products)


@query(
    "a7_segment_summary",
    """SELECT customer_segment, count(*) AS customers,
    cast(round(avg(total_spent)) as decimal(18,0)) AS avg_spent
    FROM v_customer_table GROUP BY customer_segment""",
)
def _(spark, d):
    return A.segment_summary(V.customer_table(spark, d))


@query(
    "a8_payment_revenue",
    """SELECT payment_method, count(*) AS orders,
    cast(round(sum(final_amount)) as decimal(24,0)) AS revenue
    FROM v_order_table GROUP BY payment_method""",
)
def _(spark, d):
    return A.payment_revenue(V.known_amounts(spark, d))


@query("a9_total_revenue", "SELECT sum(final_amount)::decimal(24,2) AS total FROM v_order_table")
def _(spark, d):
    return A.total_revenue(V.known_amounts(spark, d))


@query(
    "a10_table_counts",
    """SELECT 'customer_analytics' AS table_name, count(*) AS n FROM v_customer_table
    UNION ALL SELECT 'order_analytics', count(*) FROM v_order_table""",
)
def _(spark, d):
    return A.table_counts(
        customer_analytics=V.customer_table(spark, d), order_analytics=V.order_table(spark, d)
    )


@query(
    "a11_status_summary",
    """SELECT count(*) AS total, count(*) FILTER (o_orderstatus <> 'P') AS written,
    count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders""",
)
def _(spark, d):
    return A.status_summary(_status(spark, d))


@query(
    "a12_upsert_counts",
    f"""SELECT created, total - created AS updated FROM (SELECT
    (SELECT count(DISTINCT k) FROM {_INCOMING} WHERE k NOT IN (SELECT k FROM {_STORED})) AS created,
    (SELECT count(*) FROM {_INCOMING}) AS total)""",
)
def _(spark, d):
    return S.upsert_counts(_stored_balances(spark, d), _incoming_balances(spark, d), "customer_id")


@query(
    "a13_run_summary",
    """SELECT (SELECT count(*) FROM v_customer_table) AS customer_rows,
    (SELECT count(DISTINCT customer_id) FROM v_customer_table) AS unique_customers,
    (SELECT count(*) FROM v_order_table) AS orders_enriched,
    (SELECT count(*) FROM orders) - (SELECT count(*) FROM v_order_table) AS orders_skipped""",
)
def _(spark, d):
    return A.run_summary(
        V.orders(spark, d), V.customer_table(spark, d), V.order_table(spark, d)
    )


# ---- windows -----------------------------------------------------------------------


@query(
    "w1_dominant_category_last",
    """SELECT order_id, category AS dominant_category FROM (SELECT *,
    row_number() OVER (PARTITION BY order_id ORDER BY amount_m DESC, category DESC) AS rn
    FROM v_totals) WHERE rn = 1""",
)
def _(spark, d):
    return E.dominant_category_window(V.lines(spark, d), tie_break="last")


@query("w1_dominant_category", "SELECT order_id, dominant_category FROM v_dominant")
def _(spark, d):
    return E.dominant_category_window(V.lines(spark, d))


@query(
    "w2_last_per_key",
    """SELECT user_id, order_id, order_timestamp, payment_method FROM (SELECT *,
    row_number() OVER (PARTITION BY user_id ORDER BY order_timestamp DESC, order_id DESC) AS rn
    FROM v_orders) WHERE rn = 1""",
)
def _(spark, d):
    orders = V.orders(spark, d).select(
        F.col("userId").alias("user_id"),
        F.col("orderId").alias("order_id"),
        F.col("orderTimestamp").alias("order_timestamp"),
        F.col("paymentMethod").alias("payment_method"),
    )
    return K.last_per_key(orders, "user_id", "order_timestamp", "order_id")


# ---- order and limits -----------------------------------------------------------------


@query(
    "l1_top_customers",
    f"""SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table WHERE customer_segment = 'High'
    ORDER BY total_spent DESC, customer_id LIMIT 5""",
)
def _(spark, d):
    return A.top_customers(V.customer_table(spark, d))


@query(
    "l2_top_by_spend",
    f"""SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table
    ORDER BY total_spent DESC, customer_id LIMIT 5""",
)
def _(spark, d):
    return A.top_by(V.customer_table(spark, d), "total_spent", 5, "customer_id")


def _placed(name: str, columns: str, table: str, order: str, frame, schema, columns_order) -> None:
    """An order as it is stored: every row with its place in files that follow one another."""

    @query(
        name,
        f"""SELECT {columns}, row_number() OVER (ORDER BY {order}) - 1 AS place FROM {table}""",
    )
    def _(spark, d):
        path = scratch_path(spark, "ordered")
        sinks.write_ordered(frame(spark, d), path, *columns_order())
        return sources.read_ordered(spark, path, schema)


_placed(
    "l3_order_customers", O.CUSTOMER_COLUMNS, "v_customer_table",
    "lifetime_value_score DESC, customer_id",
    V.customer_table, schemas.CUSTOMER_ANALYTICS, A.customer_order,
)
_placed(
    "l4_order_orders", O.ORDER_COLUMNS, "v_order_table",
    "order_date DESC, order_hour, order_id",
    V.order_table, schemas.ORDER_ANALYTICS, A.order_order,
)
_placed(
    "l4_orders_by_timestamp", O.ORDER_COLUMNS, "v_order_table",
    "order_timestamp DESC, order_id",
    V.order_table, schemas.ORDER_ANALYTICS, lambda: A.order_order(by_timestamp=True),
)


@query(
    "l3_l4_sorted_frames",
    f"""SELECT 'customer' AS kind, cast(customer_id as varchar) AS id,
    row_number() OVER (ORDER BY lifetime_value_score DESC, customer_id) - 1 AS place
    FROM v_customer_table
    UNION ALL SELECT 'order', order_id,
    row_number() OVER (ORDER BY order_timestamp DESC, order_id) - 1 FROM v_order_table""",
)
def _(spark, d):
    """The sorted frames themselves, stored as they come out and placed by their files."""

    def placed(df: DataFrame, kind: str, key: str) -> DataFrame:
        path = scratch_path(spark, "sorted")
        ids = df.select(F.col(key).cast("string").alias("id"))
        ids.write.parquet(path)
        rows = sources.read_ordered(spark, path, ids.schema)
        return rows.select(F.lit(kind).alias("kind"), "id", "place")

    customers = A.order_customers(V.customer_table(spark, d))
    orders = A.order_orders(V.order_table(spark, d), by_timestamp=True)
    return placed(customers, "customer", "customer_id").unionByName(
        placed(orders, "order", "order_id")
    )


@query("l5_head", f"SELECT {O.ORDER_COLUMNS} FROM v_order_table ORDER BY order_id LIMIT 10")
def _(spark, d):
    return A.head(V.order_table(spark, d), 10, "order_id")


# ---- sets ------------------------------------------------------------------------------


@query(
    "u1_combine_items",
    """SELECT 'customer#' || customer_id AS record_id, 'customer' AS record_type
    FROM v_customer_table UNION ALL SELECT 'order#' || order_id, 'order' FROM v_order_table""",
)
def _(spark, d):
    return _kv_items(spark, d).select("record_id", "record_type")


@query(
    "u2_distinct_ids",
    """SELECT order_id, array_to_string(list_sort(list_distinct(list(product_id))), ',') AS ids
    FROM g_lines GROUP BY order_id""",
)
def _(spark, d):
    ids = F.array_sort(nested.distinct_ids(F.col("products")))
    return V.generated_carts(spark, d).select(
        F.col("orderId").alias("order_id"), F.array_join(ids, ",").alias("ids")
    )


# ---- scalar functions ---------------------------------------------------------------------


def _per_user(name: str, oracle_expr: str, column) -> None:
    @query(name, f"SELECT id, {oracle_expr} AS value FROM v_users")
    def _(spark, d):
        return V.users(spark, d).select("id", column().alias("value"))


_per_user("f1_email_clean", "email", lambda: text.email_clean(F.col("email")))
_per_user(
    "f2_email_domain", "email_domain",
    lambda: text.email_domain(text.email_clean(F.col("email"))),
)
_per_user(
    "f3_full_name", "trim(first_name) || ' ' || trim(last_name)",
    lambda: text.full_name(F.col("firstName"), F.col("lastName")),
)
_per_user(
    "f8_tenure_days", f"cast(greatest({O.DAY} - signup_date, 0) as integer)",
    lambda: time.tenure_days(F.to_date(time.parse_ts(F.col("createdAt"), AS_OF)), AS_OF),
)
_per_user("f15_default_to", "city", lambda: text.default_to(F.col("address.city"), "Unknown"))


@query(
    "f4_or_unknown",
    """SELECT p_partkey AS id, CASE WHEN p_size % 10 = 0 THEN 'Unknown' ELSE p_type END AS value
    FROM part""",
)
def _(spark, d):
    blank = F.when(F.col("p_size") % 20 == 0, F.lit(" \t")).when(F.col("p_size") % 10 == 0, None)
    dirty = blank.when(F.col("p_size") % 10 != 0, F.concat(F.lit(" "), "p_type", F.lit("\n")))
    return V.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), text.or_unknown(dirty).alias("value")
    )


_STAMP = "o_orderdate + to_hours(cast(o_orderkey % 24 as integer))"


def _stamp_texts(spark, d) -> DataFrame:
    """Order times as text in four notations; every seventh does not parse."""
    key = F.col("o_orderkey")
    hours = F.make_dt_interval(F.lit(0), (key % 24).cast("int"))
    stamp = F.col("o_orderdate").cast("timestamp") + hours
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    written = (
        F.when(key % 7 == 0, F.when(key % 2 == 0, F.lit("12:30")).otherwise(F.lit("soon")))
        .when(key % 4 == 0, F.concat(iso, F.lit("Z")))
        .when(key % 4 == 1, F.concat(iso, F.lit("+00:00")))
        .when(key % 4 == 2, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(iso)
    )
    return V.table(spark, d, "orders").select(key.alias("id"), written.alias("stamp"))


@query(
    "f5_parse_ts",
    f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN cast({O.DAY} as timestamp)
    ELSE {_STAMP} END AS value FROM orders""",
)
def _(spark, d):
    stamps = _stamp_texts(spark, d)
    return stamps.select("id", time.parse_ts(F.col("stamp"), AS_OF).alias("value"))


@query(
    "f6_date_and_hour",
    """SELECT order_id, cast(order_timestamp as date) AS order_date,
    cast(hour(order_timestamp) as integer) AS order_hour FROM v_orders""",
)
def _(spark, d):
    return V.orders(spark, d).select(
        F.col("orderId").alias("order_id"),
        time.order_date(F.col("orderTimestamp")).alias("order_date"),
        time.order_hour(F.col("orderTimestamp")).alias("order_hour"),
    )


@query(
    "f7_coerce_date",
    f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN cast({_STAMP} as date) END
    AS value FROM orders""",
)
def _(spark, d):
    return _stamp_texts(spark, d).select("id", time.coerce_date(F.col("stamp")).alias("value"))


@query(
    "f9_round",
    f"""SELECT order_id, product_id, price_c, {O.money('(price_c * 15 + 50) // 100')} AS money,
    {O.ratio('(pct * tax * 5 + 5) // 10')} AS ratio FROM (SELECT cast(l_orderkey as varchar) AS
    order_id, l_partkey AS product_id, cast(round(l_extendedprice * 100) as bigint) AS price_c,
    cast(round(l_discount * 100) as bigint) AS pct, cast(round(l_tax * 100) as bigint) AS tax
    FROM lineitem)""",
)
def _(spark, d):
    price = F.col("l_extendedprice").cast("decimal(14,2)")
    discount, tax = (F.col(c).cast("decimal(4,2)") for c in ("l_discount", "l_tax"))
    return V.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        money.cents(price).alias("price_c"),
        money.round_money(price * F.lit(Decimal("0.15"))).alias("money"),
        money.round_ratio(discount * tax * F.lit(Decimal("0.5"))).alias("ratio"),
    )


@query("f10_discount_ratio", "SELECT order_id, discount_ratio FROM v_order_table")
def _(spark, d):
    return V.order_table(spark, d).select(
        "order_id",
        money.discount_ratio(F.col("total_discount_amount"), F.col("gross_amount")).alias(
            "discount_ratio"
        ),
    )


def _per_customer(name: str, oracle_column: str, column) -> None:
    @query(name, f"SELECT customer_id, {oracle_column} AS value FROM v_customer_table")
    def _(spark, d):
        return V.customer_table(spark, d).select("customer_id", column().alias("value"))


_per_customer(
    "f11_avg_order_value", "avg_order_value",
    lambda: money.avg_order_value(F.col("total_spent"), F.col("total_orders")),
)
_per_customer(
    "f13_ltv", "lifetime_value_score",
    lambda: money.ltv(
        F.col("total_spent"), F.col("total_orders"), F.col("customer_tenure_days")
    ),
)
_per_customer(
    "f14_segment", "customer_segment", lambda: money.segment(F.col("lifetime_value_score"))
)
_per_customer(
    "f22_customer_label", "full_name || ' | ' || customer_segment || ' | $' || total_spent",
    serialize.customer_label,
)


@query("f12_complexity", "SELECT order_id, cast(2 * uniq + items as integer) AS value FROM v_sums")
def _(spark, d):
    sums = E.line_sums(V.lines(spark, d))
    value = money.complexity(F.col("unique_products"), F.col("items"))
    return sums.select("order_id", value.alias("value"))


@query(
    "f16_json_safe",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ordered_on,
    cast(cast(round(o_totalprice * 100) as bigint) / 100.0 as double) AS exact FROM orders""",
)
def _(spark, d):
    typed = V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
        .alias("price"),
        F.col("o_orderdate").cast("date").alias("ordered_on"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("exact"),
    )
    return typed.select(
        *[serialize.json_safe(F.col(f.name), f.dataType).alias(f.name) for f in typed.schema]
    )


@query(
    "f17_kv_safe",
    """SELECT order_id, cast(order_date as varchar) AS order_date,
    strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S') AS order_timestamp, final_amount, total_items
    FROM v_order_table""",
)
def _(spark, d):
    typed = V.order_table(spark, d).select(
        "order_id", "order_date", "order_timestamp", "final_amount", "total_items"
    )
    return typed.select(
        *[serialize.kv_safe(F.col(f.name), f.dataType).alias(f.name) for f in typed.schema]
    )


@query(
    "f17_kv_safe_nested",
    """SELECT order_id, strftime(cast(order_timestamp as timestamp), '%Y-%m-%dT%H:%M:%S') AS placed,
    substr(order_timestamp, 1, 10) AS first_day, substr(order_timestamp, 1, 10) AS marked,
    prices FROM g_orders JOIN (SELECT order_id, array_to_string(list(
      cast(cast(price_c * 0.01 as decimal(14,2)) as varchar) ORDER BY product_id, price_c), ',')
      AS prices FROM g_lines GROUP BY order_id) USING (order_id)""",
)
def _(spark, d):
    """Times in structs, arrays and maps; prices, doubles two levels deep, read back from
    the item as exact decimals."""
    placed = F.col("orderTimestamp").cast("timestamp")
    day = F.to_date(placed)
    nested_rows = V.generated_carts(spark, d).select(
        "orderId",
        F.struct(
            placed.alias("placed"),
            F.array(day).alias("days"),
            F.create_map(F.lit("first"), day).alias("marks"),
        ).alias("info"),
        "products",
    )
    safe = nested_rows.select(
        *[serialize.kv_safe(F.col(f.name), f.dataType).alias(f.name) for f in nested_rows.schema]
    )
    shape = (
        "orderId string, info struct<placed: string, days: array<string>, "
        "marks: map<string, string>>, products array<struct<id: bigint, price: decimal(14,2)>>"
    )
    item = safe.select(F.from_json(F.to_json(F.struct("*")), shape).alias("i")).select("i.*")
    prices = F.transform(F.array_sort("products"), lambda p: p["price"].cast("string"))
    return item.select(
        F.col("orderId").alias("order_id"),
        "info.placed",
        F.col("info.days")[0].alias("first_day"),
        F.col("info.marks")["first"].alias("marked"),
        F.array_join(prices, ",").alias("prices"),
    )


@query("f18_record_key", "SELECT 'order#' || o_orderkey AS record_id FROM orders")
def _(spark, d):
    return V.table(spark, d, "orders").select(
        text.record_key("order", F.col("o_orderkey")).alias("record_id")
    )


@query(
    "f19_to_doc",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS market FROM customer""",
)
def _(spark, d):
    customers = V.table(spark, d, "customer")
    doc = customers.select(serialize.to_doc(customers).alias("doc"))
    return doc.select(
        F.get_json_object("doc", "$.c_custkey").cast("bigint").alias("id"),
        F.get_json_object("doc", "$.c_name").alias("name"),
        F.get_json_object("doc", "$.c_mktsegment").alias("market"),
    )


@query(
    "f20_truthy",
    """SELECT o_orderkey AS id, o_orderkey % 6 IN (0, 1, 2, 3) AS value FROM orders""",
)
def _(spark, d):
    key = F.col("o_orderkey")
    words = F.array(*[F.lit(w) for w in (" TRUE", "yes", "On ", "1", "off", None)])
    return V.table(spark, d, "orders").select(
        key.alias("id"),
        text.truthy(F.element_at(words, (key % 6 + 1).cast("int"))).alias("value"),
    )


@query(
    "f21_to_utc",
    "SELECT order_id, order_timestamp - to_hours(2) AS value FROM v_orders",
)
def _(spark, d):
    return V.orders(spark, d).select(
        F.col("orderId").alias("order_id"),
        time.to_utc(F.col("orderTimestamp"), "+02:00").alias("value"),
    )


@query(
    "f22_order_label",
    """SELECT order_id, 'Order ' || substr(order_id, 1, 8) || '…' || ' | $' || final_amount
    || ' | ' || payment_method AS value FROM v_order_table""",
)
def _(spark, d):
    return V.order_table(spark, d).select("order_id", serialize.order_label().alias("value"))


@query(
    "f23_coerce_types",
    """SELECT cast(o_orderkey as bigint) AS customer_id,
    CASE WHEN o_orderkey % 5 <> 0
    THEN cast(cast(round(o_totalprice * 100) as bigint) / 100.0 as decimal(14,2)) END
    AS final_amount FROM orders""",
)
def _(spark, d):
    key = F.col("o_orderkey")
    raw = V.table(spark, d, "orders").select(
        key.cast("string").alias("customer_id"),
        F.when(key % 5 == 0, F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
        .alias("final_amount"),
    )
    target = [schemas.ORDER_ANALYTICS[c] for c in raw.columns]
    return S.coerce_types(raw, target)


# ---- arrays ----------------------------------------------------------------------------------


@query(
    "x1_explode_products",
    """SELECT order_id, product_id, title, category, price_c / 100.0::double AS price,
    quantity, cast(pct as double) AS discount_percentage
    FROM (SELECT order_id FROM g_orders WHERE id % 10 <> 0) JOIN g_lines USING (order_id)
    UNION ALL SELECT order_id, NULL, NULL, NULL, NULL, NULL, NULL FROM g_orders
    WHERE id % 10 = 0""",
)
def _(spark, d):
    carts = V.generated_carts(spark, d)
    emptied = F.when(F.col("id") % 20 == 0, F.array().cast(schemas.CART["products"].dataType)).when(
        F.col("id") % 10 != 0, F.col("products")
    )
    return _flat_products(carts.withColumn("products", emptied))


@query("x2_fold_products", "SELECT order_id, cast(sum(quantity * quantity) as bigint) AS value FROM g_lines GROUP BY 1")
def _(spark, d):
    fold = nested.fold_products(
        F.col("products"), lambda p: (p["quantity"] * p["quantity"]).cast("bigint"), "bigint"
    )
    return V.generated_carts(spark, d).select(
        F.col("orderId").alias("order_id"), fold.alias("value")
    )


@query(
    "x3_product_ids",
    """SELECT order_id, array_to_string(list(product_id ORDER BY product_id), ',') AS ids
    FROM g_lines GROUP BY order_id""",
)
def _(spark, d):
    ids = F.array_sort(nested.product_ids(F.col("products")))
    return V.generated_carts(spark, d).select(
        F.col("orderId").alias("order_id"), F.array_join(ids, ",").alias("ids")
    )


@query("x4_n_products", "SELECT order_id, cast(count(*) as integer) AS value FROM g_lines GROUP BY 1")
def _(spark, d):
    return V.generated_carts(spark, d).select(
        F.col("orderId").alias("order_id"), nested.n_products(F.col("products")).alias("value")
    )


@query("x5_last_part", "SELECT c_custkey AS id, split_part(c_name, '#', -1) AS value FROM customer")
def _(spark, d):
    return V.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), text.last_part(F.col("c_name"), "#").alias("value")
    )


@query("x6_dominant_category", "SELECT order_id, dominant_category FROM g_dominant")
def _(spark, d):
    return V.generated_carts(spark, d).select(
        F.col("orderId").alias("order_id"),
        nested.dominant_category(F.col("products")).alias("dominant_category"),
    )


@query(
    "x6_repeated_categories",
    """SELECT order_id, category AS dominant_category FROM (SELECT order_id, category,
      row_number() OVER (PARTITION BY order_id ORDER BY amount_m DESC, category) AS rn FROM (
        SELECT order_id, category, sum(amount_m) AS amount_m FROM (
          SELECT order_id, amount_m, CASE product_id % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'a'
            ELSE 'b' END AS category FROM v_amounts) GROUP BY ALL)) WHERE rn = 1""",
)
def _(spark, d):
    """Given lines nested by order, three categories only, one of them blank."""
    key = F.col("id") % 3
    lines = V.lines(spark, d).withColumn(
        "category", F.when(key == 0, F.lit(" \t")).when(key == 1, F.lit("a")).otherwise(F.lit(" b"))
    )
    return E.nest_products(lines).select(
        F.col("orderId").alias("order_id"),
        nested.dominant_category(F.col("products")).alias("dominant_category"),
    )


@query(
    "x7_nest_products",
    """SELECT order_id, count(*) AS n, array_to_string(list(title ORDER BY product_id, title), '|')
    AS titles FROM v_lines GROUP BY order_id""",
)
def _(spark, d):
    carts = E.nest_products(V.lines(spark, d))
    titles = F.transform("products", lambda p: p["title"])
    return carts.select(
        F.col("orderId").alias("order_id"),
        F.size("products").cast("bigint").alias("n"),
        F.array_join(titles, "|").alias("titles"),
    )


_CHUNK = 50


@query(
    "x7_nest_in_chunks",
    f"""SELECT order_id, chunk, n_lines, count(*) AS n,
    array_to_string(list(product_id ORDER BY place), ',') AS ids FROM (
      SELECT order_id, product_id, rn AS place, (rn - 1) // {_CHUNK} AS chunk, n_lines FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY product_id) AS rn,
               count(*) OVER (PARTITION BY order_id) AS n_lines
        FROM (SELECT CASE WHEN cast(order_id as bigint) % 3 = 0 THEN 'hot' ELSE order_id END
              AS order_id, product_id FROM v_lines)))
    GROUP BY order_id, chunk, n_lines""",
)
def _(spark, d):
    """All lines, those of every third order as one order."""
    hot = F.col("orderId").cast("bigint") % 3 == 0
    lines = V.lines(spark, d).withColumn(
        "orderId", F.when(hot, F.lit("hot")).otherwise(F.col("orderId"))
    )
    ids = F.transform("products", lambda p: p["id"])
    return E.nest_in_chunks(lines, _CHUNK).select(
        F.col("orderId").alias("order_id"),
        "chunk",
        "n_lines",
        F.size("products").cast("bigint").alias("n"),
        F.array_join(ids, ",").alias("ids"),
    )


# ---- sinks -------------------------------------------------------------------------------------


@query(
    "k1_raw_json",
    "SELECT id, first_name, last_name, email, city, created_at FROM g_users",
)
def _(spark, d):
    path = sinks.write_raw_json(V.generated_users(spark, d), scratch_path(spark, "raw"))
    return _user_rows(sources.read_users(spark, path, lines=True))


@query("k2_processed_csv", f"SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table")
def _(spark, d):
    path = sinks.write_processed_csv(V.customer_table(spark, d), scratch_path(spark, "csv"))
    return sources.read_processed_csv(spark, path, schemas.CUSTOMER_ANALYTICS)


@query("k3_publish_table", f"SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table")
def _(spark, d):
    return spark.table(_published(spark, V.customer_table(spark, d), "customers"))


@query(
    "k4_upsert",
    f"""SELECT coalesce(i.k, s.k) AS customer_id,
    CASE WHEN i.k IS NOT NULL THEN i.o_orderstatus ELSE s.c_name END AS name,
    CASE WHEN i.k IS NOT NULL
      THEN {O.money('cast(round(i.o_totalprice * 100) as bigint)')}
      ELSE {O.money('cast(round(s.c_acctbal * 100) as bigint)')} END AS balance,
    coalesce(i.o_orderkey, -1) AS version,
    CASE WHEN s.k IS NOT NULL THEN TIMESTAMP '1998-01-01' ELSE cast({O.DAY} as timestamp) END
      AS created_at,
    CASE WHEN i.k IS NULL THEN TIMESTAMP '1998-01-01' ELSE cast({O.DAY} as timestamp) END
      AS updated_at
    FROM {_STORED} s FULL JOIN (SELECT * FROM (SELECT *,
      row_number() OVER (PARTITION BY k ORDER BY o_orderkey DESC) AS rn FROM {_INCOMING})
      WHERE rn = 1) i ON s.k = i.k""",
)
def _(spark, d):
    return S.upsert(
        _stored_balances(spark, d), _incoming_balances(spark, d), "customer_id", AS_OF, ("version",)
    )


@query(
    "k4_upsert_buckets",
    f"""SELECT coalesce(i.k, s.k) AS customer_id,
    CASE WHEN i.k IS NOT NULL THEN i.o_orderstatus ELSE s.c_name END AS name,
    coalesce(i.o_orderkey, -1) AS version,
    CASE WHEN s.k IS NOT NULL THEN TIMESTAMP '1998-01-01' ELSE cast({O.DAY} as timestamp) END
      AS created_at,
    CASE WHEN i.k IS NULL THEN TIMESTAMP '1998-01-01' ELSE cast({O.DAY} as timestamp) END
      AS updated_at,
    (SELECT count(DISTINCT k) FROM {_INCOMING} WHERE k NOT IN (SELECT k FROM {_STORED}))
      AS created, (SELECT count(*) FROM {_INCOMING}) AS arrived
    FROM {_STORED} s FULL JOIN (SELECT * FROM (SELECT *,
      row_number() OVER (PARTITION BY k ORDER BY o_orderkey DESC) AS rn FROM {_INCOMING})
      WHERE rn = 1) i ON s.k = i.k""",
)
def _(spark, d):
    """All customers stored in buckets, then all orders upserted as balances."""
    root = scratch_path(spark, "buckets")
    name = f"balances_{root.rpartition('-')[2]}"
    first = _stored_balances(spark, d).drop("created_at", "updated_at")
    sinks.upsert_table(first, name, "customer_id", root, "1998-01-01")
    created, updated = sinks.upsert_table(
        _incoming_balances(spark, d), name, "customer_id", root, AS_OF, ("version",)
    )
    return spark.table(name).select(
        "customer_id",
        "name",
        "version",
        "created_at",
        "updated_at",
        F.lit(created).cast("bigint").alias("created"),
        F.lit(created + updated).cast("bigint").alias("arrived"),
    )


def _as_double(columns: str, names: tuple[str, ...]) -> str:
    return ", ".join(
        f"cast({c} as double) AS {c}" if c in names else c
        for c in (c.strip() for c in columns.split(","))
    )


def _document_shape(schema: T.StructType) -> T.StructType:
    """Types of the fields in a document: decimals as numbers, times as text."""
    shape = T.StructType()
    for f in schema:
        simple = f.dataType
        if isinstance(simple, T.DecimalType):
            simple = T.DoubleType()
        if isinstance(simple, (T.DateType, T.TimestampType)):
            simple = T.StringType()
        shape = shape.add(f.name, simple)
    return shape


_CUSTOMER_DOC = _as_double(
    O.CUSTOMER_COLUMNS, ("total_spent", "avg_order_value", "lifetime_value_score")
)
_ORDER_DOC = _as_double(
    O.ORDER_COLUMNS,
    (
        "gross_amount", "total_discount_amount", "net_amount", "shipping_cost", "final_amount",
        "discount_ratio",
    ),
)
for _c in ("order_timestamp", "order_date"):
    _ORDER_DOC = _ORDER_DOC.replace(f"{_c},", f"strftime({_c}, '%Y-%m-%dT%H:%M:%S') AS {_c},")


@query(
    "k5_customer_documents",
    f"SELECT cast(customer_id as varchar) AS doc_id, {_CUSTOMER_DOC} FROM v_customer_table",
)
def _(spark, d):
    documents = I.to_documents(
        V.customer_table(spark, d), schemas.CUSTOMER_DOCUMENT_FIELDS, "customer_id"
    )
    parsed = F.from_json("doc", _document_shape(schemas.CUSTOMER_ANALYTICS)).alias("r")
    return documents.select("doc_id", parsed).select("doc_id", "r.*")


@query("k5_order_documents", f"SELECT order_id AS doc_id, {_ORDER_DOC} FROM v_order_table")
def _(spark, d):
    documents = I.to_documents(V.order_table(spark, d), schemas.ORDER_DOCUMENT_FIELDS, "order_id")
    parsed = F.from_json("doc", _document_shape(schemas.ORDER_ANALYTICS)).alias("r")
    return documents.select("doc_id", parsed).select("doc_id", "r.*")


@query(
    "k5_documents_replaced",
    """SELECT cast(customer_id as varchar) AS doc_id, customer_segment,
    CASE WHEN customer_id % 100 = 7 THEN 'replaced' ELSE city END AS city,
    (SELECT count(*) FROM v_customer_table WHERE customer_id % 100 = 7) AS written
    FROM v_customer_table""",
)
def _(spark, d):
    """All documents written, then every hundredth again with another city."""
    root = scratch_path(spark, "documents")
    name = f"documents_{root.rpartition('-')[2]}"
    fields = ("customer_id", "customer_segment", "city")
    rows = V.customer_table(spark, d).select(*fields)
    sinks.write_documents(rows, fields, "customer_id", name, root)
    again = rows.where("customer_id % 100 = 7").withColumn("city", F.lit("replaced"))
    written = sinks.write_documents(again, fields, "customer_id", name, root)
    return spark.table(name).select(
        "doc_id",
        F.get_json_object("doc", "$.customer_segment").alias("customer_segment"),
        F.get_json_object("doc", "$.city").alias("city"),
        F.lit(written).cast("bigint").alias("written"),
    )


_ITEM_ORDER = O.ORDER_COLUMNS.replace(
    "order_timestamp,", "strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S') AS order_timestamp,"
).replace("order_date,", "cast(order_date as varchar) AS order_date,")


@query(
    "k6_kv_items",
    f"""SELECT 'customer#' || customer_id AS record_id, 'customer' AS record_type, * FROM
    (SELECT {O.CUSTOMER_COLUMNS} FROM v_customer_table)
    UNION ALL BY NAME SELECT 'order#' || order_id AS record_id, 'order' AS record_type, * FROM
    (SELECT {_ITEM_ORDER} FROM v_order_table)""",
)
def _(spark, d):
    """Every field of both kinds of items, money as exact decimals."""
    shape = T.StructType()
    for f in [*schemas.CUSTOMER_ANALYTICS, *schemas.ORDER_ANALYTICS]:
        if f.name not in shape.fieldNames():
            timed = isinstance(f.dataType, (T.DateType, T.TimestampType))
            shape = shape.add(f.name, T.StringType() if timed else f.dataType)
    return _kv_items(spark, d).select(
        "record_id", "record_type", F.from_json("item", shape).alias("i")
    ).select("record_id", "record_type", "i.*")


@query("k7_all_or_nothing", _ALL_IDS.format(v="false"))
def _(spark, d):
    def refuse_one(batch) -> None:
        if (batch["record_id"] == "customer#1").any():
            raise OSError("store refused the batch")

    path = scratch_path(spark, "status")
    sinks.write_kv(_kv_items(spark, d), refuse_one, path, all_or_nothing=True)
    return sources.load_write_status(spark, path)


@query(
    "k7_partly_refused",
    """SELECT 'customer#' || customer_id AS record_id, customer_id % 10 <> 3 AS written
    FROM v_customer_table UNION ALL SELECT 'order#' || order_id, true FROM v_order_table""",
)
def _(spark, d):
    def refuse_some(batch):
        ids = batch["record_id"]
        return ids[ids.str.startswith("customer#") & ids.str.endswith("3")]

    path = scratch_path(spark, "status")
    sinks.write_kv(_kv_items(spark, d), refuse_some, path)
    return sources.load_write_status(spark, path)


@query(
    "k8_view_status",
    """SELECT 'order#' || o_orderkey AS record_id, false AS written FROM orders
    WHERE o_orderstatus = 'P' ORDER BY 1 LIMIT 20""",
)
def _(spark, d):
    shown, _summary = A.view_status(_status(spark, d), only_failed=True, limit=20)
    return shown


@query(
    "k8_status_summary",
    """SELECT count(*) AS total, count(*) FILTER (o_orderstatus <> 'P') AS written,
    count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders""",
)
def _(spark, d):
    _shown, summary = A.view_status(_status(spark, d), only_failed=True, limit=20)
    return summary


@query(
    "k7_resend",
    """SELECT 'customer#' || customer_id AS record_id, customer_id % 10 <> 7 AS written
    FROM v_customer_table UNION ALL SELECT 'order#' || order_id, true FROM v_order_table""",
)
def _(spark, d):
    """Ids that end in 3 are refused twice, customers that end in 7 always."""
    refusals: dict[str, int] = {}  # each task has its own copy

    def busy(batch):
        refused = []
        for record in batch["record_id"]:
            seen = refusals.get(record, 0)
            always = record.startswith("customer#") and record.endswith("7")
            if always or (record.endswith("3") and seen < 2):
                refusals[record] = seen + 1
                refused.append(record)
        return refused

    path = scratch_path(spark, "status")
    resend = sinks.Resend(attempts=3, first_wait=0.01, pending=500)
    sinks.write_kv(_kv_items(spark, d), busy, path, resend=resend)
    return sources.load_write_status(spark, path)


_BROKEN = """(SELECT c_custkey AS k, CASE WHEN c_custkey % 19 <> 0 THEN c_name END AS full_name,
    CASE WHEN c_custkey % 17 = 0 THEN repeat('x', 300) ELSE c_name END AS email,
    CASE WHEN c_custkey % 23 = 0 THEN 1000000000000 ELSE 1 END AS total_spent FROM customer
    UNION ALL SELECT c_custkey, c_name, c_name, 1 FROM customer WHERE c_acctbal < 0)"""


_BALANCE_CONTRACT = schemas.Contract(
    key="customer_id",
    not_null=("full_name",),
    max_length={"email": 255},
    decimals={"total_spent": (14, 2)},
)


def _broken_customers(spark, d) -> DataFrame:
    key = F.col("c_custkey")
    customers = V.table(spark, d, "customer")
    broken = customers.select(
        key.alias("customer_id"),
        F.when(key % 19 != 0, F.col("c_name")).alias("full_name"),
        F.when(key % 17 == 0, F.repeat(F.lit("x"), 300)).otherwise(F.col("c_name")).alias("email"),
        F.when(key % 23 == 0, F.lit(10**12)).otherwise(F.lit(1)).cast("decimal(20,2)").alias(
            "total_spent"
        ),
    )
    again = customers.filter(F.col("c_acctbal") < 0).select(
        key.alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_name").alias("email"),
        F.lit(1).cast("decimal(20,2)").alias("total_spent"),
    )
    return broken.unionByName(again)


@query(
    "k9_check_contract",
    f"""SELECT 'not_null:full_name' AS rule, count(*) FILTER (full_name IS NULL) AS violations
    FROM {_BROKEN}
    UNION ALL SELECT 'max_length:email', count(*) FILTER (length(email) > 255) FROM {_BROKEN}
    UNION ALL SELECT 'range:total_spent', count(*) FILTER (total_spent >= 1000000000000)
    FROM {_BROKEN}
    UNION ALL SELECT 'unique:customer_id', count(*) - count(DISTINCT k) FROM {_BROKEN}""",
)
def _(spark, d):
    return S.check_contract(_broken_customers(spark, d), _BALANCE_CONTRACT)


@query(
    "k9_gate",
    f"""SELECT 'table' AS place, c_custkey AS customer_id, c_name AS full_name, '' AS rules
    FROM customer
    UNION ALL SELECT 'quarantine', k, full_name, rules FROM (SELECT k, full_name, concat_ws(',',
      CASE WHEN full_name IS NULL THEN 'not_null:full_name' END,
      CASE WHEN length(email) > 255 THEN 'max_length:email' END,
      CASE WHEN total_spent >= 1000000000000 THEN 'range:total_spent' END,
      CASE WHEN count(*) OVER (PARTITION BY k) > 1 THEN 'unique:customer_id' END) AS rules
      FROM {_BROKEN}) WHERE rules <> ''""",
)
def _(spark, d):
    """A good batch is published; a broken one after it leaves the table as it was."""
    root = scratch_path(spark, "gate")
    name = f"gated_{root.rpartition('-')[2]}"
    good = V.table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_name").alias("email"),
        F.lit(1).cast("decimal(20,2)").alias("total_spent"),
    )
    sinks.publish_table(good, name, root, contract=_BALANCE_CONTRACT)
    try:
        sinks.publish_table(_broken_customers(spark, d), name, root, contract=_BALANCE_CONTRACT)
        refused = good.limit(0).withColumn("broken_rules", F.array().cast("array<string>"))
    except gate.ContractError as error:
        refused = error.rows

    def listed(df: DataFrame, place: str, rules) -> DataFrame:
        return df.select(
            F.lit(place).alias("place"), "customer_id", "full_name", rules.alias("rules")
        )

    return listed(spark.table(name), "table", F.lit("")).unionByName(
        listed(refused, "quarantine", F.array_join("broken_rules", ","))
    )


@query(
    "k9_order_contract",
    """SELECT rule, 0::bigint AS violations FROM (VALUES """
    + ", ".join(
        f"('{r}')"
        for r in (
            *[f"not_null:{c}" for c in schemas.ORDER_CONTRACT.not_null],
            *[f"max_length:{c}" for c in schemas.ORDER_CONTRACT.max_length],
            *[f"range:{c}" for c in schemas.ORDER_CONTRACT.decimals],
            "unique:order_id",
        )
    )
    + ") t(rule)",
)
def _(spark, d):
    return S.check_contract(V.order_table(spark, d), schemas.ORDER_CONTRACT)


@query(
    "k10_evolve",
    """SELECT customer_id, full_name, email, '' AS email_domain, city, customer_tenure_days,
    total_orders, total_spent, avg_order_value, lifetime_value_score, customer_segment
    FROM v_customer_table""",
)
def _(spark, d):
    old = V.customer_table(spark, d).drop("email_domain").withColumn("currency", F.lit("USD"))
    return S.evolve(old, schemas.CUSTOMER_ANALYTICS, schemas.CUSTOMER_DEFAULTS)
