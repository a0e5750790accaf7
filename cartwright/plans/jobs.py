"""The warehouse and the serving job, and a runner that keeps them apart."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.time import AsOf
from ..operators.analytics import (
    build_order_analytics,
    customers_from_orders,
    status_summary,
)
from ..operators.enrich import cart_facts, keep_known_users
from ..operators.generate import synthesize_orders
from ..operators.items import to_kv_items
from ..schemas import (
    CART,
    CUSTOMER_CONTRACT,
    CUSTOMER_DEFAULTS,
    CUSTOMER_DOCUMENT_FIELDS,
    ORDER_CONTRACT,
    ORDER_DEFAULTS,
    ORDER_DOCUMENT_FIELDS,
    USER,
)
from ..session import prepare
from ..sinks import (
    publish_table,
    store_items,
    upsert_table,
    write_documents,
    write_kv,
    write_processed_csv,
    write_raw_json,
)
from ..sinks.keyvalue import BatchWriter
from ..sources import load_seed, read_landed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobConfig:
    """Where a run reads and writes. ``root`` must be reachable by all executors.

    Without a ``kv_writer`` the items become a table.
    """

    root: str
    as_of: AsOf
    seed_carts: str = ""
    seed_users: str = ""
    seed_as_lines: bool = True
    n_orders: int = 10_000
    seed: int = 0
    namespace: str = "analytics"
    kv_writer: BatchWriter | None = None
    kv_all_or_nothing: bool = False

    def table(self, name: str) -> str:
        return f"{self.namespace}.{name}"


def generate(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, DataFrame]:
    """Synthetic carts and users over the landed seed (empty when none landed)."""
    _, users = load_seed(
        spark,
        cfg.seed_carts or f"{cfg.root}/raw/carts",
        cfg.seed_users or f"{cfg.root}/raw/users",
        lines=cfg.seed_as_lines,
    )
    return synthesize_orders(spark, users, cfg.n_orders, cfg.as_of, cfg.seed)


def order_table(carts: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    return build_order_analytics(keep_known_users(cart_facts(carts, as_of), users))


class Counted:
    """Rows of frames, counted by the jobs that write what is made of them."""

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        self.seen[name] = Observation()
        return df.observe(self.seen[name], F.count(F.lit(1)).alias("rows"))

    def __getitem__(self, name: str) -> int:
        return self.seen[name].get.get("rows", 0)


def _tables(
    carts: DataFrame, users: DataFrame, cfg: JobConfig, orders_name: str, customers_name: str
) -> tuple[DataFrame, DataFrame, dict]:
    """Publish the order and the customer table of a run, and its figures.

    The stored order table is the hand-over point: customers and everything later read
    it back, so the enrichment runs once and nothing is cached in executors that may be
    lost. All figures are counted in the two writing jobs: carts before the user join,
    orders after it, customers as they are stored, one row each as the contract demands.
    """
    counted = Counted()
    orders = publish_table(
        counted("orders", order_table(counted("carts", carts), users, cfg.as_of)),
        cfg.table(orders_name),
        cfg.root,
        contract=ORDER_CONTRACT,
    )
    customers = publish_table(
        counted("customers", customers_from_orders(orders, users, cfg.as_of)),
        cfg.table(customers_name),
        cfg.root,
        contract=CUSTOMER_CONTRACT,
    )
    figures = {
        "customer_rows": counted["customers"],
        "unique_customers": counted["customers"],
        "order_rows": counted["orders"],
        "skipped_orders": counted["carts"] - counted["orders"],
    }
    return orders, customers, figures


def run_warehouse(spark: SparkSession, cfg: JobConfig) -> dict:
    """Generate, enrich, publish both tables, put the items."""
    prepare(spark)
    carts, users = generate(spark, cfg)
    orders, customers, figures = _tables(carts, users, cfg, "order_analytics", "customer_analytics")
    items = to_kv_items(customers, orders)
    status_path = f"{cfg.root}/processed/write_status"
    if cfg.kv_writer is None:
        status = store_items(items, cfg.table("items"), cfg.root, status_path)
    else:
        status = write_kv(items, cfg.kv_writer, status_path, cfg.kv_all_or_nothing)
    total, written, failed = status_summary(status).first()
    return figures | {
        "items_total": total,
        "items_written": written,
        "items_failed": failed,
    }


def run_serving(spark: SparkSession, cfg: JobConfig) -> dict:
    """Generate, snapshot, enrich, write CSV, upsert the stored tables, write documents."""
    prepare(spark)
    carts, users = generate(spark, cfg)
    carts = read_landed(spark, write_raw_json(carts, f"{cfg.root}/raw/synthetic_carts"), CART)
    users = read_landed(spark, write_raw_json(users, f"{cfg.root}/raw/synthetic_users"), USER)
    orders, customers, figures = _tables(
        carts.documents, users.documents, cfg, "order_batch", "customer_batch"
    )
    write_processed_csv(customers, f"{cfg.root}/processed/customer_analytics")
    write_processed_csv(orders, f"{cfg.root}/processed/order_analytics")
    stored_customers = upsert_table(
        customers,
        cfg.table("customer_store"),
        "customer_id",
        cfg.root,
        cfg.as_of,
        defaults=CUSTOMER_DEFAULTS,
        contract=CUSTOMER_CONTRACT,
        published=True,
    )
    stored_orders = upsert_table(
        orders,
        cfg.table("order_store"),
        "order_id",
        cfg.root,
        cfg.as_of,
        defaults=ORDER_DEFAULTS,
        contract=ORDER_CONTRACT,
        published=True,
    )
    customer_docs = write_documents(
        customers,
        CUSTOMER_DOCUMENT_FIELDS,
        "customer_id",
        cfg.table("customer_documents"),
        cfg.root,
        published=True,
    )
    order_docs = write_documents(
        orders,
        ORDER_DOCUMENT_FIELDS,
        "order_id",
        cfg.table("order_documents"),
        cfg.root,
        published=True,
    )
    return figures | {
        "broken_documents": carts.broken_count() + users.broken_count(),
        "customers_created": stored_customers[0],
        "customers_updated": stored_customers[1],
        "orders_created": stored_orders[0],
        "orders_updated": stored_orders[1],
        "customer_docs": customer_docs,
        "order_docs": order_docs,
    }


BRANCHES: dict[str, Callable[[SparkSession, JobConfig], dict]] = {
    "serving": run_serving,
    "warehouse": run_warehouse,
}


class RunError(RuntimeError):
    """Some branches failed; ``results`` has those of the others, ``errors`` the reasons."""

    def __init__(self, results: dict[str, dict], errors: dict[str, Exception]) -> None:
        super().__init__(" | ".join(f"{n} branch failed: {e}" for n, e in errors.items()))
        self.results, self.errors = results, errors


def run(
    spark: SparkSession, cfg: JobConfig, branches: tuple[str, ...] = ("serving", "warehouse")
) -> dict[str, dict]:
    """Run the branches one after the other; a failed one does not stop the rest.

    Failures are raised together at the end, with the results of the others.
    """
    results: dict[str, dict] = {}
    errors: dict[str, Exception] = {}
    for name in branches:
        try:
            results[name] = BRANCHES[name](spark, cfg)
        except Exception as error:
            log.exception("%s branch failed", name)
            errors[name] = error
    if errors:
        raise RunError(results, errors)
    return results
