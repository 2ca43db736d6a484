"""The scheduled run: whatever has landed since the last one, up to the dashboards.

Files are loaded entity by entity in parallel, then dimensions, order facts, the
other facts, checks, and the stored views. Each table is published on its own,
so a run that stops half-way leaves complete tables and the next run goes on.
Staging, dimensions and facts are kept in parts, and each step takes what was
staged since it was last published, so a batch costs the parts it touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import ENTITIES
from ..operators import quality
from ..operators.history import current_rows
from ..operators.partitions import exists, read_months, replace_rows
from ..operators.skew import lookup
from ..operators.store import Store
from ..session import held, release, together
from ..streaming.loads import EntityLoad
from . import bootstrap, transforms, views
from .tables import history, keyed


MARKER, DIMENSIONS_MARKER = "facts_marker", "dimensions_marker"
# Versions of each table that stay after a run, the current one included.
VERSIONS_KEPT = 3


def orders_to_bind(
    staging: DataFrame, customers: DataFrame, products: DataFrame, since: Column | None
) -> DataFrame:
    """The staged orders whose fact row can differ from the stored one.

    ``since`` is when the last run began that published its facts. Binding every
    staged order again would give the others the row they have: only orders
    staged since then, by whichever runs, and those whose customer or product got
    a new current row since then, come out differently. None takes every order.
    """
    if since is None:
        return staging

    def opened(dim: DataFrame, key: str, flag: str) -> DataFrame:
        return lookup(current_rows(dim).filter(F.col("valid_from") >= since).select(key, F.lit(True).alias(flag)))

    marked = staging.join(opened(customers, "customer_id", "_c"), "customer_id", "left").join(
        opened(products, "product_id", "_p"), "product_id", "left"
    )
    return marked.filter((F.col("_loaded_at") >= since) | F.col("_c") | F.col("_p")).select(*staging.columns)


@dataclass
class HourlyRun:
    store: Store
    landing: str

    @property
    def facts_path(self) -> str:
        return f"{self.store.root}/fact_orders_by_month"

    def fact_orders(self) -> DataFrame:
        ddl = T.StructType.fromDDL(bootstrap.ANALYTICS["fact_orders"])
        return read_months(self.store.spark, self.facts_path, ddl)

    def tables(self) -> dict[str, DataFrame]:
        names = ("dim_date", "dim_customers", "dim_products", "dim_inventory", "fact_payments", "fact_returns",
                 "agg_revenue")
        stored = [f"mv_{n}" for n in views.MATERIALIZED if self.store.exists(f"mv_{n}")]
        return {**{n: self.store.read(n) for n in (*names, *stored)}, "fact_orders": self.fact_orders()}

    def run(self, as_of: str, at: str) -> dict[str, object]:
        """One run at a given day and time; returns counts for the log."""
        day, now = F.lit(as_of).cast("date"), F.lit(at).cast("timestamp")
        bootstrap.ensure_schema(self.store, self.store.spark.range(1).select(day.alias("as_of")), ("fact_orders",))
        loaded = self.load(now)
        release(self.store.spark)
        self.dimensions(now)
        release(self.store.spark)
        orphans = self.facts(now)
        release(self.store.spark)
        tables = self.tables()
        violations = quality.constraint_violations(tables).agg(F.sum("violations")).first()[0]
        outside = quality.default_partition_rows(tables["fact_orders"], day).first()[0]
        refreshed = bootstrap.refresh_views(self.store, tables, day)
        self.store.retain(VERSIONS_KEPT)
        release(self.store.spark)
        return {"entities": loaded, "orphans_cleared": orphans, "violations": violations,
                "default_partition_rows": outside, "views_refreshed": refreshed}

    def load(self, now: Column) -> list[str]:
        """Load the entities that have a folder; the others have no files yet."""
        present = [e for e in ENTITIES if exists(self.store.spark, f"{self.landing}/entity={e}")]
        together([lambda e=e: EntityLoad(self.store, self.landing, e).run(now) for e in present])
        return present

    def dimensions(self, now: Column) -> None:
        """Merge what was staged since the dimensions were last published, by whichever runs."""
        s, since = self.store, self.since(DIMENSIONS_MARKER, now)

        def merge(table: str, newest, source: str) -> None:
            staged = s.read(source) if since is None else s.read(source).filter(F.col("_loaded_at") >= since)
            with held(newest(staged), "newest") as rows:
                history(s, table).merge(rows, now)

        together([
            lambda: merge("dim_customers", transforms.newest_customers, "stg_customers"),
            lambda: merge("dim_products", transforms.newest_products, "stg_products"),
            lambda: s.publish("dim_inventory", transforms.dim_inventory(s.read("dim_inventory"), s.read("stg_inventory"), now)),
        ])
        s.publish(DIMENSIONS_MARKER, s.spark.range(1).select(now.alias("bound_up_to")))

    def facts(self, now: Column) -> int:
        """Bring the facts up to date; returns how many dangling references were cleared."""
        s = self.store
        # Orders are bound to current rows; the closed ones are not read.
        dims = {**{n: history(s, n).current() for n in ("dim_customers", "dim_products")}, "dim_date": s.read("dim_date")}
        orders = s.read("stg_orders")
        since = self.since(MARKER, now)
        stale = orders_to_bind(orders, dims["dim_customers"], dims["dim_products"], since)
        # What was staged since the last run that published its facts; other rows are as they were.
        batch = {name: s.read(f"stg_{name}") for name in ("payments", "returns")}
        if since is not None:
            batch = {name: rows.filter(F.col("_loaded_at") >= since) for name, rows in batch.items()}
        # The batch stays on disk only until the tables hold it.
        with (
            held(transforms.order_rows(stale, dims["dim_customers"], dims["dim_products"]), "orders-batch") as order_rows,
            held(transforms.payment_rows(batch["payments"]), "payments-batch") as payment_rows,
            held(transforms.return_rows(batch["returns"]), "returns-batch") as return_rows,
        ):
            found = {"fact_orders": order_rows, "fact_payments": payment_rows, "fact_returns": return_rows}
            cleared = self.replace(found, dims, orders, now)
        # Last: a run that stops before this leaves its orders to the next one.
        s.publish(MARKER, s.spark.range(1).select(now.alias("bound_up_to")))
        return cleared

    def replace(self, found: dict[str, DataFrame], dims: dict[str, DataFrame], orders: DataFrame, now: Column) -> int:
        """Replace the facts found by their sound rows; returns how many dangling references were cleared."""
        s = self.store
        # A known payment or return keeps its date, so only new ones can be cleared.
        new = {t: keyed(s, t).unknown(found[t]) for t in ("fact_payments", "fact_returns")}
        cleared = quality.orphan_total({"fact_orders": found["fact_orders"], **new, **dims}).first()[0]
        near = {**dims, **{n: lookup(dims[n].select(k)) for n, k in (
            ("dim_customers", "customer_sk"), ("dim_products", "product_sk"), ("dim_date", "date_key"))}}
        sound = quality.clear_all_orphans({**found, **near})

        def replace_orders() -> None:
            with held(sound["fact_orders"], "orders-sound") as rows:
                replace_rows(s.spark, self.facts_path, rows)

        def upsert(table: str, updated: tuple[str, ...]) -> None:
            with held(sound[table], f"{table}-sound") as rows:
                keyed(s, table).upsert(rows, updated)

        together([
            replace_orders,
            lambda: upsert("fact_payments", transforms.PAYMENT_UPDATED),
            lambda: upsert("fact_returns", transforms.RETURN_UPDATED),
            lambda: s.publish("agg_revenue", transforms.agg_revenue(s.read("agg_revenue"), s.read("stg_revenue"), orders, now)),
        ])
        return cleared

    def since(self, marker: str, now: Column) -> Column | None:
        """When the last run began that published this marker; never later than this one."""
        if not self.store.exists(marker):
            return None
        found = self.store.read(marker).select(F.least("bound_up_to", now).alias("at")).first()["at"]
        return F.lit(found)
