"""The star schema over the given tables, built once and stored.

``Warehouse`` is a mapping of table names. The first request for a table builds
it and those it depends on and writes it below the shared folder; queries then
read Parquet, as a dashboard reads tables a nightly load has written.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import ANALYTICS, ENTITIES
from ..operators.merge import latest_per_key
from ..operators.partitions import read_months, write_months
from ..session import fresh_dir, prepare, together
from ..sources import retail
from ..sources.sinks import write_dated_csv
from . import transforms, views

_BUILT: dict[tuple[str, str], "Warehouse"] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> "Warehouse":
    """The warehouse of this application over one set of tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = Warehouse(prepare(spark), sf_dir)
    return _BUILT[key]


def ts(text: str):
    return F.lit(text).cast("timestamp")


def file_day():
    """The date in the folder of a raw row's file."""
    return F.to_date(F.regexp_extract("_source_file", r"(\d{4}/\d{2}/\d{2})", 1), "yyyy/MM/dd")


class Warehouse(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = fresh_dir(spark, "warehouse")
        self._stored: dict[str, DataFrame] = {}
        self._locks = {name: threading.Lock() for name in BUILDERS}
        self._landing: str | None = None
        self.runs: dict[str, object] = {}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._stored:
                self._stored[name] = self._store(name, BUILDERS[name](self))
        return self._stored[name]

    def rows(self, name: str) -> DataFrame:
        """A table for one step that reads it once: as stored if it is, else as what would be stored.

        Storing the widest table only to read it back once would cost as much as bringing its facts together.
        """
        with self._locks[name]:
            return self._stored[name] if name in self._stored else BUILDERS[name](self)

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        if name.startswith("fact_orders"):
            write_months(df, path, indexed=False)
            return read_months(self.spark, path, df.schema)
        # Identifiers are hex digits: half their size, and no byte of them repeats for a faster codec.
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def build(self) -> None:
        """Build every table, those that do not depend on each other side by side."""
        for level in LEVELS:
            together([lambda n=n: self[n] for n in level])

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)

    def empty(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([], ANALYTICS[name])

    def typed(self, entity: str) -> DataFrame:
        return retail.TYPED[entity](self.spark, self.sf_dir)

    def landing(self) -> str:
        """A folder with the seven raw entities as dated CSV files, written on first use."""
        if self._landing is None:
            self._landing = self.land(f"{self.root}/landing")
        return self._landing

    def land(self, root: str, part=None) -> str:
        """Write the raw rows of every entity below a folder, all or those that meet a condition."""

        def write(entity: str) -> None:
            large = entity in retail.NARROW
            raw = retail.raw_by_file(self.spark, self.sf_dir, entity, part) if large else retail.raw(self.spark, self.sf_dir, entity)
            rows = raw.select(*ENTITIES[entity].columns, file_day().alias("_day"))
            rows = rows if part is None or large else rows.filter(part)
            write_dated_csv(rows, root, entity, "_day", together=large, compression="gzip")

        together([lambda e=e: write(e) for e in ENTITIES])
        return root

    def as_of(self) -> DataFrame:
        """The day the data stands at, read from the orders: one row."""
        orders = retail.read(self.spark, self.sf_dir, "orders")
        return orders.agg(F.to_date(F.max("o_orderdate")).alias("as_of"))


def _latest(entity: str, rows):
    """Entities of which several rows may have one key: the latest row stays."""

    def build(w: Warehouse) -> DataFrame:
        return rows(w.spark, w.sf_dir).select(*ENTITIES[entity].staging_schema.names)

    return build


def _plain(entity: str):
    """Entities whose key is unique in the given tables."""

    def build(w: Warehouse) -> DataFrame:
        return w.typed(entity).select(*ENTITIES[entity].staging_schema.names)

    return build


def _customer_changes(w: Warehouse) -> DataFrame:
    changes = retail.customer_changes(w.spark, w.sf_dir)
    rows = latest_per_key(changes, ["customer_id"], ["_loaded_at", "_k"])
    return rows.select(*ENTITIES["customers"].staging_schema.names)


def _product_changes(w: Warehouse) -> DataFrame:
    return retail.product_changes(w.spark, w.sf_dir).select(*ENTITIES["products"].staging_schema.names)


def _view(view):
    return lambda w: view(w, F.lit(retail.AS_OF).cast("date"))


BUILDERS = {
    "stg_customers": _plain("customers"),
    "stg_customer_changes": _customer_changes,
    "stg_products": _plain("products"),
    "stg_product_changes": _product_changes,
    "stg_orders": _latest("orders", retail.latest_orders),
    "stg_payments": _plain("payments"),
    "stg_inventory": _plain("inventory"),
    "stg_revenue": _plain("revenue"),
    "stg_returns": _latest("returns", retail.latest_returns),
    "dim_date": lambda w: transforms.rolling_calendar(w.as_of(), pad=False),
    "dim_customers_v1": lambda w: transforms.dim_customers(
        w.empty("dim_customers"), w["stg_customers"], ts(retail.FIRST_LOAD)
    ),
    "dim_customers": lambda w: transforms.dim_customers(
        w["dim_customers_v1"], w["stg_customer_changes"], ts(retail.SECOND_LOAD)
    ),
    "dim_products_v1": lambda w: transforms.dim_products(
        w.empty("dim_products"), w["stg_products"], ts(retail.FIRST_LOAD)
    ),
    "dim_products": lambda w: transforms.dim_products(
        w["dim_products_v1"], w["stg_product_changes"], ts(retail.SECOND_LOAD)
    ),
    "fact_orders": lambda w: transforms.order_rows(w.rows("stg_orders"), w["dim_customers"], w["dim_products"]),
    "fact_orders_asof": lambda w: transforms.order_rows(
        w.rows("stg_orders"), w["dim_customers"], w["dim_products"], binding="asof"
    ),
    "fact_payments": lambda w: transforms.payment_rows(w["stg_payments"]),
    "fact_returns": lambda w: transforms.return_rows(w["stg_returns"]),
    # The stored views, as the last refresh left them.
    **{f"mv_{n}": _view(view) for n, view in views.MATERIALIZED.items()},
}

# Tables of one level depend on earlier levels only.
LEVELS = (
    [n for n in BUILDERS if n.startswith("stg_")] + ["dim_date"],
    ["dim_customers_v1", "dim_products_v1", "fact_payments", "fact_returns"],
    ["dim_customers", "dim_products"],
    ["fact_orders", "fact_orders_asof"],
    [n for n in BUILDERS if n.startswith("mv_")],
)
