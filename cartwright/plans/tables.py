"""Which stored tables are kept in parts, and by what."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import ENTITIES
from ..operators.parted import History, Keyed
from ..operators.store import Store
from .transforms import CUSTOMER_TRACKED, PRODUCT_TRACKED

# One row per key: the table and its key.
KEYED = {**{f"stg_{name}": spec.key for name, spec in ENTITIES.items()}, "fact_payments": "payment_id", "fact_returns": "return_id"}
# Full history: the table, its key, its surrogate key, and the columns a change of which opens a new row.
HISTORIES = {
    "dim_customers": ("customer_id", "customer_sk", CUSTOMER_TRACKED),
    "dim_products": ("product_id", "product_sk", PRODUCT_TRACKED),
}


def keyed(store: Store, table: str) -> Keyed:
    return Keyed(store.spark, f"{store.root}/{table}", KEYED[table])


def history(store: Store, table: str) -> History:
    return History(store.spark, f"{store.root}/{table}", *HISTORIES[table])


def ensure(store: Store, table: str, ddl: str) -> bool:
    """Create a table empty, kept as it should be, unless it exists; whether it was created."""
    if table in KEYED:
        return keyed(store, table).ensure(T.StructType.fromDDL(ddl))
    if table in HISTORIES:
        return history(store, table).ensure(T.StructType.fromDDL(ddl))
    return store.ensure(table, ddl)


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """What names a stream across restarts; None where it has not begun."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
