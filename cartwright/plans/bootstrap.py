"""Creating the tables and keeping the stored views up to date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..catalog import ANALYTICS, ENTITIES, LEDGER
from ..operators.store import Store
from ..session import together
from . import views
from .tables import ensure
from .transforms import dim_date


def ensure_schema(store: Store, as_of: DataFrame, stored_elsewhere: tuple[str, ...] = ()) -> list[str]:
    """Create missing tables, empty, and add missing days to the date dimension.

    Running it again changes nothing. Returns the tables that were created.
    """
    wanted = {t: ddl for t, ddl in ANALYTICS.items() if t not in stored_elsewhere}
    wanted["processed_files"] = LEDGER
    for name, spec in ENTITIES.items():
        wanted[f"stg_{name}"] = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.staging_schema)
    made = together([lambda n=name, d=ddl: ensure(store, n, d) for name, ddl in wanted.items()])
    created = [name for name, new in zip(wanted, made) if new]
    known = store.read("dim_date")
    days = dim_date(known, as_of)
    if not days.join(known.select("date_key"), "date_key", "left_anti").isEmpty():
        store.publish("dim_date", days)
    return created


def ensure_views(store: Store, tables: views.Tables, as_of: Column) -> int:
    """Compute the stored views that do not exist yet and register all seven.

    Returns how many objects are present: each stored view counts twice, once
    for its table and once for the view over it.
    """
    missing = {n: view for n, view in views.MATERIALIZED.items() if not store.exists(f"mv_{n}")}
    together([lambda n=n, view=view: store.publish(f"mv_{n}", view(tables, as_of)) for n, view in missing.items()])
    return register_views(store, tables, as_of)


def refresh_views(store: Store, tables: views.Tables, as_of: Column) -> int:
    """Recompute every stored view; returns how many there are."""
    every = views.MATERIALIZED
    together([lambda n=n, view=view: store.publish(f"mv_{n}", view(tables, as_of)) for n, view in every.items()])
    register_views(store, tables, as_of)
    return len(views.MATERIALIZED)


def register_views(store: Store, tables: views.Tables, as_of: Column) -> int:
    present = 0
    for name in views.MATERIALIZED:
        if store.exists(f"mv_{name}"):
            store.read(f"mv_{name}").createOrReplaceTempView(f"v_{name}")
            present += 2
    for name, view in views.LIVE.items():
        view(tables, as_of).createOrReplaceTempView(f"v_{name}")
        present += 1
    return present
