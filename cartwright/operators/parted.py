"""Tables in parts, of which a batch replaces only those it touches.

A part (a month, a bucket of key hashes) is a folder of Parquet files that no
write ever changes. A commit writes the new content of the parts it touches into
folders of its own and then a manifest, one small file that names the live folder
of every part. Readers go by the newest manifest, so they see all of a commit or
nothing of it, whatever stops in between, and the files of other parts stay as
they are. One driver writes a table at a time.

A table may have several layouts, which one manifest switches together: rows by
month next to the month of each key, current rows next to closed ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbering import number_by_digest
from ..session import stored, together
from .history import differs
from .merge import upsert
from .narrow import with_packed_ids, with_plain_ids

BUCKET = "_bucket"
# Buckets of tables created from now on; set it so that a bucket of the largest table is a few gigabytes.
BUCKETS_CONF, BUCKETS = "spark.cartwright.buckets", 16
# The layouts whose rows make up the table, and what a stream applied last: (its id, batch).
Changes = dict[str, tuple[Iterable[str], DataFrame]]


class Parted:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jpath

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("manifests") if n.endswith(".json")]

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict:
        version = self.versions()[-1] if version is None else version
        fs, path = self._fs(f"{self.path}/manifests/{version:08d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """Switch to a manifest: written aside, then renamed."""
        version = max(self.versions(), default=0) + 1
        fs, aside = self._fs(f"{self.path}/manifests/_{uuid.uuid4().hex[:12]}")
        out = fs.create(aside)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        if not fs.rename(aside, self._fs(f"{self.path}/manifests/{version:08d}.json")[1]):
            raise RuntimeError(f"could not publish version {version} of {self.path}")

    def create(self, layouts: dict[str, tuple[str, T.StructType]], reads: Sequence[str], **meta) -> None:
        """An empty table: per layout its part column and the other columns; ``reads`` are the layouts that are its rows."""
        self._publish({
            "layouts": {n: {"by": by, "schema": schema.json(), "parts": {}} for n, (by, schema) in layouts.items()},
            "reads": list(reads), "meta": meta,
        })

    def layout(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a layout with its part column as text, of all parts or of some."""
        found = self.manifest()["layouts"][name]
        schema = T.StructType.fromJson(json.loads(found["schema"]))
        wanted = found["parts"] if parts is None else {p: found["parts"][p] for p in parts if p in found["parts"]}
        whole = T.StructType([*schema, T.StructField("_commit", T.StringType()), T.StructField(found["by"], T.StringType())])
        paths = [f"{self.path}/{name}/_commit={commit}/{found['by']}={part}" for part, commit in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], whole).drop("_commit")
        reader = self.spark.read.schema(whole).option("basePath", f"{self.path}/{name}")
        return reader.parquet(*self._folded(name, found, wanted, paths)).select(*schema.names, found["by"])

    def _folded(self, name: str, found: dict, wanted: dict[str, str], paths: list[str]) -> list[str]:
        """The paths, with a commit's own folder in place of all its parts where every one of them is wanted."""
        out, by_commit = [], {}
        for path, (_, commit) in zip(paths, sorted(wanted.items())):
            by_commit.setdefault(commit, []).append(path)
        for commit, own in by_commit.items():
            folder = f"{name}/_commit={commit}"
            written = [n for n in self._names(folder) if n.startswith(f"{found['by']}=")]
            out += [f"{self.path}/{folder}"] if len(own) == len(written) else own
        return out

    def read(self) -> DataFrame:
        """The rows of the table; a part column that is no bucket is one of its columns."""
        found = self.manifest()
        frames = [self.layout(n) for n in found["reads"]]
        hidden = {layout["by"] for layout in found["layouts"].values() if layout["by"].startswith("_")}
        columns = [c for c in frames[0].columns if c not in hidden]
        out = frames[0].select(*columns)
        for frame in frames[1:]:
            out = out.unionByName(frame.select(*columns))
        return out

    def applied(self, stream: str | None, batch: int | None) -> bool:
        """Whether the table already holds a stream's batch."""
        last = self.manifest()["meta"].get("applied") or [None, -1]
        return stream is not None and last[0] == stream and batch <= last[1]

    def commit(self, changes: Changes, stream: str | None = None, batch: int | None = None, **meta) -> None:
        """Replace parts: per layout those named, by the parts of the rows given (which have the part column)."""
        manifest, name = self.manifest(), uuid.uuid4().hex[:16]
        layouts = manifest["layouts"]

        def write(layout: str, rows: DataFrame) -> None:
            by = layouts[layout]["by"]
            moved = with_packed_ids(rows).hint("rebalance", by)
            plain = with_plain_ids(moved, T.StructType.fromJson(json.loads(layouts[layout]["schema"])))
            plain.write.option("compression", "zstd").partitionBy(by).parquet(f"{self.path}/{layout}/_commit={name}")

        together([lambda n=n, rows=rows: write(n, rows) for n, (_, rows) in changes.items()])
        for layout, (touched, _) in changes.items():
            found, by = layouts[layout], layouts[layout]["by"]
            written = [n.split("=", 1)[1] for n in self._names(f"{layout}/_commit={name}") if n.startswith(f"{by}=")]
            kept = {p: c for p, c in found["parts"].items() if p not in set(touched)}
            if overlap := set(kept) & set(written):
                raise ValueError(f"rows of parts that are not replaced: {sorted(overlap)[:5]}")
            found["parts"] = {**kept, **{p: name for p in written}}
        if stream is not None:
            meta["applied"] = [stream, batch]
        manifest["meta"].update(meta)
        self._publish(manifest)

    def retain(self, last: int) -> None:
        """Keep the newest ``last`` manifests and the folders they name; for the end of a run."""
        versions = self.versions()
        live = [self.manifest(v) for v in versions[-last:]]
        for v in versions[:-last]:
            fs, path = self._fs(f"{self.path}/manifests/{v:08d}.json")
            fs.delete(path, False)
        for layout in live[-1]["layouts"] if live else []:
            used = {(c, p) for m in live for p, c in m["layouts"][layout]["parts"].items()}
            by, commits = live[-1]["layouts"][layout]["by"], {c for c, _ in used}
            for folder in self._names(layout):
                commit = folder.split("=", 1)[-1]
                gone = [folder] if commit not in commits else [
                    f"{folder}/{n}" for n in self._names(f"{layout}/{folder}")
                    if n.startswith(f"{by}=") and (commit, n.split("=", 1)[1]) not in used]
                for g in gone:
                    fs, path = self._fs(f"{self.path}/{layout}/{g}")
                    fs.delete(path, True)


def values(df: DataFrame, column: str) -> list[str]:
    """The parts that rows belong to; only their names reach the driver."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def buckets_of(spark: SparkSession) -> int:
    return int(spark.conf.get(BUCKETS_CONF, str(BUCKETS)))


def with_bucket(rows: DataFrame, key: str | Sequence[str], buckets: int) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))


class Keyed(Parted):
    """A table with one row per key, dealt into a fixed number of buckets by the key's hash.

    An upsert reads and writes the buckets that its keys fall into.
    """

    def __init__(self, spark: SparkSession, path: str, *key: str):
        super().__init__(spark, path)
        self.key = list(key)

    def ensure(self, schema: T.StructType, buckets: int | None = None) -> bool:
        if self.exists():
            return False
        buckets = buckets or buckets_of(self.spark)
        self.create({"rows": (BUCKET, schema)}, ["rows"], buckets=buckets)
        return True

    def adopt(self, rows: DataFrame, buckets: int | None = None) -> None:
        """Take over a table that was kept otherwise."""
        buckets = buckets or buckets_of(self.spark)
        self.ensure(rows.schema, buckets)
        self.commit({"rows": ([], with_bucket(rows, self.key, buckets))})

    def unknown(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the table lacks; reads the keys of the buckets they fall into."""
        dealt = with_bucket(rows, self.key, self.manifest()["meta"]["buckets"])
        known = with_packed_ids(self.layout("rows", values(dealt, BUCKET)).select(*self.key, BUCKET))
        fresh = with_packed_ids(dealt).join(known, [*self.key, BUCKET], "left_anti")
        return with_plain_ids(fresh.select(*rows.columns), rows.schema)

    def upsert(
        self, rows: DataFrame, updated: Sequence[str] | None = None, stream: str | None = None, batch: int | None = None
    ) -> bool:
        """Insert new keys, overwrite the ``updated`` columns of known ones; whether the table changed.

        ``rows`` hold a row per key and are read several times, so pass a stored table.
        """
        if self.applied(stream, batch):
            return False
        dealt = with_bucket(rows, self.key, self.manifest()["meta"]["buckets"])
        touched = values(dealt, BUCKET)
        if not touched and stream is None:
            return False
        self.commit({"rows": (touched, upsert(
            with_packed_ids(self.layout("rows", touched)), with_packed_ids(dealt), [*self.key, BUCKET], updated))}
                    if touched else {}, stream, batch)
        return bool(touched)


class Monthly(Parted):
    """Rows stored by month, next to the month of every key.

    A row whose time moves to another month must leave the old one. Where it is now is
    looked up in the buckets that the batch's keys fall into, two narrow columns; no month
    is read to find that out, and months without a row of the batch are not read at all.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "order_id", by: str = "order_month"):
        super().__init__(spark, path)
        self.key, self.by = key, by

    def write(self, rows: DataFrame, indexed: bool = True, buckets: int | None = None) -> None:
        """The first content; ``rows`` have the month."""
        buckets = buckets or buckets_of(self.spark)
        schema = T.StructType([f for f in rows.schema if f.name != self.by])
        months = T.StructType([rows.schema[self.key], T.StructField(self.by, T.StringType())])
        self.create({"rows": (self.by, schema), "months": (BUCKET, months)}, ["rows"], buckets=buckets, indexed=indexed)
        changes: Changes = {"rows": ([], rows)}
        if indexed:
            changes["months"] = ([], with_bucket(rows.select(self.key, self.by), self.key, buckets))
        self.commit(changes)

    def months_of(self, keys: DataFrame) -> DataFrame:
        """(key, month, bucket) of the keys that the table holds."""
        meta = self.manifest()["meta"]
        if not meta["indexed"]:
            # A table written without: the months are listed once.
            self.commit({"months": ([], with_bucket(self.layout("rows").select(self.key, self.by), self.key, meta["buckets"]))},
                        indexed=True)
        dealt = with_bucket(keys.select(self.key), self.key, meta["buckets"])
        listed, own = self.layout("months", values(dealt, BUCKET)), with_packed_ids(dealt.select(self.key, BUCKET))
        return with_plain_ids(with_packed_ids(listed).join(own, [self.key, BUCKET], "left_semi"), listed.schema)

    def replace(self, rows: DataFrame) -> list[str]:
        """Replace the rows of the keys given; the months involved. ``rows`` are read several times."""
        keys_of = rows.select(self.key)
        keys = with_packed_ids(keys_of)
        former = values(self.months_of(keys_of), self.by)
        touched = sorted({*values(rows, self.by), *former})
        if not touched:
            return []
        kept = with_packed_ids(self.layout("rows", touched)).join(keys, self.key, "left_anti")
        placed = with_bucket(rows.select(self.key, self.by), self.key, self.manifest()["meta"]["buckets"])
        buckets = values(placed, BUCKET)
        listed = with_packed_ids(self.layout("months", buckets)).join(keys, self.key, "left_anti").unionByName(
            with_packed_ids(placed))
        placed_rows = with_packed_ids(rows.select(*kept.columns))
        self.commit({"rows": (touched, kept.unionByName(placed_rows)), "months": (buckets, listed)})
        return touched


class History(Parted):
    """A dimension with full history: current rows in buckets of the key, closed rows only ever added.

    A batch reads and writes the buckets of current rows that its keys fall into, and adds
    a folder of closed rows. Keys that have closed rows only are listed, so that they stay
    closed; the largest surrogate key in use stands in the manifest.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, surrogate: str, tracked: Sequence[str]):
        super().__init__(spark, path)
        self.key, self.surrogate, self.tracked = key, surrogate, tuple(tracked)

    def ensure(self, schema: T.StructType, buckets: int | None = None) -> bool:
        if self.exists():
            return False
        buckets = buckets or buckets_of(self.spark)
        only_key = T.StructType([schema[self.key]])
        self.create({"current": (BUCKET, schema), "closed": ("_added", schema), "retired": (BUCKET, only_key)},
                    ["current", "closed"], buckets=buckets, last=0, added=0)
        return True

    def current(self) -> DataFrame:
        return self.layout("current").drop(BUCKET)

    def adopt(self, dim: DataFrame, buckets: int | None = None) -> None:
        """Take over a dimension that was kept as one table."""
        buckets = buckets or buckets_of(self.spark)
        self.ensure(dim.schema, buckets)
        current, closed = dim.filter("is_current"), dim.filter("NOT is_current")
        retired = closed.select(self.key).distinct().join(current.select(self.key), self.key, "left_anti")
        self.commit({
            "current": ([], with_bucket(current, self.key, buckets)),
            "closed": ([], closed.withColumn("_added", F.lit("0"))),
            "retired": ([], with_bucket(retired, self.key, buckets)),
        }, last=dim.agg(F.coalesce(F.max(self.surrogate), F.lit(0))).first()[0])

    def merge(self, staged: DataFrame, at: Column, stream: str | None = None, batch: int | None = None) -> bool:
        """A batch of one row per key; what happens to a key is as in ``merge_history``."""
        meta = self.manifest()["meta"]
        if self.applied(stream, batch):
            return False
        dealt = with_bucket(staged, self.key, meta["buckets"])
        touched = values(dealt, BUCKET)
        if touched:
            old = self.layout("current", touched)
            before = old.select(self.key, BUCKET, F.lit(True).alias("_held"), *[F.col(c).alias(f"_old_{c}") for c in self.tracked])
            moved = differs([F.col(c) for c in self.tracked], [F.col(f"_old_{c}") for c in self.tracked])
            known = dealt.join(before, [self.key, BUCKET], "left").join(
                self.layout("retired", touched), [self.key, BUCKET], "left_anti")
            opened = known.filter(F.col("_held").isNull() | moved).select(*dealt.columns, (F.col("_held") & moved).alias("_again"))
            opened = stored(opened, "history-opened")
            if not opened.isEmpty():
                self._commit(old, opened, touched, at, meta, stream, batch)
                return True
        if stream is not None:
            self.commit({}, stream, batch)
        return False

    def _commit(self, old, opened, touched, at, meta, stream, batch) -> None:
        columns = [c for c in old.columns if c != BUCKET]
        fresh = opened.drop(BUCKET, "_again").withColumns({
            "valid_from": at, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
        fresh = number_by_digest(fresh, self.key, self.surrogate).withColumn(self.surrogate, F.col(self.surrogate) + meta["last"])
        fresh = stored(with_bucket(fresh.select(*columns), self.key, meta["buckets"]), "history-fresh")
        changed = opened.filter(F.coalesce("_again", F.lit(False))).select(self.key, BUCKET)
        # Only the buckets that get a new row are written.
        hit = values(opened, BUCKET)
        added = str(meta["added"] + 1)
        closed = old.join(changed, [self.key, BUCKET], "left_semi").select(*columns).withColumns(
            {"valid_to": at, "is_current": F.lit(False), "_added": F.lit(added)})
        kept = self.layout("current", hit).join(changed, [self.key, BUCKET], "left_anti")
        self.commit({"current": (hit, kept.unionByName(fresh)), "closed": ([], closed)}, stream, batch,
                    last=fresh.agg(F.max(self.surrogate)).first()[0], added=meta["added"] + 1)
