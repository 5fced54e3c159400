"""Raw tables in key buckets: a load rewrites only the buckets it touches.

A bucketed table is a chain of catalog tables, one for each version.  Each is
partitioned by ``slot`` and clustered by the key into as many buckets, and a
row's slot is its bucket, so a slot's directory holds one bucket's files.  The
partition list of a version is its manifest: a slot that a load does not touch
points at the directory an earlier load wrote.  Spark knows the clustering, so
two tables with the same bucket count join on the key without an exchange, and
the slot list prunes what is read.

A load writes the touched slots to a directory of its own, then creates the next
version with its whole manifest, and then names that version in a property of
the table's head; that property alone makes it current.  A job
may stop after any statement: readers see the old version, and the next load
removes what was left.  The latest ``KEEP_OLD`` versions before the current one
stay for readers that still use them; a directory goes when no version that
stays points into it.

One writer per table.  Null keys have a slot like any other (they match nothing).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.store import TableStore

SLOT = "slot"
HEAD_PROP = "ledgerlake.head"
KEEP_OLD = 1
# Rows a bucket should hold, when the number of buckets is chosen from a table's size.
BUCKET_ROWS = 2_000_000
MOST_BUCKETS = 65_536


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two, so that a table that has grown splits each bucket in two."""
    n = 1
    while n < MOST_BUCKETS and n * bucket_rows < rows:
        n *= 2
    return n


def slot_of(key: str, buckets: int) -> Column:
    """The bucket Spark puts a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


@dataclass(frozen=True)
class Load:
    """What a load did: rows put in, rows deleted, and the slots it wrote."""

    loaded: int
    deleted: int
    slots: tuple[int, ...]


class BucketedTable:
    def __init__(self, store: TableStore, schema: str, table: str, key: str = "id", buckets: int | None = None):
        """``buckets`` is asked for when the table has no version yet; later it is the table's own."""
        self.store, self.schema, self.table, self.key = store, schema, table, key
        self.spark: SparkSession = store.spark
        self.db = store.db(schema)
        self.head_name = f"{self.db}.{table}__head"
        self.root = f"{store.root}/{schema}/{table}__buckets"
        head = self.head()
        self.buckets = head["buckets"] if head else buckets

    # ------------------------------------------------------------- versions
    def head(self) -> dict | None:
        """name, number, buckets, rows and watermark of the current version."""
        if not self.spark.catalog.tableExists(self.head_name):
            return None
        props = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.head_name}").collect()}
        return json.loads(props[HEAD_PROP]) if HEAD_PROP in props else None

    def read(self, slots: list[int] | None = None) -> DataFrame | None:
        """The rows (of some slots); None before the first load."""
        head = self.head()
        if head is None:
            return None
        df = self.spark.table(f"{self.db}.{head['name']}")
        if slots is not None:
            df = df.filter(F.col(SLOT).isin(slots))
        return df.drop(SLOT)

    def rows(self) -> int | None:
        return (self.head() or {}).get("rows")

    def watermark(self) -> str | None:
        return (self.head() or {}).get("wm")

    def manifest(self, name: str | None = None) -> dict[int, str]:
        """The directory of each slot of a version (the current one, if none is named)."""
        head = self.head()
        name = name or (head and head["name"])
        if not name:
            return {}
        rows = self.spark.read.schema("slot int, dir string").json(f"{self.root}/_manifests/{name}").collect()   # one row a slot
        return {r["slot"]: r["dir"] for r in rows}

    def _create(self, name: str, fields: str, location: str) -> None:
        self.spark.sql(f"CREATE TABLE {self.db}.{name} ({fields}, {SLOT} INT) USING parquet PARTITIONED BY ({SLOT}) "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{location}'")

    @staticmethod
    def _fields(df: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    # -------------------------------------------------------------- staging
    def stage(self, df: DataFrame, name: str, dealt: bool = False) -> tuple[DataFrame, dict[int, str], dict]:
        """``df`` written in buckets to a directory of its own, one file a slot, and read back from a table that
        ``unstage`` drops; the directories of its slots; and its rows and last load date.  ``dealt``: its rows
        lie in the table's buckets already."""
        table, path = f"{self.table}__{name}_{uuid.uuid4().hex[:8]}", f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
        self._create(table, self._fields(df), path)
        obs = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        if "load_date" in df.columns:
            metrics.append(F.max("load_date").cast("string").alias("wm"))
        rows = df if dealt else df.repartition(self.buckets, self.key)   # by the hash that numbers the buckets
        rows = rows.observe(obs, *metrics).withColumn(SLOT, slot_of(self.key, self.buckets).cast("int"))
        rows.write.insertInto(f"{self.db}.{table}")
        slots = [int(r[0].split("=", 1)[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.db}.{table}").collect()]
        self.spark.catalog.refreshTable(f"{self.db}.{table}")
        return self.spark.table(f"{self.db}.{table}"), {s: f"{path}/{SLOT}={s}" for s in slots}, obs.get | {"table": table}

    def unstage(self, facts: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.db}.{facts['table']}")

    # --------------------------------------------------------------- commit
    def _commit(self, fields: str, manifest: dict[int, str], rows: int, wm: str | None) -> None:
        head = self.head()
        number = (head["number"] if head else 0) + 1
        name = f"{self.table}__v{number:06d}_{uuid.uuid4().hex[:6]}"
        self._create(name, fields, f"{self.root}/_versions/{name}")
        listed = sorted(manifest.items())
        for at in range(0, len(listed), 1000):  # not current yet
            parts = " ".join(f"PARTITION ({SLOT} = {s}) LOCATION '{d}'" for s, d in listed[at:at + 1000])
            self.spark.sql(f"ALTER TABLE {self.db}.{name} ADD {parts}")
        self.spark.createDataFrame(listed, "slot int, dir string").coalesce(1).write.json(f"{self.root}/_manifests/{name}")
        if not self.spark.catalog.tableExists(self.head_name):
            self.spark.sql(f"CREATE TABLE {self.head_name} (name STRING) USING parquet LOCATION '{self.root}/_head'")
        new = json.dumps({"name": name, "number": number, "buckets": self.buckets, "rows": rows, "wm": wm})
        self.spark.sql(f"ALTER TABLE {self.head_name} SET TBLPROPERTIES ('{HEAD_PROP}' = '{new}')")
        self._clean(name)

    def _clean(self, current: str) -> None:
        """Drop versions that are neither current nor among the latest before it, and directories no version points into."""
        names = sorted(r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {self.db}").collect()
                       if r["tableName"].startswith(f"{self.table}__v"))
        number = lambda n: n.split("__v")[1][:6]
        older = [n for n in names if number(n) < number(current)]
        keep = {current, *(older[-KEEP_OLD:] if KEEP_OLD else [])}
        for n in set(names) - keep:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.db}.{n}")
            self._delete(f"_manifests/{n}")
        used = {d.rstrip("/").rsplit("/", 2)[1] for n in keep for d in self.manifest(n).values()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        for st in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path):
            name = st.getPath().getName()
            if not name.startswith("_") and name not in used:
                self._delete(name)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    # ---------------------------------------------------------------- loads
    def load(self, batch: DataFrame, live: DataFrame | None = None, live_key: str = "id",
             batch_rows: int | None = None, allow_empty: bool = True) -> Load:
        """Replace the rows whose key is in ``batch`` by the batch's (all of them, where it has a key twice), then
        delete the rows whose key is not ``live`` (null keys never are).  Without ``live`` nothing is deleted.

        The batch and the live keys are dealt into the table's buckets first; after that, the table, the batch
        and the live keys join bucket by bucket without an exchange.  Only slots that hold a key of the batch or
        a row to delete are written, and a load that finds none writes no version.
        """
        from ledgerlake.operators.load import EmptyLiveSet

        if self.buckets is None:
            self.buckets = bucket_count(batch_rows if batch_rows is not None else batch.count())
        target, staged = self.read(), []
        fields = self._fields(target if target is not None else batch)
        try:
            new, _, new_facts = self.stage(batch.select(*(target if target is not None else batch).columns), "batch")
            staged.append(new_facts)
            alive = None
            if live is not None:
                keys = live.select(F.col(live_key).alias(self.key)).filter(F.col(self.key).isNotNull()).distinct()
                alive, _, facts = self.stage(keys, "live")
                staged.append(facts)
                if not allow_empty and not facts["rows"]:
                    raise EmptyLiveSet("no live ids; pass allow_empty=True to delete every row")
            touched = {r[SLOT] for r in new.select(SLOT).distinct().collect()}
            parts = [new] if target is None else [self.kept(new), new]
            deleted = 0
            if alive is not None:
                gone = [by_bucket(x.select(self.key, SLOT), alive.select(self.key), self.key, "left_anti") for x in parts]
                for r in reduce(DataFrame.unionByName, gone).groupBy(SLOT).agg(F.count(F.lit(1)).alias("n")).collect():  # one row a slot
                    touched.add(r[SLOT])
                    deleted += r["n"]
            if not touched and target is not None:
                return Load(0, 0, ())
            slots = sorted(touched)
            rows = reduce(DataFrame.unionByName, self.next_rows(new, alive, slots))
            _, dirs, facts = self.stage(rows.drop(SLOT), "slots", dealt=True)
            staged.append(facts)
            manifest = {s: d for s, d in self.manifest().items() if s not in touched} | dirs
            untouched = 0 if target is None else self.rows() - self.rows_in(slots)
            wm = max(filter(None, (self.watermark(), facts.get("wm"))), default=None)
            self._commit(fields, manifest, untouched + int(facts["rows"]), wm)
            return Load(int(new_facts["rows"]), deleted, tuple(slots))
        finally:
            for facts in staged:
                self.unstage(facts)

    def rows_in(self, slots: list[int]) -> int:
        """Rows of some slots (parquet footers only)."""
        df = self.read(slots)
        return 0 if df is None else df.count()

    def kept(self, new: DataFrame, slots: list[int] | None = None) -> DataFrame:
        """Rows of the table (of some slots) that the batch ``new`` does not replace, with their slot."""
        old = self.spark.table(f"{self.db}.{self.head()['name']}")
        if slots is not None:
            old, new = old.filter(F.col(SLOT).isin(slots)), new.filter(F.col(SLOT).isin(slots))
        return by_bucket(old, new.select(self.key), self.key, "left_anti")

    def next_rows(self, new: DataFrame, alive: DataFrame | None, slots: list[int]) -> list[DataFrame]:
        """What the slots hold after a load: the rows kept, and the batch's, both less what is not ``alive``."""
        parts = [self.kept(new, slots)] if self.head() else []
        parts.append(new.filter(F.col(SLOT).isin(slots)))
        if alive is None:
            return parts
        alive = alive.filter(F.col(SLOT).isin(slots)).select(self.key)
        return [by_bucket(x, alive, self.key, "left_semi") for x in parts]

    def replace(self, rows: DataFrame, buckets: int | None = None) -> None:
        """Write the whole table anew (a change to every row), with another number of buckets if asked for."""
        if buckets:
            self.buckets = buckets
        if self.buckets is None:
            self.buckets = bucket_count(rows.count())
        _, dirs, facts = self.stage(rows, "slots")
        try:
            self._commit(self._fields(rows), dirs, int(facts["rows"]), facts.get("wm"))
        finally:
            self.unstage(facts)


def by_bucket(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Both sides lie in the same buckets: merged where they are."""
    return left.join(right.hint("merge"), key, how)
