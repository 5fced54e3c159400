"""Versioned tables (K8, K9): plain Spark catalog tables over parquet.

Stock Spark cannot MERGE/UPDATE parquet or overwrite a path it is reading.
So every publish writes a directory of its own,
``<root>/<schema>/<table>/v=<n>-<random>``, and then repoints the catalog table
at it (``ALTER TABLE ... SET LOCATION``), which alone makes it current.  What is
recorded about a version (row count, watermark) is stored before that, under the
directory's name, and counts only while the table points there; so a job may
stop after any statement: readers see the old or the new version, a directory is
never written twice, and the next publish goes on from the one that is current.
Of versions no longer current the latest ``KEEP_OLD`` are kept, for readers that
still use them.  Reading a published table also cuts the lineage of its plan.

One writer per table.  The root must be a shared folder on a cluster.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.scalar import ts_literal
from ledgerlake.session import release_shuffles
from ledgerlake.spec import OPEN_END, VALID_FROM, VALID_TO

META_PROP = "ledgerlake.meta"              # directory name, rows and max(load_date) of a version, counted while writing
KEEP_OLD = 1
COMPRESSION = "zstd"                       # surrogate keys are hex text, which snappy leaves as long as it is
RELEASE_ROWS = 100_000                     # a write of so many rows may leave shuffle files worth giving back
ROWS_PROP = "ledgerlake.rows"              # of a snapshot
OPEN_ROWS_PROP = "ledgerlake.open_rows"
OPEN_RUN_PROP = "ledgerlake.open_run"
BEGUN_PROP = "ledgerlake.begun"            # versions that begin at the last run
SEGMENT = "scd2_segment"
OPEN_SEGMENT = "open"


@dataclass(frozen=True)
class Written:
    """A version that is written but not current."""

    path: str
    schema: StructType
    meta: str
    partition_by: tuple[str, ...]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


class TableStore:
    def __init__(self, spark: SparkSession, root: str,
                 schemas=("raw", "staging", "warehouse", "test_failures"), prefix: str = ""):
        """``prefix`` namespaces the databases (e.g. one store per test)."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        for s in schemas:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db(s)} LOCATION '{self.root}/_catalog/{s}'")

    def db(self, schema: str) -> str:
        return f"{self.prefix}{schema}"

    def bucketed(self, schema: str, table: str):
        """The table's bucketed form, if it is kept in buckets (see ``sources.buckets``)."""
        from ledgerlake.sources.buckets import BucketedTable
        if not self.spark.catalog.tableExists(f"{self.db(schema)}.{table}__head"):
            return None
        return BucketedTable(self, schema, table)

    def exists(self, schema: str, table: str) -> bool:
        return self.bucketed(schema, table) is not None or self.spark.catalog.tableExists(f"{self.db(schema)}.{table}")

    def location(self, schema: str, table: str) -> str | None:
        """Name of the current version's directory."""
        if not self.exists(schema, table) or self.bucketed(schema, table):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.db(schema)}.{table}").filter("col_name = 'Location'").collect()
        return rows[0]["data_type"].rstrip("/").rsplit("/", 1)[-1]

    def version(self, schema: str, table: str) -> int | None:
        """The current version's number, from its directory."""
        name = self.location(schema, table)
        return int(name[2:].split("-")[0]) if name and name.startswith("v=") else None

    def path(self, schema: str, table: str, version: int) -> str:
        """A new directory for a version; no two writes share one."""
        return f"{self.root}/{schema}/{table}/v={version:06d}-{uuid.uuid4().hex[:8]}"

    def _meta(self, schema: str, table: str) -> dict:
        """What was recorded about the current version; nothing, if the record
        belongs to a publish that did not end."""
        name = self.location(schema, table)
        meta = json.loads(self._props(f"{self.db(schema)}.{table}").get(META_PROP, "{}")) if name else {}
        return meta if meta.get("dir") == name else {}

    def read(self, schema: str, table: str) -> DataFrame | None:
        if not self.exists(schema, table):
            return None
        if (b := self.bucketed(schema, table)) is not None:
            return b.read()
        return self.spark.table(f"{self.db(schema)}.{table}")

    def read_or_empty(self, schema: str, table: str, struct: StructType) -> DataFrame:
        df = self.read(schema, table)
        return df if df is not None else self.spark.createDataFrame([], struct)

    def write(self, df: DataFrame, schema: str, table: str, partition_by: list[str] | None = None) -> Written:
        """Write ``df`` as a version that is not current yet."""
        p = self.path(schema, table, (self.version(schema, table) or 0) + 1)
        obs = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        if "load_date" in df.columns:
            metrics.append(F.max("load_date").cast("string").alias("wm"))
        w = df.observe(obs, *metrics).write.option("compression", COMPRESSION)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(p)
        got = obs.get
        if int(got["rows"]) >= RELEASE_ROWS:
            release_shuffles(self.spark)
        meta = {"dir": p.rsplit("/", 1)[-1], "rows": int(got["rows"])} | ({"wm": got["wm"] or ""} if "wm" in got else {})
        return Written(p, df.schema, json.dumps(meta), tuple(partition_by or ()))

    def commit(self, w: Written, schema: str, table: str) -> int:
        """Make a written version current, and drop versions past ``KEEP_OLD``."""
        name = f"{self.db(schema)}.{table}"
        if not self.exists(schema, table):
            parts = f"PARTITIONED BY ({', '.join(w.partition_by)}) " if w.partition_by else ""
            fields = ([f for f in w.schema.fields if f.name not in w.partition_by]
                      + [f for f in w.schema.fields if f.name in w.partition_by])
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet {parts}LOCATION '{w.path}' "
                           f"TBLPROPERTIES ('{META_PROP}' = '{w.meta}')")
        else:
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{META_PROP}' = '{w.meta}')")
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{w.path}'")
        if w.partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        self.spark.catalog.refreshTable(name)
        self._drop_old(schema, table)
        return self.version(schema, table)

    def _drop_old(self, schema: str, table: str) -> None:
        """Delete what is neither current nor among the ``KEEP_OLD`` versions
        before it (a later number is a publish that did not end)."""
        jvm, jsc = self.spark._jvm, self.spark._jsc
        top = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{schema}/{table}")
        fs = top.getFileSystem(jsc.hadoopConfiguration())
        current = self.location(schema, table)
        names = sorted(st.getPath().getName() for st in fs.listStatus(top) if st.getPath().getName().startswith("v="))
        old = [n for n in names if n < current and n.split("-")[0] != current.split("-")[0]]
        for n in set(names) - {current} - set(old[-KEEP_OLD:] if KEEP_OLD else []):
            fs.delete(jvm.org.apache.hadoop.fs.Path(top, n), True)

    def publish(self, df: DataFrame, schema: str, table: str, partition_by: list[str] | None = None) -> int:
        """Write ``df`` as the next version and make it current."""
        if (b := self.bucketed(schema, table)) is not None:
            b.replace(df)
            return b.head()["number"]
        return self.commit(self.write(df, schema, table, partition_by), schema, table)

    def watermark(self, schema: str, table: str) -> tuple[bool, str | None]:
        """(known, max(load_date)) recorded when the current version was
        written; an empty table records an empty value (no watermark)."""
        if not self.exists(schema, table):
            return True, None
        if (b := self.bucketed(schema, table)) is not None:
            return True, b.watermark()
        meta = self._meta(schema, table)
        return "wm" in meta, meta.get("wm") or None

    def rows(self, schema: str, table: str) -> int | None:
        """Row count recorded when the current version was written (no job)."""
        if not self.exists(schema, table):
            return None
        if (b := self.bucketed(schema, table)) is not None:
            return b.rows()
        props = self._props(f"{self.db(schema)}.{table}")
        if ROWS_PROP in props:                       # a snapshot
            return int(props[ROWS_PROP])
        return self._meta(schema, table).get("rows")

    def count(self, schema: str, table: str) -> int:
        """Row count of the current version (parquet footers only)."""
        df = self.read(schema, table)
        return 0 if df is None else df.count()

    # ------------------------------------------------------------ snapshots
    # A snapshot table is partitioned by ``scd2_segment``: 'open' holds the
    # current versions and is repointed to a new directory on every run;
    # 'c<run_id>' holds the versions closed by that run, written once.  A run
    # reads only the open partition and writes open versions + its closures,
    # so its cost does not grow with the length of the history.
    #
    # Commit order: write both directories (in one pass) -> add the closed partition ->
    # repoint 'open' -> record ``open_run``.  A closed partition newer than
    # ``open_run`` belongs to an unfinished run and is dropped on the next
    # publish (its versions are still open in 'open'); a run already recorded
    # is not applied twice.

    def _props(self, name: str) -> dict:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}

    def _segments(self, name: str) -> set[str]:
        return {r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}

    def snapshot_open_run(self, table: str) -> int | None:
        if not self.exists("warehouse", table):
            return None
        v = self._props(f"{self.db('warehouse')}.{table}").get(OPEN_RUN_PROP)
        return int(v) if v is not None else None

    def publish_snapshot(self, changes: DataFrame | Iterable[DataFrame], table: str, run_id: int,
                         run_ts: str | None = None) -> bool:
        """Commit one run of a snapshot: ``changes`` holds the open versions
        after the run and the versions it closed, as a whole or in parts that
        are written one after another.  Returns False when this run
        was already committed (nothing is written).  With ``run_ts`` the versions
        that begin at the run are counted while they are written."""
        name = f"{self.db('warehouse')}.{table}"
        base = f"{self.root}/warehouse/{table}"
        parts = iter([changes] if isinstance(changes, DataFrame) else changes)
        first = None
        if not self.exists("warehouse", table):
            first = next(parts)
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({cols}, {SEGMENT} STRING) USING parquet "
                           f"PARTITIONED BY ({SEGMENT}) LOCATION '{base}/_table' "
                           f"TBLPROPERTIES ('{OPEN_RUN_PROP}' = '0')")
        done = int(self._props(name).get(OPEN_RUN_PROP, "0"))
        if run_id <= done:
            return False
        segments = self._segments(name)
        for seg in segments:                                  # roll back an unfinished run
            if seg.startswith("c") and int(seg[1:]) > done:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({SEGMENT} = '{seg}')")
        props = self._props(name)
        closed_before = int(props.get(ROWS_PROP, "0")) - int(props.get(OPEN_ROWS_PROP, "0"))
        # one pass writes both segments: a cache of the rows would be spilled beside what is written
        is_open = F.col(VALID_TO) == ts_literal(OPEN_END)
        begins = F.col(VALID_FROM) == ts_literal(run_ts) if run_ts else F.lit(False)
        segment = F.when(is_open, F.lit(OPEN_SEGMENT)).when(~is_open, F.lit(f"c{run_id}"))
        run_dir = f"{base}/run={run_id}"
        closed_dir, open_dir = f"{run_dir}/{SEGMENT}=c{run_id}", f"{run_dir}/{SEGMENT}={OPEN_SEGMENT}"
        n = n_open = begun = 0
        for i, part in enumerate(parts if first is None else chain([first], parts)):
            ob = Observation()
            (part.withColumn(SEGMENT, segment).filter(F.col(SEGMENT).isNotNull())
                 .observe(ob, F.count(F.lit(1)).alias("n"), F.count_if(is_open).alias("open"), F.count_if(begins).alias("begun"))
                 .write.mode("append" if i else "overwrite").option("partitionOverwriteMode", "static")
                 .option("compression", COMPRESSION).partitionBy(SEGMENT).parquet(run_dir))
            got = ob.get
            n, n_open, begun = n + int(got["n"]), n_open + int(got["open"]), begun + int(got["begun"])
            if int(got["n"]) >= RELEASE_ROWS:
                release_shuffles(self.spark)
        self._make_dirs(closed_dir, open_dir)                 # a segment without rows
        n_total = closed_before + n
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({SEGMENT} = 'c{run_id}') "
                       f"LOCATION '{closed_dir}'")
        if OPEN_SEGMENT in segments:
            self.spark.sql(f"ALTER TABLE {name} PARTITION ({SEGMENT} = '{OPEN_SEGMENT}') SET LOCATION '{open_dir}'")
        else:
            self.spark.sql(f"ALTER TABLE {name} ADD PARTITION ({SEGMENT} = '{OPEN_SEGMENT}') LOCATION '{open_dir}'")
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{OPEN_RUN_PROP}' = '{run_id}', "
                       f"'{ROWS_PROP}' = '{n_total}', '{OPEN_ROWS_PROP}' = '{n_open}', "
                       f"'{BEGUN_PROP}' = '{begun if run_ts else ''}')")
        self.spark.catalog.refreshTable(name)
        return True

    def _make_dirs(self, *paths: str) -> None:
        for path in paths:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(p)

    def snapshot_begun(self, table: str, run_id: int) -> int | None:
        """Versions that begin at the run, counted when it wrote them; None if this run is not the last one or was not counted."""
        if self.snapshot_open_run(table) != run_id:
            return None
        v = self._props(f"{self.db('warehouse')}.{table}").get(BEGUN_PROP)
        return int(v) if v else None

    def read_closed(self, table: str, run_id: int) -> DataFrame:
        """The versions that one run closed: its own partition alone."""
        df = self.read("warehouse", table)
        return df.filter(F.col(SEGMENT) == f"c{run_id}").drop(SEGMENT)

    def snapshot_open_rows(self, table: str) -> int | None:
        """Open versions of the current snapshot (recorded when committed)."""
        if not self.exists("warehouse", table):
            return None
        v = self._props(f"{self.db('warehouse')}.{table}").get(OPEN_ROWS_PROP)
        return int(v) if v is not None else None

    def read_snapshot(self, table: str, open_only: bool = False) -> DataFrame | None:
        """The whole history (or, pruned to one partition, the open versions)."""
        df = self.read("warehouse", table)
        if df is None:
            return None
        if open_only:
            df = df.filter(F.col(SEGMENT) == OPEN_SEGMENT)
        return df.drop(SEGMENT)
