"""Tables in parts: a change rewrites the parts that it touches and leaves the files of all others alone.

The rows of a part written by commit n lie in ``data/<part column>=<value>/commit=<n>``. After them one small file,
``commits/<n>.json``, is written: it names for every part the commit that holds its present rows. Readers follow the newest such file,
so they see a commit whole or not at all. A commit that runs again replaces its own folders and file, and builds on the commit before it,
so it may be repeated after a failure. Only names of parts pass through the driver: choose parts that the calendar or a number of buckets bounds.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Folder

COMMIT = "commit"


class PartTable:
    """``ddl`` names all columns, the part column among them. Parts are strings, dates or whole numbers, not NULL."""

    def __init__(self, spark: SparkSession, path: str, ddl: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.schema = T.StructType.fromDDL(ddl)
        self.files = Folder(spark, path)

    def commits(self) -> list[int]:
        """Commits that have ended, in order."""
        return self.files.numbers("commits")

    def parts(self, before: int | None = None) -> dict[str, int]:
        """The commit that holds each part, at present or before a commit."""
        usable = [c for c in self.commits() if before is None or c < before]
        return json.loads(self.files.text(f"commits/{usable[-1]}.json")) if usable else {}

    def read(self, parts: Iterable | None = None, before: int | None = None) -> DataFrame:
        """The present rows, or those before a commit; of some parts only those folders are opened."""
        held = self.parts(before)
        if parts is not None:
            wanted = {str(p) for p in parts}
            held = {p: c for p, c in held.items() if p in wanted}
        if not held:
            return self._none()
        paths = [f"{self.path}/data/{self._folder(p)}/{COMMIT}={c}" for p, c in sorted(held.items())]
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*paths)
        if parts is not None:
            kind = self.schema[self.part].dataType
            rows = rows.where(F.col(self.part).isin([F.lit(p).cast(kind) for p in sorted(held)]))
        return rows.select(*self.schema.fieldNames())

    def _none(self) -> DataFrame:
        """No rows, in a form that the optimizer knows to be empty."""
        return self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]).limit(0)

    def _folder(self, part: str) -> str:
        return f"{self.part}={self.files.escape(part)}"

    def replace(self, rows: DataFrame, parts: Iterable, commit: int | None = None) -> int:
        """Make ``rows`` the rows of ``parts``; a part without rows goes. Rows of other parts are left out. Returns the commit."""
        done = self.commits()
        commit = (done[-1] + 1 if done else 0) if commit is None else commit
        wanted = sorted({str(p) for p in parts})
        held = {p: c for p, c in self.parts(before=commit).items() if p not in set(wanted)}
        there = set(self.files.names("data"))
        for p in wanted:  # left by a commit that runs again
            if self._folder(p) in there:
                self.files.delete(f"data/{self._folder(p)}/{COMMIT}={commit}")
        own = rows.where(F.col(self.part).cast("string").isin(wanted)).select(*self.schema.fieldNames())
        # One task writes a part, so its files are few.
        own.withColumn(COMMIT, F.lit(commit).cast("bigint")).repartition(self.part).write.partitionBy(self.part, COMMIT).mode("append").parquet(f"{self.path}/data")
        held |= {p: commit for p in wanted if self.files.exists(f"data/{self._folder(p)}/{COMMIT}={commit}")}
        self.files.publish("commits", f"{commit}.json", json.dumps(held, sort_keys=True))
        return commit

    def change(self, touched: Iterable, build: Callable[[DataFrame], DataFrame], commit: int | None = None) -> int:
        """Replace parts by what ``build`` makes of their rows."""
        touched = list(touched)
        return self.replace(build(self.read(touched, before=commit)), touched, commit)

    def clean(self, keep: int = 2) -> None:
        """Delete the lists and folders that none of the newest ``keep`` commits uses. Two let the newest one run again."""
        done = self.commits()
        used = {(p, c) for n in done[-keep:] for p, c in self.parts(before=n + 1).items()}
        if not done:
            return
        for folder in self.files.names("data"):
            if not folder.startswith(f"{self.part}="):
                continue
            part = self.files.unescape(folder.split("=", 1)[1])
            for own in self.files.names(f"data/{folder}"):
                if own.startswith(f"{COMMIT}=") and int(own.split("=")[1]) <= done[-1] and (part, int(own.split("=")[1])) not in used:
                    self.files.delete(f"data/{folder}/{own}")
        for n in done[:-keep]:
            self.files.delete(f"commits/{n}.json")


class BucketTable:
    """A keyed table in buckets of its keys. UPDATE, DELETE and upserts rewrite only the buckets that hold a changed row."""

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, path: str, ddl: str, keys: Sequence[str], buckets: int = 64):
        self.keys, self.buckets = list(keys), buckets
        self.table = PartTable(spark, path, f"{ddl}, {self.BUCKET} int", self.BUCKET)
        self.columns = [c for c in self.table.schema.fieldNames() if c != self.BUCKET]

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def read(self) -> DataFrame:
        return self.table.read().select(*self.columns)

    def load(self, df: DataFrame) -> None:
        """Replace all rows."""
        self.table.replace(self.bucketed(df), range(self.buckets))

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self.BUCKET).distinct().collect())

    def update(self, set_values: dict[str, Column] | None = None, where: Column | None = None, delete_where: Column | None = None) -> list[int]:
        """UPDATE ... SET ... WHERE, then DELETE ... WHERE (which sees the new values). Returns the buckets that were rewritten."""
        from ..operators.changes import apply_changes

        def changed(rows: DataFrame) -> DataFrame:
            return apply_changes(rows, set_values, where, delete_where)

        hit = F.lit(False)
        if set_values:
            hit = hit | (F.lit(True) if where is None else F.coalesce(where, F.lit(False)))
        rows = self.table.read()
        if delete_where is not None:
            # What goes is known after the update.
            flagged = apply_changes(rows.withColumn("_hit", hit), set_values, where)
            found = flagged.where(F.col("_hit") | F.coalesce(delete_where, F.lit(False)))
        else:
            found = rows.where(hit)
        touched = self._touched(found)
        if touched:
            self.table.change(touched, changed)
        return touched

    def upsert(self, updates: DataFrame, deletes: DataFrame | None = None) -> list[int]:
        """Rows of ``updates`` replace or join those of the same keys; keys in ``deletes`` go. Returns the buckets that were rewritten."""
        from ..operators.changes import upsert

        gone = updates.select(*self.keys).limit(0) if deletes is None else deletes.select(*self.keys)
        touched = self._touched(self.bucketed(updates.select(*self.keys).unionByName(gone)))
        if touched:
            self.table.change(touched, lambda old: self.bucketed(upsert(old.select(*self.columns), updates, gone, self.keys)))
        return touched
