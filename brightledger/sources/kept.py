"""Tables with a kept history: a log of changes by commit day, and snapshots in between.

``append`` writes the rows of a commit (with ``op`` I, U or D) to ``log/commit_day=<day>/change_id=<n>``, every ``every`` commits also the whole table
to ``snapshots/change_id=<n>``, and then one small file that lists all commits. A commit that failed is not in the list and is written again. To read the table as of some moment,
the last commit and the nearest snapshot before it are looked up in that list; the rows are those of the snapshot and of the log folders after it, latest entry per
key, without deleted keys. So the work follows the table and the changes of a few commits, not the length of the history.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import latest_state, without_keys
from .files import Folder


class KeptTable:
    def __init__(self, spark: SparkSession, path: str, ddl: str, keys: Sequence[str], every: int = 16):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), list(keys), every
        self.schema = T.StructType.fromDDL(ddl)
        self.columns = self.schema.fieldNames()
        self.files = Folder(spark, path)

    def commits(self) -> list[dict]:
        """The commits in order: change_id, commit_ts, snapshot."""
        done = self.files.numbers("commits")
        return json.loads(self.files.text(f"commits/{done[-1]}.json")) if done else []

    def append(self, entries: DataFrame, commit_ts: str) -> int:
        """Add a commit: rows with ``op``. Commit times must not go back. Returns the number of the change."""
        done = self.commits()
        at = datetime.fromisoformat(commit_ts)
        if done and at < datetime.fromisoformat(done[-1]["commit_ts"]):
            raise ValueError(f"the last commit was at {done[-1]['commit_ts']}")
        change = done[-1]["change_id"] + 1 if done else 1
        entry = {"change_id": change, "commit_ts": at.isoformat(" "), "snapshot": False}
        entries.select(*self.columns, "op").write.mode("overwrite").parquet(f"{self.path}/{self._folder(entry)}")
        latest = max((c["change_id"] for c in done if c["snapshot"]), default=0)
        if change - latest >= self.every:
            self._state([*done, entry]).write.mode("overwrite").parquet(f"{self.path}/snapshots/change_id={change}")
            entry["snapshot"] = True
        self.files.publish("commits", f"{change}.json", json.dumps([*done, entry]))
        if change > 2:
            self.files.delete(f"commits/{change - 2}.json")
        return change

    @staticmethod
    def _folder(commit: dict) -> str:
        return f"log/commit_day={commit['commit_ts'][:10]}/change_id={commit['change_id']}"

    def _state(self, commits: list[dict]) -> DataFrame:
        """The table after these commits."""
        near = max((k for k, c in enumerate(commits) if c["snapshot"]), default=-1)
        tail = [f"{self.path}/{self._folder(c)}" for c in commits[near + 1 :]]
        wide = T.StructType([*self.schema.fields, T.StructField("op", T.StringType())])
        parts = []
        if near >= 0:
            whole = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/change_id={commits[near]['change_id']}")
            if not tail:
                return whole.select(*self.columns)
            parts.append(whole.select(*self.columns, F.lit("I").alias("op"), F.lit(0).alias("change_id")))
        if tail:
            log = self.spark.read.schema(wide).option("basePath", f"{self.path}/log").parquet(*tail)
            parts.append(log.select(*self.columns, "op", F.col("change_id").cast("int").alias("change_id")))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return latest_state(rows, self.keys, ["change_id"]).select(*self.columns)

    def current(self) -> DataFrame:
        return self._state(self.commits())

    def as_of(self, ts: str, offset_seconds: int = 0) -> DataFrame:
        """The table at a moment, or that many seconds after it (before, if negative)."""
        moment = datetime.fromisoformat(ts) + timedelta(seconds=offset_seconds)
        return self._state([c for c in self.commits() if datetime.fromisoformat(c["commit_ts"]) <= moment])

    def before_change(self, change_id: int) -> DataFrame:
        """The table just before a change."""
        return self._state([c for c in self.commits() if c["change_id"] < change_id])

    def restore(self, ts: str) -> DataFrame:
        """The present rows, and those of an earlier moment whose key is gone."""
        current = self.current()
        return current.unionByName(without_keys(self.as_of(ts), current, self.keys))
