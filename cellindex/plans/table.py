"""The index as plain Parquet tables: an appended changelog, and a base in buckets of rows.

Batches are known by their subscription and number. Every attempt to write one
goes to a folder of its own, and counts from the moment a small note names it; until
then readers see the attempt before it, whole. A base notes, for each
subscription, the last batch it holds, so batches of a new subscription are
never taken for old ones. Readers fold what came after the last base into it.

The base is partitioned by a hash of the row, and a compaction writes those buckets
anew that changed; a base is the newest folder of each bucket up to its number. All
changes of a document, and the deletes of its row, lie in one bucket. With a key
format of the user, whose ids may be the same for several rows, there is one bucket.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellindex.operators import changelog
from cellindex.spec import IndexSpec

DEFAULT_SUBSCRIPTION = "batches"
BATCHES = "subscription string, batch long, folder string, at long"
BASES = "base long, subscription string, upto long"
BUCKETS = "base long, bucket int, of int, folder string"


class IndexTable:
    """An index under ``path``. ``buckets`` counts when its first base is made; a bucket should fit a few tasks."""

    def __init__(self, spark: SparkSession, path: str, spec: IndexSpec, buckets: int = 16):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.multipart = spec.mapping == "row"
        self.buckets = buckets if spec.key_format in ("string", "hex") else 1

    def write_batch(
        self,
        changes: DataFrame,
        batch_id: int,
        subscription: str = DEFAULT_SUBSCRIPTION,
        observed: Mapping[str, Column] | None = None,
        counts: dict[str, int] | None = None,
    ) -> DataFrame:
        """Store the changes of one batch and return them; a batch written again replaces itself as a whole.

        ``observed`` names aggregates that Spark takes while it writes; their values go to ``counts``.
        """
        at = time.time_ns()
        folder = f"changes/{subscription}/{batch_id}-{uuid.uuid4().hex}"
        stamped = changes.withColumn("at", F.lit(at))
        watch = Observation(f"batch-{uuid.uuid4().hex}")
        if observed:
            stamped = stamped.observe(watch, *[c.alias(n) for n, c in observed.items()])
        stamped.write.parquet(f"{self.path}/{folder}")
        if observed and counts is not None:
            counts.update(watch.get)
        self._note("batches", BATCHES, [(subscription, batch_id, folder, at)])
        return self._stored([folder])

    def changes(self) -> DataFrame | None:
        """Stored changes that no base holds yet, quarantined documents included; None if there are none."""
        return self._changes(self._last_base())

    def _changes(self, base: list) -> DataFrame | None:
        folders = [r["folder"] for r in self._recent(base)]
        return self._stored(folders) if folders else None

    def quarantine(self) -> DataFrame | None:
        """Bad documents that no later change has replaced, with their faults; None if nothing was written."""
        base = self._last_base()
        rows = [x for x in (self._base(base), self._changes(base)) if x is not None]
        if not rows:
            return None
        every = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        return changelog.pending_faults(every, self.multipart).groupBy("id", "seq").agg(F.max("error").alias("error"))

    def bases(self) -> DataFrame | None:
        """Per finished compaction and subscription the last batch it holds."""
        return self._read("bases", BASES)

    def _schema(self) -> T.StructType:
        return changelog.change_schema(self.spark, self.spec)

    def _stored(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self._schema()).parquet(*[f"{self.path}/{f}" for f in folders])

    def _bucket(self, of: int) -> Column:
        return F.pmod(F.xxhash64("row_val"), F.lit(of)).cast("int").alias("bucket")

    def _places(self, base: list) -> list:
        """Where each bucket of a base lies: a small row for every bucket that has rows."""
        notes = self._read("buckets", BUCKETS) if base else None
        if notes is None:
            return []
        upto = notes.filter(F.col("base") <= base[0]["base"])
        return upto.groupBy("bucket", "of").agg(F.max_by("folder", "base").alias("folder")).collect()

    def _base(self, base: list, only: set[int] | None = None) -> DataFrame | None:
        """Rows of a base, those of some buckets alone if wanted; None if there are none."""
        folders = [f"{p['folder']}/bucket={p['bucket']}" for p in self._places(base) if only is None or p["bucket"] in only]
        return self._stored(folders) if folders else None

    def state(self, docs_only: bool = False) -> DataFrame:
        """Folded state of everything written so far, or only its documents."""
        base = self._last_base()
        log = self._changes(base)
        if log is None and not base:
            raise ValueError(f"nothing was written to {self.path}")
        old = self._base(base)
        if old is None and log is None:  # batches without any change
            old = self.spark.createDataFrame([], self._schema())
        return self._folded(old, log, docs_only)

    def _folded(self, old: DataFrame | None, log: DataFrame | None, docs_only: bool = False) -> DataFrame:
        if old is None:
            return changelog.fold(changelog.good(log), self.multipart, docs_only=docs_only)
        old = changelog.good(old)
        if log is None:
            return old.filter(F.col("kind") == changelog.UPSERT) if docs_only else old
        return changelog.apply_changes(old, changelog.good(log), self.multipart, docs_only=docs_only)

    def documents(self) -> DataFrame:
        return changelog.documents(self.state(docs_only=True), self.spec)

    def compact(self) -> int:
        """Fold all batches into the buckets they touch, note the new base once it is whole, and return its number."""
        base = self._last_base()
        recent = self._recent(base)
        if not recent:
            if not base:
                raise ValueError(f"nothing was written to {self.path}")
            return base[0]["base"]
        number = base[0]["base"] + 1 if base else 0
        places = self._places(base)
        of = places[0]["of"] if places else self.buckets
        log = self._stored([r["folder"] for r in recent])
        touched = {r["bucket"] for r in log.select(self._bucket(of)).distinct().collect()}  # numbers below ``of``
        if touched:
            old = self._base(base, touched)
            every = log if old is None else old.unionByName(log)
            whole = self._folded(old, log).unionByName(changelog.pending_faults(every, self.multipart), allowMissingColumns=True)
            folder = f"base/{number}-{uuid.uuid4().hex}"
            # Spread over tasks by bucket, large ones over several.
            placed = whole.withColumn("bucket", self._bucket(of)).hint("rebalance", "bucket")
            placed.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
            self._note("buckets", BUCKETS, [(number, b, of, folder) for b in sorted(touched)])
        upto = {r["subscription"]: r["upto"] for r in base}
        for r in recent:
            upto[r["subscription"]] = max(upto.get(r["subscription"], -1), r["batch"])
        self._note("bases", BASES, [(number, s, b) for s, b in sorted(upto.items())])
        return number

    def vacuum(self, keep: int = 1) -> int:
        """Delete what no reader of the last ``keep`` bases needs, and return the number of folders deleted.

        That is: batches that the oldest of these bases holds with their replaced attempts, and buckets written
        anew since. Attempts under way are kept, as their batches are in no base yet.
        """
        notes = self.bases()
        if notes is None:
            return 0
        newest = notes.agg(F.max("base")).first()[0]
        oldest = newest - keep + 1
        if oldest < 0:
            return 0
        held = notes.filter(F.col("base") == oldest).select("subscription", "upto")
        batches = self._read("batches", BATCHES).join(held, "subscription").filter("batch <= upto").select("folder")
        buckets = self._read("buckets", BUCKETS)
        gone = [r["folder"] for r in batches.distinct().collect()]  # a name for each batch since the last call
        if buckets is not None:
            live = buckets.filter(F.col("base") <= oldest).groupBy("bucket").agg(F.max("base").alias("base"))
            old = buckets.filter(F.col("base") <= oldest).join(live, ["bucket", "base"], "left_anti")
            gone += [f"{r['folder']}/bucket={r['bucket']}" for r in old.select("folder", "bucket").distinct().collect()]
        jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return sum(bool(p.getFileSystem(conf).delete(p, True)) for p in (jvm(f"{self.path}/{g}") for g in gone))

    def _recent(self, base: list) -> list:
        """Notes of the valid attempts of all batches after the last base: one small row each."""
        notes = self._read("batches", BATCHES)
        if notes is None:
            return []
        held = {r["subscription"]: r["upto"] for r in base}
        last = notes.groupBy("subscription", "batch").agg(F.max_by("folder", "at").alias("folder"))
        for subscription, upto in held.items():
            last = last.filter((F.col("subscription") != subscription) | (F.col("batch") > upto))
        return last.collect()

    def _last_base(self) -> list:
        """The notes of the newest base, one per subscription."""
        notes = self.bases()
        if notes is None:
            return []
        # Every base names all subscriptions so far, so the last note of each is that of the newest base.
        newest = notes.groupBy("subscription").agg(F.max(F.struct("base", "upto")).alias("last"))
        return newest.select("subscription", "last.*").collect()

    def _note(self, name: str, schema: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
