"""Sinks (A6-A11, A16, A18, J6).

``KeyedTable`` is the idempotent "bulk save by id into a day slice": a
Parquet table where each key has one current row.  It is merge-on-read: a
micro-batch writes only its own rows, into a new folder, partitioned by the
slice (a day, say), and a commit puts that folder in the place of the one
that the same (writer, batch id) wrote before.  So a replayed batch leaves
exactly what it wrote last, a write costs the size of the batch, and readers
see a batch whole or not at all, and a replay as old or new.  Readers resolve
the current row per key (partial aggregate on the key); a filter on the slice
column prunes folders before that.  Folders are merged by levels: ``FANOUT``
of one level become one of the next, so a table of n batches has about
``FANOUT * log(n)`` folders and each row is rewritten ``log(n)`` times.

``TopicFiles`` is a topic on files: each micro-batch is written into the
folder of its (writer, batch id), with the same replay rule.  ``KafkaTopic``
takes the same messages to Kafka where the connector is available.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.streaming.commits import CommitLog

ADAPTIVE, SKIPPED_RULES = "spark.sql.adaptive.enabled", "spark.sql.adaptive.optimizer.excludedRules"
EMPTY_RULE = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a file or folder is there, on any file system that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def writer_tag(checkpoint: str) -> str:
    """A short stable tag for the query writing a table (its checkpoint):
    batch ids restart at 0 on a new checkpoint, so folders are keyed by
    (writer, batch id)."""
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:10]


class KeyedTable:
    """A table with one current row per ``keys``, partitioned by the
    writing batch and by ``slice_col`` (a function of the key).

    Competing rows of one key are ordered by ``order_cols`` (the source's
    own order: record time, partition, offset) and then by ``_version``, the
    time at which their batch was written; the greatest wins.  Batch ids
    don't take part: they restart at 0 on a new checkpoint.  Deletes are
    tombstones (``_deleted``), so they are upserts too and replay the same way.
    """

    VERSION, DELETED, BATCH = "_version", "_deleted", "_batch"
    FANOUT = 8

    def __init__(self, spark: SparkSession, path: str, keys: list[str], slice_col: str,
                 order_cols: list[str] | None = None, slice_expr=None, keep: str = "latest",
                 compact: bool = True):
        """``slice_expr`` derives the storage slice from other columns when
        the batch lacks ``slice_col`` (e.g. the month of a day).

        ``keep='latest'`` lets the greatest ``order_cols`` win (then the
        batch written last); ``keep='earliest'`` keeps the smallest
        ``order_cols`` whatever batch brought it (a first-visit table), so
        replays, restarts without state and late arrivals can never replace
        an earlier row.  ``compact=False`` leaves merging to calls of
        :meth:`compact` (a maintenance job, say).
        """
        if keep not in ("latest", "earliest"):
            raise ValueError(keep)
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.slice_col = keys, slice_col
        self.order_cols = order_cols or []
        self.slice_expr = slice_expr
        self.keep = keep
        self.data_path = f"{self.path}/data"
        self.commits = CommitLog(spark, self.path)
        self.merging = compact

    # ------------------------------------------------------------ reading

    # A folder's name is ``<level>.<writer and batch id>.<attempt>``.

    @staticmethod
    def _tag(batch_id: int, writer: str) -> str:
        return f"b{writer}_{batch_id:012d}"

    @staticmethod
    def _tag_of(folder: str) -> str:
        return folder.split(".", 1)[1].rsplit(".", 1)[0]

    def _folder(self, name: str) -> str:
        return f"{self.data_path}/{self.BATCH}={name}"

    def _rows(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        # Slice values are text; undo partition-value type inference
        # (a day such as 2024-01-15 would come back as a date).
        df = self.spark.read.option("basePath", self.data_path).parquet(*[self._folder(f) for f in folders])
        return df.withColumn(self.slice_col, F.col(self.slice_col).cast("string")).drop(self.BATCH)

    def _raw(self, but: str | None = None) -> DataFrame | None:
        """Every stored row version, without those of the batch ``but``."""
        return self._rows([f for f in self.commits.live()[1] if self._tag_of(f) != but])

    def read(self) -> DataFrame | None:
        """The current row per key, tombstones and ``_version`` included."""
        raw = self._raw()
        return None if raw is None else self._resolve(raw)

    def read_but(self, batch_id: int, writer: str = "") -> DataFrame | None:
        """The current row per key as it is without one batch, so that a replay of the
        batch can start from what its first run started from."""
        raw = self._raw(self._tag(batch_id, writer))
        return None if raw is None else self._resolve(raw)

    def table(self) -> DataFrame:
        """The current rows, without tombstones and bookkeeping columns."""
        df = self.read()
        if df is None:
            raise FileNotFoundError(self.data_path)
        return df.where(~F.col(self.DELETED)).drop(self.VERSION, self.DELETED)

    def field(self, name: str, slice_value: str) -> DataFrame:
        """One field of the current rows of a slice (its folders only)."""
        return self.table().where(F.col(self.slice_col) == slice_value).select(name)

    def _resolve(self, raw: DataFrame) -> DataFrame:
        """Latest (or earliest) row per key.  The slice column is grouped on
        as well (it is a function of the key), so a slice filter on the
        result is pushed below the aggregate into the scan."""
        group = self.keys + ([self.slice_col] if self.slice_col not in self.keys else [])
        order = [c for c in self.order_cols if c not in (self.VERSION, *group)]
        if self.keep == "earliest":
            # Tombstones sort first among equals so a delete still wins.
            rest = [c for c in raw.columns if c not in group and c not in order]
            pick = F.min(F.struct(*order, (~F.col(self.DELETED)).alias("_live"), *rest))
        else:
            order = [*order, self.VERSION]
            rest = [c for c in raw.columns if c not in group and c not in order]
            pick = F.max(F.struct(*order, *rest))
        agg = raw.groupBy(*group).agg(pick.alias("_l"))
        return agg.select(*group, *[F.col(f"_l.{c}").alias(c) for c in order + rest])

    # ------------------------------------------------------------ writing

    def upsert(self, batch: DataFrame, batch_id: int, writer: str = "") -> None:
        """Write ``batch`` as the rows of (``writer``, ``batch_id``);
        replaying the same batch id replaces all of them, in one commit."""
        if self.slice_col not in batch.columns and self.slice_expr is not None:
            batch = batch.withColumn(self.slice_col, self.slice_expr)
        batch = batch.withColumn(self.VERSION, F.lit(time.time_ns() // 1000).cast("long"))
        if self.DELETED not in batch.columns:
            batch = batch.withColumn(self.DELETED, F.lit(False))
        tag = self._tag(batch_id, writer)
        name = self._store(batch, f"0.{tag}")
        self.commits.commit(lambda live: [f for f in live if self._tag_of(f) != tag] + name)
        if self.merging:
            self.compact()

    def _store(self, rows: DataFrame, prefix: str) -> list[str]:
        """Write rows into a new folder, not yet part of the table; none if there are no rows."""
        name = f"{prefix}.{uuid.uuid4().hex[:12]}"
        # Rebalance on the slice: AQE packs small slices into one file and
        # splits a hot slice over several tasks, so a day holding a third
        # of the rows is not written by one task.
        # Only AQE does that, and a stateful query's batches have it off (their state's
        # partitions are fixed, and made by then): without it a slice is one task.  It must
        # not cut an empty plan short, as the plan's observed counts would be missing then.
        conf = rows.sparkSession.conf
        skipped = conf.get(SKIPPED_RULES, None)
        before = {ADAPTIVE: conf.get(ADAPTIVE), SKIPPED_RULES: skipped}
        conf.set(ADAPTIVE, "true")
        conf.set(SKIPPED_RULES, f"{skipped},{EMPTY_RULE}" if skipped else EMPTY_RULE)
        try:
            rows.hint("rebalance", self.slice_col).write.partitionBy(self.slice_col).parquet(self._folder(name))
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(name))
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return [name] if any(s.isDirectory() and "=" in s.getPath().getName() for s in found) else []

    # ------------------------------------------------------------ maintenance

    def _mergeable(self, live: list[str]) -> list[str]:
        """``FANOUT`` or more folders of one level, the lowest that has so many.  The last
        batch of each writer stays as it is, since it may be replayed."""
        last: dict[str, str] = {}
        for f in live:
            if f.startswith("0."):
                writer = self._tag_of(f)[:-13]
                last[writer] = max(last.get(writer, ""), self._tag_of(f))
        levels = defaultdict(list)
        for f in live:
            if not (f.startswith("0.") and self._tag_of(f) in last.values()):
                levels[int(f.split(".", 1)[0])].append(f)
        return next((levels[k] for k in sorted(levels) if len(levels[k]) >= self.FANOUT), [])

    def compact(self) -> None:
        """Merge folders of a level into one of the next, until no level has ``FANOUT``: the
        current row per key among them, tombstones included.  Readers go on with what they
        have; if a folder was replaced meanwhile, the merged one isn't committed."""
        while old := self._mergeable(self.commits.live()[1]):
            level = int(old[0].split(".", 1)[0]) + 1
            new = self._store(self._resolve(self._rows(old)), f"{level}.c")
            live = self.commits.commit(
                lambda now: [f for f in now if f not in old] + new if set(old) <= set(now) else now)
            if not set(new) <= set(live):
                return

    def vacuum(self, hours: float = 24) -> int:
        """Delete folders that no kept commit names and that are older than ``hours`` (longer
        than any reader or writer needs); returns their number."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.data_path)
        fs, kept, n = path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.commits.kept(), 0
        for s in fs.listStatus(path) if fs.exists(path) else []:
            name = s.getPath().getName().removeprefix(f"{self.BATCH}=")
            if s.isDirectory() and name not in kept and s.getModificationTime() < (time.time() - hours * 3600) * 1000:
                n += bool(fs.delete(s.getPath(), True))
        return n

    def delete(self, ids: DataFrame, batch_id: int, writer: str = "") -> None:
        """A19 on the stored table: tombstone the rows of the given keys."""
        cur = self.read()
        if cur is None:
            return
        hit = cur.join(ids.select(*self.keys).distinct(), self.keys, "left_semi")
        self.upsert(hit.withColumn(self.DELETED, F.lit(True)), batch_id, writer)

    def copy_to(self, target: "KeyedTable") -> None:
        """Maintenance: the current rows as one batch of a fresh table.  This
        one stays as it is, so its readers aren't disturbed; switch to the
        copy when it is complete."""
        rows = self.read()
        if rows is not None:
            target.upsert(rows, 0, "copy")


class TopicFiles:
    """A6-A8 on files: messages ``topic, value`` (+ any columns) stored
    under ``batch=<writer>_<id>/topic=<name>``; readable as a stream source."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write_batch(self, messages: DataFrame, batch_id: int, writer: str = "") -> None:
        """Replaces the batch's folder as a whole, topics that a replay no
        longer has included."""
        (messages.write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("topic").parquet(f"{self.path}/batch=b{writer}_{batch_id:012d}"))

    def read(self, topic: str | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path).drop("batch")
        return df if topic is None else df.where(F.col("topic") == topic)


class KafkaTopic:
    """A6-A8 on Kafka: each message to the topic it names, ``key`` kept when
    there is one; an idempotent producer that waits for all replicas.  A
    replayed batch is sent again (consumers see at-least-once)."""

    def __init__(self, bootstrap: str, **options: str):
        self.options = {"kafka.bootstrap.servers": bootstrap, "kafka.acks": "all",
                        "kafka.enable.idempotence": "true", **options}

    @staticmethod
    def messages(messages: DataFrame) -> DataFrame:
        """The columns that Kafka takes: topic, value and, if given, key."""
        columns = ["topic", *(["key"] if "key" in messages.columns else []), "value"]
        return messages.select(*[F.col(c).cast("string") for c in columns])

    def write_batch(self, messages: DataFrame, batch_id: int, writer: str = "") -> None:
        self.messages(messages).write.format("kafka").options(**self.options).save()
