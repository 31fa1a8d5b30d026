"""Tables of the layers in one root folder: how each is read and how each is published."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataledger import schemas
from strataledger.session import configure
from strataledger.sources.commits import Commits, ConcurrentRun, State
from strataledger.sources.files import local_frame, remove, written
from strataledger.sources.ledger import MERGED, IdLedger

# Partitions whose rows are counted while they are written; the rows of more are counted from the files' footers.
COUNTED = 800
# Appended batches of control rows that are merged into one.
APPENDED_BATCHES = 32


class Change:
    """Folders written for one commit. Nothing is visible before ``commit``."""

    def __init__(self, wh: Warehouse, run_id: str):
        self.wh, self.run_id = wh, run_id
        self.written: list[str] = []
        self._parts: list[tuple] = []
        self._snapshots: dict[str, str] = {}
        self._appended: dict[str, str] = {}
        self._merged: dict[str, list[str]] = {}

    def folder(self, name: str, key: str = "b") -> str:
        """A new folder below a table's."""
        folder = f"{name}/{key}={uuid.uuid4().hex}"
        self.written.append(folder)
        return folder

    def parts(self, rows: DataFrame, name: str, column: str, values: Iterable) -> dict:
        """Write partitions of a table; returns the row count of each. Values without rows lose their partition."""
        folder, values = self.folder(name), list(values)
        counts = self.wh.counted_write(rows, folder, [column], [(value,) for value in values])
        return self.place(name, folder, {value: counts[(value,)] for value in values})

    def place(self, name: str, folder: str, counts: dict) -> dict:
        """Partitions of a table that were written to ``folder``."""
        self._parts.append((name, folder, counts))
        return counts

    def snapshot(self, rows: DataFrame, name: str) -> int:
        self._snapshots[name] = folder = self.folder(name, "v")
        return self.wh.counted_write(rows, folder, [], [()])[()]

    def append(self, name: str, rows: list) -> None:
        if rows:
            self._appended[name] = folder = self.folder(name, "a")
            self.wh.frame(rows, self.wh.APPENDED[name]).coalesce(1).write.parquet(self.wh.path(folder))

    def merge(self, name: str) -> None:
        """All appended batches of control rows as one. The calendar and the number of runs bound their rows."""
        self._merged[name] = list(self.wh.state.appended[name])
        self._appended[name] = folder = self.folder(name, "a")
        self.wh.appended(name).coalesce(1).write.parquet(self.wh.path(folder))

    def following(self) -> State:
        """The state after this change."""
        state = self.wh.state.next(self.run_id)
        replaced: list[tuple] = []
        for name, folder, counts in self._parts:
            held = state.parts.setdefault(name, {})
            for value, count in counts.items():
                if old := held.pop(str(value), None):
                    replaced.append((old[0], f"{old[0]}/{self.wh.column(name)}={value}" if name != self.wh.LEDGER else None))
                if count:
                    held[str(value)] = [folder, count]
            state.sizes[folder] = sum(count > 0 for count in counts.values())
        for name, folder in self._snapshots.items():
            replaced += [(state.snapshots[name], None)] if name in state.snapshots else []
            state.snapshots[name] = folder
        for name, folder in self._appended.items():
            merged = self._merged.get(name, [])
            replaced += [(batch, None) for batch in merged]
            state.appended[name] = [batch for batch in state.appended.get(name, []) if batch not in merged] + [folder]
        current = state.folders()
        state.sizes = {folder: size for folder, size in state.sizes.items() if folder in current}
        # A folder goes as a whole once nothing names it, otherwise the replaced part of it.
        gone = {folder if folder not in current else part for folder, part in replaced} - {None}
        state.stale += [[self.run_id, folder] for folder in sorted(gone)]
        return state

    def commit(self) -> None:
        """Make everything that was written current at once."""
        only_rows = not self._parts and not self._snapshots and not self._merged
        while True:
            state = self.following()
            # What earlier runs replaced had readers until now; what this run replaced stays until the next one.
            gone = [folder for run, folder in state.stale if self.run_id and run != self.run_id]
            state.stale = [entry for entry in state.stale if entry[1] not in gone]
            try:
                self.wh.commits.claim(state)
                break
            except ConcurrentRun:
                if not only_rows:
                    self.abandon()
                    raise
                # Rows of a log follow whatever came before them.
                self.wh.refresh()
        self.wh.state = state
        # A folder without rows is no part of any table.
        current = state.folders()
        gone += [folder for folder in self.written if not any(name.startswith(folder) for name in current)]
        for folder in gone:
            remove(self.wh.spark, self.wh.path(folder))
        if not self._merged:
            self.wh.merge_appended([name for name in self._appended if len(state.appended[name]) > APPENDED_BATCHES], self.run_id)

    def abandon(self) -> None:
        for folder in self.written:
            remove(self.wh.spark, self.wh.path(folder))


class Warehouse:
    """All tables consist of folders that are written once; the newest commit names the current ones.

    Dated tables have a folder per written batch with one part per date, snapshots a folder per version, logs
    and registries a folder per appended batch. A table that is being read is never overwritten.
    """

    DATED = {
        "bronze/transactions": schemas.BRONZE_TRANSACTIONS,
        "bronze/accounts": schemas.BRONZE_ACCOUNTS,
        "bronze/broken_transactions": schemas.BROKEN_ROWS,
        "bronze/broken_accounts": schemas.BROKEN_ROWS,
        "silver/transactions": schemas.SILVER_TRANSACTIONS,
        "quarantine/transactions": schemas.QUARANTINE_TRANSACTIONS,
        "quarantine/accounts": schemas.QUARANTINE_ACCOUNTS,
    }
    SNAPSHOT = {
        "bronze/transaction_codes": schemas.BRONZE_CODES,
        "silver/transaction_codes": schemas.SILVER_CODES,
        "gold/daily_summary": schemas.GOLD_DAILY,
        "pipeline/control": schemas.CONTROL,
    }
    APPENDED = {
        "pipeline/loads": schemas.LOADS,
        "pipeline/weeks": schemas.WEEK_REGISTRY,
        "pipeline/run_log": schemas.RUN_LOG,
    }
    WEEKLY = "gold/weekly_account_summary"
    PARTIALS = "silver/daily_measures"
    # Accepted and rejected rows of a batch, written in one pass; silver and quarantine are parts of it.
    SETTLED = "settled/transactions"
    LEDGER = "ledger/accepted_ids"
    # The account snapshot, in buckets of the id's hash: an increment rewrites the buckets of its accounts.
    ACCOUNTS = "silver/accounts"

    def __init__(self, spark: SparkSession, root: str, source: str, multiline: bool = False, strict: bool = False):
        """``multiline``: source files may hold line breaks inside quotes. ``strict``: a row with a wrong number of
        fields fails the load; otherwise it is kept as text in a table of its own."""
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.source = source.rstrip("/")
        self.multiline = multiline
        self.strict = strict
        self.commits = Commits(self.spark, self.path("pipeline/commits"))
        self._state: State | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def frame(self, rows: list, schema: StructType) -> DataFrame:
        return local_frame(self.spark, rows, schema)

    def column(self, name: str) -> str:
        """The partition column of a table."""
        return {self.WEEKLY: "week_start_date", self.ACCOUNTS: "bucket"}.get(name, "date")

    # State

    @property
    def state(self) -> State:
        """The tables as this object last read or committed them."""
        if self._state is None:
            self.refresh()
        return self._state

    @state.setter
    def state(self, state: State) -> None:
        self._state = state

    def refresh(self) -> None:
        """Read the newest commit; a run does so when it starts."""
        self._state = self.commits.latest()

    def rows_of(self, name: str, values: Iterable) -> dict:
        """Rows of each partition, as they were counted when it was written."""
        held = self.state.parts.get(name, {})
        return {value: held[str(value)][1] if str(value) in held else 0 for value in values}

    # Reading

    def read(self, schema: StructType, base: str, folders: list[str]) -> DataFrame:
        """Folders of the table ``base``; none make an empty table."""
        if not folders:
            return self.frame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(base))
        return reader.parquet(*map(self.path, folders)).select(*schema.fieldNames())

    def _parts(self, name: str, schema: StructType, only: Iterable | None = None) -> DataFrame:
        """All parts of a table, or those of some partition values."""
        wanted = None if only is None else set(map(str, only))
        values: dict[str, list[str]] = {}
        for value, (folder, _) in self.state.parts.get(name, {}).items():
            if wanted is None or value in wanted:
                values.setdefault(folder, []).append(value)
        folders: list[str] = []
        for folder, held in values.items():
            whole = len(held) == self.state.sizes[folder]
            folders += [folder] if whole else [f"{folder}/{self.column(name)}={value}" for value in held]
        return self.read(schema, next(iter(values), "").split("/b=")[0], folders)

    def dated(self, name: str) -> DataFrame:
        return self._parts(name, self.DATED[name])

    def dated_with_position(self, name: str, start: str, end: str) -> DataFrame:
        """Rows of some file dates; ``_row_tag`` is their place in the source file, as ingestion stored it."""
        return within(self.dated(name), start, end).withColumnRenamed("_source_position", "_row_tag")

    def appended(self, name: str) -> DataFrame:
        return self.read(self.APPENDED[name], name, self.state.appended.get(name, []))

    def has_snapshot(self, name: str) -> bool:
        return name in self.state.snapshots

    def snapshot(self, name: str) -> DataFrame:
        if name == self.ACCOUNTS:
            return self._parts(name, schemas.SILVER_ACCOUNTS_STORED)
        return self.read(self.SNAPSHOT[name], name, [self.state.snapshots[name]] if self.has_snapshot(name) else [])

    def weekly(self) -> DataFrame:
        return self._parts(self.WEEKLY, schemas.GOLD_WEEKLY)

    def partials(self, schema: StructType) -> DataFrame:
        return self._parts(self.PARTIALS, schema)

    def accounts(self) -> DataFrame:
        """Silver accounts with their public columns."""
        return self.snapshot("silver/accounts").select(*schemas.SILVER_ACCOUNTS.fieldNames())

    # Writing

    def stage(self, rows: DataFrame, name: str, partition_by: Iterable[str] = ()) -> tuple[DataFrame, str]:
        return written(self.spark, rows, name, partition_by)

    def counted_write(self, rows: DataFrame, folder: str, columns: list[str], values: list[tuple]) -> dict[tuple, int]:
        """Write rows to a new folder and count those of each partition on the way."""

        def holds(value: tuple) -> Column:
            equal = (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, value))
            return F.count(F.when(reduce(Column.__and__, equal, F.lit(True)), 1))

        seen, found = Observation(), {}
        observed = rows
        if len(values) <= COUNTED:
            counts = [holds(value).alias(f"n{i}") for i, value in enumerate(values)]
            observed = rows.observe(seen, F.count(F.lit(1)).alias("total"), *counts)
        observed.write.partitionBy(*columns).parquet(self.path(folder))
        if len(values) <= COUNTED:
            found = seen.get
        if found:
            counted, total = {value: found[f"n{i}"] for i, value in enumerate(values)}, found["total"]
        else:  # more partitions than are observed, or a plan that is known to be empty
            again = self.spark.read.schema(rows.schema).parquet(self.path(folder)).groupBy(*columns).count().collect()
            held = {tuple(row)[:-1]: row["count"] for row in again}
            counted, total = {value: held.get(value, 0) for value in values}, sum(held.values())
        if sum(counted.values()) != total:
            raise ValueError(f"{folder}: {total - sum(counted.values())} rows lie outside the partitions that were asked for")
        return counted

    def change(self, run_id: str) -> Change:
        return Change(self, run_id)

    def publish_partitions(self, rows: DataFrame, name: str, column: str, values: Iterable, run_id: str = "") -> dict:
        """Replace the given partitions by the rows, in one commit; returns the row count of each.

        A partition without rows is removed, so no stale output survives a re-run.
        """
        change = self.change(run_id)
        counts = change.parts(rows, name, column, values)
        change.commit()
        return counts

    def publish_snapshot(self, rows: DataFrame, name: str, run_id: str) -> int:
        """Write the next version and make it current; returns its rows."""
        change = self.change(run_id)
        count = self.write_accounts(change, rows, range(self.buckets())) if name == self.ACCOUNTS else change.snapshot(rows, name)
        change.commit()
        return count

    def append(self, name: str, rows: list, run_id: str = "") -> None:
        if rows:
            change = self.change(run_id)
            change.append(name, rows)
            change.commit()

    def merge_appended(self, names: list[str], run_id: str) -> None:
        """Keep the number of small files bounded."""
        for name in names:
            change = self.change(run_id)
            change.merge(name)
            try:
                change.commit()
            except ConcurrentRun:  # the batches stay as they are
                self.refresh()

    def unreferenced(self) -> list[str]:
        """Folders that no commit names, left by runs that ended early. A run that is still writing has some too."""
        known = self.commits.latest()
        current = {folder.split("/_accepted=")[0].split("/_broken=")[0] for folder in known.folders()}
        current |= {folder.split("/_accepted=")[0].split("/_broken=")[0].split("/date=")[0].split("/week_start_date=")[0].split("/bucket=")[0] for _, folder in known.stale}
        tables = [*self.DATED, *self.SNAPSHOT, *self.APPENDED, self.WEEKLY, self.PARTIALS, self.SETTLED, self.LEDGER, self.ACCOUNTS]
        found = [f"{table}/{name}" for table in tables for name in self.commits.files.names(self.path(table)) if "=" in name]
        return [folder for folder in found if folder not in current]

    def clean(self) -> list[str]:
        """Remove what ended runs left behind. Call it while no run is active."""
        found = self.unreferenced()
        for folder in found:
            remove(self.spark, self.path(folder))
        return found

    # Buckets

    def buckets(self) -> int:
        """The number of buckets of accounts and accepted ids: that of the session's shuffles when the warehouse was new."""
        return self.state.settings.setdefault("buckets", int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("account_id"), F.lit(self.buckets())).cast("int")

    def accounts_in(self, buckets: list[int]) -> DataFrame:
        """Stored rows of some buckets; the others are not read."""
        return self._parts(self.ACCOUNTS, schemas.SILVER_ACCOUNTS_STORED, buckets)

    def write_accounts(self, change: Change, rows: DataFrame, buckets: Iterable[int]) -> int:
        """Replace some buckets of the account snapshot within a change; returns the rows of the whole snapshot."""
        buckets = list(buckets)
        counts = change.parts(rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket"), self.ACCOUNTS, "bucket", buckets)
        kept = self.state.parts.get(self.ACCOUNTS, {})
        return sum(counts.values()) + sum(n for value, (_, n) in kept.items() if int(value) not in counts)

    def ledger(self) -> IdLedger:
        return IdLedger(self.spark, self.path(self.LEDGER), self.buckets())

    def _ledger_dates(self) -> dict[str, list[str]]:
        dates: dict[str, list[str]] = {}
        for value, (folder, _) in self.state.parts.get(self.LEDGER, {}).items():
            dates.setdefault(folder, []).append(value)
        return dates

    def accepted_ids(self, without: Iterable[dt.date] = ()) -> DataFrame | None:
        """Ids accepted on other dates than the given ones; None if there are none."""
        left_out, asked = {str(day) for day in without}, {}
        for folder, dates in self._ledger_dates().items():
            kept = [day for day in dates if day not in left_out]
            if kept:
                whole = len(kept) == self.state.sizes[folder]
                asked[folder.split("/batch=")[1]] = None if whole else [dt.date.fromisoformat(day) for day in kept]
        return self.ledger().ids(asked) if asked else None

    def merge_ledger(self, run_id: str) -> bool:
        """Merge batches of one class if there are enough of them; returns whether it did."""
        classes: dict[int, list[str]] = {}
        for folder in self._ledger_dates():
            classes.setdefault(int(folder.split("/batch=")[1].split("-")[0]), []).append(folder)
        for level, folders in sorted(classes.items()):
            if len(folders) >= MERGED:
                held = self.state.parts[self.LEDGER]
                counts = {dt.date.fromisoformat(day): rows for day, (folder, rows) in held.items() if folder in folders}
                dates = {f.split("/batch=")[1]: [d for d in counts if held[str(d)][0] == f] for f in folders}
                change = self.change(run_id)
                self.write_ledger(change, self.ledger().ids(dates), counts, level + 1)
                change.commit()
                return True
        return False

    def write_ledger(self, change: Change, ids: DataFrame, counts: dict, level: int = 0) -> None:
        """Ids (transaction_id, date) as a batch of the ledger, within a change."""
        batch = f"{level}-{uuid.uuid4().hex}"
        folder = f"{self.LEDGER}/batch={batch}"
        change.written.append(folder)
        self.ledger().add(ids, batch)
        change.place(self.LEDGER, folder, counts)


def within(rows: DataFrame, start: str, end: str) -> DataFrame:
    """File dates from start to end: a partition filter."""
    return rows.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)
