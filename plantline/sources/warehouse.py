"""Stored warehouse: parquet tables, the quarter-partitioned ledger and versioned marts."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

LEDGER = "fact_inventory_movements"
QUARTER = "movement_quarter"
# The declared range of the ledger, [first day, day after the last).
LEDGER_RANGE = (date(2025, 1, 1), date(2026, 7, 1))


def quarter_of(day: Column, declared: tuple[date, date]) -> Column:
    """Partition name of a date: ``2025_q1`` inside the declared range, ``default`` outside."""
    inside = (day >= F.lit(declared[0])) & (day < F.lit(declared[1]))
    name = F.concat(F.year(day).cast("string"), F.lit("_q"), F.quarter(day).cast("string"))
    return F.when(inside, name).otherwise("default")


def quarters_between(low: date, high: date | None, declared: tuple[date, date]) -> list[str]:
    """Names of all partitions that can hold dates in [low, high]; no high means no end."""
    names = []
    day = declared[0]
    while day < declared[1]:
        following = date(day.year + (day.month > 9), (day.month + 2) % 12 + 1, 1) if day.month > 9 else date(
            day.year, day.month + 3, 1
        )
        if following > low and (high is None or day <= high):
            names.append(f"{day.year}_q{(day.month + 2) // 3}")
        day = following
    if low < declared[0] or high is None or high >= declared[1]:
        names.append("default")
    return names


def touched_quarters(movements: DataFrame, declared: tuple[date, date]) -> tuple[date, date, list[str]] | None:
    """First and last day of a batch and the partitions it falls into; nothing if it is empty or holds no date.

    One job over the batch; there are no more names than the declared range has quarters.
    """
    day = F.col("movement_date")
    found = movements.where(day.isNotNull()).agg(
        F.min(day).alias("low"), F.max(day).alias("high"), F.sort_array(F.collect_set(quarter_of(day, declared))).alias("quarters")
    ).first()
    return None if found.low is None else (found.low, found.high, found.quarters)


def ledger_between(
    ledger: DataFrame, low: date, high: date | None = None, declared: tuple[date, date] = LEDGER_RANGE
) -> DataFrame:
    """Movements dated in [low, high].

    A date filter alone does not prune partitions, as the partition column is the
    quarter; on a partitioned ledger the quarters implied by the range are added.
    """
    day = F.col("movement_date")
    rows = ledger.where(day >= F.lit(low))
    if high is not None:
        rows = rows.where(day <= F.lit(high))
    if QUARTER in ledger.columns:
        rows = rows.where(F.col(QUARTER).isin(*quarters_between(low, high, declared)))
    return rows


def write_ledger(
    movements: DataFrame, path: str, declared: tuple[date, date] = LEDGER_RANGE, mode: str = "overwrite"
) -> None:
    """Write movements by quarter, sorted so that row-group statistics narrow a material filter.

    Rows are shuffled by quarter and material range: a quarter holding most of
    the ledger is still written by many tasks.
    """
    named = movements.withColumn(QUARTER, quarter_of(F.col("movement_date"), declared))
    order = [QUARTER, "material_id", "warehouse_id", "movement_date"]
    (
        named.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .partitionBy(QUARTER)
        .parquet(path)
    )


TOTALS = "ledger_totals"
SIGNATURES = "ledger_total_signatures"
CELL = ["material_id", "warehouse_id"]


def ledger_signatures(ledger: DataFrame) -> dict[str, str]:
    """A checksum of the names of each quarter's files; it changes with every append to the quarter."""
    names: dict[str, list[str]] = {}
    for path in ledger.inputFiles():
        folder, _, name = path.rpartition("/")
        quarter = folder.rpartition(f"/{QUARTER}=")[2]
        names.setdefault(quarter, []).append(name)
    return {q: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for q, n in names.items()}


def quarter_end(name: str) -> date:
    """The day after the last of a quarter."""
    year, quarter = int(name[:4]), int(name[-1])
    return date(year + quarter // 4, quarter % 4 * 3 + 1, 1)


class Warehouse(Mapping[str, DataFrame]):
    """Tables stored below one folder, readable like a dict of DataFrames."""

    def __init__(self, spark: SparkSession, root: str, names: list[str], declared: tuple[date, date] = LEDGER_RANGE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.names = names
        self.declared = declared
        self._opened: dict[str, DataFrame] = {}
        self._fresh: list[str] | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(self.path(name))
        return self._opened[name]

    def refresh(self, name: str) -> None:
        """Forget the file listing of a table that was written to."""
        self._opened.pop(name, None)
        self._fresh = None

    def refresh_totals(self) -> list[str]:
        """Sum up the ledger by quarter and cell where files came since the last time; returns those quarters.

        The totals of other quarters stay. A quarter's signature is stored after its
        totals, so that a run that fails in between leaves the quarter out of date.
        """
        self.refresh(LEDGER)
        ledger = self[LEDGER]
        signatures = ledger_signatures(ledger)
        stale = sorted(set(signatures) - set(self.summed_quarters()))
        if stale:
            quantity = F.col("quantity")
            (
                ledger.where(F.col(QUARTER).isin(*stale)).groupBy(QUARTER, *CELL)
                .agg(F.sum(quantity).alias("quantity"), F.sum(F.when(quantity < 0, -quantity)).alias("outflow"))
                .repartition(QUARTER)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(QUARTER).parquet(self.path(TOTALS))
            )
            rows = [(q, signatures[q], time.time_ns()) for q in stale]
            found = self.spark.createDataFrame(rows, f"{QUARTER} string, signature string, written_at bigint")
            found.coalesce(1).write.mode("append").parquet(self.path(SIGNATURES))
            self._fresh = None
        return stale

    def summed_quarters(self) -> list[str]:
        """Quarters whose totals stand for all their files. Looked up once until the ledger is written to."""
        if self._fresh is None:
            try:
                rows = self.spark.read.parquet(self.path(SIGNATURES))
                last = rows.groupBy(QUARTER).agg(F.max_by("signature", "written_at").alias("signature")).collect()
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
                last = []
            now = ledger_signatures(self[LEDGER])
            self._fresh = sorted(r[QUARTER] for r in last if now.get(r[QUARTER]) == r.signature)
        return self._fresh

    def totals(self, quarters: list[str]) -> DataFrame:
        stored = self.spark.read.schema(f"material_id {self._kind('material_id')}, warehouse_id {self._kind('warehouse_id')}, "
                                        f"quantity bigint, outflow bigint, {QUARTER} string").parquet(self.path(TOTALS))
        return stored.where(F.col(QUARTER).isin(*quarters))

    def _kind(self, column: str) -> str:
        return self[LEDGER].schema[column].dataType.simpleString()

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)

    @classmethod
    def load(
        cls,
        tables: Mapping[str, DataFrame],
        spark: SparkSession,
        root: str,
        declared: tuple[date, date] = LEDGER_RANGE,
    ) -> Warehouse:
        """Write every table below ``root`` and return the stored warehouse."""
        stored = cls(spark, root, list(tables), declared)
        for name, df in tables.items():
            if name == LEDGER:
                write_ledger(df, stored.path(name), declared)
            else:
                df.write.mode("overwrite").parquet(stored.path(name))
        return stored


def ledger_flows(tables: Mapping[str, DataFrame], since: date | None = None, cell: Sequence[str] = tuple(CELL)) -> DataFrame:
    """(``cell``, quantity, outflow, recent): parts that add up to the flows of each cell.

    ``outflow`` is null without any; ``recent`` is the outflow from ``since`` on. A
    stored warehouse gives the totals of quarters that are up to date and end by
    ``since``, and movements of the other quarters only: a closed quarter is not
    scanned again until files are added to it.
    """
    quantity, day = F.col("quantity"), F.col("movement_date")
    out = F.when(quantity < 0, -quantity)
    recent = F.when(day >= F.lit(since), out) if since else F.lit(None).cast("bigint")
    rows, stored = tables[LEDGER], None
    if isinstance(tables, Warehouse) and QUARTER in rows.columns:
        closed = [q for q in tables.summed_quarters() if since is None or (q != "default" and quarter_end(q) <= since)]
        if closed:
            rows = rows.where(~F.col(QUARTER).isin(*closed))
            stored = tables.totals(closed).select(*cell, "quantity", "outflow", F.lit(None).cast("bigint").alias("recent"))
    moved = rows.groupBy(*cell).agg(
        F.sum(quantity).alias("quantity"), F.sum(out).alias("outflow"), F.sum(recent).cast("bigint").alias("recent")
    )
    return moved if stored is None else moved.unionByName(stored)


VERSION = "published_at bigint, path string, business string"
#: A claim without a version after it, left by a writer that died, counts no more after this time.
CLAIM_SECONDS = 900


class ConcurrentWrite(RuntimeError):
    """Another writer has published since the version that a table was made from."""


def _versions(root: str, name: str) -> str:
    return f"{root}/_versions/{name}"


def _claims(root: str, name: str) -> str:
    return f"{root}/_claims/{name}"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark itself sees them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _claim(spark: SparkSession, root: str, name: str, after: int) -> None:
    """Take the right to publish the version that follows ``after``; of several writers only one gets it."""
    files, path = _files(spark, f"{_claims(root, name)}/{after:020d}")
    if files.exists(path) and time.time() - files.getFileStatus(path).getModificationTime() / 1000 > CLAIM_SECONDS:
        files.delete(path, False)
    try:
        files.create(path, False).close()
    except Py4JJavaError as problem:
        if not files.exists(path):
            raise
        raise ConcurrentWrite(f"another writer publishes {name} below {root}") from problem


def latest_number(spark: SparkSession, root: str, name: str) -> int:
    """Number of the current version, to be given to ``publish`` as ``base``; 0 if there is none."""
    latest = _latest(spark, root, name)
    return 0 if latest is None else latest.published_at


def publish_files(
    spark: SparkSession, root: str, name: str, version: str, write: Callable[[str], None], base: int | None = None
) -> str:
    """Add a version whose files ``write`` puts below the path given to it; returns that path.

    Readers see it once its row in the version log is written, after all its
    files. The version published last is the current one, whatever its business
    time, so that a later backfill or rerun is seen. With ``base``, the version must
    directly follow that one: if another writer was faster, ConcurrentWrite is raised
    and the files written are removed, so that nobody's rows are lost unseen.
    """
    path = f"{root}/{name}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(path)
    try:
        after = latest_number(spark, root, name)
        if base is not None and after != base:
            raise ConcurrentWrite(f"{name} below {root} has been published since version {base}")
        _claim(spark, root, name, after)
    except ConcurrentWrite:
        files, mine = _files(spark, path)
        files.delete(mine, True)
        raise
    row = (max(time.time_ns(), after + 1), path, version)
    spark.createDataFrame([row], VERSION).coalesce(1).write.mode("append").parquet(_versions(root, name))
    return path


def publish(df: DataFrame, root: str, name: str, version: str, by: str | None = None, base: int | None = None) -> None:
    """Add a version of a table, partitioned ``by`` a column if given; ``version`` is its business time, kept for information.

    A table that is made from its current version is published with the number of that version as ``base``.
    """

    def write(path: str) -> None:
        if by is None:
            df.write.parquet(path)
        else:
            # Large partitions get several writers, small ones share one.
            df.repartitionByRange(by, *[c for c in df.columns if c != by][:1]).write.partitionBy(by).parquet(path)

    publish_files(df.sparkSession, root, name, version, write, base)


def remove_old_versions(spark: SparkSession, root: str, name: str, keep: int = 2, grace_seconds: float = 7 * 86400) -> list[str]:
    """Delete the files of versions that nobody can be reading any more; returns their paths.

    The last ``keep`` versions stay. An older one goes once it has been replaced for
    ``grace_seconds``: a reader that opened it while it was current has had that long.
    Files of writers that never published go when they are that old too. The version
    log keeps its rows.
    """
    try:
        log = spark.read.schema(VERSION).parquet(_versions(root, name)).orderBy("published_at").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        log = []
    now = time.time()
    # A version is out of use from the publication of the next one on.
    old = {
        row.path.rpartition("/")[2]
        for row, following in zip(log[:-keep] if keep else log, log[1:], strict=False)
        if now - following.published_at / 1e9 >= grace_seconds
    }
    known = {row.path.rpartition("/")[2] for row in log}
    files, folder = _files(spark, f"{root}/{name}")
    removed = []
    for found in files.listStatus(folder) if files.exists(folder) else []:
        last = found.getPath().getName()
        stray = last not in known and now - _last_change(files, found) >= grace_seconds
        if last in old or stray:
            files.delete(found.getPath(), True)
            removed.append(f"{root}/{name}/{last}")
    return sorted(removed)


def _last_change(files, found) -> float:
    """Seconds of the newest change of a folder or of anything directly below it."""
    times = [found.getModificationTime(), *[f.getModificationTime() for f in files.listStatus(found.getPath())]]
    return max(times) / 1000


def _latest(spark: SparkSession, root: str, name: str) -> Row | None:
    """Last row of the version log; nothing if the table has never been published."""
    try:
        log = spark.read.schema(VERSION).parquet(_versions(root, name))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.agg(F.max_by(F.struct("*"), "published_at").alias("last")).first().last


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """Where the files of the version published last are."""
    latest = _latest(spark, root, name)
    if latest is None:
        raise LookupError(f"{name} has not been published below {root}")
    return latest.path


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The version published last; files of other versions are not opened."""
    return spark.read.parquet(current_path(spark, root, name))


def replace_partitions(df: DataFrame, root: str, name: str, by: str) -> None:
    """Overwrite those partitions of the current version that ``df`` has rows of; the files of others stay.

    ``df`` must not read the version it goes to; store it first. A reader that has
    listed a replaced partition before must read again.
    """
    path = current_path(df.sparkSession, root, name)
    (
        df.repartitionByRange(by, *[c for c in df.columns if c != by][:1])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    )


def current_or(spark: SparkSession, root: str, name: str, otherwise: DataFrame) -> DataFrame:
    """The current version of a table, or ``otherwise`` when none has been published yet. Other errors are raised."""
    return otherwise if _latest(spark, root, name) is None else current(spark, root, name)
