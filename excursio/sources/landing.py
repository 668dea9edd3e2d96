"""CSV landing zone: typed loading with quarantine, and incremental day loads.

Layout: ``<landing>/<table>/dt=YYYY-MM-DD/*.csv``. Loaded rows go to ``<lake>/raw/<table>``,
rejected ones to ``<lake>/quarantine/<table>``, both partitioned by ``dt`` and ``load``.

A load writes its rows and the list of its files under an id of its own, and then commits both at
once in ``<lake>/loads/<table>/commits``. Readers take committed loads only, so a load that broke
off leaves nothing to see, and its files come with the next load. A committed file is left out of
every later load, whichever way it comes again; of two loads that run side by side and share a
file, one fails.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.operators.measures import row_count
from excursio.operators.quality import CheckFailed
from excursio.plans.checks import gate_batch, gate_rules
from excursio.schemas import RAW_SCHEMAS, columns
from excursio.shared import release, write_shared
from excursio.sources.commits import Commit, CommitLog, delete
from excursio.sources.state import read_or_none

# Texts that mean NULL in a landing file.
NULL_TOKENS = ("", "NULL", "null")
_LINE = "_line"
_REASONS = "_reasons"
_FILE, _SIZE, _MODIFIED = "_file", "_size", "_modified"
HALT, QUARANTINE = "halt", "quarantine"
# Rows are gathered by day before they are written, where files of fewer landing bytes than that would come of it.
SMALL_FILE = 250_000


@dataclass(frozen=True)
class Lake:
    """Folders of one deployment."""

    landing: str
    lake: str

    def files(self, table: str) -> str:
        return f"{self.landing}/{table}"

    def raw(self, table: str) -> str:
        return f"{self.lake}/raw/{table}"

    def quarantine(self, table: str) -> str:
        return f"{self.lake}/quarantine/{table}"

    def commits(self, table: str) -> str:
        return f"{self.lake}/loads/{table}/commits"

    def loaded_files(self, table: str) -> str:
        return f"{self.lake}/loads/{table}/files"

    def checkpoint(self, name: str) -> str:
        return f"{self.lake}/checkpoints/{name}"

    @property
    def builds(self) -> str:
        return f"{self.lake}/builds"

    @property
    def published(self) -> str:
        return f"{self.lake}/published"

    @property
    def state(self) -> str:
        return f"{self.lake}/state"

    @property
    def models(self) -> str:
        return f"{self.lake}/models"


def text_schema(table: str, with_day: bool = False) -> T.StructType:
    """Everything as text, plus the whole line when it cannot be split into the columns."""
    schema = T.StructType()
    for name in columns(table):
        schema.add(name, "string")
    schema.add(_LINE, "string")
    return schema.add("dt", "date") if with_day else schema


_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _LINE,
    # The header must name the contract's columns in their order, or the load stops.
    "enforceSchema": "false",
}


def read_csv(spark: SparkSession, table: str, *paths: str, with_day: bool = False) -> DataFrame:
    reader = spark.read.schema(text_schema(table, with_day)).options(**_CSV_OPTIONS)
    return reader.csv(list(paths))


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegerType):
        # "3.0" is a whole number too
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast("int")
        return F.coalesce(text.try_cast("int"), whole)
    return text.try_cast(kind)


def parse(lines: DataFrame, table: str) -> DataFrame:
    """Typed columns plus ``_reasons``: why the row must be rejected (empty when it is fine).

    Read as text and converted afterwards: a typed CSV read knows a single NULL token and
    would reject the others in numeric columns.
    """
    extra = [c for c in lines.columns if c not in columns(table) and c != _LINE]
    text = {
        f.name: F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name))
        for f in RAW_SCHEMAS[table]
    }
    typed = {f.name: _typed(text[f.name], f.dataType) for f in RAW_SCHEMAS[table]}
    failed = [
        F.when(text[n].isNotNull() & typed[n].isNull(), F.concat(F.lit(f"{n}: "), text[n]))
        for n in typed
        if not isinstance(RAW_SCHEMAS[table][n].dataType, T.StringType)
    ]
    malformed = F.when(F.col(_LINE).isNotNull(), F.concat(F.lit("line: "), F.col(_LINE)))
    reasons = F.array_compact(F.array(malformed, *failed))
    return lines.select(*[c.alias(n) for n, c in typed.items()], reasons.alias(_REASONS), *extra)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size(_REASONS) == 0).drop(_REASONS)


def rejected(parsed: DataFrame) -> DataFrame:
    """Rejected rows with the reasons as text; unreadable values are NULL in their column."""
    reason = F.concat_ws("; ", _REASONS).alias("reason")
    kept = [c for c in parsed.columns if c != _REASONS]
    return parsed.filter(F.size(_REASONS) > 0).select(*kept, reason)


def bulk_load(spark: SparkSession, lake: Lake, table: str, *paths: str) -> None:
    """Full load of one table from flat files; once it is committed it replaces what was there."""
    load = f"bulk-{uuid.uuid4().hex}"
    typed = parse(read_csv(spark, table, *paths), table).withColumns({"dt": F.lit(None).cast("date"), "load": F.lit(load)})
    parsed = write_shared(typed, f"bulk-{table}")
    try:
        write_days(accepted(parsed), lake.raw(table))
        write_days(rejected(parsed), lake.quarantine(table))
        CommitLog(spark, lake.commits(table)).add(load, load, replaces=True)
    finally:
        release(parsed)


def _committed(spark: SparkSession, lake: Lake, table: str, path: str, extra: str = "") -> DataFrame | None:
    """Rows of committed loads, None before the first; other partitions are pruned, not read."""
    loads = [c.label for c in CommitLog(spark, lake.commits(table)).current()]
    if not loads:
        return None
    schema = T.StructType([*RAW_SCHEMAS[table].fields, *T.StructType.fromDDL(f"{extra}dt date, load string").fields])
    rows = read_or_none(spark, path, schema=schema)
    return None if rows is None else rows.filter(F.col("load").isin(loads))


def read_raw(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """Loaded rows of a table, None before its first load."""
    loaded = _committed(spark, lake, table, lake.raw(table))
    return None if loaded is None else loaded.select(*columns(table))


def read_quarantine(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """Rejected rows of a table with their day and the reason, None before its first load."""
    refused = _committed(spark, lake, table, lake.quarantine(table), "reason string, ")
    return None if refused is None else refused.drop("load")


def load_history(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    """Every file of every committed load: path, size, time of change, rows and load."""
    return _files_of(spark, lake, table, CommitLog(spark, lake.commits(table)).all())


def _files_of(spark: SparkSession, lake: Lake, table: str, commits: list[Commit]) -> DataFrame | None:
    schema = f"{_FILE} string, {_SIZE} long, {_MODIFIED} timestamp, rows long, load string"
    listed = read_or_none(spark, lake.loaded_files(table), schema=schema) if commits else None
    return None if listed is None else listed.filter(F.col("load").isin([c.label for c in commits]))


def remove_unfinished(spark: SparkSession, lake: Lake, table: str) -> list[str]:
    """Delete what loads that never committed have left; not to be run while a load is running."""
    known = {c.label for c in CommitLog(spark, lake.commits(table)).all()}
    gone = set()
    for path in (lake.raw(table), lake.quarantine(table)):
        rows = read_or_none(spark, path, schema="dt string, load string")
        found = rows.select("dt", "load").distinct().collect() if rows is not None else []  # one row a load and day
        for day, load in found:
            if load not in known:
                delete(spark, f"{path}/dt={day or '__HIVE_DEFAULT_PARTITION__'}/load={load}")
                gone.add(load)
    for load in gone:
        delete(spark, f"{lake.loaded_files(table)}/load={load}")
    return sorted(gone)


def write_days(df: DataFrame, path: str) -> None:
    """Write ``dt``/``load`` partitions, replacing only the ones present in ``df``.

    Rows of a day are gathered first, and large days split again by size, so the number of files
    follows the data and not tasks times days.
    """
    _write_as_dealt(df.hint("rebalance", "dt"), path)


def _write_as_dealt(df: DataFrame, path: str) -> None:
    """``write_days`` without the shuffle, for few and large days: every task writes a file of each."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt", "load").parquet(path)


def _store(parsed: DataFrame, lake: Lake, table: str, name: str, on_violation: str) -> None:
    """Gate one batch, write the good rows and the rejected ones, and commit them with their files.

    Files of committed loads are left out. ``name`` is committed once: a batch that is retried
    although it was committed does nothing.
    """
    spark = parsed.sparkSession
    log = CommitLog(spark, lake.commits(table))
    before = log.all()
    if any(c.name == name for c in before):
        return
    taken = _files_of(spark, lake, table, before)
    if taken is not None:
        parsed = parsed.join(taken.select(_FILE), _FILE, "left_anti")
    load = f"{name}-{uuid.uuid4().hex}"
    # The gate's shuffle is over, and its files gone, once the batch is held; what follows reads the copy.
    gated = _with_gate_reasons(parsed, table) if on_violation == QUARANTINE else parsed
    held = write_shared(gated.withColumn("load", F.lit(load)), f"load-{table}")
    try:
        if held.isEmpty():
            return
        listed = held.groupBy(_FILE).agg(F.first(_SIZE).alias(_SIZE), F.first(_MODIFIED).alias(_MODIFIED), row_count("rows"))
        batch, write = held.drop(_FILE, _SIZE, _MODIFIED), write_days
        if on_violation == HALT:
            found = gate_batch(table, accepted(batch)).filter("violations > 0").collect()
            if found:
                raise CheckFailed(
                    [{"table": table, "check": r["rule"], "violations": r[-1]} for r in found]
                )
        else:
            # Every task may write each day; that is left to the writers unless files would become tiny.
            size, days = listed.agg(F.sum(_SIZE)).first()[0], held.select("dt").distinct().count()
            if len(held.inputFiles()) * days * SMALL_FILE <= size:
                write = _write_as_dealt
        write(accepted(batch), lake.raw(table))
        write_days(rejected(batch), lake.quarantine(table))
        listed.write.parquet(f"{lake.loaded_files(table)}/load={load}")

        def compatible(others: list[Commit]) -> bool:
            theirs = _files_of(spark, lake, table, others)
            return theirs is None or listed.join(theirs.select(_FILE), _FILE, "left_semi").isEmpty()

        log.add(name, load, compatible=compatible, seen=len(before))
    finally:
        release(held)


def _with_gate_reasons(batch: DataFrame, table: str) -> DataFrame:
    broken = [F.when(c, F.lit(f"rule: {rule}")) for rule, c in gate_rules(table).items()]
    if table == "bookings":
        # Among repeats the first readable row stays, the same one that deduplication would keep.
        refused = F.size(_REASONS) > 0
        first = Window.partitionBy("booking_id").orderBy(
            refused, F.asc_nulls_last("booking_timestamp"), *columns(table)
        )
        batch = batch.withColumn("_place", F.row_number().over(first))
        broken.append(F.when((F.col("_place") > 1) & ~refused, F.lit("rule: unique booking_id")))
    reasons = F.concat(F.col(_REASONS), F.array_compact(F.array(*broken)))
    return batch.withColumn(_REASONS, reasons).drop("_place")


def ingest(
    spark: SparkSession,
    lake: Lake,
    table: str,
    day: dt.date | None = None,
    on_violation: str = HALT,
    files_per_batch: int | None = None,
) -> None:
    """Load the files not loaded before, of one day or of all days, then stop.

    The committed files are the load history; the stream's checkpoint saves reading them again.
    A batch that fails the gate is recorded in neither, so its files are read again once they have
    been repaired.
    """
    name = f"{table}/{day.isoformat() if day else 'all'}"
    path = f"{lake.files(table)}/dt={day.isoformat()}" if day else lake.files(table)
    reader = spark.readStream.schema(text_schema(table, with_day=day is None))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.options(**_CSV_OPTIONS).csv(path)
    parsed = parse(_with_file(lines), table)
    if day:
        parsed = parsed.withColumn("dt", F.lit(day))

    def load(batch: DataFrame, batch_id: int) -> None:
        _store(batch, lake, table, f"{day or 'all'}-{batch_id:08d}", on_violation)

    run_once(parsed, load, lake.checkpoint(f"ingest/{name}"))


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what is available through ``sink``, raising the sink's own error if it fails."""
    errors: list[Exception] = []

    def guarded(batch: DataFrame, batch_id: int) -> None:
        try:
            sink(batch, batch_id)
        except Exception as error:
            errors.append(error)
            raise

    query = (
        stream.writeStream.foreachBatch(guarded)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except Exception as error:
        raise errors[0] if errors else error


def backfill(
    spark: SparkSession,
    lake: Lake,
    table: str,
    start: dt.date,
    end: dt.date,
    on_violation: str = HALT,
) -> None:
    """Load all day folders of [start, end) in one job; other days are pruned, not read.

    Every call is a load of its own, which takes the files that no load before it has taken.
    """
    lines = _days(spark, lake, table, start, end)
    _store(parse(_with_file(lines), table), lake, table, f"backfill-{uuid.uuid4().hex}", on_violation)


def _days(spark: SparkSession, lake: Lake, table: str, start: dt.date, end: dt.date) -> DataFrame:
    lines = read_csv(spark, table, lake.files(table), with_day=True)
    return lines.filter((F.col("dt") >= F.lit(start)) & (F.col("dt") < F.lit(end)))


def pending_days(spark: SparkSession, lake: Lake, table: str, start: dt.date, end: dt.date) -> list[dt.date]:
    """Days of [start, end) with files that no load has taken; at most one row a day comes to the driver."""
    files = _with_file(_days(spark, lake, table, start, end)).select("dt", _FILE)
    taken = load_history(spark, lake, table)
    if taken is not None:
        files = files.join(taken.select(_FILE), _FILE, "left_anti")
    return sorted(r["dt"] for r in files.select("dt").distinct().collect())


def _with_file(lines: DataFrame) -> DataFrame:
    """Add the file that each line is from, its size and its time of change."""
    meta = F.col("_metadata")
    return lines.withColumns({_FILE: meta["file_path"], _SIZE: meta["file_size"], _MODIFIED: meta["file_modification_time"]})


def write_landing(df: DataFrame, lake: Lake, table: str, day: str | Column, gather: bool = True) -> None:
    """Hand over a frame as day-partitioned CSV files (gzip), with every value as Spark prints it.

    The CSV writer's own timestamp format stops at milliseconds. ``gather=False`` is for few and large
    days: every task writes a file of each, and no row is shuffled.
    """
    texts = [F.col(c).cast("string").alias(c) for c in df.columns]
    dated = df.select(*texts, F.to_date(day).alias("dt"))
    writer = (dated.hint("rebalance", "dt") if gather else dated).write.mode("append").partitionBy("dt").option("header", True)
    writer.option("escape", '"').option("compression", "gzip").csv(lake.files(table))


def load_reconciliation(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """Rows in the files against rows loaded and rejected, per day."""

    def per_day(df: DataFrame | None, name: str) -> DataFrame:
        if df is None:
            return spark.createDataFrame([], f"dt date, {name} bigint")
        return df.groupBy("dt").agg(row_count(name))

    # Columns are pruned to the partition day; the rows are still counted line by line.
    files = per_day(read_csv(spark, table, lake.files(table), with_day=True), "file_rows")
    loaded = per_day(_committed(spark, lake, table, lake.raw(table)), "loaded_rows")
    refused = per_day(read_quarantine(spark, lake, table), "rejected_rows")
    counts = ["file_rows", "loaded_rows", "rejected_rows"]
    joined = files.join(loaded, "dt", "full").join(refused, "dt", "full")
    zeroed = joined.select("dt", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    complete = F.col("file_rows") == F.col("loaded_rows") + F.col("rejected_rows")
    return zeroed.withColumn("complete", complete)
