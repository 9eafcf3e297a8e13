"""Sinks, and jobs that write a stream batch by batch. Every job has a checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skein.operators.order import day_of, previous_value
from skein.session import cut, delete_folder, new_folder
from skein.sources.store import Folder, rolled_text


def to_console(stream: DataFrame, mode: str = "append", checkpoint: str | None = None,
               **trigger) -> StreamingQuery:
    """Print each batch untruncated."""
    return _start(stream.writeStream.format("console").option("truncate", False).outputMode(mode),
                  stream.sparkSession, checkpoint, trigger)


def to_csv(stream: DataFrame, path: str, checkpoint: str | None = None, sep: str = ";",
           **trigger) -> StreamingQuery:
    """Append rows to delimited files."""
    return _start(stream.writeStream.format("csv").option("sep", sep).option("path", path),
                  stream.sparkSession, checkpoint, trigger)


def to_text(stream: DataFrame, path: str, checkpoint: str | None = None, suffix: str | None = None,
            **trigger) -> StreamingQuery:
    """Append rows, written as ``(a,b,…)``, to text files, whose names end in ``suffix`` (three letters) where given."""
    if suffix:
        writer = one_line(as_text(stream)).writeStream.format("csv").options(**PLAIN_LINES, extension=suffix)
    else:
        writer = as_text(stream).writeStream.format("text")
    return _start(writer.option("path", path), stream.sparkSession, checkpoint, trigger)


def to_parquet(stream: DataFrame, path: str, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Append rows to Parquet files."""
    return _start(stream.writeStream.format("parquet").option("path", path),
                  stream.sparkSession, checkpoint, trigger)


def as_text(df: DataFrame) -> DataFrame:
    """Each row as one string ``(a,b,…)`` in column ``value``; a missing value is written ``null``."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *values), F.lit(")")).alias("value"))


# The text writer names its files itself; the CSV writer takes a suffix, and with these settings writes plain lines.
PLAIN_LINES = {"sep": "\x01", "quote": "\x00", "escape": "\x00", "escapeQuotes": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def one_line(rows: DataFrame) -> DataFrame:
    """Control characters that would end or split a line, written as escapes."""
    value = F.col("value")
    for sign, written in (("\n", "\\n"), ("\r", "\\r"), ("\x01", "\\1"), ("\x00", "\\0")):
        value = F.replace(value, F.lit(sign), F.lit(written))
    return rows.select(value.alias("value"))


def write_text(df: DataFrame, path: str, suffix: str | None = None) -> None:
    """Batch counterpart of :func:`to_text`; ``path`` carries the prefix of the output."""
    if suffix:
        one_line(as_text(df)).write.options(**PLAIN_LINES, extension=suffix).csv(path)
    else:
        as_text(df).write.text(path)


def write_rolled(df: DataFrame, path: str, prefix: str, suffix: str = "", **bounds: int) -> list[str]:
    """Rows as ``(a,b,…)`` in files of bounded rows and bytes, named with prefix and suffix; see :func:`rolled_text`."""
    return rolled_text(one_line(as_text(df)), path, prefix, suffix, **bounds)


def to_rolled(stream: DataFrame, path: str, prefix: str, suffix: str = "", checkpoint: str | None = None,
              bounds: dict | None = None, **trigger) -> StreamingQuery:
    """Streaming counterpart of :func:`write_rolled`; a batch that is run again replaces its own files."""
    def save(batch: DataFrame, batch_id: int) -> None:
        rolled_text(one_line(as_text(batch)), path, prefix, suffix, run=str(batch_id), **(bounds or {}))

    return _start(stream.writeStream.foreachBatch(save), stream.sparkSession, checkpoint, trigger)


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Article sink: one JSON object per line. A store that is read and rewritten takes :func:`skein.sources.store.rewrite_store`."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_batches(stream: DataFrame, path: str, mode: str, checkpoint: str | None = None,
                  **trigger) -> StreamingQuery:
    """Write every batch of a complete- or update-mode result to ``path/batch=<id>``.

    A batch that is run again after a failure overwrites its own folder.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(stream.writeStream.foreachBatch(save).outputMode(mode),
                  stream.sparkSession, checkpoint, trigger)


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Result of a complete-mode job: what its last batch wrote."""
    batches = spark.read.parquet(path)
    last = batches.agg(F.max("batch"))
    return batches.filter(F.col("batch") == last.scalar()).drop("batch")


def latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Result of an update-mode job: the newest row of each key."""
    batches = spark.read.parquet(path)
    values = [c for c in batches.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch")
    return batches.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


# Batches of changes beside a snapshot before they are merged into the next one.
COMPACT_EVERY = 8


def write_changes(stream: DataFrame, path: str, keys: list[str], every: int = COMPACT_EVERY,
                  checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Keep the result of an update-mode job as one row per key: a snapshot and the changes since.

    Every batch writes its changed keys under its own number. After ``every`` of them the snapshot and they are merged
    to the next snapshot, numbered like the last of them, and what went into it is deleted, so neither files nor the cost of
    reading grow with the number of batches. A batch that is run again overwrites its own changes, or, if the
    snapshot already holds them, changes nothing.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        merge_changes(batch, batch_id, path, keys, every)

    return _start(stream.writeStream.foreachBatch(save).outputMode("update"), stream.sparkSession, checkpoint, trigger)


def merge_changes(batch: DataFrame, batch_id: int, path: str, keys: list[str], every: int = COMPACT_EVERY) -> None:
    """One batch of :func:`write_changes`."""
    spark, folder = batch.sparkSession, Folder(batch.sparkSession, path)
    base, changes = _parts(folder)
    if base is not None and batch_id <= base:
        return
    batch.write.mode("overwrite").parquet(f"{path}/changes-{batch_id}")
    changes = sorted({*changes, batch_id})
    if len(changes) >= every:
        _merged(spark, path, base, changes, keys, batch.schema).write.mode("overwrite").parquet(f"{path}/snapshot-{changes[-1]}")
        for name in folder.names():  # the new snapshot is whole; a crash here leaves folders that the next merge deletes
            kind, _, number = name.partition("-")
            if (kind == "changes" and int(number) <= changes[-1]) or (kind == "snapshot" and int(number) < changes[-1]):
                folder.delete(name)


def read_changes(spark: SparkSession, path: str, keys: list[str], schema: StructType | str) -> DataFrame:
    """Result of :func:`write_changes`: the newest row of each key, from one snapshot and fewer than ``every`` batches."""
    return _merged(spark, path, *_parts(Folder(spark, path)), keys, schema)


def _parts(folder: Folder) -> tuple[int | None, list[int]]:
    """Number of the newest whole snapshot, and of the batches of changes after it."""
    found: dict[str, list[int]] = {"snapshot": [], "changes": []}
    for name in folder.names():
        kind, _, number = name.partition("-")
        if kind in found and folder.has(f"{name}/_SUCCESS"):
            found[kind].append(int(number))
    base = max(found["snapshot"], default=None)
    return base, sorted(n for n in found["changes"] if base is None or n > base)


def _merged(spark: SparkSession, path: str, base: int | None, changes: list[int], keys: list[str], schema) -> DataFrame:
    folders = [(f"{path}/snapshot-{base}", base)] if base is not None else []
    folders += [(f"{path}/changes-{n}", n) for n in changes]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = reduce(DataFrame.union, [spark.read.schema(schema).parquet(f).withColumn("_batch", F.lit(n)) for f, n in folders])
    values = [c for c in rows.columns if c not in (*keys, "_batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_row"))
    return newest.select(*keys, "_row.*").select(*[c for c in rows.columns if c != "_batch"])


def tee(stream: DataFrame, path: str, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Append a stream to a log of Parquet files, each batch exactly once, for other jobs to :func:`follow`.

    The source is read once however many outputs there are: stateless and stateful ones alike read the log, which keeps
    only the columns they need, and each keeps its own place in it.
    """
    return to_parquet(stream, path, checkpoint, **trigger)


def follow(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The log of :func:`tee` as a stream, batch by batch as it was written; files of an unfinished batch are not seen."""
    return spark.readStream.schema(schema).parquet(path)


def split_late(stream: DataFrame, path: str, time: str, delay: str, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Write all rows below ``path/rows``, with ``part`` telling those behind the watermark (``late``) from the others (``on_time``).

    Spark's own watermark drops late rows without a trace. Here the newest time of the batches before, less ``delay``, is
    the mark, as Spark has it; a row without a time is never late. The mark is kept per batch, so a batch run again splits its
    rows the same way, and overwrites its own folders. Numbers per batch, below ``path/counts``, come with the
    writing, by ``observe``.
    """
    spark = stream.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if batch_id > 0:
            newest = spark.read.parquet(f"{path}/marks/batch={batch_id - 1}").first()["newest"]
        late = F.lit(False)
        if newest is not None:
            late = F.coalesce(F.col(time) < F.lit(newest) - F.expr(f"interval {delay}"), F.lit(False))
        seen = Observation()
        marked = batch.withColumn("_late", late).observe(
            seen, F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_late"), 1)).alias("n_late"), F.max(time).alias("newest"))
        marked.select(F.when(F.col("_late"), "late").otherwise("on_time").alias("part"), *batch.columns).write.mode("overwrite").partitionBy(
            "part").parquet(f"{path}/rows/batch={batch_id}")
        got = seen.get
        known = [x for x in (newest, got["newest"]) if x is not None]
        spark.createDataFrame([(max(known) if known else None,)], batch.select(F.col(time).alias("newest")).schema).write.mode(
            "overwrite").parquet(f"{path}/marks/batch={batch_id}")
        spark.createDataFrame([(batch_id, got["n"], got["n_late"])], "batch_id long, n long, n_late long").write.mode("overwrite").parquet(
            f"{path}/counts/batch={batch_id}")

    return _start(stream.writeStream.foreachBatch(save), spark, checkpoint, trigger)


def run_sinks(stream: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]],
              write: Callable[[DataFrame, str, int], None], checkpoint: str | None = None,
              **trigger) -> StreamingQuery:
    """Several stateless outputs of one stream: each batch is read once and written under every name.

    Outputs that keep state are queries of their own.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, shape in outputs.items():
                write(shape(batch), name, batch_id)
        finally:
            batch.unpersist()

    return _start(stream.writeStream.foreachBatch(save), stream.sparkSession, checkpoint, trigger)


def advances_by_batch(stream: DataFrame, path: str, time: str, order: str, key: str | None = None,
                      columns: list[str] | None = None, checkpoint: str | None = None,
                      sizes: dict | None = None, zone: str = "UTC", **trigger) -> StreamingQuery:
    """Rows whose calendar day is later than that of the row before, written to ``path/rows``.

    Inside a batch the previous row comes from the skew-safe batch operator, so neither a hot key nor
    a stream without any key ends up in one task. Only a key's first row of a batch needs the past:
    the last day per key, a table rewritten under the batch's own number, so that a batch run again
    after a failure starts from the same state.
    """
    columns, spark = columns or [], stream.sparkSession
    by = key or "_all"
    narrow = stream.select(
        *([key] if key else []), order, *columns, day_of(stream, time, zone).alias("event_date"),
        F.lit(True).alias("_seen"))

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch if key else batch.withColumn(by, F.lit(0))
        before = F.struct("event_date", "_seen")
        linked = previous_value(rows.withColumn("_now", before), "_now", [order], key, "_before",
                                **(sizes or {}))
        linked = cut(linked)  # used for the first and for the later rows of a key
        last = rows.groupBy(F.col(by).alias("_key")).agg(F.max_by("event_date", order).alias("last_date"))
        if batch_id > 0:
            state = spark.read.parquet(f"{path}/state/batch={batch_id - 1}")
            first = linked.filter(F.col("_before").isNull())
            later = linked.filter(F.col("_before").isNotNull())
            first = first.join(state, F.col(by).eqNullSafe(F.col("_key")), "left").drop("_key")
            linked = first.unionByName(later.withColumn("last_date", F.lit(None).cast("date")))
            seen = last.select(F.col("_key").alias("_seen_key"))
            last = last.unionByName(
                state.join(seen, F.col("_key").eqNullSafe(F.col("_seen_key")), "left_anti"))
        else:
            linked = linked.withColumn("last_date", F.lit(None).cast("date"))
        previous = F.when(F.col("_before").isNotNull(), F.col("_before.event_date")).otherwise(
            F.col("last_date"))
        advanced = linked.withColumn("previous_date", previous).filter(
            F.col("previous_date") < F.col("event_date"))
        advanced.select(*([key] if key else []), order, *columns, "event_date", "previous_date") \
            .write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        last.write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")
        if batch_id > 1:  # only the batch before can still be asked for
            delete_folder(spark, f"{path}/state/batch={batch_id - 2}")

    return _start(narrow.writeStream.foreachBatch(step), spark, checkpoint, trigger)


def _start(writer, spark: SparkSession, checkpoint: str | None, trigger: dict) -> StreamingQuery:
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint or new_folder(spark, "stream")).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded run (``availableNow=True``) and raise what went wrong in it."""
    query.awaitTermination()
