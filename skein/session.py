"""Session for local runs (tests, bench) and the shared folder every job writes its cuts to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders made by this driver and not yet dropped, by application.
_MADE: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g",
                  name: str = "skein", **settings: str) -> SparkSession:
    """Single-machine session with a folder of its own for cuts. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skein-"))
        # The tables of the tests are single small files; let Spark split them for all cores.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "1m")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/skein-cuts"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder."""
    folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_cuts(spark: SparkSession) -> None:
    """Delete the folders this application made so far. Call it when the results that read them are written."""
    for folder in _MADE.pop(spark.sparkContext.applicationId, []):
        delete_folder(spark, folder)


def write_cut(df: DataFrame, *by: str) -> str:
    """Write ``df`` to the shared folder, in folders by the columns ``by``, and return the path."""
    folder = new_folder(df.sparkSession, "cut")
    df.write.partitionBy(*by).parquet(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and go on from there.

    Survives the loss of executors, fixes row placement (partition ids, local row numbers) and gives
    the optimizer real sizes.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_cut(df))


# Rows that go to a Python task at once where rows hold whole texts: some megabytes, twice in the executor and once in the task.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python at most ``BATCH_ROWS`` at once from now on; a session that asks for fewer keeps its own number.

    Spark's 10,000 rows are tens of megabytes of text for each task, in buffers outside the heap that double as they grow.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


# Bytes of files that make a piece of their own when rows are handed out; in memory they are several times larger.
SPREAD_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """Hand rows out to all cores when they lie in fewer files than that, in more pieces where the files are large.

    For work that costs much per row. The number of pieces says nothing here: a file of one row group may be cut into
    many, of which one holds all rows. A table of many files comes back as it is.
    """
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, list(df._jdf.inputFiles())
    return df if len(files) >= cores else df.repartition(max(cores, sum(file_bytes(spark, f) for f in files) // SPREAD_BYTES))


def file_bytes(spark: SparkSession, file: str) -> int:
    """Length of a file wherever it lies; ``file`` is a URI as :meth:`DataFrame.inputFiles` gives it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(file))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
