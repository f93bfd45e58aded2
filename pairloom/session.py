"""Session for local work, and the shared folder that tables between stages go to."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

_local_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pairloom") -> SparkSession:
    """A session on this machine for tests and the bench; on a cluster use the one it gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``; only a local master may go without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="pairloom-")
        _local_folders[context.applicationId] = folder
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/pairloom/{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a table between two stages and read it back.

    Cuts the lineage, outlives lost executors, and gives both readers of a branch the same rows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that run inside send their Python workers Arrow batches of at most about ``size`` bytes; a smaller limit of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    given = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(key, str(min(given, size)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_BUCKETED = "pairloom_bucketed_"


def bucketed(df: DataFrame, keys: Sequence[str], label: str = "bucketed", deal: bool = True, **options: str) -> DataFrame:
    """A stage table that lies in files by buckets of ``keys``: joins of two such tables on their keys need no exchange.

    Rows are dealt out first, so that a bucket is one sorted file; without ``deal`` each task writes what it has, unsorted, to a file for each of its buckets,
    and nothing is shuffled. ``options`` go to the writer.
    """
    spark = df.sparkSession
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _BUCKETED + uuid.uuid4().hex
    if deal:
        df = df.repartition(many, *keys)  # as the buckets are, so that each task writes one file
    writer = df.write.options(**options).bucketBy(many, *keys)
    (writer.sortBy(*keys) if deal else writer).format("parquet").option("path", fresh_path(spark, label)).saveAsTable(name)
    return spark.table(name)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fingerprint(df: DataFrame) -> str:
    """What a plan reads and does: its canonical form, Spark's hash of it, and name, size and time of every file in the folders it reads."""
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    known = hashlib.sha256(f"{plan}\n{df.semanticHash()}\n{df.schema.json()}".encode())
    for folder in sorted({file.rsplit("/", 1)[0] for file in df.inputFiles()}):
        where, system = _file_system(spark, folder)
        files = sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in system.listStatus(where))
        known.update(repr(files).encode())
    return known.hexdigest()


def materialize_once(df: DataFrame, label: str = "stage") -> DataFrame:
    """As ``materialize``, but a table that an earlier run of the same plan over the same files has written is read again.

    A table is taken only if its writer finished (its success mark is there); what a run left half done is removed and written anew. Rows are written beside
    the place they belong to and moved there when they are complete, so two runs at a time cannot mix; the first one to move wins. Plans with random
    values or the time of day are reused as they came out first: use ``materialize`` for them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/pairloom/reused/{label}-{fingerprint(df)}"
    where, system = _file_system(spark, path)
    mark = _file_system(spark, f"{path}/_SUCCESS")[0]
    if not system.exists(mark):
        beside = f"{path}-{uuid.uuid4().hex}"
        df.write.parquet(beside)
        if system.exists(where) and not system.exists(mark):
            system.delete(where, True)
        if system.exists(where) or not system.rename(_file_system(spark, beside)[0], where):
            system.delete(_file_system(spark, beside)[0], True)
    return spark.read.schema(df.schema).parquet(path)


def clear_reused(spark: SparkSession) -> None:
    """Delete the tables of ``materialize_once``, also those of other applications."""
    where, system = _file_system(spark, f"{shared_folder(spark)}/pairloom/reused")
    system.delete(where, True)


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few fixed rows, handed over as one Arrow table: a list of rows would start Python on the executors just to be read."""
    kind = spark.createDataFrame([], schema).schema
    columns = list(zip(*rows)) or [()] * len(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(kind))], names=kind.names), kind)


def clear_stages(spark: SparkSession) -> None:
    """Delete the stage tables of this application; call it after the last result has been read."""
    for name in [t.name for t in spark.catalog.listTables(pattern=f"{_BUCKETED}*")]:
        spark.sql(f"drop table {name}")
    where, system = _file_system(spark, f"{shared_folder(spark)}/pairloom/{spark.sparkContext.applicationId}")
    system.delete(where, True)
