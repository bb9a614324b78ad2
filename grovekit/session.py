"""Session set-up and the one place that decides where lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A table is broadcast by hint only when its measured size stays below this.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for sessions that were started elsewhere.

    Not needed where the package is installed on all machines or given with ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        folder = tempfile.mkdtemp(prefix="grovekit-code-")
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(f"{folder}/grovekit", "zip", root, "grovekit")
        spark.sparkContext.addPyFile(archive)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _shipped.add(app)


def local_session(app: str = "grovekit", cores: str = "8", shuffle: str = "8") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    ship(spark)
    return spark


_shipped: set[str] = set()
# Folders of local sessions that were given none, by application; removed when Python ends.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder, which is
    removed at exit.  On a cluster a machine-local path would be lost with the
    machine, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="grovekit-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and return it as a scan.

    Cuts lineage so that a lost executor re-reads files instead of replaying a
    whole loop, and keeps parquet's pruning and size statistics.  ``discard``
    removes the files when nothing reads them any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/grovekit/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` wrote; they cannot be read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Driver-held rows (models, parameters) as a local relation with exact statistics."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, schema=fields), struct)
