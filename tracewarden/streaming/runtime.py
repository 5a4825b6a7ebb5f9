"""Start, drain, restart and reset streams. Checkpoints live in the shared folder, state in RocksDB.

The outputs are Parquet tables with a log of their batches: a batch that was written but not committed is not written again when its
query starts anew, so no row is lost or repeated.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.session import new_folder

_STORE = "spark.sql.streaming.stateStore"
#: State in RocksDB, compacted with each batch: a look for the sessions of a key walks over all that batches before removed behind it. Rows of state
#: are not counted, which would take a read before each write.
_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.compactOnCommit": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
#: Seconds between two looks at the progress of a stream that is drained.
LOOK_S = 5


@contextmanager
def _rocksdb(spark: SparkSession):
    """A query takes the settings over when it starts; the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _started(stream: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    # A stream without a batch makes no folder, and readers want one.
    files, path = _file_system(stream.sparkSession, out)
    files.mkdirs(path)
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    with _rocksdb(stream.sparkSession):
        return writer.trigger(**trigger).start(out)


def start(stream: DataFrame, out: str, checkpoint: str, cfg: DetectionConfig = DEFAULTS) -> StreamingQuery:
    """Append the stream's rows to Parquet files at ``out``, continuing from ``checkpoint``.

    To pause, stop the query; starting it again with the same two folders loses and repeats nothing.
    To reset, stop it, :func:`reset` the two folders and start it again.
    """
    return _started(stream, out, checkpoint, processingTime=cfg.trigger)


def _note_late(query: StreamingQuery, late: dict[int, int]) -> None:
    for progress in query.recentProgress:
        dropped = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        if dropped:
            late[progress["batchId"]] = dropped


def drain(stream: DataFrame, out: str, checkpoint: str) -> dict[int, int]:
    """Process all that is there, then stop. Returns how many rows each batch dropped behind the watermark, if any.

    A stateful step counts what reaches it: rows that a partial aggregate put together before count as one."""
    query, late = _started(stream, out, checkpoint, availableNow=True), {}
    while not query.awaitTermination(LOOK_S):
        _note_late(query, late)
    _note_late(query, late)
    return late


def reset(spark: SparkSession, *folders: str) -> None:
    """Forget a stopped stream: its checkpoint with all state, and its output."""
    for folder in folders:
        files, path = _file_system(spark, folder)
        files.delete(path, True)


def drained(stream: DataFrame, label: str) -> DataFrame:
    """Drain into fresh folders and read the result."""
    spark = stream.sparkSession
    out = new_folder(spark, label)
    drain(stream, out, new_folder(spark, f"{label}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def table_stream(spark, folder: str, schema) -> DataFrame:
    """The rows that another stream appends to a folder, as a stream. A reader that drains it with its
    own checkpoint gets what is new since its last fetch."""
    return spark.readStream.schema(schema).parquet(folder)


def chained(first: DataFrame, then, label: str) -> DataFrame:
    """Drain ``first`` into files and stream those files through ``then``."""
    spark = first.sparkSession
    folder = new_folder(spark, label)
    drain(first, folder, new_folder(spark, f"{label}-checkpoint"))
    return then(table_stream(spark, folder, first.schema))


def gathered(streams: list[DataFrame], then, label: str) -> DataFrame:
    """Drain each of ``streams`` into files of its own and stream all of them together through ``then``."""
    first, *others = [chained(s, lambda rows: rows, label) for s in streams]
    for other in others:
        first = first.unionByName(other)
    return then(first)
