"""Tables written once and read many times, in the folder all executors share."""

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# The folder of the run that owns the tables stored now; None outside a run.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the one set on the context.

    Only a local session without either gets a folder of its own; on a cluster a missing
    setting is an error, as a folder of one machine would be lost with it.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pairloom-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it was running, not the stages
    before, and filters on the result never move back into the computation. Inside
    ``stored_tables`` the table goes with the run, elsewhere it stays until the folder is cleared.
    ``compression`` is the session's if not given.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder that lies and goes with the stored tables."""
    return f"{_RUN.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    found, files = _hadoop(spark, path)
    files.delete(found, True)


def write_apart(
    df: DataFrame, number: str, targets: Sequence[str], file_format: str, compression: str | None = None
) -> None:
    """Write the rows to one folder per value of ``number``, from 0, in a single pass over ``df``.

    They are written side by side into a folder next to the first target, whose parts then move to their
    places; folders without rows are made, too.
    """
    spark = df.sparkSession
    aside = f"{targets[0].rstrip('/')}-parts-{uuid.uuid4().hex}"
    # Files stay open side by side, else each task would sort its rows by their folder.
    writers, before = "spark.sql.maxConcurrentOutputFileWriters", None
    before = spark.conf.get(writers, None)
    spark.conf.set(writers, str(len(targets)))
    try:
        options = {"compression": compression} if compression else {}
        df.write.partitionBy(number).format(file_format).options(**options).save(aside)
        for k, target in enumerate(targets):
            source, files = _hadoop(spark, f"{aside}/{number}={k}")
            if not files.exists(source):
                df.where(F.lit(False)).drop(number).write.format(file_format).save(target)
                continue
            place, _ = _hadoop(spark, target)
            files.mkdirs(place.getParent())
            if files.exists(place) or not files.rename(source, place):
                raise FileExistsError(target)
            # What a writer leaves in a folder that is complete.
            done, _ = _hadoop(spark, f"{target}/_SUCCESS")
            files.create(done).close()
    finally:
        if before is None:
            spark.conf.unset(writers)
        else:
            spark.conf.set(writers, before)
        remove_folder(spark, aside)


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[str]:
    """Owns all tables stored inside: they are removed at the end, also of a failed run.

    Lazy results that read such a table must have been written by then.
    """
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove_folder(spark, folder)
