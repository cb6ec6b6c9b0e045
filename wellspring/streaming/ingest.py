"""T-01 / T-02: incremental ingest of new logger files with Structured Streaming.

The reference downloads only files it has not seen and appends them; here the
file source's checkpoint remembers seen files and ``availableNow`` turns
each run into bounded batches (a daily job).  The stream carries file names only; each
batch reads its own files, so that a file that does not fit goes to a quarantine table and the
others are taken.  A batch writes folders of its own number and overwrites them: run again
after a failure, it leaves the same files.

Beside the rows a batch keeps their value counts, a state that adds up over batches: the
statistics of everything, exact quantiles among them, come from the state without the
rows of earlier runs.  ``append_unseen`` is the batch twin (anti join on paths).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import filters as P
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import stats as A
from ..plans.composites import CONDUCTIVITY_LIMIT, sensor_long_from_raw, sensor_stats_flow
from ..session import cut_lineage
from ..sources.readers import CSV_OPTIONS, SENSOR_FILE_SCHEMA, file_path

BATCH_COL = "ingest_batch"
#: Files that one batch takes at most; their names pass through the driver.
FILES_PER_BATCH = 10_000
_LISTING = "path string, modificationTime timestamp, length long, content binary"
_NAMES = [f.name for f in SENSOR_FILE_SCHEMA.fields]
_CELLS = [f"c{i}" for i in range(len(_NAMES) + 1)]


def sensor_stream(spark: SparkSession, source_dir: str, glob: str = "*.csv", max_files: int | None = None) -> DataFrame:
    """The rows of new files as a stream; headers are checked, and a file that does not fit ends it."""
    reader = (
        spark.readStream.schema(SENSOR_FILE_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.csv(source_dir)
    return raw.withColumn("file", file_path())


def new_files(spark: SparkSession, source_dir: str, glob: str = "*.csv", max_files: int = FILES_PER_BATCH) -> DataFrame:
    """The paths of new files as a stream; no contents are read."""
    reader = spark.readStream.format("binaryFile").schema(_LISTING).option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).load(source_dir).select("path")


def read_loosely(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line of logger files as text cells with ``file``, and whether it is the header or ``fits`` the schema."""
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    schema = ", ".join(f"{c} string" for c in _CELLS)
    lines = spark.read.schema(schema).option("ignoreLeadingWhiteSpace", True).csv(plain).withColumn("file", file_path())
    cells = [F.col(c) for c in _CELLS]
    header = cells[-1].isNull()
    for cell, name in zip(cells, _NAMES, strict=False):
        header = header & F.coalesce(F.trim(cell) == name, F.lit(False))
    number = [c.isNull() | c.try_cast("double").isNotNull() for c in cells[2:4]]
    fits = S.to_int(cells[0]).isNotNull() & S.local_plus_one_to_utc(cells[1]).isNotNull() & number[0] & number[1] & cells[-1].isNull()
    return lines.withColumns({"is_header": header, "fits": fits})


def judged_files(lines: DataFrame) -> DataFrame:
    """(file, reason, n_rows, n_misfits): per file why it is not taken, NULL for a good one."""
    row = ~F.col("is_header")
    per_file = lines.groupBy("file").agg(
        F.count(F.when(F.col("is_header"), 1)).alias("__headers"),
        F.count(F.when(row, 1)).alias("n_rows"),
        F.count(F.when(row & ~F.col("fits"), 1)).alias("n_misfits"),
    )
    reason = F.when(F.col("__headers") == 0, F.lit("header does not fit")).when(F.col("n_misfits") > 0, F.lit("rows do not fit"))
    return per_file.select("file", reason.alias("reason"), "n_rows", "n_misfits")


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint_dir: str,
    installed_since=None,
    glob: str = "*.csv",
    quarantine_dir: str | None = None,
    state_dir: str | None = None,
    max_files: int = FILES_PER_BATCH,
) -> int | None:
    """Process every file not yet recorded in ``checkpoint_dir`` and append
    its rows in long form to the parquet table at ``sink_dir``.  Returns the
    number of the last micro-batch since the checkpoint began, None if nothing was new.

    Files whose header or rows do not fit go, with the reason, to the table at ``quarantine_dir``
    (by default beside the sink, ``<sink>_quarantine``) and none of their rows to the sink.
    The value counts of the batch go to ``state_dir`` if given (``stats_from_state``).
    """
    quarantine_dir = quarantine_dir or f"{sink_dir.rstrip('/')}_quarantine"

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        paths = [r.path for r in batch.collect()]
        if not paths:
            return

        def write(df: DataFrame, path: str) -> None:
            df.write.mode("overwrite").parquet(f"{path}/{BATCH_COL}={number}")

        lines = read_loosely(session, paths)
        judged = cut_lineage(judged_files(lines))
        write(judged.where("reason is not null"), quarantine_dir)
        good = lines.where(~F.col("is_header")).join(judged.where("reason is null").select("file"), "file", "left_semi")
        typed = good.select("file", *[F.col(c).try_cast(f.dataType).alias(f.name) for c, f in zip(_CELLS, SENSOR_FILE_SCHEMA.fields, strict=False)])
        long = sensor_long_from_raw(typed, installed_since)
        write(long, sink_dir)
        if state_dir:
            # the counts are of the rows as written: the files are not parsed again
            written = session.read.schema(long.schema).parquet(f"{sink_dir}/{BATCH_COL}={number}")
            write(A.value_counts(P.null_implausible(written, "parameter", "messwert", "Leitfaehigkeit", CONDUCTIVITY_LIMIT)), state_dir)

    query = (
        new_files(spark, source_dir, glob, max_files)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = query.lastProgress
    return last["batchId"] if last and last["numInputRows"] else None


def stats_from_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """T-02: the statistics of everything ingested, from the value counts of all batches.  The state has a
    row per batch, series and distinct value; the measurements are not read."""
    return A.stats_of_counts(A.merged_counts(spark.read.parquet(state_dir)))


def refresh_stats(spark: SparkSession, sink_dir: str) -> DataFrame:
    """T-02 without a state: statistics over the whole accumulated table in one batch job."""
    return sensor_stats_flow(spark.read.parquet(sink_dir))


def append_unseen(existing: DataFrame, incoming: DataFrame, path_col: str = "file") -> DataFrame:
    """Batch twin of T-01 (J-13 + U-02): rows of files not in ``existing``."""
    new_paths = J.unseen(incoming, existing, path_col)
    fresh = incoming.join(new_paths, path_col, "left_semi")
    return R.append_strict(existing, fresh.select(*existing.columns))
