"""Episodes from a growing folder of transcripts, as a restartable stream.

Every new file is read whole once (a file is a session, bounded by the discovery limits), so no open window has to live in state:
each micro-batch is parsed, redacted, cut and gated like a batch, and what earlier batches have written is anti-joined away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from episodica.operators.episodes import build_episodes
from episodica.operators.normalize import normalize_files
from episodica.operators.redact import redact

FILES = "value string"


def new_files(spark: SparkSession, folder: str, files_per_batch: int = 500) -> DataFrame:
    """path, content of the files of a folder as a stream."""
    stream = spark.readStream.schema(FILES).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").option("wholetext", "true").format("text").load(folder)
    return stream.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def episodes_of(files: DataFrame, source: str, format: str, hint: str | None = None, include_raw: bool = False, **constants: str) -> DataFrame:
    """Redacted, gated episodes of files (path, content)."""
    return build_episodes(redact(normalize_files(files, source, format, hint)), include_raw, source_tool=source, **constants)


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, source: str, format: str, hint: str | None = None, files_per_batch: int = 500, include_raw: bool = False, **constants: str) -> StreamingQuery:
    """Process what is in folder now and stop; start again with the same checkpoint for what came since.

    Episodes go to out/batch=N. A repeated batch overwrites its folder, so each episode is written once.
    """

    def put(files: DataFrame, batch: int) -> None:
        made = episodes_of(files, source, format, hint, include_raw, **constants)
        before = written(files.sparkSession, out).filter(F.col("batch") < batch).select("id").distinct()
        fresh = made.dropDuplicates(["id"]).join(before, "id", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return new_files(spark, folder, files_per_batch).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def written(spark: SparkSession, out: str) -> DataFrame:
    """All episodes written so far, with batch."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target) or not len(files.listStatus(target)):
        return spark.createDataFrame([], "id string, batch int")
    return spark.read.parquet(out)
