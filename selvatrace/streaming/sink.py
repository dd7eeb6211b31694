"""Sinks for streams, in the shared folder."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from selvatrace.plans.ordered import first_rows
from selvatrace.session import scratch_path


def stream_sink(stream: DataFrame, path: str, mode: str = "update") -> StreamingQuery:
    """Starts a stream that upserts into ``path``; read it back with ``read_upserts``.

    Each micro-batch goes into a folder named after its id. A batch that runs again after a
    failure overwrites its own folder, so every batch counts exactly once. The stream's progress lies
    beside the batches, under a name that readers of the folder skip: numbers of batches then never start afresh
    among older ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}/_progress")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers behind ``prefix`` in the names of what lies in ``path``, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def _live(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame | None, list[int], list[int]]:
    """The rows that count, and the numbers of their merged folder, if any, and of the batches after it."""
    merged = _folders(spark, f"{path}/_merged", "upto=")[-1:]
    batches = [b for b in _folders(spark, path, "batch_id=") if not merged or b > merged[0]]
    read = spark.read.schema(f"{schema}, batch_id bigint")
    parts = [read.parquet(f"{path}/_merged/upto={m}") for m in merged]
    if batches:
        parts.append(read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in batches]))
    return reduce(DataFrame.unionByName, parts) if parts else None, merged, batches


def compact(spark: SparkSession, path: str, key: list[str], schema: str) -> int:
    """Merges all batches but the newest into one folder of the newest rows; returns how many folders are then read.

    The newest batch may still run again after a failure, so it stays as it is. What is merged is written under a name that
    readers skip and then renamed, in one step: until then readers see the old folders, and from then on the merged one in
    their place. Folders that no longer count are deleted last; if that does not happen they are skipped, and deleted next time.
    """
    rows, merged, batches = _live(spark, path, schema)
    old = batches[:-1]
    if old:
        upto, draft = old[-1], f"{path}/_drafts/{uuid.uuid4().hex}"
        first_rows(rows.filter(F.col("batch_id") <= upto), key, [F.col("batch_id").desc()], 1).write.parquet(draft)
        place = spark._jvm.org.apache.hadoop.fs.Path
        files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(place(f"{path}/_merged"))
        if not files.rename(place(draft), place(f"{path}/_merged/upto={upto}")):
            raise OSError(f"could not rename {draft}")
        gone = [f"_merged/upto={m}" for m in _folders(spark, f"{path}/_merged", "upto=") if m < upto]
        gone += [f"batch_id={b}" for b in _folders(spark, path, "batch_id=") if b <= upto]
        for name in gone:
            files.delete(place(f"{path}/{name}"), True)
    return bool(old or merged) + len(batches) - len(old)


def read_upserts(spark: SparkSession, path: str, key: list[str], schema: str) -> DataFrame:
    """The newest row per key over all batches written by ``stream_sink``, merged (``compact``) or not."""
    rows = _live(spark, path, schema)[0]
    if rows is None:
        return spark.createDataFrame([], schema)
    return first_rows(rows, key, [F.col("batch_id").desc()], 1).drop("batch_id")


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Waits for a stream with an end; raises what stopped it, or if it takes longer than ``seconds``, if given."""
    done = query.awaitTermination(seconds) if seconds is not None else (query.awaitTermination() or True)
    failure = query.exception()
    if failure is not None:
        raise failure
    if not done:
        query.stop()
        raise TimeoutError(f"stream still running after {seconds} s")


def drain(stream: DataFrame, name: str, seconds: int | None = None) -> DataFrame:
    """Runs an append-mode stream over what is there now and returns the files it wrote."""
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-progress")
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, seconds)
    return spark.read.schema(stream.schema).parquet(out)


def drain_upserts(stream: DataFrame, name: str, key: list[str], seconds: int | None = None) -> DataFrame:
    """Runs an update-mode stream over what is there now and returns its newest rows."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    finish(stream_sink(stream, out), seconds)
    return read_upserts(spark, out, key, _ddl(stream))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
