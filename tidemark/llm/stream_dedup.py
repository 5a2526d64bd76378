"""Exact deduplication by a stateful stream with disk-backed state.

Documents land once in the shared folder with their SHA-256 digest and a row number.  A
stream over the landed files keeps one state entry for each digest, in RocksDB and without
expiry: the stable identifier of the row that stays, the locator of the content that the
others are compared with (its landed row), and the number of arrivals.  The entry is a
streaming aggregate, so every task first combines its own copies and a group holding a
third of all rows reaches its state partition as one row per task.

The landed files are read in several micro-batches (``batches``), so later arrivals meet the
state of earlier ones.  With ``state_folder`` landed rows, state and progress last: another
call goes on from there and decides about its own rows against all that came before.  One
call at a time may use such a folder, its documents have the same columns every time, and
a call that was interrupted before its result is repeated with a new folder.

A digest that arrives again is a hit.  Hits are checked on full bytes: rows of hits are
numbered by a join that moves no text, their texts are found by row number, and each task
combines its copies by digest and text before they are moved, so a hot text meets as one
row per task.  Should two texts share a digest, the group by full text decides instead of
the state.

Edge cases: a null text counts as empty.  Null identifiers are smaller than all others; of
several rows with the largest identifier the one with the smallest row number stays, so
exactly one row of a group is kept even where rows repeat.  An empty table gives an empty
table.  Input columns named like a result column are replaced by the result.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import packed, stored, text_or_empty, unpacked, with_result, work_folder

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All state partitions of an executor share one bounded cache.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores would each reserve megabytes of disk ahead of use.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# A Bloom filter of the hit rows' numbers runs over the landed rows before the exchange, so only
# rows of hits are moved for the check of their bytes.
HIT_SETTINGS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def land(
    docs: DataFrame, folder: str, first: int, id_column: str, text_column: str, digest: Callable[[Column], Column]
) -> None:
    """Append the documents with digest and row number (from ``first``) to the folder."""
    row = F.col("row")
    (
        packed(docs)
        .select(
            "row",
            row.getField(id_column).alias("id"),
            digest(text_or_empty(row.getField(text_column))).alias("digest"),
            (F.monotonically_increasing_id() + first).alias("seq"),
        )
        .write.mode("append")
        .option("compression", "lz4")
        .parquet(folder)
    )


def registered_arrivals(arrivals: DataFrame) -> DataFrame:
    """State of each digest after the arrivals of a stream (or a table) with id, digest, seq."""
    return arrivals.groupBy("digest").agg(
        F.max(F.struct("id", (-F.col("seq")).alias("minus_seq"))).alias("best"),
        F.min("seq").alias("locator"),
        F.count(F.lit(1)).alias("arrivals"),
    )


def run_stream(landed: DataFrame, root: str, files_per_batch: int) -> DataFrame:
    """Feed the files landed since the last call through the stateful stream; the last state
    of each digest that arrived more than once."""
    spark = landed.sparkSession
    updates = f"{root}/updates"
    source = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", files_per_batch)
    states = registered_arrivals(source.parquet(f"{root}/landed").select("id", "digest", "seq"))
    spark.createDataFrame([], states.schema).write.mode("ignore").parquet(f"{updates}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    with _settings(spark, STATE_SETTINGS):
        query = (
            states.writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/state")
            .foreachBatch(write)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    fields = [*states.schema.fields, T.StructField("batch", T.LongType())]
    # Arrivals only grow, so what has one arrival in every batch needs no exchange.
    return (
        spark.read.schema(T.StructType(fields))
        .parquet(updates)
        .where("arrivals > 1")
        .groupBy("digest")
        .agg(F.max_by(F.struct("best", "locator", "arrivals"), "batch").alias("s"))
        .select("digest", "s.*")
    )


def _landed(spark: SparkSession, folder: str) -> DataFrame | None:
    """What earlier calls landed, or None."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _decided(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batches: int = 3,
    state_folder: str | None = None,
) -> DataFrame:
    """Rows landed by this call with the state of their group; null for rows that are alone."""
    spark = docs.sparkSession
    root = state_folder or work_folder(spark, "digest-state")
    folder = f"{root}/landed"
    earlier = _landed(spark, folder)
    first, known = 0, 0
    if earlier is not None:
        first = earlier.agg(F.coalesce(F.max("seq") + 1, F.lit(0))).first()[0]
        known = len(earlier.inputFiles())
    land(docs, folder, first, id_column, text_column, digest)
    landed = spark.read.parquet(folder) if earlier is None else spark.read.schema(earlier.schema).parquet(folder)
    new_files = len(landed.inputFiles()) - known
    hits = stored(run_stream(landed, root, max(1, -(-new_files // batches))), "digest-hits")

    # Rows of hits by number: narrow, so copies of one text meet their state without it.
    state = F.struct("best", "arrivals").alias("state")
    hit_rows = stored(
        landed.select("id", "digest", "seq").join(hits.select("digest", "locator", "arrivals", state), "digest"),
        "hit-rows",
    )
    # Texts are found by row number, which spreads the copies of a text evenly.  Each task then
    # combines its copies, so one row per task and text is moved to where they are compared.
    text = text_or_empty(F.col("row").getField(text_column))
    contents = (
        landed.select("seq", text.alias("content"))
        .join(hit_rows.where("arrivals > 1").select("id", "digest", "seq", "locator"), "seq")
        .groupBy("digest", "content")
        .agg(
            F.max(F.col("seq") == F.col("locator")).alias("is_reference"),
            F.max(F.struct("id", (-F.col("seq")).alias("minus_seq"))).alias("best"),
            F.count(F.lit(1)).alias("arrivals"),
        )
    )
    with _settings(spark, HIT_SETTINGS):
        checked = stored(contents.withColumn("text_key", F.sha2("content", 512)).drop("content"), "checked-hits")
    differing = checked.where("NOT is_reference").select("digest").distinct()

    arrived = landed.where(F.col("seq") >= first) if first else landed
    joined = arrived.join(hit_rows.select("seq", "state"), "seq", "left")
    if not differing.isEmpty():
        # Texts that differ from the content their digest was registered with: the group by
        # full text, found again by a second digest that separates them, decides.
        if checked.count() != checked.select("digest", "text_key").distinct().count():
            raise ValueError("texts with equal digests cannot be told apart")
        by_text = checked.join(differing, "digest", "left_semi").select(
            "digest", "text_key", F.struct("best", "arrivals").alias("by_text")
        )
        joined = (
            joined.withColumn("text_key", F.when(F.col("state").isNotNull(), F.sha2(text, 512)))
            .join(by_text, ["digest", "text_key"], "left")
            .withColumn("state", F.coalesce("by_text", "state"))
        )
    return joined


def _stays() -> Column:
    return F.col("state").isNull() | (F.col("state.best.minus_seq") == -F.col("seq"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of the documents with keep_id, group_size, kept, text_digest.

    The row with the largest identifier of a group of equal texts stays.  Options are
    ``id_column``, ``text_column``, ``batches``, ``state_folder`` and ``digest``, which may be
    any function of the text; results do not depend on its collisions.
    """
    return with_result(
        _decided(docs, **options),
        keep_id=F.when(F.col("state").isNull(), F.col("id")).otherwise(F.col("state.best.id")),
        group_size=F.coalesce(F.col("state.arrivals"), F.lit(1)).cast("long"),
        kept=_stays(),
        text_digest=F.lower(F.hex("digest")),
    )


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """The input without all but the kept row of each group."""
    return unpacked(_decided(docs, **options).where(_stays()))
