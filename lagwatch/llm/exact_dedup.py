"""Exact deduplication as a stream with keyed state on disk.

Digests of the normalised texts arrive as a stream of small rows. A keyed aggregation without
watermark, on the RocksDB state store, holds per digest the stable identifier of the row that stays
(smallest doc_id, then place), the number of rows seen and the locator of the kept content. Nothing
expires. Each micro-batch writes the keys it changed, named by batch id and replaced on a rerun.
Map-side sums come before the state's shuffle, so a digest that a third of all rows share sends one
row per task.

A hit is a row whose digest is held by another row. Hits are checked on full bytes: the texts of a
digest meet, and where their bytes differ (only possible where a digest collides) its rows are
grouped by their full text instead.

Nulls: a null text is an empty text. A null doc_id sorts after all others and forms rows of its own.
Repeated rows: of rows equal in doc_id and text exactly one is kept. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import SPACES, hot_keys, salted_join, stage
from lagwatch.session import scratch_path

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column | str) -> Column:
    """White-space runs become one space; null becomes empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digest_rows(docs: DataFrame, digest=sha256_of, name: str = "digests") -> DataFrame:
    """Staged (doc_id, digest, place): place is unique and fixed once written."""
    text = normalised("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), digest(text).alias("digest"), sha256_of(text).alias("text_sha256")
    )
    return stage(rows.withColumn("place", F.monotonically_increasing_id()), name)


def _rank(doc_id: str = "doc_id", place: str = "place") -> Column:
    return F.struct(
        F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"), F.col(place).alias("place")
    )


def stream_groups(rows_path: str, schema, spark, files_per_batch: int = 64, name: str = "dedup") -> DataFrame:
    """Run the stream over the files below ``rows_path``; (digest, keeper, group_size) at its end.

    ``keeper`` is a struct of identifier and locator. The stream ends when all present files are
    read; started again on the same checkpoint it goes on with new files and the old state.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "64")
    # else each store sets 4 MB of disk aside, whatever it holds
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    changes = scratch_path(spark, f"{name}-changes")
    stream = (
        session.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(rows_path)
        .groupBy("digest")
        .agg(F.min(_rank()).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    fields = "digest string, keeper struct<none:boolean,doc_id:bigint,place:bigint>, group_size bigint, batch int"
    if query.lastProgress is None:  # no file, no batch
        return spark.createDataFrame([], fields).drop("batch")
    return (
        spark.read.schema(fields)
        .parquet(changes)
        .groupBy("digest")
        .agg(F.max_by(F.struct("keeper", "group_size"), "batch").alias("s"))
        .select("digest", "s.keeper", "s.group_size")
    )


def exact_duplicates(docs: DataFrame, digest=sha256_of, files_per_batch: int = 64, name: str = "dedup") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` needs doc_id and text; other columns are ignored. ``digest`` makes the state's key
    from the normalised text (a weaker one only sends more rows to the check of full bytes).
    """
    found = _grouped(docs, digest, files_per_batch, name)
    members = stage(found.filter("group_size > 1").select(F.col("doc_id").alias("_id")).distinct(), f"{name}-members")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(members, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return _judged(_checked(docs, found, texts, digest, name)[0])


def _grouped(docs: DataFrame, digest, files_per_batch: int, name: str) -> DataFrame:
    """Every row with the keeper and size of its digest group, before the check of full bytes."""
    spark = docs.sparkSession
    rows = digest_rows(docs, digest, f"{name}-digests")
    path = rows.inputFiles()
    if not path:
        return rows.select(
            "doc_id", "place", "digest", "text_sha256", F.col("doc_id").alias("keep_id"),
            F.col("place").alias("keep_place"), F.lit(1).cast("long").alias("group_size"),
        )
    folder = path[0].rsplit("/", 1)[0]
    groups = stage(stream_groups(folder, rows.schema, spark, files_per_batch, name), f"{name}-groups")
    joined = salted_join(rows, groups, ["digest"], "inner", stage(hot_keys(groups, ["digest"], "group_size"), f"{name}-hot"))
    out = joined.select(
        "doc_id", "place", "digest", "text_sha256", F.col("keeper.doc_id").alias("keep_id"),
        F.col("keeper.place").alias("keep_place"), "group_size",
    )
    return stage(out, f"{name}-grouped")


def _checked(docs: DataFrame, grouped: DataFrame, texts: DataFrame, digest, name: str) -> tuple[DataFrame, bool]:
    """``grouped`` after the check of full bytes, and whether the check changed it."""
    differing = stage(_differing(texts, digest), f"{name}-differing")
    if differing.isEmpty():
        return grouped, False
    return _by_full_text(docs, grouped, differing, digest, name), True


def _judged(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), "text_sha256"
    )


def _differing(texts: DataFrame, digest) -> DataFrame:
    """Digests under which full bytes differ. ``texts`` has the text of every row in a group.

    Whole texts are the grouping key, so each is compared byte for byte; copies in one task are
    combined before the shuffle, which a hot group passes as one row per task.
    """
    text = normalised("text")
    mine = texts.select(digest(text).alias("digest"), text.alias("text")).distinct()
    return mine.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")


def _by_full_text(docs: DataFrame, grouped: DataFrame, differing: DataFrame, digest, name: str) -> DataFrame:
    """Regroup the rows of colliding digests by full text."""
    fine = grouped.join(differing, "digest", "left_anti")
    text = normalised("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), digest(text).alias("digest"))
    rows = rows.join(differing, "digest", "left_semi").withColumn("place", F.monotonically_increasing_id())
    rows = stage(rows, f"{name}-collisions")
    keys = rows.groupBy("digest", "text").agg(F.min(_rank()).alias("k"), F.count(F.lit(1)).alias("group_size"))
    again = rows.join(keys, ["digest", "text"]).select(
        "doc_id", "place", "digest", sha256_of(F.col("text")).alias("text_sha256"), F.col("k.doc_id").alias("keep_id"),
        F.col("k.place").alias("keep_place"), "group_size",
    )
    return fine.unionByName(again)


def _marked(docs: DataFrame, grouped: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` as struct ``row`` beside what is decided for their doc_id, written once.

    Serves the check of full bytes and the result, so the texts are joined once for both. Only
    ids in a group or on several rows take part in the join; all other rows stay as they are.
    """
    flags = grouped.groupBy(F.col("doc_id").alias("id")).agg(
        (F.count(F.lit(1)) > 1).alias("repeated"),
        F.max(F.col("group_size") > 1).alias("hit"),
        F.max(F.col("place") == F.col("keep_place")).alias("kept"),
    )
    flags = stage(flags.filter("repeated or hit"), f"{name}-flags")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = rows.join(flags, F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")), "left")
    defaults = {"repeated": False, "hit": False, "kept": True}
    return stage(joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()}), f"{name}-marked")


def drop_duplicates(docs: DataFrame, name: str = "dedup") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    grouped = _grouped(docs, sha256_of, 64, name)
    marked = _marked(docs, grouped, name)
    hits = marked.filter("hit").select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"))
    grouped, changed = _checked(docs, grouped, hits, sha256_of, name)
    if changed:
        marked = _marked(docs, grouped, name)
    once = marked.filter("kept and not repeated").select("row.*")
    several = marked.filter("kept and repeated").withColumn("sha", sha256_of(normalised(F.col("row.text"))))
    if several.isEmpty():
        return once
    # a doc_id on several rows: one row for each distinct text that stays under it
    stays = _judged(grouped).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    several = several.join(stays, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left_semi")
    return once.unionByName(several.dropDuplicates(["id", "sha"]).select("row.*"))
