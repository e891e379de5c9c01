"""Helpers shared by the corpus operators: staging, Arrow batches, hot keys, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagwatch.session import ship, stage_table

#: Words are runs of characters other than these six (space, tab, line feed, VT, FF, CR).
SPACES = r"[\x20\x09-\x0D]+"
#: A key with more than one row in HOT_SHARE of all rows counts as hot; so at most HOT_SHARE keys
#: are hot, whatever the input, which bounds every table of hot keys.
HOT_SHARE = 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    return stage_table(df, name)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null reads as empty."""
    return [t or "" for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null reads as empty."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(binary).to_pylist()]


def batches(source: Iterator[pa.RecordBatch], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that what a task holds at once does not follow the session's batch size."""
    for batch in source:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def hot_keys(counts: DataFrame, keys: list[str], count: str = "n", per_salt: int = 5_000) -> DataFrame:
    """Of ``counts`` (a row per key), the keys that hold more than one row in HOT_SHARE, with salts.

    At most HOT_SHARE rows come out whatever the input, so the result may be broadcast.
    """
    total = counts.agg(F.greatest(F.sum(count) / HOT_SHARE, F.lit(float(per_salt))).alias("_least"))
    return counts.join(F.broadcast(total), F.col(count) > F.col("_least")).select(
        *keys, F.ceil(F.col(count) / per_salt).cast("int").alias("_salts")
    )


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: DataFrame) -> DataFrame:
    """Join on ``keys`` where ``right`` has one row per key and ``left`` may have very many.

    Rows of hot keys are dealt over salts, and the single right row is repeated once per salt.
    """
    hot = F.broadcast(hot)
    many = left.join(hot, keys, "left").withColumn(
        "_salt",
        F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int"), F.lit(0)),
    )
    one = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return many.drop("_salts").join(one.drop("_salts"), [*keys, "_salt"], how).drop("_salt")


def connected_components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as rows (a, b); returns (node, component).

    ``component`` is the smallest node of each component. Alternates large-star and small-star
    steps, which need a number of rounds that grows with the logarithm of the component size; each
    round is staged. Self loops are kept as nodes. A node linked to very many others is a long
    list of rows, never one row: the minimum of its neighbours is aggregated before the shuffle,
    and the join back can be split.
    """
    loops = edges.filter(F.col("a") == F.col("b")).select(F.col("a").alias("node")).distinct()
    both = edges.filter(F.col("a") != F.col("b"))
    both = stage(
        both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    nodes = stage(
        both.select(F.col("a").alias("node")).union(both.select("b")).union(loops).distinct(), name
    )
    current, before = both, None
    for _ in range(most_rounds):
        # large-star: every larger neighbour of a node is linked to the least of its neighbourhood
        around = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("_m"))
        least = least.select("a", F.least("a", "_m").alias("_m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = stage(large.distinct(), name)
        # small-star: smaller neighbours and the node itself are linked to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(least, "a").filter("b != _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        current = stage(small.union(least.select("a", F.col("_m").alias("b"))).distinct(), name)
        check = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if check == before:
            break
        before = check
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return nodes.join(current.select(F.col("a").alias("node"), F.col("b").alias("_c")), "node", "left").select(
        "node", F.coalesce("_c", "node").alias("component")
    )


def held_out(doc_id: F.Column | str) -> F.Column:
    """True for the fifth of documents whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents outside the held-out fifth.

    The sample is taken in the order of a hash of doc_id, so it is the same on every run. Null
    labels, null ids and labels other than 0 and 1 are left out; of repeated label rows the
    largest value counts. The chosen ids are at most ``most`` rows, hence the broadcast.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")

