"""Exact de-duplication as a stateful stream (DataFrame operations only).

A feed of fingerprints ``(digest, n_bytes, doc_id, file, row)`` is consumed by
Structured Streaming.  The keyed state lives on disk (RocksDB, checkpointed in
the shared folder), never expires, and holds per digest the number of copies
and the keeper's stable identifier and content locator (file and row).  The
state is then read back as a table.  A digest hit alone decides nothing: the
whole bytes of each hit are compared with the keeper's, and rows that differ in
spite of an equal digest are grouped by their text instead.

Skew: the stream aggregates each micro-batch before its shuffle.  Digests that
hold at least 1/``HEAVY`` of the rows are at most ``HEAVY`` keys, so that list
may be broadcast; their rows are spread over ``SALTS`` sub-keys in the byte
check, which compares each row with one keeper (no pairs within a group).

Defined results: null text equals empty text; the copy with the largest
``doc_id`` stays (nulls are smallest; among rows that repeat the same id and
text, the one latest by file and row); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import by_place, join_by_key, like, materialize, shared_folder, with_locator

HEAVY = 1000
SALTS = 64
KEY = ["digest", "n_bytes"]
#: The state store's settings.  Without pre-allocated files a store of few keys stays small.
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def fingerprints(located: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return located.select(F.sha2(text, 256).alias("digest"),
                          F.octet_length(text).cast("bigint").alias("n_bytes"),
                          F.col(id_col).alias("doc_id"), "__file", "__row")


def run_state(feed: DataFrame, checkpoint: str) -> None:
    """Feed a stream of fingerprints into the keyed state below ``checkpoint``.

    Call it again with later files and the same checkpoint: the state goes on."""
    spark = feed.sparkSession
    state = feed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"),
                                   F.max(F.struct("doc_id", "__file", "__row")).alias("keeper"))
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        (state.writeStream.format("noop").outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: digest, n_bytes, copies, keeper."""
    kept = spark.read.format("statestore").option("path", checkpoint).load()
    values = kept.schema["value"].dataType.names
    count, keeper = values[-2], values[-1]
    return kept.select("key.digest", "key.n_bytes", F.col(f"value.`{count}`").alias("copies"),
                       F.col(f"value.`{keeper}`").alias("keeper"))


@dataclass
class Dedup:
    #: One row per document: doc_id, keep_id, group_size, kept, digest, __file, __row.
    rows: DataFrame
    #: The input with its locators.
    located: DataFrame


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Dedup:
    spark = docs.sparkSession
    located = with_locator(docs)
    path = shared_folder(spark, "dedup-feed")
    fingerprints(located, id_col, text_col).write.parquet(path)
    feed = spark.read.parquet(path)
    total = feed.count()
    out = ["doc_id", "keep_id", "group_size", "kept", "digest", "__file", "__row"]
    alone = feed.select("doc_id", F.col("doc_id").alias("keep_id"),
                        F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"),
                        *KEY, "__file", "__row")
    if not total:
        return Dedup(alone.select(*out), located)
    checkpoint = shared_folder(spark, "dedup-state")
    run_state(spark.readStream.schema(feed.schema).parquet(path), checkpoint)
    hits = materialize(read_state(spark, checkpoint).filter("copies > 1"), "dedup-hits")

    heavy = hits.filter(F.col("copies") * HEAVY >= total).select(*KEY)  # at most HEAVY rows
    light = hits.join(F.broadcast(heavy), KEY, "left_anti")
    singles = (alone.join(F.broadcast(heavy), KEY, "left_anti").join(light, KEY, "left_anti"))

    # only the texts of hits are shuffled
    hit_rows = join_by_key(feed, hits.select(*KEY, "copies"), KEY, "copies", total)
    checked = _check_bytes(by_place(located, hit_rows, "left_semi"), hits, heavy, id_col, text_col)
    odd = checked.filter("differs")
    if odd.isEmpty():
        groups = checked.withColumn("group_size", F.col("copies"))
    else:
        groups = _split(checked, odd)
    found = groups.select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size",
        ((F.col("keeper.__file") == F.col("__file")) & (F.col("keeper.__row") == F.col("__row"))).alias("kept"),
        "digest", "__file", "__row")
    return Dedup(singles.select(*out).unionByName(found.select(*out)), located)


def _check_bytes(located, hits, heavy, id_col, text_col) -> DataFrame:
    """Rows of the hit digests with ``differs`` (from the keeper's bytes) and, then, their text."""
    salts = F.explode(F.when(F.col("is_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                      .otherwise(F.array(F.lit(0))))
    spread = (hits.join(F.broadcast(heavy.withColumn("is_heavy", F.lit(True))), KEY, "left")
              .withColumn("is_heavy", F.coalesce("is_heavy", F.lit(False)))
              .withColumn("salt", salts).drop("is_heavy"))
    rows = _texts(located, id_col, text_col)
    marked = (rows.join(F.broadcast(heavy.withColumn("is_heavy", F.lit(True))), KEY, "left")
              .withColumn("salt", F.when(F.col("is_heavy"),
                                         F.pmod(F.xxhash64("__file", "__row"), F.lit(SALTS)).cast("int"))
                          .otherwise(F.lit(0))).drop("is_heavy"))
    members = materialize(marked.join(spread, [*KEY, "salt"]), "dedup-members")
    keeper = members.filter((F.col("keeper.__file") == F.col("__file"))
                            & (F.col("keeper.__row") == F.col("__row")))
    keeper_text = (keeper.select(*KEY, F.col("text").alias("keeper_text"))
                   .join(spread.select(*KEY, "salt"), KEY))
    pairs = members.join(keeper_text, [*KEY, "salt"])
    differs = ~F.col("text").eqNullSafe(F.col("keeper_text"))
    return materialize(pairs.select(*KEY, "doc_id", "__file", "__row", "copies", "keeper",
                                    differs.alias("differs"),
                                    F.when(differs, F.col("text")).alias("text")), "dedup-checked")


def _texts(located, id_col, text_col) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return located.select(F.sha2(text, 256).alias("digest"),
                          F.octet_length(text).cast("bigint").alias("n_bytes"),
                          F.col(id_col).alias("doc_id"), "__file", "__row", text.alias("text"))


def _split(checked: DataFrame, odd: DataFrame) -> DataFrame:
    """Equal digests, different bytes: the rows that differ form groups by text."""
    n_odd = odd.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_odd"))
    same = (checked.filter(~F.col("differs")).join(n_odd, KEY, "left")
            .withColumn("group_size", F.col("copies") - F.coalesce("n_odd", F.lit(0))))
    by_text = odd.groupBy("text").agg(F.count(F.lit(1)).alias("group_size"),
                                      F.max(F.struct("doc_id", "__file", "__row")).alias("keeper"))
    apart = odd.drop("keeper").join(by_text, "text")
    return same.unionByName(apart, allowMissingColumns=True)


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row keeps."""
    result = dedup(docs, id_col=id_col, text_col=text_col)
    return like(by_place(result.located, result.rows.filter("not kept"), "left_anti"), docs)
