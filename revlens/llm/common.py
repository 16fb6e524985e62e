"""Helpers shared by the operators of this sub-package."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import materialize  # noqa: F401  (re-exported: shared-folder tables)

#: Records per Arrow batch sent to a Python worker.  Texts average a few KB and
#: may reach MBs; small batches keep a worker's memory bounded.
TEXT_BATCH_ROWS = 512


@contextmanager
def small_batches(spark: SparkSession):
    """Actions run within send ``TEXT_BATCH_ROWS`` rows to a Python worker at a time, not a whole partition."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(TEXT_BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with null texts read as empty; other columns are
    dropped here, so their names can never clash with an operator's own."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def like(frame: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, taken from ``frame``, whatever their names."""
    return frame.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])


def fold_ascii(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also fold other scripts)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(id_col: str = "doc_id", modulus: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids give 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus,
                      F.lit(0).cast("bigint"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder (not created)."""
    import uuid

    from revlens.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/revlens-tables/{name}-{uuid.uuid4().hex[:12]}"


def with_locator(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__file`` and ``__row``, the place of each row's content.

    Rows that don't come straight from files are written to the shared folder first."""
    try:
        meta = docs.metadataColumn("_metadata")
        found = docs.select("*", meta["file_path"].alias("__file"), meta["row_index"].alias("__row"))
        found.schema  # noqa: B018  (resolves the names now)
        return found
    except AnalysisException:
        stored = materialize(docs, "located-input")
        meta = stored.metadataColumn("_metadata")
        return stored.select("*", meta["file_path"].alias("__file"), meta["row_index"].alias("__row"))


#: Rows of a file that share a bitmap (as many as Spark's bitmap functions hold).
BLOCK_ROWS = 32_768
#: Bytes of bitmaps that may be broadcast: a bit per row of the files and some 150 bytes per block,
#: so these stand for about 100 million rows.
MAP_BYTES = 16 * 1024 * 1024


def by_place(rows: DataFrame, places: DataFrame, how: str, map_bytes: int = MAP_BYTES) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of located ``rows`` with ``places`` (``__file``, ``__row``).

    The places become bitmaps per block of a file's rows; these are broadcast, so the rows, with
    their texts, aren't shuffled.  Above ``map_bytes`` of bitmaps both sides are shuffled."""
    places = places.select("__file", "__row")
    # a block's places meet before they are added up: one bitmap per block, not one per block and task
    maps = materialize(
        places.select("__file", F.expr(f"__row div {BLOCK_ROWS}").alias("block"),
                      (F.col("__row") % BLOCK_ROWS).alias("at")).repartition("__file", "block")
        .groupBy("__file", "block").agg(F.bitmap_construct_agg("at").alias("bits"), F.max("at").alias("last"))
        .select("__file", "block", F.expr("substring(bits, 1, cast(last div 8 + 1 as int))").alias("bits")),
        f"{how.replace('_', '-')}-places")
    size = maps.agg(F.sum(F.octet_length("bits") + F.octet_length("__file") + 32)).first()[0] or 0
    if size > map_bytes:
        return like(rows.join(places, ["__file", "__row"], how), rows)
    at = rows["__row"] % BLOCK_ROWS
    byte = F.conv(F.hex(F.substring(maps["bits"], (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    same = ((rows["__file"] == maps["__file"]) & (F.floor(rows["__row"] / BLOCK_ROWS) == maps["block"]))
    return rows.join(F.broadcast(maps), same & (F.getbit(byte, (at % 8).cast("int")) == 1), how)


#: Keys that hold at least 1/HEAVY of all rows are at most HEAVY keys: a list with
#: a proven bound, which may be broadcast.
HEAVY = 1000


def join_by_key(rows: DataFrame, keyed: DataFrame, keys: list[str], size_col: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row per key; ``size_col`` is the key's
    number of rows out of ``total``).  Heavy keys are joined map-side, the rest by shuffle."""
    heavy = keyed.filter(F.col(size_col) * HEAVY >= total)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return (rows.join(F.broadcast(heavy), keys)
            .unionByName(rest.join(keyed.filter(F.col(size_col) * HEAVY < total), keys)))
