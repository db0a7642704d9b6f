"""Tables and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridecast.operators.lookup import attach
from stridecast.sources.shared import shared_folder

#: White space of all contracts: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    It cuts the lineage: what reads the table sees the same rows each time, and a
    lost executor costs a read of some files. The tables live in
    ``spark.checkpoint.dir`` as checkpoints do, and go with that folder.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Fixed: rows that one bitmap of ``bitmap_construct_agg`` covers.
BITMAP_ROWS = 32_768


class PlacedRows:
    """The rows of a table, named by ``place_file`` and ``place_row``: their file and their
    number in it, which any reading repeats.

    Rows that are no table yet are written first. So some of them can be told apart from
    the others, also from equal ones, without their values being shuffled.
    """

    def __init__(self, docs: DataFrame):
        plan = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
        is_table = plan == "LogicalRelation" and bool(docs.inputFiles())
        self.docs = docs if is_table else stage(docs, "rows")
        place = self.docs.metadataColumn("_metadata")
        self.place = [
            place.getField("file_path").alias("place_file"),
            place.getField("row_index").alias("place_row"),
        ]

    def only(self, kept: DataFrame) -> DataFrame:
        """The rows whose places are in ``kept``, with all their columns.

        The places become bitmaps, one for some 32,000 rows of a file. Up to 64 MB of
        them are broadcast and no row moves; beyond, one join shuffles the rows.
        """
        chunk = F.floor(F.col("place_row") / BITMAP_ROWS).alias("chunk")
        bit = F.col("place_row") % BITMAP_ROWS
        bitmaps = stage(
            kept.groupBy("place_file", chunk).agg(
                F.bitmap_construct_agg(bit).alias("bits"), F.count(F.lit(1)).alias("n")
            ),
            "bitmaps",
        )
        rows = self.docs.select(F.struct("*").alias("doc"), *self.place)
        found = attach(rows.select("*", chunk), bitmaps, ["place_file", "chunk"], "n")
        byte = F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
        mask = F.expr(f"shiftleft(1, cast(place_row % {BITMAP_ROWS} % 8 as int))")
        is_kept = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(mask) != 0
        return found.where(is_kept).select("doc.*")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checked_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are at most ``most``."""
    return F.broadcast(df) if rows <= most else df


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a labelled row is kept out of training: crc32 of the id as text, mod 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
