"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import configure, scratch_path

# Rows per Arrow batch handed to Python tasks: documents are long, so batches are short.
ARROW_ROWS = 512


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; safe on a running session."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read (a lost executor costs no
    recomputation), and gives the planner a measured size: joins against the result are
    broadcast only under ``spark.sql.autoBroadcastJoinThreshold``, and otherwise both
    sides of the join are plain exchanges, which adaptive execution can split when skewed.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


COPIES_A_TASK = 1024


def every_copy(df: DataFrame) -> DataFrame:
    """Each row as often as its column ``copies`` says; a row's copies are made by many tasks."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(COPIES_A_TASK).cast("long")
    blocks = df.filter("copies > 1").withColumn("_block", F.explode(F.expr(
        f"sequence(0L, (copies - 1) div {COPIES_A_TASK})"))).repartition(parts)
    made = blocks.withColumn("_copy", F.explode(F.sequence(
        F.lit(1).cast("long"), F.least(least, F.col("copies") - F.col("_block") * least)))).drop("_block", "_copy")
    return df.filter("copies = 1").unionByName(made).drop("copies")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the vectorised ``lower``."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, LOWER))


def packed(df: DataFrame) -> DataFrame:
    """All columns of ``df`` as one struct column ``doc``, so that results beside it clash with no name."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("doc"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("doc.*")



SLICE_CHARS = 1 << 20


def text_slices(texts, limit: int = SLICE_CHARS):
    """Cut an Arrow string array into (start, end) ranges of about ``limit`` bytes; a longer text stands alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and held + size > limit:
            yield lo, i
            lo, held = i, 0
        held += int(size)
    if len(sizes) > lo:
        yield lo, len(sizes)


def map_docs(df: DataFrame, text_col: str, schema: str, make: Callable) -> DataFrame:
    """``doc`` (all columns of ``df``) and the columns of ``schema``, computed from the text alone.

    ``make()`` is called once per task and returns a function from a list of texts (a null
    text is None) to the result columns, as Arrow arrays or lists. A call sees about
    ``SLICE_CHARS`` bytes of text, or one longer text.
    """
    rows = packed(df)
    extra = StructType.fromDDL(schema)
    target = StructType([rows.schema["doc"], *extra.fields])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, work = to_arrow_schema(extra), make()
        for batch in batches:
            doc = batch.column(0)
            texts = doc.field(doc.type.get_field_index(text_col))
            for lo, hi in text_slices(texts):
                cols = work(texts.slice(lo, hi - lo).to_pylist())
                arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                          for c, f in zip(cols, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([doc.slice(lo, hi - lo), *arrays], ["doc", *arrow.names])

    return rows.mapInArrow(run, target)
