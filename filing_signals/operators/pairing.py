"""Every row of a large table with every row of a small dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension up to this size is handed to every task; a larger one is joined by a shuffle.
SMALL_BYTES = 8 << 20
SLICE_ROWS = 10_000
SALTS_PER_TASK = 4


def is_small(dim: DataFrame, limit: int = SMALL_BYTES) -> bool:
    """Whether a dimension's rows take at most `limit` bytes, summed on the cluster."""
    width = F.length(F.to_json(F.struct(*dim.columns)))
    return dim.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"] <= limit


def join_dimension(
    df: DataFrame, dim: DataFrame, keys: list[str], limit: int = SMALL_BYTES, undealt: DataFrame | None = None
) -> DataFrame:
    """Inner join of a large table with one keyed by `keys`.

    The dimension is broadcast only when its measured size allows. Otherwise both sides are
    sorted and merged, where AQE splits the partitions of a hot key. Left to its estimates,
    Spark may take the large side for the small one: it does not foresee what `explode` adds.

    Where `df` was dealt to more tasks by a shuffle, `undealt` are its rows before: a merge shuffles them anyway.
    """
    if is_small(dim, limit):
        return df.join(F.broadcast(dim), keys)
    return (df if undealt is None else undealt).join(dim.hint("merge"), keys)


def with_each(df: DataFrame, rows: list, schema: T.StructType, alias: str) -> DataFrame:
    """Each row of `df` once per dimension row, as struct `alias`, with its position `<alias>_pos`.

    A generator over one constant array: no shuffle, no join.
    """
    dim = df.sparkSession.createDataFrame(rows, schema).coalesce(1)
    packed = F.array_sort(F.collect_list(F.struct(*schema.fieldNames())))
    array = dim.agg(packed.alias("rows")).scalar()
    return df.select("*", F.posexplode(array).alias(f"{alias}_pos", alias))


def with_each_by_shuffle(
    df: DataFrame, keys: list[str], dim: DataFrame, alias: str, slices: int | None = None
) -> DataFrame:
    """The same pairs for a dimension too large to hand out.

    The dimension is cut into slices by hash and each row of `df` is sent to every slice; rows
    are also salted by their own key, so (slice, salt) cells are small and evenly filled.
    """
    spark = df.sparkSession
    salts = SALTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if slices is None:
        slices = max(1, -(-dim.count() // SLICE_ROWS))
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")).withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    )
    right = dim.select(
        F.pmod(F.xxhash64(dim.columns[0]), F.lit(slices)).cast("int").alias("_slice"),
        F.struct(*dim.columns).alias(alias),
    ).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, ["_slice", "_salt"]).drop("_slice", "_salt")
