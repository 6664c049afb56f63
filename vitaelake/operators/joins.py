"""Left join, semi-join and key filter that hold when one key owns a large share of either side."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.operators.projection import row_hash


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys that occur more than once, with their row counts: each fans a join out."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counts.where("rows > 1")


# Rows of one right key that a task joins; a key with more is dealt to several.
HOT_ROWS = 100_000
# Values that rows with a null key are spread over.
NULL_SPREAD = 1 << 20


def hot_keys(right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of more than ``hot_rows`` right rows, with the number of tasks (``salts``) to deal each
    to. Counted before the shuffle; at most one key for every ``hot_rows`` rows."""
    counts = right.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_hot"))
    salts = F.ceil(F.col("rows") / hot_rows).cast("long")
    counted = counts.agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > hot_rows)
    return counted.select("_hot", salts.alias("salts"))


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    unique_right: bool = False,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left equi-join on one column of the same name: exact match, null never matches, several
    matches fan out. A right column named like a left one gets the suffix ``_right``.

    One plain left join, built without running a job: the left side is planned and read once.
    Left rows with a null key are spread over values that match nothing. Right rows of a hot key
    are dealt to several salts by their hash, and left rows of that key go to each of them; a copy
    that meets no right row is dropped, as the key is known to have some. A key that is hot on the
    left alone can be split by adaptive execution.

    ``hot`` is ``hot_keys(right, key)`` as a job has measured and stored it, which spares the plan
    its own count of the right keys; ``unique_right`` says that no key is there twice.
    """
    clashes = set(left.columns) & set(right.columns) - {key}
    right = right.withColumnsRenamed({name: f"{name}_right" for name in clashes})
    value, right_value = F.col(f"`{key}`"), F.col("_right_key")
    right_columns = [name for name in right.columns if name != key]
    columns = [f"`{name}`" for name in [*left.columns, *right_columns]]
    keyed = right.where(value.isNotNull())
    spread = F.pmod(row_hash(left), F.lit(NULL_SPREAD))
    if unique_right:
        salted = left.withColumn("_salt", F.when(value.isNull(), spread).otherwise(F.lit(0).cast("long")))
        other = keyed.withColumn("_right_salt", F.lit(0).cast("long"))
    else:
        hot = hot_keys(right, key, hot_rows) if hot is None else hot
        salts = F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1).cast("long")) - 1)
        salts = F.when(value.isNull(), F.array(spread)).otherwise(salts)
        salted = left.join(hot, value == F.col("_hot"), "left").select(
            *[f"`{name}`" for name in left.columns],
            F.col("_hot").isNotNull().alias("_is_hot"),
            F.explode(salts).alias("_salt"),
        )
        dealt = F.coalesce(F.pmod(row_hash(right), F.col("salts")), F.lit(0).cast("long"))
        other = keyed.join(hot, value == F.col("_hot"), "left").withColumn("_right_salt", dealt)
    other = other.select(
        value.alias("_right_key"),
        "_right_salt",
        *[f"`{name}`" for name in right_columns],
        F.lit(True).alias("_met"),
    )
    on = (value == right_value) & (F.col("_salt") == F.col("_right_salt"))
    joined = salted.join(other, on, "left")
    if not unique_right:
        joined = joined.where(~F.col("_is_hot") | F.col("_met").isNotNull())
    return joined.select(*columns)


def semi_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the given keys. Each key counts once, so no row repeats."""
    return df.join(keys.select(on).where(F.col(on).isNotNull()).distinct(), on, "left_semi")


# Keys that a filter names one by one.
NAMED_KEYS = 10_000


def key_filter(df: DataFrame, keys: DataFrame, on: str, most: int = NAMED_KEYS) -> DataFrame:
    """``semi_join`` for what may be few keys: up to ``most`` are named in the filter itself, which
    reaches the scan and passes over files and row groups that hold none of them (see
    ``Table.key``). More of them are joined, with the same rows."""
    distinct = keys.select(on).where(F.col(on).isNotNull()).distinct()
    found = [row[0] for row in distinct.limit(most + 1).collect()]
    if len(found) > most:
        return semi_join(df, keys, on)
    return df.where(F.col(f"`{on}`").isin(found))
