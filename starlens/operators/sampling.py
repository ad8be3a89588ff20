"""Samples, splits, class weights and over-sampling.

Rows are put in a fixed random order by ``sampling_key``. No operator ranks
all rows of a class or of the whole table in one task: exact quotas are found
by counting hash buckets first (``quota_cut``), and small per-group quotas by
ranking within salted parts of a group first (``first_per_group``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.constants import (
    BASELINE_ROWS, NEGATIVE, NEUTRAL, REVIEWS_PER_RATING, SAMPLE_ROWS, SENTIMENTS, TEST_SHARE,
)
from starlens.functions.numbers import sampling_key

BUCKET_DIGITS = 4


def quota_cut(df: DataFrame, group: str, quota: Callable[[Column], Column], row_id: str = "review_id") -> list:
    """Per group, the sampling key and id of the last row that fits its quota.

    ``quota`` turns the size of a group into its quota. Rows are counted per
    group and leading hash digits; only the one bucket per group in which the
    quota ends is ranked, about 1/65536 of it. The groups are classes (or the
    whole table), so the cut is a handful of rows, which the driver writes
    into expressions. A group with quota 0 has none.
    """
    slim = df.select(group, F.col(row_id).alias("cut_id"), sampling_key(F.col(row_id)).alias("cut_key"))
    slim = slim.withColumn("bucket", F.substring("cut_key", 1, BUCKET_DIGITS))
    members = Window.partitionBy(group)  # over bucket counts, at most 65536 per group
    counted = slim.groupBy(group, "bucket").agg(F.count("*").alias("n")).select(
        "*", F.sum("n").over(members.orderBy("bucket")).alias("upto"),
        quota(F.sum("n").over(members)).cast("bigint").alias("quota"),
    )
    last = counted.where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota"))).collect()
    place = F.lit(None).cast("bigint")
    for row in last:
        here = (F.col(group) == row[group]) & (F.col("bucket") == row["bucket"])
        place = F.when(here, row["quota"] - row["upto"] + row["n"]).otherwise(place)
    rank = F.row_number().over(members.orderBy("cut_key", "cut_id"))
    return (
        slim.withColumn("place", place).where(F.col("place").isNotNull())
        .withColumn("rank", rank).where(F.col("rank") == F.col("place"))
        .select(group, "cut_key", "cut_id").collect()
    )


def within_cut(cuts: list, group: Column, row_id: Column) -> Column:
    """True for rows at or before the cut of their group; a plain comparison, no join."""
    key = sampling_key(row_id)
    inside = F.lit(False)
    for value, cut_key, cut_id in cuts:
        before = (key < cut_key) | ((key == cut_key) & (row_id <= F.lit(cut_id)))
        inside = F.when(group == value, before).otherwise(inside)
    return inside


def capped_sample(df: DataFrame, cap: int = SAMPLE_ROWS, row_id: str = "review_id") -> DataFrame:
    """``min(cap, n)`` rows in random but repeatable choice."""
    whole = df.withColumn("cut_group", F.lit(0))
    cuts = quota_cut(whole, "cut_group", lambda n: F.least(n, F.lit(cap)), row_id)
    return whole.where(within_cut(cuts, F.col("cut_group"), F.col(row_id))).select(*df.columns)


def first_rows(df: DataFrame, n: int = BASELINE_ROWS, row_id: str = "review_id") -> DataFrame:
    """The first ``n`` rows in sampling order."""
    return df.orderBy(sampling_key(F.col(row_id)), row_id).limit(n)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, salt: Column, salts: int = 32) -> DataFrame:
    """The first ``n`` rows of each group.

    A group is ranked in salted parts first, so a group that holds a third of
    the table spreads over ``salts`` tasks; Spark also applies the limit of
    each rank before the shuffle.
    """
    rank = F.row_number()
    part = Window.partitionBy(*keys, "salt").orderBy(*order)
    group = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("salt", F.pmod(F.xxhash64(salt), F.lit(salts)))
        .withColumn("rank", rank.over(part)).where(F.col("rank") <= n)
        .withColumn("rank", rank.over(group)).where(F.col("rank") <= n)
        .drop("salt", "rank")
    )


def group_sample(
    df: DataFrame, keys: Sequence[str] = ("category", "rating"), cap: int | None = REVIEWS_PER_RATING,
    row_id: str = "review_id", ties: Sequence[str] = (),
) -> DataFrame:
    """At most ``cap`` rows per group, in random but repeatable choice.

    ``ties`` orders rows that share an id.
    """
    if not cap:
        return df
    keyed = df.withColumn("sample_key", sampling_key(F.col(row_id)))
    order = ["sample_key", row_id, *ties]
    return first_per_group(keyed, keys, order, cap, F.col(row_id)).drop("sample_key")


def stratified_split(df: DataFrame, label: str = "sentiment", share: float = TEST_SHARE, row_id: str = "review_id") -> DataFrame:
    """Add ``split``: the given share of every class is ``test``, the rest ``train``."""
    cuts = quota_cut(df, label, lambda n: F.round(F.lit(share) * n), row_id)
    test = within_cut(cuts, F.col(label), F.col(row_id))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def class_counts(df: DataFrame, label: str = "sentiment") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, boost: float = 1.0, label: str = "sentiment") -> DataFrame:
    """Balanced weights n/(k*n_c), with the Neutral weight multiplied by ``boost``."""
    classes = Window.partitionBy(F.lit(1))  # over one row per class
    weight = F.sum("n").over(classes) / (F.count("*").over(classes) * F.col("n"))
    factor = F.when(F.col(label) == NEUTRAL, F.lit(float(boost))).otherwise(F.lit(1.0))
    return class_counts(df, label).select(label, "n", (weight * factor).alias("weight"))


def with_sample_weight(df: DataFrame, weights: DataFrame, label: str = "sentiment") -> DataFrame:
    """Attach the class weight to every row; one line per class is broadcast."""
    return df.join(F.broadcast(weights.select(label, "weight")), label)


def with_copies(train: DataFrame, label: str = "sentiment", row_id: str = "review_id") -> DataFrame:
    """Add ``copies``: how often a row occurs once Neutral is raised to the Negative count.

    Extra copies go round the Neutral rows in sampling order. So every Neutral
    row gets the whole rounds, and the first ``extra % n_neutral`` rows one
    more; no row needs its exact rank.
    """
    sizes = {row[label]: row["n"] for row in class_counts(train, label).collect()}
    n_negative, n_neutral = sizes.get(NEGATIVE, 0), sizes.get(NEUTRAL, 0)
    if n_neutral > n_negative:
        raise ValueError("over-sampling target is below the current Neutral count")
    rounds, rest = divmod(n_negative - n_neutral, n_neutral) if n_neutral else (0, 0)
    neutral = F.col(label) == NEUTRAL
    cuts = quota_cut(train.where(neutral), label, lambda n: F.lit(rest), row_id) if rest else []
    extra = rounds + F.when(within_cut(cuts, F.col(label), F.col(row_id)), 1).otherwise(0)
    return train.withColumn("copies", (1 + F.when(neutral, extra).otherwise(0)).cast("bigint"))


def over_sample(train: DataFrame, label: str = "sentiment", row_id: str = "review_id") -> DataFrame:
    """Repeat Neutral rows up to the Negative count; ``copy_no`` 0 is the original."""
    counted = with_copies(train, label, row_id)
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)
    return counted.select(*train.columns, F.explode(numbers).alias("copy_no"))


def cross_folds(df: DataFrame, folds: int = 3, label: str = "sentiment", row_id: str = "review_id") -> DataFrame:
    """Add ``fold`` (0..folds-1) of equal size in every class, cut by the sampling order."""
    fold = F.lit(0)
    for k in range(1, folds):
        cuts = quota_cut(df, label, lambda n, q=k / folds: F.floor(F.lit(q) * n), row_id)
        fold = fold + F.when(within_cut(cuts, F.col(label), F.col(row_id)), 0).otherwise(1)
    return df.withColumn("fold", fold.cast("int"))


def class_distribution(parts: Sequence[tuple[str, DataFrame]], label: str = "sentiment") -> DataFrame:
    """Class sizes of several named data sets, zero-filled."""
    frames = []
    for name, part in parts:
        wide = part.agg(*[F.count_if(F.col(label) == s).alias(s) for s in SENTIMENTS])
        rows = F.array(*[F.struct(F.lit(s).alias("sentiment"), F.col(s).alias("n")) for s in SENTIMENTS])
        frames.append(wide.select(F.lit(name).alias("part"), F.inline(rows)))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


