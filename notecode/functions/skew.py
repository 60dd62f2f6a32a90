"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of the rows on, so at most 1 / HOT_SHARE keys can be hot.
HOT_SHARE = 0.01


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Keys that hold at least HOT_SHARE of all rows, given one row per key with its count.

    At most 100 rows by construction, which is the bound that makes broadcasting them safe.
    """
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col(n) >= HOT_SHARE * F.col("_total")).select(key)


def lookup_join(rows: DataFrame, lexicon: DataFrame, key: str, hot: DataFrame, salts: int = 32) -> DataFrame:
    """Inner-join ``rows`` to a lexicon that is unique on ``key``, hot keys spread over ``salts`` tasks.

    Rows of a hot key get a salt from their own content and the key's one lexicon row is
    copied once per salt; all other keys join once. Every row keeps exactly one partner.
    """
    flag = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int")
    left = rows.join(flag, key, "left").withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lexicon.join(flag, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")
