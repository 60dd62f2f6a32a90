"""Character n-gram inverted index with weighted cosine scores, as plain joins.

Used to find, for each distinct spelling, the entries of a reference list that look like
it. Only spellings and entries that share an n-gram meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage


#: Postings, of some 60 bytes each, up to which a list is broadcast.
BROADCAST_POSTINGS = 300_000


def char_ngrams(text: Column, n: int) -> Column:
    """The distinct character n-grams of a text with one boundary mark on either side."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    at = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
    return F.array_distinct(F.transform(at, lambda i: F.substr(padded, i, F.lit(n))))


def candidates(spellings: DataFrame, entries: DataFrame, *, text: str, entry: str, n: int = 2, within: tuple[str, ...] = (), least: float = 0.5, sizes: tuple[Column, Column] | None = None) -> DataFrame:
    """(text, within..., entry, cosine) of all pairs with a cosine of ``least`` or more.

    N-grams weigh log(1 + entries / entries that have it); n-grams no entry has weigh as
    much as those of one entry, so foreign material lowers the score. ``within`` columns
    must be equal on both sides.

    Pairs are found by prefix filtering: n-grams are ordered by weight everywhere, and the
    lightest ones of a text or entry, as long as their norm is under ``least`` of the whole,
    are not joined. The heaviest n-gram two sides share lies before the rest of both if the
    cosine is reached, so no pair is lost while the long posting lists are not read. What a
    pair shares of the joined n-grams, and the most it can share of the others (they are
    all light ones of the side that leaves out more), bounds its cosine; only pairs whose
    bound reaches ``least`` are scored in full. ``sizes``, if given, are the least and the
    most characters an entry may have, as expressions of the text; tested as pairs meet.

    Until they are scored entries are known by a hash only; entries that share one can raise
    each other's bound, but not a score. Texts keep their columns: they are partitioned by
    them from the start, so pairs are counted where their text is if the entries' postings
    are at most ``BROADCAST_POSTINGS``. Both ways give the same rows.
    """
    keys = [text, *within]
    total = entries.agg(F.count("*").alias("_total"))  # one row
    index = entries.select(entry, *within, F.explode(char_ngrams(F.col(entry), n)).alias("gram"))
    weights = index.groupBy("gram").agg(F.count("*").alias("_df")).crossJoin(F.broadcast(total))
    weights = weights.select("gram", F.log1p(F.col("_total") / F.col("_df")).alias("w"))
    index = index.join(weights, "gram")
    vectors = index.groupBy(entry, *within).agg(F.sort_array(F.collect_list(F.struct("w", "gram"))).alias("_grams"), F.sum(F.col("w") * F.col("w")).alias("_sq"))
    grams = spellings.select(*keys).distinct().withColumn("gram", F.explode(char_ngrams(F.col(text), n)))
    grams = grams.join(weights, "gram", "left").crossJoin(F.broadcast(total)).select(*keys, F.struct(F.coalesce("w", F.log1p("_total")).alias("w"), "gram").alias("g"))
    texts = grams.groupBy(*keys).agg(F.sort_array(F.collect_list("g")).alias("_grams"), F.sum(F.col("g.w") * F.col("g.w")).alias("_sq"))

    # Ascending weights: the longest beginning whose norm stays under least * norm is not joined.
    most = least * least * 0.999 * F.col("_sq")

    def step(acc: Column, g: Column) -> Column:
        reached = acc["sum"] + g["w"] * g["w"]
        return F.struct(reached.alias("sum"), (acc["skip"] + F.when(reached < most, 1).otherwise(0)).alias("skip"), F.when(reached < most, reached).otherwise(acc["rest"]).alias("rest"))

    def heavy(rows: DataFrame, columns: list[str], extra: dict[str, Column]) -> DataFrame:
        """(columns, norm, norm left out, extra..., gram, weight) of the n-grams that are joined."""
        left_out = F.aggregate("_grams", F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("skip"), F.lit(0.0).alias("rest")), step)
        rows = rows.withColumns({"_cut": left_out, **extra})
        rows = rows.select(*columns, F.sqrt("_sq").alias("norm"), F.col("_cut.rest").alias("rest"), *extra, F.explode(F.expr("slice(_grams, _cut.skip + 1, size(_grams))")).alias("g"))
        return rows.select(*columns, "norm", "rest", *extra, F.col("g.gram").alias("gram"), F.col("g.w").alias("w"))

    t = heavy(texts, keys, {} if sizes is None else {"_lo": sizes[0], "_hi": sizes[1]}).withColumnsRenamed({"norm": "_sn", "rest": "_sr"})
    vectors = stage(vectors, "ngram-index")
    e = heavy(vectors.withColumn("_e", F.xxhash64(entry, *within)), ["_e", *within], {} if sizes is None else {"_size": F.length(entry)}).withColumnsRenamed({"norm": "_en", "rest": "_er"}).drop("w")
    # A list whose postings are few goes to the texts, so that pairs need not be shuffled to be counted; else both sides are shuffled by n-gram.
    if (vectors.agg(F.sum(F.size("_grams"))).head()[0] or 0) <= BROADCAST_POSTINGS:
        e = F.broadcast(e)
    shared = t.join(e, ["gram", *within])
    if sizes is not None:
        shared = shared.where(F.col("_size").between(F.col("_lo"), F.col("_hi")))
    pairs = shared.groupBy(*keys, "_e").agg(F.sum(F.col("w") * F.col("w")).alias("_part"), *[F.max(c).alias(c) for c in ("_sn", "_sr", "_en", "_er")])
    pairs = pairs.where(F.col("_part") + F.greatest("_sr", "_er") >= least * F.col("_sn") * F.col("_en")).select(*keys, "_e")
    pairs = pairs.join(texts.select(*keys, F.sqrt("_sq").alias("_sn"), F.transform("_grams", lambda g: g["gram"]).alias("_all")), keys)
    dot = F.aggregate("_grams", F.lit(0.0), lambda acc, g: acc + F.when(F.array_contains("_all", g["gram"]), g["w"] * g["w"]).otherwise(0.0))
    named = vectors.select(entry, *within, F.xxhash64(entry, *within).alias("_e"), F.sqrt("_sq").alias("_en"), "_grams")
    scored = pairs.join(named, ["_e", *within]).withColumn("cosine", dot / (F.col("_en") * F.col("_sn")))
    return scored.where(F.col("cosine") >= least).select(*keys, entry, "cosine")


def weighted_distance(a: str, b: str, cost) -> float:
    """Edit distance with ``cost(x, y)`` of replacing x by y; '' stands for nothing. Neighbour swaps cost as one edit."""
    prev2, prev = None, [0.0]
    for y in b:
        prev.append(prev[-1] + cost("", y))
    for i, x in enumerate(a, 1):
        row = [prev[0] + cost(x, "")]
        for j, y in enumerate(b, 1):
            best = min(prev[j] + cost(x, ""), row[j - 1] + cost("", y), prev[j - 1] + (0.0 if x == y else cost(x, y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, prev2[j - 2] + max(cost(x, y), 0.0 if x == y else cost(y, x)))
            row.append(best)
        prev2, prev = prev, row
    return prev[-1]

