"""Problem 2: records that differ only in formatting.

Method: dictionary-encode. Every distinct text is canonicalised once, its fields get
integer ids, a text becomes the sorted tuple of its field ids, and records are grouped
by that tuple together with their context columns, which never need the text again.

Canonical form of a field: case-folded letters and digits, the signs ``+ < > %`` and a
point between two digits; everything else is dropped. Fields are separated by ``;`` or
``|`` and a field without content does not count.

Defined results: null texts and texts without content are in no class; nulls in context
columns equal each other; repeated rows of one id count once as a copy; an empty table
gives no rows; extra input columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import hot_keys, lookup_join
from ..sources.tables import stage

#: Members of a class that one task compares with the whole class.
PER_TASK = 2000
CONTEXT = ("chart_id", "section_id", "entity_type", "start_offset")


def canonical_fields(text: Column) -> Column:
    """The sorted canonical fields of a text, empty fields left out."""
    folded = F.lower(F.upper(text))
    fields = F.split(folded, r"[;|]")
    clean = F.transform(fields, lambda f: F.regexp_replace(f, r"(?<!\p{N})\.|\.(?!\p{N})|[^\p{L}\p{N}+<>%.]", ""))
    return F.array_sort(F.filter(clean, lambda f: f != ""))


def lexicon(texts: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(distinct texts with their count and form id, hot texts).

    ``form`` is the integer id of the sorted tuple of field ids; equal forms mean equal
    canonical texts. Ids are fixed by writing each dictionary out once.
    """
    counts = stage(texts.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("text")).agg(F.count("*").alias("n")), "texts")
    # Canonicalise once per distinct text; `key` names the text by its fields until they have ids.
    split = stage(counts.select("text", F.explode(canonical_fields(F.col("text"))).alias("field")), "split-texts")
    fields = stage(split.groupBy("field").agg(F.count("*").alias("n")).select("field", "n", F.monotonically_increasing_id().alias("field_id")), "fields")
    # A field such as a route stands in a large share of all texts: hot fields are spread.
    tuples = lookup_join(split, fields.drop("n"), "field", hot_keys(fields, "field")).groupBy("text").agg(F.array_sort(F.collect_list("field_id")).alias("tuple"))
    tuples = stage(tuples, "tuples")
    forms = stage(tuples.select("tuple").distinct().select("tuple", F.monotonically_increasing_id().alias("form")), "forms")
    return tuples.join(forms, "tuple").select("text", "form"), hot_keys(counts, "text")


def encode(records: DataFrame, *, id_col: str = "entity_id", text_col: str = "entity_text", context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """(id, context columns, form): one row per record and distinct content."""
    rows = records.select(F.col(id_col).alias("id"), *context, F.col(text_col).alias("text")).where(F.col("text").isNotNull() & F.col("id").isNotNull())
    forms, hot = lexicon(rows, "text")
    return lookup_join(rows, forms, "text", hot).select("id", *context, "form")


def collapse(encoded: DataFrame, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """One row per class of equal records: its context, form, smallest id and number of copies (rows)."""
    return encoded.groupBy(*context, "form").agg(F.min("id").alias("record_id"), F.max("id").alias("last_id"), F.count("*").alias("n_copies"))


def copy_pairs(encoded: DataFrame, context: tuple[str, ...] = CONTEXT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every pair of different ids in one class, smaller id first.

    Only members of classes with two or more ids are joined to each other. One side of a class
    is dealt to as many tasks as it has ``PER_TASK`` members, the other side copied to each;
    the copies are fewer than the pairs to be listed by that factor.
    """
    keys = [*context, "form"]
    members = stage(encoded.distinct(), "members")
    shared = members.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    shared = shared.select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("_n") / PER_TASK).cast("int").alias("_tasks"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    kept = stage(members.join(shared, same).select("id", *keys, "_tasks"), "copies")
    dealt = kept.withColumn("_task", F.pmod(F.xxhash64("id"), F.col("_tasks")).cast("int"))
    copied = kept.withColumn("_task", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)))
    pair = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]) & (F.col("a._task") == F.col("b._task"))
    return dealt.alias("a").join(copied.alias("b"), pair & (F.col("a.id") < F.col("b.id"))).select(*[F.col(f"a.{k}").alias(k) for k in keep], F.col("a.id").alias("entity_id_a"), F.col("b.id").alias("entity_id_b")).distinct()
