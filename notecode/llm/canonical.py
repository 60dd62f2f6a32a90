"""Problem 1: free entries mapped to a canonical list.

Method: distinct values are normalised (case, accents, punctuation; doses, routes, times,
remarks and units beside the name are taken off; fields and comma-inverted words put in
order), looked up as they are, and the rest retrieved through a character n-gram inverted
index with weighted cosine scores. A candidate is accepted above a cosine threshold if it
is close in edit distance, and closer than every other concept by a margin.

A value may also be a name cut short: it is then compared with the name's beginning, if it
has at least half of it. Digits must agree, as stages and codes differ by nothing else.

Values no concept can reach are reported as ``UNMATCHED``. Defined results: null and blank
values are no entries; ties between concepts are unmatched; repeated rows give one row; an
empty table gives none, an empty list leaves all values unmatched; null synonyms count as
none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ngrams import candidates
from ..functions.skew import hot_keys, lookup_join
from ..functions.text import fold, sound_key, squash
from ..operators.units import UNITS, unit_key
from ..sources.tables import stage

UNMATCHED = "UNMATCHED"
#: Least weighted cosine of a candidate.
LEAST_COSINE = 0.35
#: What an edit costs in the score of a candidate, next to its cosine, and the least lead of the best score.
EDIT_COST, LEAST_MARGIN = 0.05, 0.02

# Words that stand beside a name without changing it (fixed values); spaces may be missing.
DOSE = r"\b\d+(?:[.,]\d+)? ?(?:mg|mcg|ug|g|kg|ml|l|iu|units?|tabs?|puffs?)\b"
ROUTE = r"\b(?:oral|orally|po|iv|im|sc|sq|topical|sublingual|rectal|inhaled|intravenous|subcutaneous|intramuscular)\b"
TIME = r"\b(?:(?:once|twice|three times|thrice) ?daily|daily|every ?\d+ ?(?:h|hours?)|as ?needed|prn|at ?night|nightly|in the morning|weekly|bid|tid|qid|qd|stat)\b"
REMARK = r"\b(?:known|mild|moderate|severe|probable|possible|suspected|likely|query|(?:hx|history) ?of|(?:pt|patient) ?with|status ?post|unspecified|resolving|resolved|stable|improving|worsening|as ?per ?chart|per ?chart|nos|see ?chart)\b"
LEADING = r"^(?:known|mild|moderate|severe|probable|possible|suspected|hxof|ptwith|historyof)(?=.{5})"


def _core(text: Column) -> Column:
    """The words of the name, comma kept as a word of its own."""
    t = F.regexp_replace(fold(text), r"(?<=\d)[.·](?=\d)", ",")
    t = F.regexp_replace(t, r"[;|\n]", " ; ")
    t = F.regexp_replace(t, r"[^\p{L}\p{N},;]+|(?<!\d),|,(?!\d)", " ")
    for pattern in (DOSE, TIME, ROUTE, REMARK):
        t = F.regexp_replace(t, pattern, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[;,]", " "), r"\s+", " "))


def _inverted(text: Column) -> Column:
    """The text with its comma-separated parts in reverse order."""
    return F.array_join(F.reverse(F.split(text, ",")), " ")


_TAIL = r"^(.*?)[\s\x{a0}]*(?:\(([^()]*)\)|\[([^\[\]]*\]?)\]|\(\[([^\[\]]*\])\)|,\s*(\S[^,]*)|\sin\s+(\S.*))[\s\x{a0}\x{2009}]*$"


def _letters_for_digits(text: Column) -> Column:
    """Digits read as the letters they look like, where they stand alone at or between letters of a word."""
    for digit, letter in zip("0134589", "oieasbg"):
        text = F.regexp_replace(text, rf"(?<=\p{{L}}\p{{L}}){digit}(?!\d)|(?<!\d){digit}(?=\p{{L}}\p{{L}})", letter)
    return text


def forms(values: DataFrame, column: str = "text") -> DataFrame:
    """(text, key): every reading of a distinct value, as squashed names.

    What reads a value more than once is in columns of its own, and readings that cannot
    differ from others (no comma, no digit, no bracket) are not made.
    """
    bare_letters = lambda c: F.regexp_replace(c, r"[^\p{L}\p{N}]", "")
    known = [name + plural for units in UNITS.values() for _, _, names in units for name in names for plural in ("", "s")]
    v = values.select(F.col(column).alias("text")).withColumn("_core", _core(F.col("text")))
    v = v.withColumn("_inverted", F.when(F.contains("text", F.lit(",")), _core(_inverted(F.col("text")))))
    hint = F.concat(*[F.regexp_extract("text", _TAIL, i) for i in (2, 3, 4, 5, 6)])
    v = v.withColumn("_hint", F.when(F.col("text").rlike(r"[(\[,]|\sin\s"), unit_key(F.regexp_replace(hint, r"[^\p{L}\p{N}%％°℃℉)\]\"]+$", ""))))
    v = v.withColumn("_key", bare_letters(F.col("_core")))
    head = F.when(F.col("_hint").isin(known), squash(F.regexp_extract("text", _TAIL, 1)))
    read = F.when(F.col("_core").rlike(r"\d"), bare_letters(_letters_for_digits(F.col("_core"))))
    keys = F.array(squash(F.col("text")), F.col("_key"), bare_letters(F.col("_inverted")), F.regexp_replace("_key", LEADING, ""), head, read)
    return v.select("text", F.explode(F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "")))).alias("key"))


def concept_names(concepts: DataFrame) -> DataFrame:
    """(name, cui): squashed names and synonyms; a name of two concepts is left out."""
    names = F.array_union(F.array("preferred_name"), F.coalesce("synonyms", F.array().cast("array<string>")))
    rows = concepts.select("cui", F.explode(names).alias("n")).where("n is not null and cui is not null").select("cui", squash(F.col("n")).alias("name")).where("name != ''").distinct()
    return rows.groupBy("name").agg(F.min("cui").alias("cui"), F.count("*").alias("n")).where("n = 1").drop("n")


def _digits(key: Column) -> Column:
    return F.regexp_replace(key, r"\D", "")


def _allowed(n: Column) -> Column:
    """Edits a name of n letters may differ by."""
    return F.when(n < 5, 0).when(n < 7, 1).when(n < 10, 2).when(n < 14, 3).otherwise(4)


def map_values(values: DataFrame, concepts: DataFrame) -> DataFrame:
    """(text, cui): one row per distinct value; cui is UNMATCHED where no concept is meant."""
    names = stage(concept_names(concepts), "concept-names")
    keys = stage(forms(values), "value-forms")
    exact = keys.join(names, F.col("key") == F.col("name")).groupBy("text").agg(F.min("cui").alias("cui"), F.max("cui").alias("_hi"))
    exact = stage(exact.where("cui = _hi").drop("_hi"), "exact")
    rest = keys.join(exact.select("text"), "text", "left_anti").withColumn("sound", sound_key(F.col("key")))
    sounds = names.select(sound_key(F.col("name")).alias("entry"), "name", "cui")
    longest = F.broadcast(names.agg(F.max(F.length("name")).alias("_longest")))  # one row
    # Longer than every name by more than the allowed edits: out of reach of any rule below.
    rest = stage(rest.crossJoin(longest).where(F.length("sound") <= F.col("_longest") + 4).drop("_longest"), "unknown-forms")
    a, b = F.col("sound"), F.col("entry")
    whole = F.when(_digits(a) == _digits(b), F.levenshtein(a, b, 4))
    whole = F.when((whole >= 0) & (whole <= _allowed(F.least(F.length(a), F.length(b)))), whole.cast("double"))
    start = F.expr("left(entry, length(sound))")
    short = (F.length(a) < F.length(b)) & (F.length(a) * 2 >= F.length(b)) & (F.length(a) >= 6) & (_digits(a) == _digits(start))
    cut = F.when(short, F.levenshtein(a, start, 2))
    cut = F.when((cut >= 0) & (cut <= _allowed(F.length(a)) / 2), cut + 0.5)
    distance = F.least(whole, cut)
    # Lengths between which a name or its beginning can be meant by the rules above.
    sizes = (F.length(a) - 4, F.greatest(F.length(a) + 4, F.length(a) * 2))
    near = candidates(rest.select("sound"), sounds.select("entry").distinct(), text="sound", entry="entry", n=3, least=LEAST_COSINE, sizes=sizes)
    # An exact check of what the index accepts: the letters that differ, and the digits.
    near = near.withColumn("d", distance).where("d is not null")
    found = rest.select("text", "sound").join(near, "sound").join(sounds, "entry")
    per_concept = found.groupBy("text", "cui").agg(F.max(F.col("cosine") - EDIT_COST * F.col("d")).alias("score"))
    # The best concept, and the margin to the next one.
    ranked = per_concept.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("score", "cui")), asc=False).alias("r"))
    best, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    clear = second.isNull() | (best["score"] >= second["score"] + LEAST_MARGIN)
    fuzzy = ranked.where(clear).select("text", best["cui"].alias("cui"))
    decided = exact.unionByName(fuzzy)
    return values.select("text").join(decided, "text", "left").select("text", F.coalesce("cui", F.lit(UNMATCHED)).alias("cui"))


def map_rows(rows: DataFrame, concepts: DataFrame, *, id_col: str = "entity_id", text_col: str = "entity_text") -> DataFrame:
    """(id, text, cui) of every row with a value that is not blank."""
    r = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(r"[^\s\x{a0}\x{2000}-\x{200b}\x{202f}\x{3000}\x{feff}]"))
    counts = stage(r.groupBy("text").agg(F.count("*").alias("n")), "values")
    mapped = map_values(counts.select("text"), concepts)
    return lookup_join(r, mapped, "text", hot_keys(counts, "text"))
