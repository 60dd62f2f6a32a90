"""Problem 10: texts cut off by field limits.

Method, in SQL expressions only: count word trigrams inside texts against trigrams at
their ends, join each text's final trigram to the counts, and flag the text if its final
trigram goes on inside other texts but almost never ends anything.

Texts are split into units at line breaks and after sentence ends; digits are one symbol;
the two words before a unit's first word are marks, and trigrams at a unit's beginning are
told from the same words inside a sentence. Distinct units are counted first and their trigrams after,
weighted by the count, so the shuffle carries distinct material.

A final word that was itself cut is compared as the beginning of words: in the context of
its two predecessors, all words that start with it count as going on. A final trigram
that occurs nowhere else is judged by its last two words, then by its last, unless it
begins its unit: rare closing lines are complete.

A text's tail mark (``...``, ``…``, also in brackets) is taken off before its final trigram
is read, unless texts regularly end that way and its words do not go on elsewhere. Rows of lists are complete.

Defined results: null, empty and blank texts are not cut; identical texts count once as
ends; repeated document rows give one row; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage

#: A final trigram is a cut if its complete ends are at most this share of its continuations.
MAX_END_SHARE = 0.1
MARK = r"[\s\x{200b}]*(?:\.\.\.+|…|\[(?:\.\.\.|…)\]|\((?:\.\.\.|…)\))[\s\x{200b}]*$"
_BLANK = " \t\r\n\v\f\u00a0\u200b\ufeff\u2009\u202f\u3000"
_SPACE = r"[ \t\x0b\f\x{a0}\x{2000}-\x{200b}\x{202f}\x{3000}\x{feff}]+"


def _plain(text: Column) -> Column:
    """Digits as 0, blanks within a line as single spaces."""
    return F.regexp_replace(F.regexp_replace(text, r"\p{N}+", "0"), _SPACE, " ")


def _units(text: Column) -> Column:
    """Sentences and lines of a text, digits as 0, single spaces."""
    t = F.regexp_replace(_plain(text), r"([.!?][\"”»')]*) ", "$1\n")
    return F.filter(F.transform(F.split(t, r"[\r\n]+"), F.trim), lambda u: u != "")


def _words(unit: Column) -> Column:
    """The words of a unit behind two marks. To be put into a column of its own: the trigrams read it once per word."""
    return F.concat(F.array(F.lit("¶"), F.lit("¶")), F.split(unit, " "))


def _grams(w: Column) -> Column:
    """Array of (a, b, c, more) over a column of words; ``more``: the unit goes on after c.

    A trigram that begins with the first or second word of its unit has a mark at its first
    word: a name alone on a closing line is not the same name inside a sentence.
    """
    first = lambda i: F.when(i <= 5, F.concat(F.lit("¶"), F.get(w, i - 2))).otherwise(F.get(w, i - 2))
    return F.transform(F.sequence(F.lit(2), F.size(w) - 1), lambda i: F.struct(first(i).alias("a"), F.get(w, i - 1).alias("b"), F.get(w, i).alias("c"), (i < F.size(w) - 1).alias("more")))


def _last_unit(line: Column) -> Column:
    """The last sentence of a line, as ``_units`` gives it; empty if there is none."""
    return F.trim(F.regexp_extract(_plain(line), r"(?s)^(?:.*[.!?][\"”»')]* )?(.*)$", 1))


def _once(value: Column) -> Column:
    """The value by way of a generator, so that conditions on it are tested on the result and do not repeat its making."""
    return F.explode(F.array(value))


def final_trigrams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, a, b, c, marked, whole): the final trigram of every text that is not blank and does not end in a list row."""
    whole = F.trim(F.col(text_col), F.lit(_BLANK))
    d = docs.select(F.col(id_col).alias("id"), _once(whole).alias("t")).where(F.length("t") > 0)
    # Only the text from its last line on matters for the end.
    d = d.select("id", F.xxhash64("t").alias("h"), _once(F.substring_index(F.substring_index("t", "\n", -1), "\r", -1)).alias("line"))
    row = F.col("line").rlike(r"^\s*(?:[-*•·–]|\p{N}+[.)])\s") & ~F.col("line").rlike(r"^\s*--")
    d = d.where(~row).select("id", "h", "line", _once(F.trim(F.regexp_replace("line", MARK, ""), F.lit(_BLANK))).alias("bare"))
    # Without a mark, which is most texts, the two are the same.
    d = d.select("id", "h", (F.length("line") > F.length("bare")).alias("marked"), "line", _once(_last_unit(F.col("bare"))).alias("unit")).where("unit != ''")
    d = d.select("id", "h", "marked", F.when(F.col("marked"), _last_unit(F.col("line"))).otherwise(F.col("unit")).alias("whole"), _once(F.split("unit", " ")).alias("w"))
    word = lambda k: F.coalesce(F.try_element_at("w", F.lit(-k)), F.lit("¶"))
    first = F.when(F.size("w") <= 4, F.concat(F.lit("¶"), word(3))).otherwise(word(3))
    return d.select("id", "h", "marked", "whole", first.alias("a"), word(2).alias("b"), word(1).alias("c"))


def trigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(a, b, c, mid, ends): over all texts, how often a trigram goes on, and how often it ends a line or sentence before the text's end."""
    t = docs.select(_once(_units(F.col(text_col))).alias("u"))
    units = t.select(F.posexplode("u").alias("i", "unit"), F.size("u").alias("n")).select("unit", (F.col("i") < F.col("n") - 1).alias("inner"))
    units = units.groupBy("unit").agg(F.count("*").alias("n"), F.count_if("inner").alias("inner")).select(_words(F.col("unit")).alias("w"), "n", "inner")
    grams = units.select(F.explode(_grams(F.col("w"))).alias("g"), "n", "inner")
    mid, ends = F.sum(F.when(F.col("g.more"), F.col("n")).otherwise(0)), F.sum(F.when(~F.col("g.more"), F.col("inner")).otherwise(0))
    return grams.groupBy("g.a", "g.b", "g.c").agg(mid.alias("mid"), ends.alias("ends"))


def _judge(finals: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """finals with (mid, ends, n_texts) of their trigram, cut to ``keys`` and c; the beginning of a longer word counts as going on."""
    stats = counts.groupBy(*keys, "c").agg(F.sum("mid").alias("mid"), F.sum("ends").alias("ends"))
    # Beginnings of the lengths that the final words in the same place have.
    lengths = finals.groupBy(*keys).agg(F.collect_set(F.length("c")).alias("_lengths"))
    stats = stats.join(lengths, keys) if keys else stats.crossJoin(F.broadcast(lengths))  # without keys one row, of the distinct word lengths
    starts = F.explode(F.transform(F.filter("_lengths", lambda n: n <= F.length("c")), lambda n: F.substr(F.col("c"), F.lit(1), n)))
    longer = stats.select(*keys, F.col("c").alias("full"), starts.alias("c"), "mid", "ends").groupBy(*keys, "c")
    known = longer.agg(
        F.sum(F.when(F.col("full") == F.col("c"), F.col("mid")).otherwise(F.col("mid") + F.col("ends"))).alias("mid"),
        F.sum(F.when(F.col("full") == F.col("c"), F.col("ends")).otherwise(0)).alias("ends"),
    )
    texts = finals.groupBy(*keys, "c").agg(F.sum("n_texts").alias("n_end"))
    return texts.join(known, [*keys, "c"], "left").withColumns({"mid": F.coalesce("mid", F.lit(0)), "ends": F.coalesce("ends", F.lit(0))})


def find_cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_end_share: float = MAX_END_SHARE) -> DataFrame:
    """(id, mid, n_end): every cut text with the evidence of its final trigram."""
    finals = stage(final_trigrams(docs, id_col, text_col), "finals")
    counts = stage(trigram_counts(docs, text_col), "trigrams")
    # A unit that ends several different texts with its mark is a way to end, unless its words go on inside texts: then
    # many texts were cut at the same place. The text's own end is no evidence, as below.
    unit = ["whole", "a", "b", "c"]
    often = stage(finals.where("marked").groupBy(*unit).agg(F.countDistinct("h").alias("n_texts")).where("n_texts > 2"), "marked-ends")
    going_on = _judge(often, counts, ["a", "b"]).select("a", "b", "c", "mid", "ends")
    habits = often.join(going_on, ["a", "b", "c"]).where(F.col("ends") + F.col("n_texts") - 1 > F.lit(max_end_share) * F.col("mid"))
    open_ = finals.join(habits.select(*unit), unit, "left_anti")
    grams = stage(open_.groupBy("a", "b", "c").agg(F.countDistinct("h").alias("n_texts")), "final-trigrams")
    verdicts, rest = None, grams
    for keys in (["a", "b"], ["b"], []):
        seen = _judge(grams, counts, keys)
        on = [*keys, "c"]
        here = rest.join(seen, on)
        # The text's own end, and the ends of texts cut at the same place, are not evidence of completeness:
        # ends inside texts count in full, ends of other texts as far as they outnumber chance cuts.
        known = here.where((F.col("mid") > 0) | (F.col("ends") > 0) | (F.col("n_end") > 2))
        cut = known.where((F.col("mid") > 0) & (F.col("ends") + F.col("n_end") - 1 <= F.greatest(F.lit(max_end_share) * F.col("mid"), F.lit(0)))).select("a", "b", "c", "mid", "n_end")
        verdicts = cut if verdicts is None else verdicts.unionByName(cut)
        # At a unit's beginning fewer words decide nothing: short units may be rare closing lines.
        rest = rest.join(known.select("a", "b", "c"), ["a", "b", "c"], "left_anti").where(~F.col("a").startswith("¶"))
    return open_.join(verdicts, ["a", "b", "c"]).groupBy(F.col("id").alias(id_col)).agg(F.max("mid").alias("mid"), F.max("n_end").alias("n_end"))


def cut_share(docs: DataFrame, cut: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """(source, n_docs, n_cut, share) over distinct ids; a null source is a source of its own."""
    ids = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source")).distinct()
    marked = ids.join(cut.select(F.col(id_col).alias("_id"), F.lit(1).alias("_cut")), "_id", "left")
    out = marked.groupBy("source").agg(F.count("*").alias("n_docs"), F.count("_cut").alias("n_cut"))
    return out.withColumn("share", F.round(F.col("n_cut") / F.col("n_docs"), 6))
