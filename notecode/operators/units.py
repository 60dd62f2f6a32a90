"""Problem 3: quantities recorded in different units.

Method: the distinct unit spellings (from the unit column, the value, the entity text or
the context) are mapped to known units through a character n-gram inverted index, checked
by a weighted edit distance, and the resulting alias dictionary is joined to all rows.

A unit is looked up only among the units of the row's quantity, so ``G/L`` is grams per
litre of haemoglobin and giga per litre of platelets. The first of value, unit column,
entity text and context that states a unit decides; if what it states is unknown, the row
has no result.

Numbers: ``12``, ``12.5``, ``12,5``, ``1,250`` (thousands or decimal, whichever is
nearer to the quantity's other values), ``1.250,5``, ``3e5``, ``3*10^5``; pairs of
feet and inches or stone and pounds. Ranges, bounds, estimates and words have no result.

Defined results: nulls in any column give no result or fall through to the next source of
a unit; repeated rows give one row; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ngrams import candidates, weighted_distance
from ..functions.skew import hot_keys, lookup_join
from ..sources.tables import stage

#: Unit names by kind of quantity, with the factor to the kind's base unit.
#: Base units: substance mmol/L, mass g/L, count 10*9/L, length cm, weight kg, volume mL,
#: pressure mm[Hg], share %, temperature Cel (factor and offset).
UNITS: dict[str, list[tuple[float, float, tuple[str, ...]]]] = {
    "substance": [
        (1.0, 0.0, ("mmol/l", "mm", "millimol per litre", "millimole per liter", "mmol per l")),
        (0.001, 0.0, ("umol/l", "um", "micromol/l", "micromol per litre", "micromole per liter", "umol per l")),
        (0.000001, 0.0, ("nmol/l", "nanomol per litre")),
        (1000.0, 0.0, ("mol/l", "mole per liter")),
    ],
    "equivalent": [(1.0, 0.0, ("meq/l", "mval/l", "milliequivalent per litre"))],
    "mass": [
        (0.01, 0.0, ("mg/dl", "mg%", "mg/100ml", "mg per dl", "mg per 100ml", "milligram per decilitre")),
        (10.0, 0.0, ("g/dl", "g%", "gm/dl", "g/100ml", "gm%", "g per dl", "gram per decilitre")),
        (1.0, 0.0, ("g/l", "gm/l", "gram/l", "g per l", "gram per litre", "mg/ml")),
        (0.001, 0.0, ("mg/l", "mg per l", "milligram per litre", "ug/ml")),
        (0.00001, 0.0, ("ug/dl", "microgram per decilitre")),
    ],
    "count": [
        (1.0, 0.0, ("10*9/l", "x10*9/l", "10e9/l", "x10e9/l", "g/l", "gpt/l", "giga/l", "10*3/ul", "x10*3/ul", "10e3/ul", "k/ul", "thou/ul", "10*3/mm3", "k/mm3", "thou/mm3", "x10*3cells/ul", "10*3cells/ul", "thousand/ul", "10*6/ml")),
        (0.001, 0.0, ("/ul", "cells/ul", "/mm3", "cells/mm3", "per ul", "cells per ul", "10*6/l")),
        (1000.0, 0.0, ("10*6/ul", "m/ul", "10*12/l", "mill/ul")),
    ],
    "length": [
        (1.0, 0.0, ("cm", "cms", "centimeter", "centimetre")),
        (100.0, 0.0, ("m", "meter", "metre", "mtr")),
        (0.1, 0.0, ("mm", "millimeter", "millimetre")),
        (2.54, 0.0, ("in", "inch", "inches", "[in_i]", "\"", "ins")),
        (30.48, 0.0, ("ft", "foot", "feet", "[ft_i]")),
    ],
    "weight": [
        (1.0, 0.0, ("kg", "kgs", "kilo", "kilos", "kilogram", "kilogramme")),
        (0.001, 0.0, ("g", "gm", "gms", "gram", "gramme")),
        (0.45359237, 0.0, ("lb", "lbs", "pound", "[lb_av]")),
        (6.35029318, 0.0, ("st", "stone", "[stone_av]")),
        (0.028349523125, 0.0, ("oz", "ounce", "[oz_av]")),
    ],
    "volume": [
        (1.0, 0.0, ("ml", "mls", "cc", "cm3", "ccm", "milliliter", "millilitre")),
        (100.0, 0.0, ("dl", "deciliter", "decilitre")),
        (10.0, 0.0, ("cl", "centiliter", "centilitre")),
        (1000.0, 0.0, ("l", "ltr", "liter", "litre")),
        (29.5735295625, 0.0, ("fl oz", "oz fl", "fluid ounce", "[foz_us]", "floz")),
    ],
    "pressure": [
        (1.0, 0.0, ("mm[hg]", "mmhg", "mm hg", "torr", "mm of mercury")),
        (7.500616827, 0.0, ("kpa", "kilopascal")),
    ],
    "share": [(1.0, 0.0, ("%", "percent", "pct", "per cent")), (100.0, 0.0, ("fraction", "ratio", "1", "decimal"))],
    "temperature": [
        (1.0, 0.0, ("cel", "c", "degc", "°c", "celsius", "deg c", "[degc]", "degree celsius", "centigrade")),
        (5.0 / 9.0, -32.0, ("f", "degf", "°f", "fahrenheit", "deg f", "[degf]", "degree fahrenheit")),
        (1.0, -273.15, ("k", "kelvin")),
    ],
}
#: The kinds in which a quantity with this common unit may be given, and the common unit in its kind's base unit.
COMMON: dict[str, tuple[str, float, tuple[str, ...]]] = {
    "mmol/L": ("substance", 1.0, ("substance", "equivalent", "mass")),
    "umol/L": ("substance", 0.001, ("substance", "mass")),
    "g/L": ("mass", 1.0, ("mass",)),
    "10*9/L": ("count", 1.0, ("count",)),
    "Cel": ("temperature", 1.0, ("temperature",)),
    "kg": ("weight", 1.0, ("weight",)),
    "cm": ("length", 1.0, ("length",)),
    "mm[Hg]": ("pressure", 1.0, ("pressure",)),
    "%": ("share", 1.0, ("share",)),
    "mL": ("volume", 1.0, ("volume",)),
}
#: Charge of the ion, for equivalents.
VALENCE = {"Potassium": 1.0, "Sodium": 1.0, "Calcium": 2.0, "Magnesium": 2.0}


def squash(text: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def unit_key(text: Column) -> Column:
    """A unit spelling without case, spacing and typographic variants."""
    t = F.lower(F.trim(F.translate(text, "µμ％⁰¹²³⁴⁵⁶⁷⁸⁹×·℃℉", "uu%0123456789x*CF")))
    t = F.regexp_replace(t, r"[\s   ]+", " ")
    t = F.regexp_replace(t, r"\^|\*\*", "*")
    t = F.regexp_replace(t, r"\bmc(?=[lg]\b)", "u")
    t = F.regexp_replace(t, r" ?([/*%]) ?", "$1")
    t = F.regexp_replace(t, r"(?<=\d) (?=[a-z])", "")
    return F.regexp_replace(F.regexp_replace(t, r"(?<![0-9])109/l$", "10*9/l"), r"(?<![0-9])103/ul$", "10*3/ul")


def _cost(x: str, y: str) -> float:
    """Marks, doubled letters' neighbours and plural endings are cheap; letters and digits decide."""
    one, other = (x, y) if x else (y, x)
    if not other:
        return 0.15 if not one.isalnum() else 0.3 if one == "s" else 1.0
    if not x.isalnum() and not y.isalnum():
        return 0.15
    return 1.0 if x.isalpha() and y.isalpha() else 2.0


def _accepts(spelling: str, name: str) -> float | None:
    """The distance, if a spelling is close enough: short names only but for marks and plurals, long ones by one letter after the first."""
    d = weighted_distance(spelling, name, _cost)
    letters = sum(c.isalpha() for c in name)
    most = 1.0 if letters >= 7 and spelling[:3] == name[:3] else 0.45
    return d if d <= most else None


def unit_table(spark: SparkSession) -> DataFrame:
    rows = [(kind, name, f, o) for kind, units in UNITS.items() for f, o, names in units for name in names]
    return spark.createDataFrame(rows, "kind string, name string, factor double, shift double")


def alias_dictionary(spellings: DataFrame, spark: SparkSession) -> DataFrame:
    """(key, kind, factor, shift) for the distinct (key, kind) that mean a known unit; ambiguous ones are left out."""
    names = F.broadcast(unit_table(spark))  # the fixed table above
    exact = spellings.join(names, (F.col("key") == F.col("name")) & (spellings.kind == names.kind)).select("key", spellings.kind, "name", F.lit(0.0).alias("distance"))
    rest = spellings.join(names.select(F.col("name").alias("key"), "kind"), ["key", "kind"], "left_anti")
    near = candidates(rest, names.select("name", "kind"), text="key", entry="name", within=("kind",), least=0.35)

    @F.pandas_udf("double")
    def verify(key: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([_accepts(a, b) for a, b in zip(key, name)], dtype="float64")

    fuzzy = near.withColumn("distance", verify("key", "name")).where("distance is not null and not isnan(distance)").select("key", "kind", "name", "distance")
    found = exact.unionByName(fuzzy).join(names, ["kind", "name"])
    best = found.groupBy("key", "kind").agg(F.min("distance").alias("_least"))
    found = found.join(best, ["key", "kind"]).where("distance <= _least + 0.1")
    return found.groupBy("key", "kind").agg(F.min("factor").alias("factor"), F.max("factor").alias("_most"), F.min("shift").alias("shift")).where("factor = _most").drop("_most")


def quantity_names(units: DataFrame) -> DataFrame:
    """(name_key, quantity columns): one row per way to name a quantity of the list."""
    spark = units.sparkSession
    common = spark.createDataFrame([(k, b, v, list(ks)) for k, (b, v, ks) in COMMON.items()], "common_unit string, base string, per_common double, kinds array<string>")
    valence = spark.createDataFrame(list(VALENCE.items()), "quantity string, valence double")
    names = F.explode(F.array_union(F.array("quantity"), F.coalesce("synonyms", F.array().cast("array<string>"))))
    u = units.join(F.broadcast(common), "common_unit").join(F.broadcast(valence), "quantity", "left")
    u = u.withColumn("_name", names)
    return u.select(squash(F.col("_name")).alias("name_key"), "quantity", "common_unit", "base", "per_common", "kinds", "molar_mass", "decimals", "valence").dropDuplicates(["name_key"])


_NUMBER = r"\d[\d.,']*(?:[eE][+-]?\d+)?"


def parse_number(literal: Column) -> tuple[Column, Column]:
    """(reading with the comma as a decimal mark where ambiguous, reading with it as a thousands mark)."""
    mantissa = F.regexp_replace(F.regexp_extract(literal, r"^([\d.,']+)", 1), "'", "")
    power = F.coalesce(F.try_to_number(F.regexp_extract(literal, r"[eE]([+-]?\d+)$", 1), F.lit("S99")).cast("double"), F.lit(0.0))
    plain = F.when(mantissa.rlike(r"^\d+(\.\d+)?$"), mantissa)
    comma = F.when(mantissa.rlike(r"^\d+,\d+$"), F.regexp_replace(mantissa, ",", "."))
    thousands = F.when(mantissa.rlike(r"^[1-9]\d{0,2}(,\d{3})+(\.\d+)?$"), F.regexp_replace(mantissa, ",", ""))
    european = F.when(mantissa.rlike(r"^[1-9]\d{0,2}(\.\d{3})+,\d+$"), F.regexp_replace(F.regexp_replace(mantissa, r"\.", ""), ",", "."))
    scale = F.pow(F.lit(10.0), power)
    return F.coalesce(plain, european, comma, thousands).cast("double") * scale, thousands.cast("double") * scale


def convert(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Every row with a single number of a listed quantity in one of its units.

    Columns: entity_id, quantity, common_unit, decimals, value_common, as_recorded (already in the common form).
    """
    spark = rows.sparkSession
    names = F.broadcast(stage(quantity_names(units), "quantity-names"))  # measure_units: fixed size, a few names per quantity
    value = F.trim(F.regexp_replace("value", r"[\s  ]+", " "))
    r = rows.where(F.col("value").rlike(r"\d") & F.col("entity_text").isNotNull() & F.col("entity_id").isNotNull()).select("entity_id", "entity_text", F.col("value").alias("raw_value"), value.alias("value"), "unit", F.col("entity_context").alias("context"))
    # The name of the quantity: the whole text, or what stands before a unit named in it.
    tail = r"^(.*?)[\s ]*(?:\(([^()]*)\)|\[([^\[\]]*)\]|,\s*(\S[^,]*)|\sin\s+(\S.*))[\s ]*$"
    r = r.withColumn("_whole", squash(F.col("entity_text"))).withColumn("_head", squash(F.regexp_extract("entity_text", tail, 1)))
    hint = F.concat(*[F.regexp_extract("entity_text", tail, i) for i in (2, 3, 4, 5)])
    whole = r.join(names, F.col("_whole") == F.col("name_key")).withColumn("hint", F.lit(""))
    head = r.join(names.select(F.col("name_key").alias("_whole")), "_whole", "left_anti").join(names, F.col("_head") == F.col("name_key")).withColumn("hint", hint)
    r = stage(whole.unionByName(head).drop("_whole", "_head", "name_key"), "quantities")  # read for pairs and for single numbers

    pair = r"(?i)^(\d+)\s*(ft|feet|foot|'|st|stone)\s*(\d+(?:\.\d+)?)\s*(in|ins|inch|inches|\"|''|lb|lbs|pounds?)?$"
    big, small, which = F.regexp_extract("value", pair, 1), F.regexp_extract("value", pair, 3), F.lower(F.regexp_extract("value", pair, 2))
    is_pair = F.col("value").rlike(pair)
    inches = F.when((F.col("base") == "length") & which.isin("ft", "feet", "foot", "'"), (big.try_cast("double") * 12 + small.try_cast("double")) * 2.54)
    pounds = F.when((F.col("base") == "weight") & which.isin("st", "stone"), (big.try_cast("double") * 14 + small.try_cast("double")) * 0.45359237)
    paired = r.where(is_pair).withColumn("value_common", F.coalesce(inches, pounds) / F.col("per_common")).where("value_common is not null")

    number = r.where(~is_pair).withColumn("_literal", F.regexp_extract("value", rf"^\+?({_NUMBER})(?:$|[^\d.,'].*$)", 1)).where("_literal != ''")
    number = number.withColumn("_literal", F.regexp_replace("_literal", r"[.,']+$", ""))
    rest = F.trim(F.expr("substring(value, instr(value, _literal) + length(_literal))"))
    power = r"^[*xX×]\s*10\s*(?:\^|\*\*|\*|e)?\s*(\d+)$"
    number = number.withColumn("_rest", rest).withColumn("_power", F.regexp_extract("_rest", power, 1).try_cast("double")).withColumn("_rest", F.when(F.col("_power").isNotNull(), "").otherwise(F.col("_rest")))
    stated = F.expr(r"regexp_extract(context, concat('(?:^|[^0-9.,])\\Q', value, '\\E(?![0-9])[ ]*(.*)$'), 1)")
    context_unit = F.regexp_extract(stated, r"^(.*?)(?:\s+at\s+\d|\s*\(|,|;|\.(?:\s|$)|$)", 1)
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    number = number.withColumn("_spelling", F.coalesce(blank(F.col("_rest")), blank(F.col("unit")), blank(F.col("hint")), blank(context_unit))).where("_spelling is not null")
    number = number.withColumn("key", unit_key(F.col("_spelling")))
    number = stage(number.drop("entity_text", "context", "hint", "value"), "measurements")  # read twice: for the dictionary and for the join

    spellings = stage(number.select("key", F.explode("kinds").alias("kind")).distinct(), "unit-spellings")
    aliases = stage(alias_dictionary(spellings, spark), "unit-aliases")
    # A few spellings hold most rows: the join spreads them.
    by_key = aliases.groupBy("key").agg(F.collect_list(F.struct("kind", "factor", "shift")).alias("_alias"))
    hot = hot_keys(number.groupBy("key").agg(F.count("*").alias("n")), "key")
    number = lookup_join(number, by_key, "key", hot).withColumn("_a", F.explode("_alias")).where(F.array_contains("kinds", F.col("_a.kind")))
    number = number.select("*", "_a.*").drop("_alias", "_a")
    # From the unit's kind to the common unit's kind.
    across = (
        F.when(F.col("kind") == F.col("base"), 1.0)
        .when((F.col("kind") == "equivalent") & (F.col("base") == "substance"), 1.0 / F.col("valence"))
        .when((F.col("kind") == "mass") & (F.col("base") == "substance"), 1000.0 / F.col("molar_mass"))
    )
    decimal, thousands = parse_number(F.col("_literal"))
    to_common = lambda x: (x * F.pow(F.lit(10.0), F.coalesce("_power", F.lit(0.0))) + F.col("shift")) * F.col("factor") * across / F.col("per_common")
    number = number.withColumn("_a", to_common(decimal)).withColumn("_b", to_common(thousands))
    # A comma before three digits is read as what lies nearer to the middle of the quantity's values that can be read in one way only.
    sure = number.where("_b is null and _a > 0").groupBy("quantity").agg(F.percentile_approx(F.log("_a"), 0.5, 1000).alias("_middle"))
    number = number.join(F.broadcast(sure), "quantity", "left")  # one row per quantity of the list
    far = lambda c: F.abs(F.log(c) - F.col("_middle"))
    number = number.withColumn("value_common", F.when(F.col("_b").isNull() | (far("_a") < far("_b")), F.col("_a")).otherwise(F.col("_b"))).where("value_common is not null")
    columns = ["entity_id", "quantity", "common_unit", "decimals", "value_common", F.coalesce((F.col("unit") == F.col("common_unit")) & F.col("raw_value").rlike(r"^\d+(\.\d+)?$"), F.lit(False)).alias("as_recorded")]
    return reduce(DataFrame.unionByName, [x.select(*columns) for x in (paired, number)]).distinct()


def scaled(converted: DataFrame) -> DataFrame:
    """(entity_id, value_scaled): the value times 10^decimals, rounded half up, of rows not already in the common form."""
    x = F.col("value_common") * F.pow(F.lit(10.0), F.col("decimals"))
    return converted.where("not as_recorded").select("entity_id", F.floor(x + 0.5 + 1e-9).cast("long").alias("value_scaled")).distinct()
