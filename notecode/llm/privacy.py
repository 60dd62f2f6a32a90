"""Problem 5: personal information in free text.

Method: offset-preserving deobfuscation. Transducers rewrite a text (look-alike letters and
full-width forms to plain ones, spelled digits to digits, ``at``/``dot`` disguises to signs,
words broken at line ends joined) and record which source character every character of
the result comes from. Identifiers are detected in the rewritten text and their spans are
mapped back, so that the source text stays as it is around the placeholders.

Types: NAME, EMAIL, PHONE, ID, ADDRESS. A name starts after titles, an ID after its label,
an address at its house number, a phone number at its first digit, ``+`` or bracket.
Given names are learned from the names of providers over all charts, however rare; surnames
are what stands with a given name or a title.

The workers hold no list of names but a filter of fixed size, ``FILTER_BITS``. A span that
rests on a given name carries it along and is kept if the name is in the full table of
names; only then do overlapping spans of a text compete. (A false hit of the filter can do
no more than take a word behind a titled name's comma into its placeholder.)

Defined results: null, empty and blank texts have no items and are returned as they are;
whole texts are read at any length; repeated rows give one row; an empty table gives none.
Offsets count code points from 0.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage

FILTER_BITS = 22

TITLES = r"(?:Drs?|DRS?|Mrs?|MRS?|Ms|MS|Miss|MISS|Mx|Prof(?:essor)?|PROF|Nurse|NURSE|Sister|Sir|Dame|Rev)"
_TITLE = re.compile(rf"\b{TITLES}\b\.? +")
_PART = r"[^\W\d_]+(?:['’][^\W\d_]+)*(?:-[^\W\d_]+)*"
_INITIAL = r"[^\W\d_]\."
_PARTICLE = r"(?:van der|van den|van|von|de la|de|di|del|du|le) "

#: Latin look-alikes (fixed values): Cyrillic and Greek letters, then forms made from their rule below.
_LOOKS = dict(zip("АВЕКМНОРСТУХаеорсухіјѕԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα", "ABEKMHOPCTYXaeopcyxijsdhlABEZHIKMNOPTYXoa"))
#: Styled letters and digits (full-width, mathematical, circled, super- and subscript) by their compatibility forms.
_LOOKS |= {chr(c): d for block in (range(0xB2, 0xBA), range(0x2070, 0x20A0), range(0x2460, 0x24FF), range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800)) for c in block if len(d := unicodedata.normalize("NFKD", chr(c))) == 1 and d.isascii() and d.isalnum() | (c > 0xFF00)}
_LOOKS |= {"\n": " ", "\r": " ", "\t": " ", " ": " ", " ": " ", " ": " ", "‑": "-", "‐": "-", "–": "-", "−": "-"}
_TABLE = str.maketrans(_LOOKS)
_DIGIT_WORDS = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789"))
_SPELLED = re.compile(r"\b(?:(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)\b[ -]*){4,}", re.I)
_WORD = re.compile(r"[a-z]+", re.I)
_AT = re.compile(r" *[\[({<] ?at ?[\])}>] *| +at +(?=[\w.-]+ *(?:[\[({<] ?dot ?[\])}>]| dot ) *\w)", re.I)
_DOT = re.compile(r" *[\[({<] ?(?:dot|punkt|point) ?[\])}>] *|(?<=\w) +dot +(?=(?:\w+|\w+ dot \w+)\b)", re.I)
_BREAK = re.compile(r"(?<=[^\W\d_])[-­¬‐]\s*\n\s*(?=[a-zß-ÿ])")
_HIDDEN = re.compile("[​-‍⁠﻿­]")
_ODD = re.compile(r"[^\x00-\x7f]|[\n\r\t]|[\[({<] ?at ?[\])}>]|\bdot\b|\b(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)\b[ -]*\b(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)\b", re.I)


def normalise(text: str) -> tuple[str, list[int] | None, list[int] | None, set[int]]:
    """(rewritten text, starts of its pieces, where each piece starts in the source, rewritten pieces); None for no change of place."""
    edits: list[tuple[int, int, str]] = []
    if not _ODD.search(text):
        return text, None, None, set()
    for m in _BREAK.finditer(text):
        edits.append((m.start(), m.end(), ""))
    for m in _HIDDEN.finditer(text):
        edits.append((m.start(), m.end(), ""))
    flat = text.translate(_TABLE)
    low = flat.lower() if len(flat.lower()) == len(flat) else flat
    disguised = [(m.start(), m.end(), "@") for m in _AT.finditer(flat)] if "at" in low else []
    if disguised or "@" in flat:
        edits += disguised
        signs = [a for a, _, _ in disguised] + [m.start() for m in re.finditer("@", flat)]
        # Dots are read where an address can be: within a mail name's length of an at sign.
        edits += [(m.start(), m.end(), ".") for m in _DOT.finditer(flat) if any(-80 < m.start() - at < 80 for at in signs)]
    for m in _SPELLED.finditer(flat):
        said = list(_WORD.finditer(m[0]))
        for k, w in enumerate(said):
            last = k + 1 == len(said)
            # Ten digits are written as a number is: 3-3-4.
            mark = "-" if len(said) == 10 and k in (2, 5) else ""
            edits.append((m.start() + w.start(), m.start() + (w.end() if last else said[k + 1].start()), _DIGIT_WORDS[w[0].lower()] + mark))
    if not edits:
        return flat, None, None, set()
    out, starts, sources, edited, at, size = [], [], [], set(), 0, 0
    for a, b, new in sorted(edits):
        if a < at:
            continue
        for piece, source in ((flat[at:a], at), (new, a)):
            if piece:
                if source == a and piece is new:
                    edited.add(len(starts))
                out.append(piece)
                starts.append(size)
                sources.append(source)
                size += len(piece)
        at = b
    starts.append(size)
    sources.append(at)
    out.append(flat[at:])
    return "".join(out), starts, sources, edited


def source_end(i: int, starts: list[int] | None, sources: list[int] | None, edited: set[int]) -> int:
    """Where the source of the character before ``i`` ends; a rewritten piece stands for all of its source."""
    if starts is None:
        return i
    k = bisect_right(starts, i - 1) - 1
    return sources[k + 1] if k in edited else sources[k] + i - starts[k]


def source_offset(i: int, starts: list[int] | None, sources: list[int] | None) -> int:
    if starts is None:
        return i
    k = bisect_right(starts, i) - 1
    return sources[k] + i - starts[k]


_EMAIL = re.compile(r"(?<![\w.+-])[\w.+'-]{1,64}@ ?[\w-]+(?:\. ?[\w-]+)+")
_D = r"[0-9]"
_PHONE = re.compile(rf"(?<![\w+(#./-])(?:\+{_D}{{1,3}}[ .-]?(?:\(\d{{2,4}}\)|\d{{1,4}})[ .-]?{_D}{{2,4}}[ .-]?{_D}{{3,4}}|1[-. ]{_D}{{3}}[-. ]{_D}{{3}}[-. ]{_D}{{4}}|\({_D}{{3}}\) ?{_D}{{3}}[-. ]{_D}{{4}}|{_D}{{3}}[-./ ] ?{_D}{{3}}[-. ]?{_D}{{4}}|0{_D}{{2,4}}[ .]{_D}{{3,4}}[ .]{_D}{{3,4}}|0{_D}(?:[ .]{_D}{{2}}){{4}})(?![\w/-]|\.\d)")
_LABEL = r"(?:MRN|medical record(?: number)?|med(?:\.|ical)? ?rec(?:ord)?\.?|SSN|SS ?#|social security|passport|travel document|insurance|policy ?holder|member(?:ship)? ?ID|member|subscriber|driver'?s? ?licen[cs]e|driving licen[cs]e|licen[cs]e|national ID|NHS|patient ID|health card|identity card|ID card)"
_ID = re.compile(rf"\b{_LABEL}(?: ?(?:no|nr|number|num|ID)\b\.?)?[ :#.]{{0,3}}((?:[A-Z]{{1,2}}[- ]?)?\d[\dA-Z]*(?:[- ](?:\d[\dA-Z]*|[A-Z](?![A-Za-z])))*)", re.I)
_STREET = r"(?:St(?:reet|\.)?|R(?:oa)?d|Ave(?:nue)?|L(?:ane|n)|Blvd|Boulevard|Close|Terrace|Ter|Court|Ct|Drive|Dr|Way|Place|Pl|Square|Sq|Crescent|Row|Hill|Gardens|Grove|Mews|Walk|Parade)"
_ADDRESS = re.compile(rf"(?<![\w/.,:-])\d{{1,5}}[a-z]?,? +(?:[A-Z][\w'’-]* +){{1,4}}?{_STREET}\b\.?(?:,? *(?:Apt|Flat|Unit|Suite|No)\.? *\w+)?(?:, *[A-Z][\w'’-]*(?: +[A-Z][\w'’-]*){{0,2}}(?: +\d{{4,6}})?)?")
_ADDRESS_UP = re.compile(rf"(?<![\w/.,:-])\d{{1,5}}[A-Z]?,? +(?:[A-Z][A-Z'’-]* +){{1,4}}?{_STREET.upper()}\b\.?(?:,? *(?:APT|FLAT|UNIT|SUITE)\.? *\w+)?")
#: Streets named by their type first.
_ADDRESS_FIRST = re.compile(r"(?<![\w/.,:-])\d{1,5}(?: ?(?:bis|ter|[a-z]))?,? +(?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Pp]lace|[Cc]hemin|[Ii]mpasse|[Aa]llée|[Qq]uai|[Cc]alle|[Aa]venida|[Pp]laza|[Vv]ia|[Pp]iazza|[Rr]ua) +(?:(?:de|du|des|la|le|les|del|della|di|do|da|los|las|el) +|[dl]['’])*[A-ZÀ-Þ][\w'’-]*(?: +(?:(?:de|du|des|la|le|del|di) +)*[A-ZÀ-Þ][\w'’-]*){0,3}")
_NAMED = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_HAS_DIGITS = re.compile(r"\d")
_NOT_NAME = {"and", "or", "for", "with", "was", "is", "the", "to", "by", "on", "in", "at", "of", "a", "has", "holds", "returned", "because", "patient", "team", "reports", "confirmed", "now", "tel", "over", "no", "manoeuvre", "sign", "disease", "syndrome", "disorder", "clinic", "hospital", "agreed", "once", "after", "who", "via"}


class Detector:
    """Finds spans in single texts; ``given`` tells whether a lower-case word may be a given name."""

    def __init__(self, given: Callable[[str], bool]):
        self.given = given
        self.plain: set[str] = set()  # words known to be no names, as far as they are kept
        self.after = re.compile(rf" (?:{_INITIAL} )?(?:{_PARTICLE})?({_PART})", re.I)
        self.before = re.compile(rf"((?:{_PARTICLE})?{_PART}), $", re.I)
        self.titled = re.compile(rf"(?:{_INITIAL} ?)*(?:{_PARTICLE})?{_PART}(?:(?:, | )(?:{_INITIAL} )*(?:{_PARTICLE})?{_PART})?(?: {_INITIAL})?", re.I)

    def find(self, text: str) -> list[tuple[str, int, int, str | None]]:
        """(type, start, end, given name it rests on) in the source; spans may overlap."""
        flat, starts, sources, edited = normalise(text)
        spans: list[tuple[int, int, str, str | None]] = []
        if "@" in flat:
            spans += [(m.start(), m.end(), "EMAIL", None) for m in _EMAIL.finditer(flat) if not m[0].endswith("@")]
        if _HAS_DIGITS.search(flat):
            spans += [(m.start(1), m.end(1), "ID", None) for m in _ID.finditer(flat) if sum(c.isdigit() for c in m[1]) >= 5]
            spans += [(m.start(), m.end(), "PHONE", None) for m in _PHONE.finditer(flat)]
            spans += [(m.start(), m.end(), "ADDRESS", None) for p in (_ADDRESS, _ADDRESS_UP, _ADDRESS_FIRST) for m in p.finditer(flat)]
        spans += self._names(flat)
        return [(kind, source_offset(a, starts, sources), source_end(b, starts, sources, edited), name) for a, b, kind, name in spans]

    def _any_given(self, flat: str) -> bool:
        """Whether a text has a word that may be a given name; most have none, and are read no further."""
        if len(self.plain) > 500_000:
            self.plain.clear()
        hit = False
        for word in set(_NAMED.findall(flat.lower())) - self.plain:
            if self.given(word) or self.given(re.split("['’]", word)[0]):
                hit = True
            else:
                self.plain.add(word)
        return hit

    def _firsts(self, flat: str):
        """(start, end) of words that may be given names: whole words, not the first part of a hyphenated one; short ones only with a capital."""
        for m in _NAMED.finditer(flat) if self._any_given(flat) else ():
            word = m[0]
            if word in self.plain:
                continue
            if not self.given(word.lower()):
                word = re.split("['’]", word)[0]
                if len(word) == len(m[0]) or not self.given(word.lower()):
                    continue
            a, b = m.start(), m.start() + len(word)
            if (a and (flat[a - 1] in "@.-" or flat[a - 1].isalnum() or flat[a - 1] == "_")) or flat[b : b + 1] == "@" or flat[b : b + 1].isalnum() or flat[b : b + 1] == "_" or (flat[b : b + 1] == "-" and flat[b + 1 : b + 2].isalnum()):
                continue
            if len(word) > 3 or word[:1].isupper():
                yield a, b

    def _names(self, flat: str) -> list[tuple[int, int, str, str | None]]:
        spans = []
        for m in _TITLE.finditer(flat):
            name = self.titled.match(flat, m.end())
            if not name:
                continue
            first = re.split(r"[ ,]+", name[0])[0].lower()
            sure = flat[name.start()].isupper() or first in ("van", "von", "de")
            if not sure and not self.given(first):
                continue
            end = self._trim(flat, name.start(), name.end())
            if end > name.start():
                spans.append((name.start(), end, "NAME", None if sure else first))
        for a, b in self._firsts(flat):
            back, first = flat[max(0, a - 60) : a], flat[a:b].lower()
            inverted = self.before.search(back) if back.endswith(", ") else None
            if inverted and not self._plain(inverted[1].split()[-1]) and self._shape(inverted[1]) and not self._said(inverted[1], flat[a:b]):
                tail = re.match(rf" {_INITIAL}", flat[b : b + 4])
                spans.append((a - len(back) + inverted.start(), b + (tail.end() if tail else 0), "NAME", first))
                continue
            follow = self.after.match(flat, b)
            if follow and not self._plain(follow[1]):
                lead = re.search(rf"(?<![\w.])({_INITIAL}) $", back)
                spans.append((a - (len(lead[0]) if lead else 0), follow.end(), "NAME", first))
        return spans

    @staticmethod
    def _plain(word: str) -> bool:
        return word.lower() in _NOT_NAME

    @staticmethod
    def _shape(words: str) -> bool:
        last = words.split()[-1]
        return last[:1].isupper() or len(last) >= 6

    @staticmethod
    def _said(surname: str, given: str) -> bool:
        """A word before a comma and a given name in other letter case is running text."""
        return surname.split()[-1][:1].islower() and given[:1].isupper()

    def _trim(self, flat: str, a: int, b: int) -> int:
        """Cut a titled name where running text begins."""
        end, first = a, True
        style = None
        for m in re.finditer(rf"{_INITIAL}|{_PART}", flat[a:b]):
            word = m[0]
            gap = flat[end : a + m.start()]
            if not first and word.lower() in _NOT_NAME:
                break
            if not first and "," in gap and not (self.given(word.lower()) or re.fullmatch(_INITIAL, word)):
                break
            if not first and word[:1].islower() and word not in ("van", "der", "den", "von", "de", "la") and style != "lower":
                break
            style = style or ("lower" if word[:1].islower() and word not in ("van", "von", "de") else "upper")
            end, first = a + m.end(), False
        return end


def given_names(providers: DataFrame, column: str = "provider") -> DataFrame:
    """(g): the distinct given names of people named in full, over all rows."""
    part = _PART.replace(r"[^\W\d_]", r"\p{L}")  # the same in Java's notation
    bare = F.trim(F.regexp_replace(F.col(column), rf"^(?:{TITLES}\.? )+", ""))
    inverted = F.regexp_extract(bare, rf"^[^,]+, ({part})", 1)
    straight = F.regexp_extract(bare, rf"^({part})(?: \p{{L}}\.)? +\S.*$", 1)
    name = F.lower(F.when(bare.contains(","), inverted).otherwise(straight))
    return providers.where(F.col(column).isNotNull()).select(name.alias("g")).where((F.length("g") >= 2) & ~F.col("g").isin("van", "von", "del", "de", "di", "la", "le", "du")).distinct()


def _filter_of(names: DataFrame) -> bytes:
    rows = names.select(F.crc32(F.encode("g", "utf-8")).bitwiseAND((1 << FILTER_BITS) - 1).cast("int").alias("i")).distinct().toPandas()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[rows["i"].to_numpy()] = True
    return np.packbits(bits).tobytes()


def name_test(bits: bytes) -> Callable[[str], bool]:
    """Whether a word hits the filter; answers are kept for as long as they are few."""
    mask, memo = (1 << FILTER_BITS) - 1, {}

    def test(word: str) -> bool:
        got = memo.get(word)
        if got is None:
            if len(memo) > 500_000:
                memo.clear()
            i = zlib.crc32(word.encode("utf-8", "surrogatepass")) & mask
            got = memo[word] = bool(bits[i >> 3] >> (7 - (i & 7)) & 1)
        return got

    return test


def find_items(rows: DataFrame, given: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(record_id, h, items): the items of every text that has any, in order and without overlaps; h names the text.

    Items are structs of start, end and type.
    """
    names = stage(given, "given-names")
    bits = rows.sparkSession.sparkContext.broadcast(_filter_of(names))

    def run(batches):
        detector = Detector(name_test(bits.value))
        for pdf in batches:
            out = [(i, h, *span) for i, h, t in zip(pdf["id"], pdf["h"], pdf["text"]) for span in detector.find(t)]
            yield pd.DataFrame(out, columns=["record_id", "h", "kind", "a", "b", "name"])

    texts = rows.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).where("id is not null and length(text) > 0")
    spans = stage(texts.mapInPandas(run, "record_id string, h long, kind string, a int, b int, name string"), "spans")
    sure = spans.where("name is null").unionByName(spans.where("name is not null").join(names, F.col("name") == F.col("g"), "left_semi"))
    # The first span wins, of those that begin together the longest.
    packed = sure.groupBy("record_id", "h").agg(F.sort_array(F.collect_set(F.struct("a", F.negative("b").alias("z"), "kind"))).alias("s"))
    begin = F.struct(F.lit(-1).alias("end"), F.array().cast("array<struct<start:int,end:int,type:string>>").alias("kept"))
    item = lambda s: F.struct(s["a"].alias("start"), F.negative(s["z"]).alias("end"), s["kind"].alias("type"))
    step = lambda acc, s: F.when(s["a"] >= acc["end"], F.struct(F.negative(s["z"]).alias("end"), F.concat(acc["kept"], F.array(item(s))).alias("kept"))).otherwise(acc)
    return packed.select("record_id", "h", F.aggregate("s", begin, step)["kept"].alias("items"))


def each_item(found: DataFrame) -> DataFrame:
    """(record_id, pii_type, start_offset, end_offset) of every item."""
    return found.select("record_id", F.explode("items").alias("i")).select("record_id", F.col("i.type").alias("pii_type"), F.col("i.start").alias("start_offset"), F.col("i.end").alias("end_offset"))


def redact(rows: DataFrame, given: DataFrame, *, id_col: str, text_col: str, out_col: str = "redacted") -> DataFrame:
    """``rows`` with the text, items replaced by ``[TYPE]`` and otherwise unchanged, in ``out_col``.

    Null and empty texts stay as they are; rows without an id are redacted too.
    """
    rows = rows.withColumn("_rid", F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    items = find_items(rows, given, id_col="_rid", text_col=text_col).select(F.col("record_id").alias("_id"), F.col("h").alias("_h"), F.col("items").alias("_items"))

    @F.pandas_udf("string")
    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        def one(t, spans):
            out, at = [], 0
            for s in spans:
                out += [t[at : s["start"]], f"[{s['type']}]"]
                at = s["end"]
            return "".join(out) + t[at:]

        return pd.Series([t if spans is None else one(t, spans) for t, spans in zip(texts, found)], dtype="object")

    has = F.length(text_col) > 0
    keyed = rows.withColumn("_h", F.xxhash64(text_col))
    joined = keyed.where(has).join(items, (F.col("_rid") == F.col("_id")) & (keyed["_h"] == items["_h"]), "left").drop("_id", "_h")
    done = joined.withColumn(out_col, F.when(F.col("_items").isNull(), F.col(text_col)).otherwise(replace(text_col, "_items"))).drop("_items")
    return done.unionByName(rows.where(~F.coalesce(has, F.lit(False))).withColumn(out_col, F.col(text_col))).drop("_rid")
