"""Problem 4: noise in text from scanned pages.

Method: skip-gram vectors are learned over all notes and sections, rare words are linked
to more frequent words that differ from them by glyph confusions of character recognition
and keep the same company, every occurrence of a linked word is judged in its context, then
page furniture is removed, broken words are joined and the lines reflowed into paragraphs.

1. ``survey`` reads every text once: running lines and page numbers, words broken at line
   ends, and the counts of all words.
2. ``glyph_links`` generates confusions of every distinct word and joins them to the words:
   one confusion by equality, two by meeting half way. No dictionary leaves the tables.
3. ``core_words``, those with at least ``CORE_SHARE`` of all words (so at most its inverse),
   are the contexts of the skip-gram model. Their vectors are trained on the driver from
   their pair counts; the vector of every other linked word is then fitted to these from the
   word's own pairs, word by word on the executors, so no word is without one for its rank.
4. ``occurrences`` reads every text again for the places and the company of linked words.
   A filter of fixed size, ``FILTER_BITS``, tells which words to report; the joins that
   follow remove its false hits.
5. A link holds if the frequent word, by its count and by how well it fits the company of the
   rare word (against chance), outweighs the rare one by the ratio; the same is asked of every
   occurrence in its own context, for words of any length. Unknown company counts as chance.

Words with a digit or sign inside and no link are misread if their likeliest letters spell
like words of the corpus and the digit is not one of many in the same place (codes, doses).

Furniture: page numbers by form; running headers by their place before the first section
with a page number at the note's end, or by repetition; running footers by repetition.
Sections take the running lines of their chart.

Defined results: null, empty and blank texts have no lines; a text of any length is read
whole; repeated rows give one row; an empty table gives none; sections of unknown charts
are read without running lines.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage

#: Share of all words from which on a word is a context of the skip-gram model: at most 1 / CORE_SHARE words.
CORE_SHARE = 1e-4
#: Pairs of core words with a smaller share of all such pairs are left out of training: at most 1 / PAIR_SHARE pairs reach the driver.
PAIR_SHARE = 1e-7
DIMENSIONS = 32
WINDOW = 2
#: Noise words per word pair in training; a pair that meets as often as by chance has log odds of -log of it.
NEGATIVES = 5
#: Passes over the core words in training.
EPOCHS = 80
FILTER_BITS = 22
#: A correction is this many times as frequent as the word it replaces, weighed by its fit. All tests on counts are
#: ratios, so that they say the same of a corpus and of its tenfold: long words have few neighbours by chance, and
#: words with digits or signs among their letters are no words.
RATIO, LONG_RATIO, ODD_RATIO = 20, 4, 4
#: Common words are more frequent than this share of the distinct words: codes with a digit or sign inside that
#: resemble no word, numbers with letters, and the parts of a compound.
CODES, NUMBERS, PARTS = 0.75, 0.9, 0.95
#: A context word speaks for or against a correction by no more than these log odds, and the least mean of a
#: correction of something that may be a word; what has glyphs that words do not have is weighed by the odds alone.
CLIP, LEAST_FIT = 4.0, -3.0
#: Forms that differ in their digits only, from which on the digits are content.
MANY_FORMS = 3

#: Confusions of character recognition, read -> meant (fixed values).
GLYPHS = (
    "0:o 1:l 1:i 5:s 8:b 6:b 9:g 3:e 4:a 2:z |:i |:l !:l !:i +:t @:a $:s €:e ©:c "
    "c:e e:c l:i i:l i:j j:i l:t t:l t:f f:t r:t h:b b:h a:o o:a u:v v:u y:v v:y n:u u:n q:g g:q n:r k:lc "
    "rn:m m:rn ri:n n:ri cl:d d:cl ii:u u:ii li:h h:li vv:w w:vv nn:m in:m m:in tn:m iii:m lc:k ol:d fi:h ln:h ti:h n:ii n:il il:u lt:h it:n"
)
_PAIRS = [tuple(p.split(":")) for p in GLYPHS.split()]
_LETTER = {}
for _read, _meant in _PAIRS:
    if len(_read) == 1 and not _read.isalpha():
        _LETTER.setdefault(_read, []).append(_meant)
_STRIP = "()[]{}<>.,;:!?\"'“”‘’*#"
_HYPHEN = "-­¬‐"
_TOKEN = re.compile(r"\S+")
_PART = re.compile(r"[^-/‐]+")
_MAIL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+|@\w+\.\w")
_BROKEN = re.compile(rf"(?P<w>[^\W\d_][^\s]*?)(?P<h>[{_HYPHEN}])\s*$")
_NUMBERISH = re.compile(r"^[(]?(?=.*\d)(?=.*[OolISBZ|b])(?:[\dOolISBZ|]|b(?=\d))+(?:[.,:/-](?:[\dOolISBZ|]|b(?=\d))+)*[%)]?$")
_PAGE = re.compile(r"^\W*(?:p(?:age|g|\.)?\.?\s*)?[\dlIO|SBZ]{1,4}(?:\s*(?:of|/|0f|oi)\s*[\dlIO|SBZ]{1,4})?\W*$", re.I)
_PAGE_WORD = re.compile(r"^\W*p[a@]?[gq]?[ec]?\W*\s", re.I)
_SECTION = re.compile(r"^(?:#{1,3}\s.*|[^a-z]{0,3}[\w/ ,'|@+]{2,40}:)\s*$")
_INNER = re.compile(r"[^\W\d_][0-9|@+$!][^\W\d_]|^[0-9|@+$!](?=[^\W\d_]{3})|[^\W\d_]{3}[|@+$!0-9]$")
_STARTS = re.compile(r"[^\W\d_]|[0-9|@+$!][^\W\d_]")
_FIRST = re.compile(r"[^\s.,;:()\-/]*")


def split_token(token: str) -> list[tuple[str, int]]:
    """(word, offset) of a token: without outer marks, cut at hyphens and slashes; none for addresses of mail."""
    if "@" in token and _MAIL.search(token):
        return []
    out = []
    for p in _PART.finditer(token):
        word = p[0].strip(_STRIP)
        if word:
            out.append((word, p.start() + p[0].index(word)))
    return out


def is_page_number(line: str) -> bool:
    s = line.strip()
    return bool(s) and bool(_PAGE.match(s)) and any(c.isdigit() or c in "lIO|" for c in s)


def template(line: str) -> str:
    """A line without what changes from page to page and what recognition confuses."""
    s = re.sub(r"\d+", "0", line.strip().lower())
    for a, b in (("0", "o"), ("1", "l"), ("|", "l"), ("i", "l"), ("5", "s"), ("+", "t"), ("@", "a"), ("rn", "m"), ("c", "e"), ("8", "b")):
        s = s.replace(a, b)
    return re.sub(r"\W+", "", s)


def near(a: str, b: str, most: int = 2) -> bool:
    """Edit distance up to ``most``."""
    if abs(len(a) - len(b)) > most:
        return False
    if a == b:
        return True
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        if min(new) > most:
            return False
        row = new
    return row[-1] <= most


def _alike(line: str, running: str, key: str) -> bool:
    return abs(len(line.strip()) - len(running)) <= 4 and near(key, template(line))


def running_lines(text: str | None) -> list[str]:
    """The running header and footer of a note, as far as it has them."""
    if not text or not text.strip():
        return []
    filled = [x for x in text.split("\n") if x.strip()]
    numbers = [is_page_number(x) for x in filled]
    out = []

    def places(line: str) -> list[int]:
        key = template(line)
        return [i for i, x in enumerate(filled) if _alike(x, line, key)] if len(key) >= 4 else []

    first = filled[0].strip()
    if not _SECTION.match(first) and not numbers[0]:
        at = places(first)
        # Shown by repetition (no sentence, unless at the pages' beginnings), or by its place before a section with a page number at the note's end.
        if len(at) > 1 and (first[-1] not in ".;:," or all(numbers[i - 1] for i in at if i)) or at and numbers[-1] and len(filled) > 2 and _SECTION.match(filled[1].strip()):
            out.append(first)
    last = next((i for i in reversed(range(len(filled))) if not numbers[i]), None)
    if last and last > 0 and not _SECTION.match(filled[last].strip()):
        foot = filled[last].strip()
        at = places(foot) if foot not in out else []
        edge = lambda i: i + 1 == len(filled) or numbers[i + 1] or bool(out) and _alike(filled[i + 1], out[0], template(out[0]))
        sentence = foot[-1] in ".;:,"
        if len(at) > 2 and (not sentence or all(map(edge, at))) or len(at) == 2 and not sentence and all(map(edge, at)):
            out.append(foot)
    return out


def furniture(lines: list[str], running: list[str]) -> set[int]:
    """Numbers (from 0) of the lines that are running headers, footers or page numbers."""
    heads: set[int] = set()
    for r in running:
        key = template(r)
        heads |= {i for i, x in enumerate(lines) if _alike(x, r, key)}
    out = set(heads)
    numbers = [i for i, x in enumerate(lines) if x and i not in heads and is_page_number(x)]
    if not numbers:
        return out
    filled = [i for i, x in enumerate(lines) if x.strip()]
    place = {i: at for at, i in enumerate(filled)}
    for i in numbers:
        at, s = place[i], lines[i].strip()
        after = filled[at + 1] if at + 1 < len(filled) else None
        before = filled[at - 1] if at else None
        edge = after is None or after in heads or (before is not None and before in heads)
        formed = bool(_PAGE_WORD.match(s)) or re.match(r"^[-–—]\s*\S+\s*[-–—]$", s) or (re.match(r"^\d{1,3}/\d{1,3}$", s) and edge)
        # A bare number is a page number at the end, before a header, or between lines that are both full.
        if formed or edge or (re.match(r"^[\dlIO|]{1,2}$", s) and before is not None and len(lines[before].strip()) >= 40):
            out.add(i)
    return out


def body_lines(lines: list[str], drop: set[int]) -> list[tuple[int, list[str], tuple | None]]:
    """(line number, its whole tokens, (next line, left part, right part, mark, their places) if it ends in a broken word), running lines last."""
    body = [i for i, x in enumerate(lines) if i not in drop and x.strip()]
    out, skip = [], False
    for k, i in enumerate(body):
        x = lines[i].rstrip()
        tokens = x.split()
        if skip:
            tokens = tokens[1:]
        skip, found = False, None
        if x[-1] in _HYPHEN and k + 1 < len(body) and (m := _BROKEN.search(x)):
            after = lines[body[k + 1]].lstrip()
            left = re.split(r"[-/]", m["w"])[-1].lstrip(_STRIP)
            right = _FIRST.match(after)[0]
            if left and _STARTS.match(right) and not (right[:1].isupper() and left[-1:].islower()):
                found = (body[k + 1], left, right, m["h"], m.end("w") - len(left), len(lines[body[k + 1]]) - len(after))
                tokens, skip = tokens[:-1], True
        out.append((i, tokens, found))
    return out + [(i, lines[i].split(), None) for i in sorted(drop) if not is_page_number(lines[i])]


def odd(low: str) -> bool:
    """Whether a word has glyphs that words do not have."""
    return any(c in "|@+$€©!" for c in low) or (any(c.isdigit() for c in low) and sum(c.isalpha() for c in low) >= 2)


def ratio(low: str) -> int:
    return ODD_RATIO if odd(low) else LONG_RATIO if len(low) >= 8 else RATIO


def _may_be_misread(low: str) -> bool:
    return not low.isdigit() and "-" not in low and (len(low) >= 3 or odd(low)) and not (odd(low) and sum(c.isalpha() for c in low) < 2)


def edits(word: str, pairs: list[tuple[str, str]] = _PAIRS) -> set[str]:
    """The word with one confusion undone."""
    out = set()
    for read, meant in pairs:
        at = word.find(read)
        while at >= 0:
            out.add(word[:at] + meant + word[at + len(read) :])
            at = word.find(read, at + 1)
    return out


def number_meant(word: str) -> str | None:
    """The number meant by digits with letters among them."""
    if not _NUMBERISH.match(word):
        return None
    plain = word.strip("()%")
    if re.fullmatch(r"[A-Z]{1,2}[\d-]+|\d+(?:[.,]\d+)?l", plain):
        return None
    letters, digits = sum(c.isalpha() or c == "|" for c in plain), sum(c.isdigit() for c in plain)
    return plain.translate(str.maketrans("OolI|SBZb", "001115826")) if digits >= letters and len(plain) >= 2 else None


def survey(records: DataFrame) -> DataFrame:
    """Rows of three kinds: ``furniture`` lines, ``break``s (left part a, right part b) and ``word``s with their count."""

    def run(batches):
        columns = ["kind", "id", "h", "line", "next", "a", "b", "mark", "at", "at2", "ctx", "n"]
        for pdf in batches:
            seen: Counter = Counter()
            rows = []
            for i, h, text, running in zip(pdf["id"], pdf["h"], pdf["text"], pdf["running"]):
                lines = text.split("\n")
                drop = furniture(lines, running if running is not None else [])
                rows += [("furniture", i, h, k, None, None, None, None, None, None, [], None) for k in drop]
                for k, tokens, found in body_lines(lines, drop):
                    seen.update(tokens)
                    if found:
                        before = [w.lower() for t in tokens[-WINDOW:] for w, _ in split_token(t)][-WINDOW:]
                        rows.append(("break", i, h, k, found[0], found[1], found[2], found[3], found[4], found[5], before, None))
            words: Counter = Counter()
            for token, n in seen.items():
                low = token.lower()
                for w, _ in split_token(low):
                    words[w] += n
                if "-" in low and "@" not in low:
                    words[low.strip(_STRIP)] += n
            if rows:
                yield pd.DataFrame(rows, columns=columns).astype({"next": "Int32", "at": "Int32", "at2": "Int32", "n": "Int64"})
            if words:
                yield pd.DataFrame({"kind": "word", "id": None, "h": 0, "line": 0, "next": None, "a": list(words), "b": None, "mark": None, "at": None, "at2": None, "ctx": [[]] * len(words), "n": list(words.values())}, columns=columns)

    return records.mapInPandas(run, "kind string, id string, h long, line int, next int, a string, b string, mark string, at int, at2 int, ctx array<string>, n long")


def glyph_links(words: DataFrame) -> DataFrame:
    """(word, n, meant, m): words and the more frequent ones they may be misreadings of, given (word, n) of all words.

    Words two confusions away are taken for words of six letters or more that have no nearer link.
    """

    def forward(batches):
        for pdf in batches:
            out = [(w, n, v, ratio(w)) for w, n in zip(pdf["word"], pdf["n"]) if _may_be_misread(w) for v in edits(w) if v != w]
            yield pd.DataFrame(out, columns=["word", "n", "via", "ratio"])

    back_pairs = [(b, a) for a, b in _PAIRS]

    def backward(batches):
        for pdf in batches:
            out = [(w, n, v) for w, n in zip(pdf["word"], pdf["n"]) if len(w) >= 4 and "-" not in w for v in edits(w, back_pairs) if v != w]
            yield pd.DataFrame(out, columns=["meant", "m", "via"])

    steps = stage(words.mapInPandas(forward, "word string, n long, via string, ratio int"), "glyph-steps")
    enough = F.col("m") >= F.greatest(F.lit(1), F.col("n") * F.col("ratio"))
    real = words.where("n > 0")
    once = stage(steps.join(real.select(F.col("word").alias("via"), F.col("n").alias("m")), "via").where(enough).select("word", "n", F.col("via").alias("meant"), "m", "ratio").distinct(), "links-once")
    rest = steps.where(F.length("word") >= 6).join(once.select("word").distinct(), "word", "left_anti")
    twice = rest.join(real.mapInPandas(backward, "meant string, m long, via string"), "via").where(enough & (F.col("meant") != F.col("word"))).select("word", "n", "meant", "m", "ratio").distinct()
    return once.unionByName(twice)


def spelled_links(words: DataFrame, linked: DataFrame, most: int) -> DataFrame:
    """(word, n, meant): words with a digit or sign inside and no link, whose likeliest letters spell like words of the corpus."""

    def candidates(batches):
        for pdf in batches:
            out = []
            for w, n in zip(pdf["word"], pdf["n"]):
                if n > most or "-" in w or not _INNER.search(w) or sum(c.isalpha() for c in w) < 3 or re.search(r"\d{2}", w):
                    continue
                forms = [""]
                for c in w:
                    forms = [f + m for f in forms for m in _LETTER.get(c, [c])][:16]
                out += [(w, n, re.sub(r"\d", "#", w), f) for f in forms if f.isalpha()]
            yield pd.DataFrame(out, columns=["word", "n", "form", "meant"])

    def trigrams(c: Column) -> Column:
        padded = F.concat(F.lit("^"), c, F.lit("$"))
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substr(padded, i, F.lit(3))))

    found = words.mapInPandas(candidates, "word string, n long, form string, meant string").join(linked.select("word").distinct(), "word", "left_anti")
    # The same word with other digits: the digit is content.
    forms = words.where(F.col("word").rlike(r"\d")).groupBy(F.regexp_replace("word", r"\d", "#").alias("form")).agg(F.count("*").alias("k")).where(F.col("k") >= MANY_FORMS)
    found = found.join(forms.select("form"), "form", "left_anti")
    spelling = words.where(F.col("word").rlike(r"^\p{L}{3,}$")).select(F.explode(trigrams(F.col("word"))).alias("g")).groupBy("g").agg(F.count("*").alias("k")).where("k > 1").select("g", F.lit(1).alias("ok"))
    tested = found.select("word", "n", "meant", F.explode(trigrams(F.col("meant"))).alias("g")).join(spelling, "g", "left")
    spelt = tested.groupBy("word", "n", "meant").agg(F.count("*").alias("k"), F.count("ok").alias("good")).where("k = good")
    return spelt.groupBy("word", "n").agg(F.min("meant").alias("meant"))


def _bitmap(words: DataFrame, column: str) -> bytes:
    """A filter of 2^FILTER_BITS bits over a column's words; its size does not depend on their number."""
    rows = words.select(F.crc32(F.encode(F.col(column), "utf-8")).bitwiseAND((1 << FILTER_BITS) - 1).cast("int").alias("i")).distinct().toPandas()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[rows["i"].to_numpy()] = True
    return np.packbits(bits).tobytes()


def _has(bits: bytes, word: str) -> bool:
    i = zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << FILTER_BITS) - 1)
    return bool(bits[i >> 3] >> (7 - (i & 7)) & 1)


def occurrences(records: DataFrame, flagged: bytes, linked: bytes, core: list[str]) -> DataFrame:
    """``seen`` rows: every place of a flagged word or number with letters, with the core words around it; ``pair`` rows: how often linked and core words meet core words."""
    shared = records.sparkSession.sparkContext.broadcast((flagged, linked, core))

    def run(batches):
        flags, links, names = shared.value
        index = {w: k for k, w in enumerate(names)}
        size = max(1, len(names))
        local: dict[str, int] = {}
        words: list[str] = []
        of_core: list[int] = []
        wanted: list[bool] = []
        cache: dict[str, tuple] = {}

        def read(token):
            ids, hits = [], []
            for word, off in split_token(token):
                low = word.lower()
                k = local.get(low)
                if k is None:
                    k = local[low] = len(words)
                    words.append(low)
                    of_core.append(index.get(low, -1))
                    wanted.append(of_core[-1] >= 0 or _has(links, low))
                number = number_meant(word)
                if number is not None:
                    hits.append((len(ids), off, low, number, len(word)))
                elif _has(flags, low) and not (word.isupper() and len(word) <= 4 and not odd(low)):
                    hits.append((len(ids), off, low, None, len(word)))
                ids.append(k)
            return ids, hits

        met, times = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def meetings():
            a = met // size
            return pd.DataFrame({"kind": "pair", "word": np.array(words, object)[a], "own": np.array(of_core, np.int64)[a], "core": met % size, "n": times}).assign(id=None, h=0, line=0, at=0, size=0, number=None, ctx=[[]] * len(met))[_SEEN]

        for pdf in batches:
            stream: list[int] = []
            rows = []
            if len(cache) > 500_000:
                cache.clear()
            for i, h, text, running in zip(pdf["id"], pdf["h"], pdf["text"], pdf["running"]):
                lines, last = text.split("\n"), -1
                for k, tokens, found in body_lines(lines, furniture(lines, running if running is not None else [])):
                    for j, t in enumerate(tokens):
                        e = cache.get(t)
                        if e is None:
                            e = cache[t] = read(t)
                        for p, off, low, number, n in e[1]:
                            # Places are counted from the line's end: a line may begin with the rest of a broken word.
                            spans = [m.start() for m in _TOKEN.finditer(lines[k])]
                            at = spans[len(spans) - len(tokens) - (found is not None) + j] + off
                            rows.append((i, h, k, at, n, low, number, len(stream) + p))
                        stream += e[0]
                    if found or k < last:
                        stream += [-1] * WINDOW
                    last = k
                stream += [-1] * WINDOW
            ids = np.array([*[-1] * WINDOW, *stream, *[-1] * WINDOW], np.int64)
            core_of, want = np.array([*of_core, -1], np.int64), np.array([*wanted, False])
            near_core = core_of[ids]
            keys = []
            for d in range(1, WINDOW + 1):
                for a, b in ((ids[:-d], near_core[d:]), (ids[d:], near_core[:-d])):
                    both = want[a] & (b >= 0)
                    keys.append(a[both] * size + b[both])
            # Counts of a task are kept together, so that a pair goes out once and not once per batch.
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            met, back = np.unique(np.concatenate([met, key]), return_inverse=True)
            times = np.bincount(back, weights=np.concatenate([times, n]), minlength=len(met)).astype(np.int64)
            if len(met) > 2_000_000:
                yield meetings()
                met, times = met[:0], times[:0]
            if rows:
                at = [r[7] + WINDOW for r in rows]
                around = [[int(c) for c in (*near_core[p - WINDOW : p], *near_core[p + 1 : p + 1 + WINDOW]) if c >= 0] for p in at]
                out = pd.DataFrame([r[:7] for r in rows], columns=["id", "h", "line", "at", "size", "word", "number"])
                yield out.assign(kind="seen", ctx=around, own=-1, core=-1, n=0)[_SEEN]
        if len(met):
            yield meetings()

    return records.mapInPandas(run, "kind string, id string, h long, line int, at int, size int, word string, number string, ctx array<int>, own int, core int, n long")


_SEEN = ["kind", "id", "h", "line", "at", "size", "word", "number", "ctx", "own", "core", "n"]


def train(a: np.ndarray, b: np.ndarray, n: np.ndarray, size: int, *, epochs: int = EPOCHS, rate: float = 0.5, block: int = 256, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Skip-gram vectors with negative sampling from pair counts (word a meets word b, a ascending): (centre, around).

    The objective depends on the corpus through the pair counts only, so a pass goes over the
    words with their counts instead of over running text; every word weighs alike, and the
    expected noise words take the place of drawn ones. Memory is one block of words by size.
    """
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.1, (size, DIMENSIONS))
    around = rng.normal(0, 0.01, (size, DIMENSIONS))
    if not len(a):
        return centre, np.zeros_like(around)
    noise = NEGATIVES * _noise(b, n, size)
    total = np.maximum(np.bincount(a, weights=n, minlength=size), 1)
    share = n / total[a]
    seen_centre, seen_around = np.full(centre.shape, 1e-8), np.full(around.shape, 1e-8)
    starts = range(0, size, block)
    ends = np.searchsorted(a, [*starts, size])
    for _ in range(epochs):
        push = np.zeros_like(around)
        for lo, first, end in zip(starts, ends, ends[1:]):
            x = centre[lo : lo + block]
            met = np.bincount((a[first:end] - lo) * size + b[first:end], weights=share[first:end], minlength=len(x) * size).reshape(len(x), size)
            score = (met + noise) / (1 + np.exp(-np.clip(x @ around.T, -8, 8))) - met
            pull = score @ around
            push += score.T @ x
            seen_centre[lo : lo + block] += pull * pull
            centre[lo : lo + block] -= rate * pull / np.sqrt(seen_centre[lo : lo + block])
        seen_around += push * push  # a step per word in proportion to its gradients so far (AdaGrad)
        around -= rate * push / np.sqrt(seen_around)
    return centre, around


def _noise(b: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    noise = np.bincount(b, weights=n, minlength=size) ** 0.75
    return noise / noise.sum()


def fit_centres(counts: np.ndarray, around: np.ndarray, noise: np.ndarray, *, steps: int = 30, rate: float = 1.0) -> np.ndarray:
    """Centre vectors of words by their counts (words x core) of meeting core words, the core's vectors held fixed.

    The same objective as ``train``, with the expected instead of drawn noise words.
    """
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    x = np.zeros((len(counts), around.shape[1]))
    seen = np.full(x.shape, 1e-8)
    weight = share + NEGATIVES * noise
    for _ in range(steps):
        grad = (weight / (1 + np.exp(-np.clip(x @ around.T, -8, 8))) - share) @ around
        seen += grad * grad
        x -= rate * grad / np.sqrt(seen)
    return x


class Vectors:
    """The skip-gram model of the core words, as sent to the workers: at most 1 / CORE_SHARE words."""

    def __init__(self, core: list[str], centre: np.ndarray, around: np.ndarray, noise: np.ndarray):
        self.core, self.centre, self.around, self.noise = core, centre.astype("float32"), around.astype("float32"), noise

    def of_words(self, pairs: DataFrame) -> DataFrame:
        """(word, centre, company): every word's centre vector, and the mean vector of the core words it meets."""
        model = pairs.sparkSession.sparkContext.broadcast((self.centre, self.around, self.noise))

        def run(batches):
            centre, around, noise = model.value
            for pdf in batches:
                for lo in range(0, len(pdf), 256):
                    part = pdf.iloc[lo : lo + 256]
                    counts = np.zeros((len(part), len(around)), "float32")
                    for k, met in enumerate(part["met"]):
                        for m in met:
                            counts[k, m["core"]] += m["n"]
                    own = part["own"].to_numpy()
                    x = np.zeros((len(part), around.shape[1]))
                    known = own >= 0
                    x[known] = centre[own[known]]
                    if (~known).any():
                        x[~known] = fit_centres(counts[~known], around, noise)
                    company = counts @ around / np.maximum(counts.sum(axis=1, keepdims=True), 1)
                    yield pd.DataFrame({"word": part["word"].to_numpy(), "centre": list(x.astype("float32")), "company": list(company)})

        met = pairs.groupBy("word", "core").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
        met = met.groupBy("word").agg(F.max("own").alias("own"), F.collect_list(F.struct("core", "n")).alias("met"))
        return met.mapInPandas(run, "word string, centre array<float>, company array<float>")


def core_words(words: DataFrame, total: int) -> list[str]:
    rows = words.where((F.col("n") >= CORE_SHARE * total) & ~F.contains("word", F.lit("-"))).orderBy(F.desc("n"), "word").collect()
    return [r.word for r in rows]


def learn(pairs: DataFrame, core: list[str]) -> Vectors:
    own = pairs.where("own >= 0").groupBy("own", "core").agg(F.sum("n").alias("n"))
    least = (own.agg(F.sum("n")).head()[0] or 0) * PAIR_SHARE
    p = own.where(F.col("n") >= least).toPandas().sort_values(["own", "core"])  # in order, so that a run can be repeated
    a, b, n = p["own"].to_numpy("int64"), p["core"].to_numpy("int64"), p["n"].to_numpy("float64")
    centre, around = train(a, b, n, len(core))
    return Vectors(core, centre, around, _noise(b, n, len(core)) if len(a) else np.zeros(len(core)))


def _log_odds(fit: Column) -> Column:
    """Log of a word's count in some company against that of the word it may replace, by both counts, the fit against chance and the ratio."""
    return F.log("m") + F.coalesce(F.lit(float(np.log(NEGATIVES))) + fit, F.lit(0.0)) - F.log(F.greatest(F.col("n"), F.lit(0.25)) * F.col("ratio"))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x * y).cast("double")), F.lit(0.0), lambda s, v: s + v)


def _holds(fit: Column) -> Column:
    return (_log_odds(fit) >= 0) & ((F.col("ratio") == ODD_RATIO) & F.col("word").rlike(r"[|@+$€©!\d]") | (F.coalesce(fit, F.lit(0.0)) > LEAST_FIT))


def weigh_links(links: DataFrame, vectors: DataFrame) -> DataFrame:
    """(word, n, meant, m, ratio, fit, centre): links whose frequent word fits the company of the rare one."""
    rare = vectors.select("word", "company")
    meant = vectors.select(F.col("word").alias("meant"), "centre")
    both = links.join(rare, "word", "left").join(meant, "meant", "left")
    both = both.withColumn("fit", F.when(F.col("company").isNotNull() & F.col("centre").isNotNull(), F.greatest(F.least(_dot("company", "centre"), F.lit(CLIP)), F.lit(-CLIP))))
    return both.where(_log_odds(F.col("fit")) >= 0).drop("company")


def correct(places: DataFrame, links: DataFrame, model: Vectors, keys: list[str]) -> DataFrame:
    """(keys, meant) of the places (keys, word, ctx) whose best link holds in its own context."""
    around = places.sparkSession.sparkContext.broadcast(model.around)

    @F.pandas_udf("double")
    def local(ctx: pd.Series, centre: pd.Series) -> pd.Series:
        out = [float((around.value[np.asarray(c)] @ np.asarray(v)).clip(-CLIP, CLIP).mean()) if c is not None and v is not None and len(c) else None for c, v in zip(ctx, centre)]
        return pd.Series(out, dtype="float64")

    rows = places.join(links, "word").withColumn("here", local("ctx", "centre"))
    # Series turn nulls into NaN.
    rows = rows.withColumn("fit", F.coalesce(F.nanvl("here", F.lit(None).cast("double")), F.col("fit"))).where(_holds(F.col("fit")))
    best = F.max(F.struct(F.col("fit").isNotNull().alias("known"), "fit", "m", "meant")).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, "best.meant")


def records(charts: DataFrame, sections: DataFrame) -> DataFrame:
    """(id, h, text, running): all notes and sections with the running lines of their chart; h names the text."""

    @F.pandas_udf("array<string>")
    def running_of(texts: pd.Series) -> pd.Series:
        return texts.map(running_lines)

    notes = charts.select("chart_id", F.col("raw_text").alias("text")).where("chart_id is not null and length(text) > 0").withColumn("running", running_of("text"))
    heads = stage(notes.where("size(running) > 0").select("chart_id", F.explode("running").alias("r")).distinct().groupBy("chart_id").agg(F.array_sort(F.collect_set("r")).alias("running")), "running-lines")
    parts = sections.select("chart_id", F.col("section_id").alias("id"), F.col("section_text").alias("text")).where("id is not null and length(text) > 0")
    rows = charts.select("chart_id", F.col("chart_id").alias("id"), F.col("raw_text").alias("text")).where("id is not null and length(text) > 0").unionByName(parts)
    return rows.join(heads, "chart_id", "left").select("id", F.xxhash64("text").alias("h"), "text", "running")


def noise(charts: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, events): every line's noise with what repairs it.

    Events: id, h, line (from 0), kind, at and size of a misread word, what is meant, and for
    broken words the next line, their parts and whether they are joined only if misread.
    """
    rows = stage(records(charts, sections), "records")
    seen = stage(survey(rows), "survey")
    breaks = seen.where("kind = 'break'").select("id", "h", "line", "next", "a", "b", "mark", "at", "at2", "ctx", F.lower(F.concat("a", "b")).alias("word"), F.lower(F.concat("a", F.lit("-"), "b")).alias("kept"))
    counted = seen.where("kind = 'word'").groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("n"))
    joined = breaks.select("word").distinct().withColumn("n", F.lit(0).cast("long"))
    words = stage(counted.unionByName(joined).groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, quantiles = words.where("n > 0").agg(F.sum("n"), F.percentile_approx("n", [CODES, NUMBERS, PARTS], 10_000)).head()
    total, (code, number, part) = total or 0, quantiles or (0, 0, 0)

    links = stage(glyph_links(words), "glyph-links")
    spelt = stage(spelled_links(words.where("n > 0"), links, code), "spelled-links")
    core = core_words(words, total)
    flagged = _bitmap(links.select("word").unionByName(spelt.select("word")), "word")
    linked = _bitmap(links.select("word").unionByName(links.select(F.col("meant").alias("word"))), "word")
    found = stage(occurrences(rows, flagged, linked, core), "occurrences")
    pairs = found.where("kind = 'pair'")
    model = learn(pairs, core)
    ends = links.select("word").unionByName(links.select(F.col("meant").alias("word"))).distinct()
    vectors = stage(model.of_words(pairs.join(ends, "word", "left_semi")), "vectors")
    held = stage(weigh_links(links, vectors), "held-links")

    place = ["id", "h", "line", "at", "size"]
    at = found.where("kind = 'seen'").select(*place, "word", "number", "ctx")
    by_glyph = correct(at.where("number is null"), held, model, place)
    by_spelling = at.where("number is null").join(spelt.select("word", "meant"), "word").select(*place, "meant")
    numbers = at.where("number is not null").join(words, "word", "left").where(F.coalesce("n", F.lit(0)) <= number).select(*place, F.col("number").alias("meant"))
    misread = by_glyph.unionByName(by_spelling).unionByName(numbers).withColumn("kind", F.lit("misread"))

    # Broken words: the counts of the joined word, of the compound and of the parts.
    forms = breaks.select(F.lower("a").alias("a"), F.lower("b").alias("b"), "word", "kept").distinct()
    asked = forms.select("word", "kept", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("w")) for k, c in enumerate(("word", "kept", "a", "b"))])).alias("q"))
    answer = asked.select("word", "kept", "q.k", F.col("q.w").alias("w")).join(words.select(F.col("word").alias("w"), "n"), "w")
    count = lambda k: F.coalesce(F.max(F.when(F.col("k") == k, F.col("n"))), F.lit(0))
    judged = answer.groupBy("word", "kept").agg(count(0).alias("whole"), count(1).alias("whole_kept"), F.least(count(2), count(3)).alias("parts"))
    index = breaks.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(core)})

    @F.pandas_udf("array<int>")
    def ids(ctx: pd.Series) -> pd.Series:
        return ctx.map(lambda c: [index.value[w] for w in c if w in index.value] if c is not None else [])

    spots = stage(breaks.join(judged, ["word", "kept"], "left").withColumn("ctx", ids("ctx")), "breaks")
    spot = ["id", "h", "line", "next", "a", "b", "at", "at2"]
    meant = correct(spots.select(*spot, "word", "ctx"), held, model, spot)
    whole, kept = F.coalesce("whole", F.lit(0)), F.coalesce("whole_kept", F.lit(0))
    joins = F.when((whole > 0) | (kept > 0), whole > kept).when(F.col("mark") != "-", F.lit(True)).otherwise(~((F.coalesce("parts", F.lit(0)) >= part) & F.lit(part > 0)))
    spots = spots.select(*spot, "word", (joins & F.col("b").rlike(r"^\p{L}")).alias("joins"), kept.alias("kept_n")).join(meant, spot, "left")
    spots = stage(spots.where(F.col("joins") | F.col("meant").isNotNull() & (F.col("kept_n") == 0)), "joined")
    hyphen = spots.select("id", "h", "line", F.lit("hyphen").alias("kind"), F.col("at"), F.lit(0).alias("size"), "meant", "next", "a", "b", "at2")
    # A misread broken word counts for the line of its first wrong letter.
    same = F.length(F.regexp_extract(F.concat_ws("\n", "word", "meant"), r"^(.*).*\n\1", 1))
    wrong = spots.where("meant is not null").select("id", "h", F.when(same < F.length("a"), F.col("line")).otherwise(F.col("next")).alias("line"), F.lit("broken").alias("kind"))
    events = hyphen.unionByName(misread, allowMissingColumns=True).unionByName(wrong, allowMissingColumns=True)
    return rows, events.unionByName(seen.where("kind = 'furniture'").select("id", "h", "line", "kind"), allowMissingColumns=True)


def find_noise(charts: DataFrame, sections: DataFrame) -> DataFrame:
    """(record_id, line_no, kind) of every noisy line of notes and sections."""
    _, events = noise(charts, sections)
    kind = F.when(F.col("kind") == "broken", "misread").otherwise(F.col("kind"))
    return events.select(F.col("id").alias("record_id"), (F.col("line") + 1).cast("int").alias("line_no"), kind.alias("kind")).distinct()


def _cased(meant: str, old: str) -> str:
    return meant.upper() if old.isupper() and len(old) > 1 else meant[:1].upper() + meant[1:] if old[:1].isupper() else meant


def repair(text: str, events: list) -> str:
    """Continuous paragraphs: one per section heading and per blank-line block; furniture removed, words joined and corrected."""
    lines = text.split("\n")
    drop, fixes, broken = set(), {}, {}
    for e in events:
        if e["kind"] == "furniture":
            drop.add(e["line"])
        elif e["kind"] == "misread":
            fixes.setdefault(e["line"], []).append((int(e["at"]), int(e["size"]), e["meant"]))
        elif e["kind"] == "hyphen":
            broken[e["line"]] = (e["a"], e["b"], e["meant"])
    out: list[str] = []
    carry, half = "", None
    for i, x in enumerate(lines):
        if i in drop:
            continue
        if not x.strip():
            carry = carry or "\n"
            continue
        for at, n, meant in sorted(fixes.get(i, ()), reverse=True):
            x = x[:at] + _cased(meant, x[at : at + n]) + x[at + n :]
        x = x.strip()
        if carry == "join" and out:
            if half and half[2] and out[-1].endswith(half[0]) and x.startswith(half[1]):
                a, b, meant = half
                out[-1], x = out[-1][: len(out[-1]) - len(a)] + _cased(meant, a + b), x[len(b) :]
            out[-1] += x
        elif carry in ("\n", "") or _SECTION.match(x) or not out:
            out.append(x)
        else:
            out[-1] += " " + x
        half = broken.get(i)
        if half:
            out[-1] = re.sub(rf"[{_HYPHEN}]\s*$", "", out[-1])
            carry = "join"
        elif re.search(r"\w-$", x):
            carry = "join"
        else:
            carry = "" if _SECTION.match(x) else " "
    return "\n".join(out)


def repair_texts(charts: DataFrame, sections: DataFrame) -> DataFrame:
    """(record_id, text): every note and section as continuous paragraphs."""
    rows, events = noise(charts, sections)
    per = events.where("kind != 'broken'").groupBy("id", "h").agg(F.collect_set(F.struct("line", "kind", "at", "size", "meant", "a", "b")).alias("events"))

    @F.pandas_udf("string")
    def repaired(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([repair(t, e if e is not None else []) for t, e in zip(texts, found)], dtype="object")

    return rows.join(per, ["id", "h"], "left").select(F.col("id").alias("record_id"), repaired("text", "events").alias("text")).distinct()
