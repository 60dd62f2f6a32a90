"""Problem 8: encoding a corpus with a public byte-level BPE tokenizer.

Method: count the words of the whole corpus, compile the most frequent ones with their
ids into a minimal acyclic transducer, ship that one file to the executors, where it is
mapped into memory, and merge all other words exactly by the merge ranks.

Which words are in the transducer changes only the speed: every word outside it is
merged by the same ranks. The result equals that of the public encoder.

Defined results: null and empty texts have the empty list; strings that look like special
tokens are ordinary text; a text of any length is encoded whole; repeated rows stay;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections import Counter

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import ship_file
from .lexicon_fst import Lexicon, compile_lexicon

TOKENIZERS = os.environ.get("NOTECODE_TOKENIZERS", "/opt/tokenizers")
#: Words in the transducer, the most frequent of the whole corpus. Bounds what the driver gets.
LEXICON_WORDS = 50_000
#: A worker forgets its words beyond this many.
MEMO_WORDS = 400_000
#: Byte-level BPE word pattern of the public tokenizers (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one word, lowest rank first and leftmost among equals, in O(n log n)."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def pair(i: int) -> int | None:
        j = end[i]
        return ranks.get(word[i : end[j]]) if j < n else None

    heap = [(r, i, end[end[i]]) for i in range(n - 1) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := end[i]) >= n or end[j] != stop or not alive[j]:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        for k in (prev[i], i):
            if k >= 0 and (r := pair(k)) is not None:
                heapq.heappush(heap, (r, k, end[end[k]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n) over all texts, counted per partition before the shuffle."""

    def count(batches):
        import regex

        find = regex.compile(PATTERN).findall
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                if text:
                    seen.update(find(text))
            if len(seen) > 500_000:  # rows go out early; nothing is lost, only summed later
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                seen.clear()
        yield pd.DataFrame({"word": pd.Series(list(seen), dtype="object"), "n": pd.Series(list(seen.values()), dtype="int64")})

    rows = texts.select(F.col(column).alias("text")).where(F.length("text") > 0)
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(texts: DataFrame, column: str, ranks: dict[bytes, int], size: int = LEXICON_WORDS) -> bytes:
    """The compiled transducer of the corpus's ``size`` most frequent words of up to 64 characters that occur more than once."""
    top = word_counts(texts, column).where((F.col("n") > 1) & (F.length("word") <= 64)).orderBy(F.desc("n"), "word").limit(size)
    words = [r.word.encode() for r in top.collect()]
    return compile_lexicon({w: merge(w, ranks) for w in words})


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken", folder: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(id, ids) of every row of ``docs``."""
    spark = docs.sparkSession
    path = os.path.join(folder or TOKENIZERS, vocabulary)
    ranks = read_ranks(path)
    name = ship_file(spark, build_lexicon(docs, text_col, ranks, lexicon_words), "lexicon.bin")
    shipped = spark.sparkContext.broadcast(ranks)  # the vocabulary: 50,256 entries

    def run(batches):
        import regex

        find = regex.compile(PATTERN).findall
        lexicon, table, memo = Lexicon(SparkFiles.get(name)), shipped.value, {}
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                ids: list[int] = []
                if text:
                    for w in find(text):
                        got = memo.get(w)
                        if got is None:
                            raw = w.encode()
                            got = lexicon.get(raw)
                            if got is None:
                                got = merge(raw, table)
                            if len(memo) >= MEMO_WORDS:
                                memo.clear()
                            if len(w) <= 64:
                                memo[w] = got
                        ids += got
                out.append(ids)
            yield pd.DataFrame({"id": pdf["id"], "ids": out})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInPandas(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)
