"""Problem 9: evaluation texts inside the training corpus.

Method: suffix arrays over shards of the corpus, written once and searched as often as
there are test items: every suffix of every item is looked up by binary search in every
shard, which gives all places of its first words, and from these its longest verbatim
matches. Texts are compared as words: maximal runs of letters and digits, without case
and accents.

A shard holds whole documents, up to ``SHARD_WORDS`` words (a longer document is a shard of
its own), as 64-bit word codes that do not depend on the shard or the items, and the order
of all its suffixes, sorted by prefix doubling.

Test items are sent to the workers in blocks of bounded size; the shards, not the texts,
are read once per block. A task holds one shard and a batch of rows at a time, however many
there are: shards are written one by one and sent in batches of ``BATCH_BYTES``. Defined results: null, empty and short texts match nothing; a
repeated item or document row gives the same rows once; matches never run across two texts.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import LARGE_ROWS, small_batches, stage

MIN_WORDS = 12
#: Words of a shard.
SHARD_WORDS = 500_000
#: Characters of test text that go to the workers in one block, and suffixes searched at once.
BLOCK_CHARS, SUFFIXES = 8_000_000, 50_000
#: Bytes of rows that go to a worker at once, and words whose codes a worker keeps.
BATCH_BYTES, KNOWN_WORDS = 4_000_000, 200_000
_WORD = re.compile(r"[^\W_]+").findall


def words(text: str | None) -> list[str]:
    """Case- and accent-free words."""
    if not text:
        return []
    if text.isascii():
        return _WORD(text.lower())
    text = unicodedata.normalize("NFD", text.lower())
    return _WORD("".join(c for c in text if unicodedata.category(c)[0] != "M"))


def code_of(word: str) -> int:
    """A positive 63-bit code; 0 is left for the end of a text."""
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") >> 1 or 1


def suffix_order(tokens: np.ndarray, longest: int) -> np.ndarray:
    """All positions of words, sorted by what follows up to the end of their text; ties keep text order.

    Prefix doubling: ranks by 1, 2, 4, ... tokens, until no text is longer. A 0 ends every text.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    size = int(rank.max()) + 1 if n else 1
    step, key = 1, rank.astype(np.int64)
    while step < 4 and size ** (step + 1) < 1 << 62:  # as many words as fit into one number
        key = key * size + np.append(rank[step:], np.zeros(min(step, n), np.int64))[:n]
        step += 1
    _, group, counts = np.unique(key, return_inverse=True, return_counts=True)
    # A rank is the place of the first suffix that is the same so far: refining a group leaves the others as they are.
    rank = (np.cumsum(counts) - counts)[group]
    open_ = np.flatnonzero(counts[group] > 1)
    while step <= longest and len(open_):
        own, ahead = rank[open_], np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)], 0)
        order = np.argsort(own * (n + 1) + ahead, kind="stable")
        own, ahead, at = own[order], ahead[order], np.arange(len(order))
        new_group = np.append(True, own[1:] != own[:-1])
        new_key = new_group | np.append(True, ahead[1:] != ahead[:-1])
        fresh = own + np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        rank[open_[order]] = fresh
        alone = new_key & np.append(new_key[1:], True)
        open_ = np.sort(open_[order][~alone])
        step *= 2
    order = np.argsort(rank, kind="stable")
    return order[tokens[order] != 0].astype(np.int32)


def build_shards(corpus: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ids, bounds, tokens, suffixes): the suffix arrays of a corpus, as binary columns."""

    def run(batches):
        codes: dict[str, int] = {}

        def shard(ids, parts):
            tokens = np.concatenate([*parts, np.zeros(1, np.int64)])
            sizes = [len(p) for p in parts]
            bounds = np.cumsum([0, *sizes[:-1]]).astype(np.int32)
            return {"ids": ids, "bounds": bounds.tobytes(), "tokens": tokens.tobytes(), "suffixes": suffix_order(tokens, max(sizes)).tobytes()}

        ids, parts, size = [], [], 0
        for pdf in batches:
            for i, text in zip(pdf["id"].tolist(), pdf["text"]):
                own = words(text)
                for w in own:
                    if w not in codes:
                        codes[w] = code_of(w)
                part = np.fromiter((codes[w] for w in own), np.int64, len(own))
                if parts and size + len(part) > SHARD_WORDS:
                    yield pd.DataFrame([shard(ids, parts)])
                    ids, parts, size = [], [], 0
                ids.append(i)
                parts.append(np.append(part, 0))
                size += len(part) + 1
                if len(codes) > KNOWN_WORDS:
                    codes.clear()
        if parts:
            yield pd.DataFrame([shard(ids, parts)])

    docs = corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    kind = dict(docs.dtypes)["id"]
    return docs.mapInPandas(run, f"ids array<{kind}>, bounds binary, tokens binary, suffixes binary")


def find_suffixes(tokens: np.ndarray, order: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``queries`` (the first words of a test suffix) the range of the suffix array that begins with it, by binary search of all at once."""
    width = queries.shape[1]
    padded = np.append(tokens, np.zeros(width, np.int64))

    def bound(right: bool) -> np.ndarray:
        lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = order[np.minimum(mid, len(order) - 1)]
            have = padded[at[:, None] + np.arange(width)]
            differs = have != queries
            first = differs.argmax(axis=1)
            row = np.arange(len(queries))
            less = np.where(differs[row, first], have[row, first] < queries[row, first], right)
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo

    return bound(False), bound(True)


def search(shards: DataFrame, items: list[tuple], *, min_words: int) -> DataFrame:
    """(doc_id, item_id, n_words, doc_word, item_word): the longest match of each pair found in one block of items."""
    coded = [(i, np.array([code_of(w) for w in ws], np.int64)) for i, t in items if len(ws := words(t)) >= min_words]
    shared = shards.sparkSession.sparkContext.broadcast(coded)

    def run(batches):
        queries = shared.value
        flat = np.concatenate([np.empty(0, np.int64), *(q for _, q in queries)])
        of = np.repeat(np.arange(len(queries)), [len(q) for _, q in queries])
        begin = np.cumsum([0, *(len(q) for _, q in queries)])
        starts = np.concatenate([np.empty(0, np.int64), *(np.arange(b, b + len(q) - min_words + 1) for b, (_, q) in zip(begin, queries))])
        for pdf in batches:
            for ids, bounds, tokens, suffixes in zip(pdf["ids"], pdf["bounds"], pdf["tokens"], pdf["suffixes"]):
                bounds, order = np.frombuffer(bounds, np.int32), np.frombuffer(suffixes, np.int32)
                tokens = np.frombuffer(tokens, np.int64)
                rows: dict[tuple, tuple] = {}
                for at in range(0, len(starts) if len(order) else 0, SUFFIXES):
                    lo, hi = find_suffixes(tokens, order, flat[starts[at : at + SUFFIXES, None] + np.arange(min_words)])
                    for j in np.flatnonzero(lo < hi):
                        k = of[starts[at + j]]
                        s = int(starts[at + j] - begin[k])
                        item, q = queries[k]
                        places = order[lo[j] : hi[j]]
                        if s:  # a match that began a word earlier is already known, and longer
                            before = np.where(places > 0, tokens[np.maximum(places - 1, 0)], 0)
                            places = places[before != q[s - 1]]
                        for p in places:
                            n = min_words
                            while s + n < len(q) and tokens[p + n] == q[s + n]:
                                n += 1
                            d = int(np.searchsorted(bounds, p, "right")) - 1
                            key = (ids[d], item)
                            new = (n, int(p - bounds[d]), s)
                            if key not in rows or (rows[key][0], -rows[key][1], -rows[key][2]) < (n, -new[1], -s):
                                rows[key] = new
                yield pd.DataFrame([(*k, *v) for k, v in rows.items()], columns=["doc_id", "item_id", "n_words", "doc_word", "item_word"])

    kind = dict(shards.dtypes)["ids"][len("array<") : -1]
    return shards.mapInPandas(run, f"doc_id {kind}, item_id long, n_words int, doc_word int, item_word int")


def find_leaks(corpus: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The longest verbatim match of every (document, test item) that share ``min_words`` or more consecutive words."""
    with small_batches(corpus.sparkSession, BATCH_BYTES):
        shards = stage(build_shards(corpus, id_col, text_col), "suffix-arrays", LARGE_ROWS)
    rows = items.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t")).where(F.col("t").isNotNull()).distinct()
    found, block, size = None, [], 0

    def flush():
        nonlocal found, block, size
        with small_batches(shards.sparkSession, BATCH_BYTES):
            part = stage(search(shards, block, min_words=min_words), "leaks")
        found = part if found is None else found.unionByName(part)
        block, size = [], 0

    for r in rows.orderBy("i").toLocalIterator():
        block.append((r.i, r.t))
        size += len(r.t)
        if size >= BLOCK_CHARS:
            flush()
    if block or found is None:
        flush()
    best = F.max(F.struct("n_words", F.negative("doc_word").alias("a"), F.negative("item_word").alias("b"))).alias("m")
    out = found.groupBy("doc_id", "item_id").agg(best)
    return out.select("doc_id", "item_id", "m.n_words", F.negative("m.a").alias("doc_word"), F.negative("m.b").alias("item_word"))


def leaked_items(leaks: DataFrame) -> DataFrame:
    """Per test item: how many documents hold a passage of it, and its longest passage."""
    return leaks.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("n_words").alias("longest"))


def remove_leaked(corpus: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The corpus without the documents concerned."""
    return corpus.join(leaks.select(F.col("doc_id").alias("_leaked")).distinct(), F.col(id_col) == F.col("_leaked"), "left_anti")
