import base64
import os

import pytest

from notecode.llm import tokenise
from notecode.llm.lexicon_fst import Builder, Lexicon, compile_lexicon

FOLDER = tokenise.TOKENIZERS
pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/byte_bpe_50k.tiktoken"), reason="no vocabulary files")

TEXTS = [None, "", " ", "Hello world", "<|endoftext|> is text", "a" * 5000, "日本語 and ½ ²", "don't I'LL we've", "\n\n  x\t\ty  ", "🙂🙂🏽 family", "é​x", "1234567 12.5mg/dL", "x" + " " * 300 + "y", "Ärzte " * 200]


def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{FOLDER}/byte_bpe_50k.tiktoken", "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenise.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_public_encoder(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "y")], "doc_id long, text string, ids string")
    enc = reference()
    got = tokenise.encode(df, lexicon_words=5).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert r.ids == (enc.encode_ordinary(TEXTS[r.doc_id]) if TEXTS[r.doc_id] else []), TEXTS[r.doc_id]
        assert enc.decode(r.ids) == (TEXTS[r.doc_id] or "")


def test_empty_table(spark):
    assert tokenise.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_automaton(tmp_path):
    import random

    rng = random.Random(1)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 7))): [rng.randrange(9) for _ in range(rng.randint(0, 4))] for _ in range(300)}
    path = tmp_path / "x.bin"
    path.write_bytes(compile_lexicon(words))
    lex = Lexicon(str(path))
    assert all(lex.get(w) == v for w, v in words.items())
    assert [lex.rank(w) for w in sorted(words)] == list(range(len(words)))
    for _ in range(300):
        w = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 8)))
        assert lex.get(w) == words.get(w)


def test_automaton_is_minimal():
    b = Builder()
    for w in (b"tap", b"taps", b"top", b"tops"):
        b.add(w)
    assert len(b.finish()["final"]) == 5
    with pytest.raises(ValueError):
        b.add(b"a")


def test_empty_lexicon(tmp_path):
    path = tmp_path / "x.bin"
    path.write_bytes(compile_lexicon({}))
    assert Lexicon(str(path)).get(b"a") is None
