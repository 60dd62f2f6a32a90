from notecode.llm.truncation import cut_share, find_cut

FULL = ["The patient was seen at the clinic after two days of pain.", "Dressings are changed every 5 hours by the ward nurse.", "Discharge is expected within 9 days if nausea settles."]
BASE = [" ".join(FULL) for _ in range(12)] + ["\n".join(FULL) + "\n\nKind regards" for _ in range(6)] + [" ".join(FULL[::-1]) + "\n\nSee attached sheet…" for _ in range(5)]
SCHEMA = "doc_id long, text string, source string, mid string"


def cut(spark, texts):
    rows = [(i, t + f" No change {i}." if "\n" not in t else f"Note {i}.\n" + t, "s", "x") for i, t in enumerate(BASE)]
    rows += [(100 + i, t, None if i else "t", "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[-1:], SCHEMA)
    found = find_cut(docs)
    return docs, found, {r.doc_id - 100 for r in found.collect()}


def test_cases(spark):
    texts = [
        FULL[0] + " Dressings are changed every", FULL[1] + " Discharge is expec", FULL[1] + " Discharge is expected within 9 days if nau...", FULL[0] + " The patient was seen at the …", " ".join(FULL), FULL[0] + "\n\nKind regards", FULL[0] + "\n- weight 5", FULL[0] + "\nSee attached sheet…", None, "", "  \n ", FULL[2] + " The",
    ]
    docs, found, ids = cut(spark, texts)
    assert ids == {0, 1, 2, 3, 11}
    share = {r.source: (r.n_docs, r.n_cut) for r in cut_share(docs, found).collect()}
    assert share["t"] == (1, 1) and share["s"] == (len(BASE), 0) and share[None] == (11, 4)


def test_long_text_and_empty_table(spark):
    assert cut(spark, [(" ".join(FULL) + " ") * 2000 + "Dressings are changed"])[2] == {0}
    assert find_cut(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_cut_at_the_same_place_are_no_habit(spark):
    docs = [f"Header {h}.\n{FULL[2]} {FULL[0]}" for h in ["north", "south", "east", "west"] * 20]
    docs = [f"{t} Seen by team {chr(97 + i % 26)}{chr(97 + i // 26)}." for i, t in enumerate(docs)]
    ends = [f"Header {h}.\nDischarge is expected wi..." for h in ("north", "south", "east", "west")]
    habits = [f"Header {h}.\nTo be continued..." for h in ("north", "south", "east", "west")]
    rows = [(i, t, "s", "x") for i, t in enumerate(docs + ends + habits)]
    found = {r.doc_id for r in find_cut(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {80, 81, 82, 83}


def test_final_words_of_any_length(spark):
    long = "pneumono" + "ultramicroscopic" * 4 + "osis"
    base = [f"Number {i} was seen. The patient has {long} of the lung." for i in range(30)]
    docs = [*base, f"Seen today. The patient has {long[:50]}"]
    found = {r.doc_id for r in find_cut(spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")).collect()}
    assert found == {30}


def test_time_is_linear_in_the_length_of_a_unit(spark):
    import time

    from notecode.llm.truncation import trigram_counts

    def seconds(n):
        docs = spark.createDataFrame([(1, " ".join(f"w{i % 977}x{i % 13}" for i in range(n)))], "doc_id long, text string")
        best = 1e9
        for _ in range(2):
            began = time.time()
            trigram_counts(docs).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - began)
        return best

    seconds(100)
    assert seconds(32_000) < 2 * seconds(16_000) + 1


def test_trigrams_at_the_beginning_are_their_own(spark):
    from notecode.llm.truncation import final_trigrams, trigram_counts

    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "x"), (3, "See one two three...")], "doc_id long, text string")
    grams = {(r.a, r.b, r.c) for r in trigram_counts(docs).collect()}
    assert {("¶¶", "¶", "one"), ("¶¶", "one", "two"), ("¶one", "two", "three"), ("¶two", "three", "four"), ("three", "four", "five")} <= grams
    last = {r.id: (r.a, r.b, r.c, r.marked) for r in final_trigrams(docs).collect()}
    assert last == {1: ("four", "five", "six", False), 2: ("¶¶", "¶", "x", False), 3: ("¶one", "two", "three", True)}
