import pytest

from notecode.llm.privacy import Detector, each_item, find_items, given_names, name_test, normalise, redact, source_offset

GIVEN = ["ysolin", "fenella-ru", "émeline-or", "draveth"]
CASES = [
    ("Referred by Dr. Tamfenquist (a.b@mail.example).", ["NAME Tamfenquist", "EMAIL a.b@mail.example"]),
    ("Contact: x_y (at) thistle (dot) example or +1(600)555-0181.", ["EMAIL x_y (at) thistle (dot) example", "PHONE +1(600)555-0181"]),
    ("mail x.y [at] post.invalid", ["EMAIL x.y [at] post.invalid"]),
    ("Letter for YARBRELANE, Ysolin M. returned, new address is 136a Old Lantern Rd., Apt 4, Saltbrook 00008.", ["NAME YARBRELANE, Ysolin M.", "ADDRESS 136a Old Lantern Rd., Apt 4, Saltbrook 00008"]),
    ("Neighbour ysolin van der umesgrave holds a key, on 311/555 0133.", ["NAME ysolin van der umesgrave", "PHONE 311/555 0133"]),
    ("Patient gave MRN#006357899 at registration, SSN 000 65 1356 and licence no. N819-4963-8895.", ["ID 006357899", "ID 000 65 1356", "ID N819-4963-8895"]),
    ("insurance no. QX-80-80-13-C; passport ZZ3599363.", ["ID QX-80-80-13-C", "ID ZZ3599363"]),
    ("Seen by Nurse Fenella-Ru Grelane-\nholt in clinic", ["NAME Fenella-Ru Grelane-\nholt"]),
    ("call 311 five five five 0 1 2", []),
    ("on six zero zero five five five zero one six one", ["PHONE six zero zero five five five zero one six one"]),
    ("Order 95062322, Accession 25-533-170, lot 123-45678-90. Breornwick syndrome at Harrowmere Clinic.", []),
    ("the night nurse because of pain, 12,500 /uL on 05/11/2025 at 10:30", []),
    ("", []),
]


MORE = [
    ("mail jo.smith@example dot com today", ["EMAIL jo.smith@example dot com"]),
    ("ring 020 7946 0958 or 01 23 45 67 89.", ["PHONE 020 7946 0958", "PHONE 01 23 45 67 89"]),
    ("Habite 12 Rue de la Paix, vive en 3 calle del Sol.", ["ADDRESS 12 Rue de la Paix", "ADDRESS 3 calle del Sol"]),
    ("Seen with Bo Tamfenwick and Li Grelane, li grelane left.", ["NAME Bo Tamfenwick", "NAME Li Grelane"]),
    ("𝐃𝐫. Umegrave, x@𝗽𝗼𝘀𝘁.example", ["NAME Umegrave", "EMAIL x@𝗽𝗼𝘀𝘁.example"]),
    ("the dot plot shows no change", []),
]


def found(text, given=()):
    """The spans of a text, overlaps resolved."""
    out, end = [], -1
    for kind, a, b, _ in sorted(Detector(set(given).__contains__).find(text), key=lambda s: (s[1], -s[2])):
        if a >= end:
            out.append((kind, a, b))
            end = b
    return out


@pytest.mark.parametrize("text,want", CASES + MORE)
def test_items(text, want):
    assert [f"{k} {text[a:b]}" for k, a, b in found(text, [*GIVEN, "bo", "li"])] == want


def test_time_does_not_grow_with_the_names():
    import time

    text = "The patient was seen with Draveth Umegrave and moderate swelling of the left knee. " * 200

    def seconds(n):
        detector = Detector({f"nam{'abcdefghij'[i % 10]}{i}" for i in range(n)}.union(["draveth"]).__contains__)
        best = 1e9
        for _ in range(5):
            began = time.perf_counter()
            assert len(detector.find(text)) == 200
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(50_000) < 2 * seconds(100)


def test_offsets_survive_disguises():
    text = "Ѕее​ x.y​ (at) post (dot) example, tel ＋1 900 555 0177 🙂"
    flat, starts, sources, _ = normalise(text)
    assert all(0 <= source_offset(i, starts, sources) < len(text) for i in range(len(flat)))
    got = [(k, text[a:b]) for k, a, b in found(text)]
    assert got == [("EMAIL", "x.y​ (at) post (dot) example"), ("PHONE", "＋1 900 555 0177")]


NONE = "g string"


def test_table_functions(spark):
    rows = spark.createDataFrame([("r", "Dr. Umegrave", "x"), ("r", "Dr. Umegrave", "x"), ("n", None, "x"), ("e", "", "x"), (None, "Dr. Umegrave", "x"), ("l", "word " * 50000 + "a@b.example", "x"), ("r", "Ms Umegrave", "x")], "id string, text string, pii_type string")
    none = spark.createDataFrame([], NONE)
    got = {(r.record_id, r.pii_type, r.start_offset) for r in each_item(find_items(rows, none, id_col="id", text_col="text")).collect()}
    assert got == {("r", "NAME", 4), ("r", "NAME", 3), ("l", "EMAIL", 250000)}
    out = redact(rows.where("id is null or id != 'l'"), none, id_col="id", text_col="text")
    assert out.columns == ["id", "text", "pii_type", "redacted"]
    assert sorted(((r.id, r.redacted) for r in out.collect()), key=str) == sorted([("r", "Dr. [NAME]")] * 2 + [("r", "Ms [NAME]"), ("n", None), ("e", ""), (None, "Dr. [NAME]")], key=str)
    assert find_items(rows.limit(0), none, id_col="id", text_col="text").count() == 0


def test_false_hits_of_the_filter_are_no_names(spark, monkeypatch):
    from notecode.llm import privacy

    monkeypatch.setattr(privacy, "name_test", lambda bits: lambda word: True)
    rows = spark.createDataFrame([("a", "Seen with Draveth Umegrave at 12 Mill Lane today")], "id string, text string")
    names = spark.createDataFrame([("draveth",)], NONE)
    assert [(r.pii_type, r.start_offset) for r in each_item(find_items(rows, names, id_col="id", text_col="text")).collect()] == [("NAME", 10), ("ADDRESS", 30)]


def test_given_names_are_learned(spark):
    p = spark.createDataFrame([("Dr. Émeline-Or Ixgrave",), ("IXGRAVE, émeline-or",), ("Mr. Umegrave",), ("Mr. Umegrave",), (None,), ("Draveth P. Mere",), ("draveth mere",), ("Bo Tamwick",)], "provider string")
    assert {r.g for r in given_names(p).collect()} == {"émeline-or", "draveth", "bo"}


def test_filter(spark):
    from notecode.llm.privacy import _filter_of

    test = name_test(_filter_of(spark.createDataFrame([("émeline-or",), ("bo",)], NONE)))
    assert test("émeline-or") and test("bo") and not test("mere")


@pytest.mark.parametrize("said", ["two three four six seven eight two three four six", "six  zero  zero  five  five  five  zero  one  six  one", "TWO - three - four - six - seven - eight - two - three - four - six"])
def test_spelled_numbers_of_any_digits(said):
    assert [(k, f"call {said} today"[a:b]) for k, a, b in found(f"call {said} today")] == [("PHONE", said)]
