import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pagemill import schemas
from pagemill.functions import pii, text
from pagemill.operators import detect, redact

PAGE = """Shuttle booking 77. Contact: Tomas R. Berglund
Age: 61, born on 2.11.1963. Passport number: K9050417XY, medical record number QT-6624.
Reach him under 415-555-0126 or tomas_b@post.example.net (also +44 (207) 555-0188).
Account number:
     20056014471183925560. Amex 3499 112233 44556, debit 5105 1051 0510 5100.
Company: Nordic Lamp Works; national id AB-5519-C; driver licence no. 8842-19-7. SSN 219-09-9999.
Pick-up at 6 Harbor Mill Lane, Portland, OR 97205. Login from 192.168.7.33.
Dr. Ingrid Solheim confirms that Tomas R. Berglund waits at 6 Harbor Mill Lane, Portland, OR 97205"""


def pages(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, page_content string")


def entities(spark, *texts):
    rows = detect.entity_rows(detect.with_entities(pages(spark, *texts)), ["doc_id"]).collect()
    return [(r.category, r.original, r.masked) for r in sorted(rows, key=lambda r: (r.doc_id, r.ord))]


def test_every_class_is_found_and_masked(spark):
    found = entities(spark, PAGE)
    assert found == [
        ("PERSON_NAME", "Tomas R. Berglund", "***** *. ********"),
        ("AGE", "61", "**"),
        ("DATE_OF_BIRTH", "2.11.1963", "*.**.****"),
        ("PASSPORT_NUMBER", "K9050417XY", "****0417**"),
        ("MEDICAL_RECORD_NUMBER", "QT-6624", "**-****"),
        ("PHONE_NUMBER", "415-555-0126", "***-***-0126"),
        ("EMAIL", "tomas_b@post.example.net", "*****_*@post.example.net"),
        ("PHONE_NUMBER", "+44 (207) 555-0188", "+** (***) ***-0188"),
        ("BANK_ACCOUNT", "20056014471183925560", "********************"),
        ("CREDIT_CARD", "3499 112233 44556", "**** ****** *4556"),
        ("CREDIT_CARD", "5105 1051 0510 5100", "**** **** **** 5100"),
        ("ORGANIZATION", "Nordic Lamp Works", "****** **** *****"),
        ("NATIONAL_ID", "AB-5519-C", "**-****-*"),
        ("DRIVER_LICENSE", "8842-19-7", "***2-19-7"),
        ("SSN", "219-09-9999", "***-**-9999"),
        ("ADDRESS", "6 Harbor Mill Lane, Portland, OR 97205", "* Harbor Mill Lane, Portland, OR 97205"),
        ("IP_ADDRESS", "192.168.7.33", "***.***.*.**"),
        ("PERSON_NAME", "Ingrid Solheim", "****** *******"),
        ("ADDRESS", "6 Harbor Mill Lane, Portland, OR 97205", "* Harbor Mill Lane, Portland, OR 97205"),
    ]
    assert {c for c, _, _ in found} == set(pii.ORDER)
    assert all(len(o) == len(m) for _, o, m in found)


def test_published_form(spark):
    masked = pages(spark, PAGE).select(pii.mask_in_text(F.col("page_content"))).first()[0]
    assert "Contact: [[NAME]]\n" in masked and masked.endswith("Dr. [[NAME]] confirms that [[NAME]] waits at [ADDRESS]")
    assert "under ***-***-0126 or ***@post.example.net (also +** (***) ***-0188)" in masked
    assert "SSN <<SSN>>." in masked and "Age: 61" in masked
    assert "Amex **** ****** *****, debit **** **** **** ****." in masked
    again = pages(spark, masked).select(pii.mask_in_text(F.col("page_content"))).first()[0]
    assert again == masked


def test_values_are_taken_whole_whatever_stands_between(spark):
    cases = {
        "account: 12345678901234567890": "12345678901234567890", "Name:     Ann Lee": "Ann Lee", "Name:\tAnn Lee": "Ann Lee",
        "DOB:     1/2/1990": "1/2/1990", "Account Number:\n6650011223": "6650011223", "(DOB\n1991-04-05)": "1991-04-05",
        "DOB: March 15, 1991": "March 15, 1991", "MRN " + "A" * 40 + "7" + "B" * 40: "A" * 40 + "7" + "B" * 40,
        "Employer: " + " ".join(["Word"] * 12): " ".join(["Word"] * 12), "a@" + "b" * 300 + ".org": "a@" + "b" * 300 + ".org",
        "Card Member: Ann Lee": "Ann Lee", "Analyst: Ann Lee": "Ann Lee", "Submitted by: Ann Lee": "Ann Lee",
    }
    assert [o for _, o, _ in entities(spark, *cases)] == list(cases.values())


def test_known_names_are_masked_as_whole_words_only(spark):
    texts = {
        "Name: Al Lim. The Al Limited company and Al Lim": "Name: [[NAME]]. The Al Limited company and [[NAME]]",
        "Name: Al Lim. Contact: Al Lim Lee. xAl Lim, Al Lim Lee, (Al Lim)": "Name: [[NAME]]. Contact: [[NAME]]. xAl Lim, [[NAME]], ([[NAME]])",
    }
    got = pages(spark, *texts).orderBy("doc_id").select(pii.mask_in_text(F.col("page_content"))).collect()
    assert [r[0] for r in got] == list(texts.values())


def test_text_without_personal_data_is_unchanged(spark):
    for plain in ["", "   ", "no data here\n\n", "version 1.2.3, 20 items @ 5: #3"]:
        assert pages(spark, plain).select(pii.mask_in_text(F.col("page_content"))).first()[0] == plain


def test_text_that_holds_the_mark(spark):
    odd = "a\u0001b a@b.org \u0001 10.0.0.1"
    assert pages(spark, odd).select(pii.mask_in_text(F.col("page_content"))).first()[0] == "a\u0001b ***@b.org \u0001 10.0.0.1"
    assert [o for _, o, _ in entities(spark, odd)] == ["a@b.org", "10.0.0.1"]


PIECES = [
    "a@b.org", "x.y@c.co.uk-z@d.com", "10.1.2.3", "1.2.3.4.5", "5105 1051 0510 5100", "349911223344556", "219-09-9999", "(415) 555-0126",
    "+44 415-555-0126", "415.555.0126", "age 3", "aged: 41", "Name: Ann Lee", "name:Bo Li Wu", "Mr. Al Green", "Dr Who Is", "Employer: Ab Cd",
    "12 Elm St", "7 Long Oak Ave.", "dob 1/2/1990", "account 12345678", "é", "ñ1", "_", " ", "\n", "-", ".", "@", ":", "5", "Mrs", "passport A1",
    "mrn#77", "routing 123456", "national id: 5-5", "driver license K9",
]


def test_fast_pattern_finds_the_same(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    both = pages(spark, *texts).select(
        "page_content",
        F.regexp_extract_all("page_content", F.lit(pii.alternation().replace(r"\b", r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))")), F.lit(0)).alias("plain"),
        F.regexp_extract_all("page_content", F.lit(pii.fast_alternation()), F.lit(0)).alias("fast"),
        F.transform(F.filter(pii.cut(F.col("page_content")), lambda p, i: i % 2 == 1), lambda p: p).alias("cut"),
        F.array_join(pii.cut(F.col("page_content")), "").alias("whole"),
    ).collect()
    assert [r for r in both if r.plain != r.fast or r.fast != r["cut"]][:3] == []
    assert all(r.whole == r.page_content for r in both)
    assert sum(len(r.fast) for r in both) > 5000


def test_model_answers(spark):
    answers = {
        "none": "nothing here", "empty": "[]", "bad": '[{"original": "a", ', "no fields": '[{"x": 1}]',
        "mixed": 'Sure:\n[{"original": "Ann", "masked": "***", "category": "PERSON_NAME"}, "text", 5, null, ["a"]] done',
        "number": '[{"original": 1234, "masked": "****"}]', "null": '[{"original": null, "masked": "*"}]',
        "length": '[{"original": "A-1 b", "masked": "***"}]', "trusted": '[{"original": "Bob", "masked": "Bob", "category": "X"}]',
        "missing": None,
    }
    frame = spark.createDataFrame(list(answers.items()), "name string, answer string")
    got = {r.name: [tuple(e) for e in r.e] for r in frame.select("name", detect.answered(F.col("answer")).alias("e")).collect()}
    assert got == {
        "none": [], "empty": [], "bad": [], "no fields": [], "null": [], "missing": [],
        "mixed": [("Ann", "***", "PERSON_NAME")], "number": [("1234", "****", "UNKNOWN")],
        "length": [("A-1 b", "*-* *", "UNKNOWN")], "trusted": [("Bob", "Bob", "X")],
    }


def test_letters_and_digits_of_any_script_become_stars(spark):
    frame = spark.createDataFrame([("aü²½Ⅷ三-_ .é",)], "t string")
    assert frame.select(text.stars(F.col("t"))).first()[0] == "******-_ .*"


def test_prompt_and_blank_pages(spark):
    asked = detect.detection_input(pages(spark, "x", " \n\t ", "", "　"), ["doc_id"]).collect()
    assert [r.doc_id for r in asked] == [0] and asked[0].prompt.endswith("Text:\nx")


def test_entities_attached_from_rows(spark):
    rows = spark.createDataFrame(
        [(0, 1, "b", "*", "X"), (0, 0, "a", "*", "X")], "doc_id int, ord int, original string, masked string, category string"
    )
    both = {r.doc_id: [e.original for e in r.entities] for r in detect.attach_entities(pages(spark, "a b", "c"), rows, ["doc_id"]).collect()}
    assert both == {0: ["a", "b"], 1: []}


# --- words ------------------------------------------------------------------------------


def on_words(spark, cases, **options):
    """cases: (words, [(original, masked)]) -> per case {pos: (ent, masked)}"""
    rows = [(i, w, [(o, m, "X") for o, m in e]) for i, (w, e) in enumerate(cases)]
    frame = spark.createDataFrame(rows, f"doc_id int, words array<string>, entities array<{schemas.ENTITY}>")
    found = redact.redaction_rows(redact.with_redactions(frame, **options), ["doc_id"]).collect()
    out = [{} for _ in cases]
    for r in found:
        assert r.original_word == cases[r.doc_id][0][r.pos]
        out[r.doc_id][r.pos] = (r.ent, r.masked)
    return out


def by_hand(words, ents, repeat=False):
    key = lambda w: re.sub(r"[^\w@.\-]", "", w).lower()
    keys, owner = [key(w) for w in words], {}
    for number, (original, masked) in enumerate(ents):
        wanted = [key(t) for t in original.split()]
        at = 0
        while wanted and at + len(wanted) <= len(keys):
            span = range(at, at + len(wanted))
            if keys[at : at + len(wanted)] == wanted and not any(p in owner for p in span):
                pieces = masked.split()
                if len(pieces) != len(wanted):
                    rest, pieces = masked.replace(" ", ""), []
                    for p in span:
                        pieces.append(rest[: len(words[p])].ljust(len(words[p]), "*"))
                        rest = rest[len(words[p]) :]
                owner.update({p: (number, pieces[p - at]) for p in span})
                if not repeat:
                    break
            at += 1
    return owner


CASES = [
    (["John", "Smith,", "and", "JOHN", "smith", "John"], [("John Smith", "**** *****"), ("john smith", "**********"), ("John", "****")]),
    (["John", "John", "John"], [("John John", "**** ****"), ("John", "****")]),
    (["a", "--", "b", "..."], [("--", "--"), ("!?", "**"), ("a b", "* *")]),
    (["x"], [("   ", "***"), ("", "")]),
    ([], [("a", "*")]),
    (["New", "York", "City"], [("York City", "**** ****"), ("New York", "*** ****"), ("New", "***")]),
    (["Zoë", "三木", "x_y"], [("ZOË 三木", "*** **"), ("x_y", "***")]),
    (["long", "w", "mask"], [("long w mask", "12345678"), ("q", "*")]),
    (["a", "b"], [("a b", "1 2 3 4 5 6 7 8")]),
]


@pytest.mark.parametrize("repeat", [False, True])
def test_runs_of_words(spark, repeat):
    assert on_words(spark, CASES, repeat=repeat) == [by_hand(w, e, repeat) for w, e in CASES]


@pytest.mark.parametrize("repeat", [False, True])
def test_runs_of_words_at_random(spark, repeat):
    rng = random.Random(11)
    vocabulary = ["a", "b", "A,", "(b)", "c.", "c", "--", "d-e", "a@b.c"]
    cases = []
    for _ in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 14))]
        ents = [
            (" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 3))), rng.choice(["*", "* *", "** * *", "abcdefg"]))
            for _ in range(rng.randint(0, 5))
        ]
        cases.append((words, ents))
    assert on_words(spark, cases, repeat=repeat) == [by_hand(w, e, repeat) for w, e in cases]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="ab *-", max_size=12), st.lists(st.text(alphabet="abc", min_size=1, max_size=5), min_size=2, max_size=4))
def test_mask_pieces_fit_their_words(spark, masked, run):
    frame = spark.createDataFrame([(masked, run)], "masked string, run array<string>")
    pieces = frame.select(redact.split_mask(F.col("masked"), F.col("run"))).first()[0]
    if len(masked.split()) == len(run):
        assert pieces == masked.split()
    else:
        assert [len(p) for p in pieces] == [len(w) for w in run]


def test_loose_ends_and_kept_punctuation(spark):
    case = [(["Call", "555-0149.", "or", "(Ann),", "ok"], [("555-0149", "***-0149"), ("Ann", "***")])]
    assert on_words(spark, case) == [{3: (1, "***")}]
    assert on_words(spark, case, loose=True, keep_punctuation=True)[0][3] == (1, "(***),")
    assert on_words(spark, case, loose=True)[0][1] == (0, "***-0149")


def test_redacted_page_shows_nothing(spark):
    done = redact.redact(detect.with_entities(pages(spark, PAGE, "nothing  here\n")))
    # addresses keep all but the number, so they are masked but still partly there
    assert redact.leaks(done, ["doc_id"]).collect() == []
    assert done.filter("doc_id = 1").first().redacted == "nothing  here\n"
    assert redact.without_leaks(done).count() == 2
    raw = redact.leaks(done, ["doc_id"], "page_content").collect()
    assert {r.category for r in raw} == set(pii.ORDER) - {"AGE"}
    assert redact.without_leaks(done, "page_content").count() == 1
    assert redact.redaction_count(done).first()[0] > 30


def test_leak_check_sees_through_case_and_line_breaks(spark):
    rows = [(0, "seen JOHN\nSMITH", [("John Smith", "x", "A"), ("ab", "x", "A"), (" joh ", "x", "A"), ("zed", "x", "A")])]
    frame = spark.createDataFrame(rows, f"doc_id int, redacted string, entities array<{schemas.ENTITY}>")
    assert [r.original for r in redact.leaks(frame, ["doc_id"]).collect()] == ["John Smith", " joh "]


def test_boxes_without_area_are_left_out(spark):
    box = lambda t, w: (t, 0.0, 0.0, w, 5.0, "F", 10.0)
    rows = [(0, [box("Ann", 9.0), box("Lee", 0.0)], ["Ann", "Lee"], [("Ann Lee", "*** ***", "N")])]
    frame = spark.createDataFrame(rows, f"doc_id int, boxes array<{schemas.WORD}>, words array<string>, entities array<{schemas.ENTITY}>")
    found = redact.redaction_boxes(redact.with_redactions(frame), ["doc_id"]).collect()
    assert [(r.original_word, r.masked, r.x1, r.category) for r in found] == [("Ann", "***", 9.0, "N")]


def test_long_lines_and_many_entities_stay_linear(spark):
    import time

    took = {}
    for n in (500, 8000, 32000):
        many = " ".join(f"word{i} user{i}@mail.example.org" for i in range(n))
        at = time.time()
        done = redact.redact(detect.with_entities(pages(spark, many)))
        assert redact.redaction_count(done).first()[0] == n
        took[n] = time.time() - at
    assert took[32000] < 5 * took[8000] + 2


def test_leaks_of_many_entities_equal_plain_search(spark):
    import random

    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcé ") for _ in range(draw.randint(1, 6)))
    cases = [(i, word() * 40 if i else None, [(word() or None, "x", "A") for _ in range(draw.choice([0, 3, 9, 200]))]) for i in range(60)]
    cases += [(100, "aaaaaa", [(None, "x", "A"), ("", "x", "A")] + [("a" * n, "x", str(n)) for n in range(1, 30)]), (101, "x", None)]
    frame = spark.createDataFrame(cases, f"doc_id int, redacted string, entities array<{schemas.ENTITY}>")
    folded = lambda t: " ".join((t or "").split()).lower()
    expected = {i: [e[0] for e in es or [] if t is not None and len(folded(e[0])) > 2 and folded(e[0]) in folded(t)] for i, t, es in cases}
    found = {r.doc_id: [x.original for x in r.leaked or []] for r in frame.select("doc_id", redact.leaked(F.col("redacted"), F.col("entities")).alias("leaked")).collect()}
    assert found == expected
    clean = {r.doc_id for r in redact.without_leaks(frame.filter("entities IS NOT NULL")).collect()}
    assert clean == {i for i, _, es in cases if es is not None and not expected[i]}


def test_leak_check_of_many_entities_stays_linear(spark):
    import time

    took = {}
    for n in (500, 8000, 32000):
        names = [f"user{i}@mail.example.org" for i in range(n)]
        rows = [(0, " ".join(names[::2]), [(name, "x", "EMAIL") for name in names])]
        frame = spark.createDataFrame(rows, f"doc_id int, redacted string, entities array<{schemas.ENTITY}>")
        at = time.time()
        assert redact.leaks(frame, ["doc_id"]).count() >= n // 2
        took[n] = time.time() - at
    assert took[32000] < 5 * took[8000] + 1


def test_words_are_parted_as_python_does_without_a_pattern(spark, capsys):
    from pagemill.functions import text

    spaces = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    texts = ["", " ", None, "one", " a  b\n", "x" + "y".join(spaces) + "z", "é​f 日本　語 \U0001f600 .", spaces]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.words(F.col("t")).alias("w"))
    assert [r.w for r in frame.collect()] == [None if t is None else t.split() for t in texts]
    frame.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
