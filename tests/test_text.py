"""Text functions against Python's re on awkward strings."""

import re
import time

from pyspark.sql import functions as F

from fitmill.functions import regex as rx
from fitmill.functions import text as tx
from fitmill.rules import patterns as pt
from tests.samples import TEXTS, texts

EMAIL = r"[\w\.-]+@[\w\.-]+\.\w+"


def run(spark, function, rows=None):
    out = texts(spark, rows).select("doc_id", function(F.col("text")).alias("out"))
    return [r["out"] for r in out.orderBy("doc_id").collect()]


def clean(t):
    t = re.sub(pt.URL, " ", t)
    t = re.sub(EMAIL, "[EMAIL]", t)
    t = re.sub(pt.PHONE, "[PHONE]", t)
    t = re.sub(r"[•●○■□▪▫◦‣⁃]", "•", t)
    t = re.sub(r"\s+", " ", t)
    return re.sub(r"\.{2,}", ".", t).strip()


def test_clean_text(spark):
    assert run(spark, tx.clean_text) == [clean(t) for t in TEXTS]


def test_mask_email_between_adjacent_addresses(spark):
    rows = ["a@b.c-d@e.f", "a@b.c@d.e", "x@y", "...@-.a", "a.b@c.d.e f@g.h,i@j.k", "@" * 20, "a" * 500]
    assert run(spark, tx.mask_email, rows) == [re.sub(EMAIL, "[EMAIL]", t) for t in rows]


def test_null_is_empty(spark):
    assert run(spark, tx.clean_text, [None, ""]) == ["", ""]


def test_normalise_lines(spark):
    want = ["\n".join(x.strip() for x in t.split("\n") if x.strip()) for t in TEXTS]
    assert run(spark, tx.normalise_lines) == want


def test_bullet_items(spark):
    want = [[b.strip() for b in re.split(pt.BULLET_SPLIT, t) if len(b.strip()) > 10] for t in TEXTS]
    assert run(spark, tx.bullet_items) == want


def test_repair_artefacts(spark):
    rows = [*TEXTS, "a\\nb \\r\\n c", "donâ€™t  â€\"  ÂÂ x"]
    def want(t):
        t = " ".join(t.split())
        for wrong, right in pt.ARTEFACTS:
            t = t.replace(wrong, right)
        return t
    assert run(spark, tx.repair_artefacts, rows) == [want(t) for t in rows]


def test_counts(spark):
    assert run(spark, tx.word_count) == [len(t.split()) for t in TEXTS]
    assert run(spark, tx.char_count) == [len(t) for t in TEXTS]


def test_fold_keeps_offsets(spark):
    assert run(spark, lambda c: F.char_length(rx.fold(c))) == [len(t) for t in TEXTS]


def test_cues_never_exclude_a_match():
    for table in [*pt.ENTITY_PATTERNS.values(), pt.EDUCATION_STRINGS, pt.TITLE_STRINGS]:
        for pattern in table:
            cues = rx.cues(rx.regex_parser.parse(pattern.lower()))
            for text in TEXTS:
                for match in re.finditer(pattern.lower(), text.lower()):
                    assert not cues or any(c in match.group(0) for c in cues)


def test_cues_reach_over_optional_marks_and_shared_beginnings(spark):
    def cues(pattern):
        return rx.cues(rx.regex_parser.parse(pattern.lower()))
    assert cues(r"\b(CPA|Certified\s+Public\s+Accountant)\b") == {"cpa", "accountant"}
    assert cues(r"\b(B\.S\.?|B\.?S\.)\s*(?:in\s+[\w\s]+)?") == {"b.s", "bs."}
    assert cues(r"\b(M\.?D\.?|J\.?D\.?)\b") == {"md", "m.d", "jd", "j.d"}
    assert cues(r"\w+[-–]?\d{4}") == set()
    texts = ["ends with words.", "a B.S. in it", "BS. or MD", "J.D and CPA", "Head of it", "made of it", "2019 - 2020", "2019"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", *(
        rx.may_match(rx.fold(F.col("text")), p).alias(str(k)) for k, p in enumerate(
            [pt.DEGREES[4], pt.DEGREES[2], pt.CERTIFICATIONS[18], pt.JOB_TITLES[8], pt.DURATIONS[2]]))).collect()
    assert [[t for t in texts if {r["text"]: r[str(k)] for r in rows}[t]] for k in range(5)] == [
        ["a B.S. in it", "BS. or MD"], ["BS. or MD", "J.D and CPA"], ["J.D and CPA"], ["Head of it"], ["2019 - 2020"]]


def test_space_class_holds_what_it_lists(spark):
    points = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    spaces = [0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(9, 14), *range(0x1C, 0x21), *range(0x2000, 0x200B)]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "point int, text string")
    for flags in ("", "i", "is"):
        inside = [r.point for r in df.filter(rx.matches(F.col("text"), r"\A\s\z", flags)).collect()]
        outside = [r.point for r in df.filter(~rx.matches(F.col("text"), r"\A[^\s-]\z", flags)).collect()]
        assert sorted(inside) == sorted(spaces) and sorted(outside) == sorted([*spaces, ord("-")])


def test_words_are_counted_as_fast_as_white_space(spark):
    """A run of other characters must not cost a test for every kind of white space at each of them."""
    df = spark.range(8).select(F.repeat(F.lit("some words of a text, "), 50000).alias("text")).repartition(8).cache()

    def seconds(column):
        times = []
        for _ in range(3):
            began = time.perf_counter()
            df.agg(F.sum(column)).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    assert df.count() == 8
    assert seconds(tx.word_count(F.col("text"))) < 3 * seconds(F.char_length(F.regexp_replace("text", " +", "  ")))
