"""Fitted models of secrets: recall by alphabet, ordinary names, and texts with very many matches."""

from __future__ import annotations

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secret_scan

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
#: Words of the fitted documents, and others of the names that must not be found.
KNOWN = "thermal vector handler number import string module where production config database credentials services home internal request transaction connection index partition language history government population mountain between through".split()
FRESH = "response buffer maximum timeout window provider manager context station northern problem teacher".split()


@pytest.fixture(scope="module")
def models(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("_-/ ").join(rng.choice(KNOWN + FRESH) for _ in range(4)) for _ in range(30))
    return secret_scan.fit(spark.createDataFrame([(k, text()) for k in range(400)], "doc_id long, text string"))


def found(spark, models, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kind == 3] for r in secret_scan.find_secrets(frame, ratios=models).collect()}


def test_random_strings_of_every_alphabet_are_found(spark, models):
    rng = random.Random(21)
    kinds = {"base62": (LOWER + UPPER + DIGITS, 24), "base64": (LOWER + UPPER + DIGITS + "+/", 44), "url": (LOWER + UPPER + DIGITS + "-_", 43), "hex": ("0123456789abcdef", 24), "upper hex": ("0123456789ABCDEF", 24), "lower": (LOWER, 24), "lower 36": (LOWER + DIGITS, 24), "upper 36": (UPPER + DIGITS, 24)}
    texts = [f"é see {''.join(rng.choice(a) for _ in range(n))} here" for a, n in kinds.values() for _ in range(100)]
    got = found(spark, models, texts)
    for k, (name, (_, n)) in enumerate(kinds.items()):
        hits = [got[i] for i in range(100 * k, 100 * k + 100)]
        assert sum(bool(x) for x in hits) >= 90, name
        assert all(6 <= s < e <= 6 + n for x in hits for s, e in x)


def test_ordinary_names_are_left(spark, models):
    rng = random.Random(22)
    w = lambda: rng.choice(KNOWN + FRESH)
    kinds = [lambda: "_".join(w() for _ in range(4)), lambda: "_".join(w().upper() for _ in range(3)), lambda: w() + "".join(w().title() for _ in range(3)), lambda: "/".join(w() for _ in range(5)), lambda: w() + w() + w(), lambda: "".join(rng.choice(DIGITS) for _ in range(18)), lambda: f"2024-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}-10-30-00"]
    got = found(spark, models, [f"see {f()} here" for f in kinds for _ in range(100)])
    for k in range(len(kinds)):
        assert sum(bool(got[i]) for i in range(100 * k, 100 * k + 100)) <= 3, k


def test_models_of_no_documents(spark):
    models = secret_scan.fit(spark.createDataFrame([], "doc_id long, text string"))
    assert len(models.tables) == len(secret_scan.SORTS) and min(models.thresholds) >= 0
    assert found(spark, models, ["", "a b", "1234567890123456789"]) == {0: [], 1: [], 2: []}


def test_labelled_strings_are_the_same_at_every_call_and_of_their_alphabet(spark):
    rows = [(r["sort"], r["held"], r["run"]) for r in secret_scan.drawn(spark, 40).collect()]
    assert sorted(rows) == sorted((r["sort"], r["held"], r["run"]) for r in secret_scan.drawn(spark, 40).repartition(7).collect())
    assert len(rows) == 40 * (len(secret_scan.SORTS) - 1) and sum(h for _, h, _ in rows) * 4 == len(rows)
    low, high = secret_scan.DRAWN_CHARS
    assert all(set(run) <= set(secret_scan.SORTS[s][1]) and low <= len(run) <= high for s, _, run in rows)


def test_overlapping_spans_are_replaced_together(spark):
    spans = "array(named_struct('start', 4, 'end', 9), named_struct('start', 2, 'end', 6), named_struct('start', 5, 'end', 7), named_struct('start', 9, 'end', 11))"
    frame = spark.sql(f"select concat('é\U0001f600cdefghijklm', repeat('x', 3000)) as text, {spans} as spans")
    masked = secret_scan.masked(F.col("text"), F.col("spans"))
    cut = secret_scan.rebuilt(F.col("text"), F.col("spans"), lambda n, apart: F.when(apart, F.lit("#")).otherwise(""))
    one = frame.select(masked.alias("masked"), cut.alias("cut")).first()
    assert one.masked == "é\U0001f600" + " " * 9 + "lm" + "x" * 3000 and one.cut == "é\U0001f600##lm" + "x" * 3000


def test_very_many_matches_in_one_text(spark, models):
    rng = random.Random(23)
    text = " ".join(f"plain words token={''.join(rng.choice('0123456789wxyz') for _ in range(20))}" for _ in range(60_000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    clean = secret_scan.redact(frame, ratios=models).first().text
    assert clean == " ".join(["plain words [SECRET]"] * 60_000)
    assert time.time() - began < 60
