"""What pseudonyms leave alone, how long odd texts take, and what language identification rejects."""

import random
import time

import duckdb
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from feira.llm import langid, pii

KEY = b"k"


def altered(rows):
    return sum(pii.pseudonymise(r, KEY)[0] != r for r in rows) / len(rows)


def test_rows_of_ordinary_numbers_stay():
    rng = random.Random(1)
    short = [" ".join(str(rng.randint(10, 999)) for _ in range(12)) for _ in range(1500)]
    years = [" ".join(str(rng.randint(1900, 2030)) for _ in range(8)) for _ in range(1500)]
    cells = [" ".join(f"{rng.randint(0, 9999):04d}" for _ in range(3)) + " | " + str(rng.randint(0, 99)) for _ in range(1500)]
    items = ["item " + "".join(rng.choice("0123456789") for _ in range(13)) for _ in range(3000)]
    assert altered(short) < 0.01 and altered(years) < 0.01 and altered(cells) < 0.01
    # Only a number that begins as a card does and has its check digit: one in a hundred.
    assert altered(items) < 0.02


def test_cards_are_still_found():
    rng = random.Random(2)
    for _ in range(300):
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        digits += pii.luhn_digit(digits)
        parts = " ".join(digits[i : i + 4] for i in range(0, 16, 4))
        for text in (digits, parts, parts.replace(" ", "-"), f"7 {parts} 12", f"card: {digits[:6]} {digits[6:]}"):
            new, spans = pii.pseudonymise(f"see {text} now", KEY)
            assert [s[0] for s in spans] == ["card"], text
    odd = f"{digits[:6]} {digits[6:]}"
    assert pii.pseudonymise(f"see {odd} now", KEY)[1] == []


def test_addresses_by_place():
    told = {
        "a.b+c@x-y.example.org!": "a.b+c@x-y.example.org",
        "%a%b@x.co": "%a%b@x.co",
        "x@y": None,
        "@a.com": None,
        "-.@a.com": None,
        "l" * 65 + "@a.com": None,
        "two a@b.co,c@d.org": "a@b.co",
    }
    for text, value in told.items():
        spans = pii.find_emails(text)
        assert (text[slice(*spans[0])] if spans else None) == value, text
    assert len(pii.find_emails("two a@b.co,c@d.org")) == 2


@pytest.mark.parametrize("text", ["%" * 200_000, "%" * 100_000 + "@", "@" * 100_000, "1 " * 100_000, "a." * 100_000 + "@a.b"])
def test_hostile_texts_take_linear_time(text):
    began = time.time()
    pii.pseudonymise(text, KEY)
    assert time.time() - began < 5


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.connect().execute(f"select text, lang from '{SF}/../sf0.01/documents.parquet' where lang is not null")
    return [r for r in rows.fetchall() if len(r[0] or "") > 40]


def _rows(texts):
    x = np.array([langid.features(langid._codes(t)) for t, _ in texts], np.float16)
    names = sorted({lang for _, lang in texts})
    return x, np.array([names.index(lang) for _, lang in texts]), names


def test_texts_of_a_language_that_was_left_out_are_rejected(texts):
    for out in sorted({lang for _, lang in texts}):
        known = [t for t in texts if t[1] != out]
        x, y, names = _rows(known)
        model = langid.train(x, y, names)
        strange = [model.judge(t)[2] for t, lang in texts if lang == out]
        lost = [model.judge(t)[2] for t, _ in known]
        assert sum(lost) <= 0.01 * len(lost)
        print(out, round(model.threshold, 3), round(np.mean(strange), 3), round(np.mean(lost), 4))
        assert np.mean(strange) > 0.9


def test_two_languages_can_reject(texts):
    two = [t for t in texts if t[1] in ("de", "en")]
    x, y, names = _rows(two)
    rng = np.random.default_rng(1)
    junk = np.array([langid.features(rng.permutation(langid._codes(t))) for t, _ in two[:200]], np.float16)
    model = langid.train(x, y, names, junk=junk)
    fresh = [langid.features(rng.permutation(langid._codes(t))) @ model.weights + model.bias for t, _ in two[200:300]]
    assert np.mean([z.max() < model.threshold for z in fresh]) > 0.9
    assert np.mean([model.judge(t)[2] for t, _ in two]) < 0.01


def test_rows_of_one_id_bring_no_more_than_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda x, y, names, **rest: seen.append(len(x)) or langid.Model(names, x, y, 1.0, 0.0))
    df = spark.range(20_000).select(
        F.lit(1).alias("doc_id"), F.lit("the one text of all").alias("text"), F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("lang")
    )
    langid.fit(df, sample=400)
    # A whole text and a passage of each.
    assert seen == [800]
    many = df.withColumn("lang", F.concat(F.lit("l"), F.monotonically_increasing_id() % 700))
    langid.fit(many, sample=400)
    assert seen[1] <= 800
