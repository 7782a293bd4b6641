import random
from zlib import crc32

import numpy as np
import pytest

from tillroll.llm import langid

STEMS = {
    "en": ("th", "ing", "wh", "ough", "sh"), "de": ("sch", "ich", "ein", "ü", "ß"), "el": ("και", "της", "ου", "α", "ν"), "zz": ("qx", "jq", "vv", "xz", "kk"),
}


def text(dice, lang, words):
    return " ".join("".join(dice.choice(STEMS[lang]) for _ in range(dice.randint(1, 3))) for _ in range(words))


def corpus(n=400):
    dice = random.Random(3)
    langs = [dice.choice(list(STEMS)) for _ in range(n)]
    return [(i, text(dice, x, dice.randint(4, 80)), x, "clash") for i, x in enumerate(langs)]


SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_languages(spark):
    rows = corpus()
    got = {r.doc_id: r for r in langid.language(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, _, lang, _ in rows:
        assert got[i].held_out == (crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held) > 50


def test_texts_without_letters_and_nulls(spark):
    rows = [*corpus(60), (100, None, "en", ""), (101, "", "en", ""), (102, "123 !?", None, ""), (None, "thing sh", None, ""), (103, "thing " * 40_000, None, ""), (104, "語" * 50, None, ""), (104, "語" * 50, None, "")]
    found = langid.language(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (100, 101, 102))
    assert got[103].lang_pred == got[None].lang_pred == "en" and not got[None].held_out and got[104].lang_pred in STEMS


@pytest.mark.parametrize("rows", [[], [(1, "words", None, "")], [(7, "words", "en", "")]])
def test_little_or_nothing_to_learn_from(spark, rows):
    found = langid.language(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows) and all(r.lang_pred in ("und", "en") for r in found)


def test_vectors_equal_a_plain_bundle():
    texts = ["Abba baß x", "", None, "añ b"]
    grams = langid.Trigrams(texts)
    got = grams.vectors(grams.doc, len(texts))
    for i, t in enumerate(texts):
        expected = np.zeros(langid.DIMENSIONS)
        padded = " " + (t or "").lower() + " "
        for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
            if b.isalpha():
                va, vb, vc = (langid.letter_vectors(np.array([ord(x) if x.isalpha() else 0]))[0] for x in (a, b, c))
                expected += np.roll(va, 2) * np.roll(vb, 1) * vc
        assert np.array_equal(got[i], expected)


def test_large_alphabets_take_the_sorted_way():
    texts = ["".join(chr(0x4E00 + (i * 7) % 900) for i in range(3000))]
    grams = langid.Trigrams(texts)
    assert len(grams.at) == 3000 and grams.vectors(grams.doc, 1).any()
