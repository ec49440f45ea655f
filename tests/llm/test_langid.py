import math
import random
from collections import Counter

import pytest

from tallyforge.llm import langid

from . import cases

SYLLABLES = {"xa": ["ba", "ko", "ti", "ra", "mu"], "xb": ["schl", "eng", "ü", "orf", "ach"], "xc": ["que", "eau", "é", "tion", "les"]}


def made(n=240):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        text = " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(2, 60)))
        rows.append((i, text if i % 5 else text.upper(), lang, None, None))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(cases.documents(spark, made()), sample=30)


def test_held_out_accuracy(spark, model):
    found = langid.predict(cases.documents(spark, made()), model).where("crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2").collect()
    assert len(found) > 30 and sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert not any(r["rejected"] for r in found)


def test_model_learns_from_training_rows_only(spark):
    rows = made()
    wrong = [(i, t, lang if langid_fold(i) != 2 else "zz", s, n) for i, t, lang, s, n in rows]
    assert set(langid.fit(cases.documents(spark, wrong)).languages) == set(SYLLABLES)


def langid_fold(i):
    from zlib import crc32

    return crc32(str(i).encode()) % 4


def test_several_centroids(model):
    assert all(1 <= model.languages.count(lang) <= 4 for lang in SYLLABLES) and len(model.languages) > 3


def test_odd_texts(model):
    assert model.predict(None) == ("und", 0.0, True)
    assert model.predict("") == ("und", 0.0, True)
    assert model.predict("12 .,! \n 3") == ("und", 0.0, True)
    assert model.predict("q")[0] in SYLLABLES and not model.predict("q")[2]
    foreign = "жщъ ыэю ёжик " * 40
    assert model.predict(foreign)[0] in SYLLABLES and model.predict(foreign)[2]
    assert model.predict("que eau " * 300_000)[0] == "xc"


def test_columns_and_rows_stay(spark, model):
    docs = cases.clashing(cases.documents(spark))
    found = langid.predict(docs, model)
    assert set(found.columns) == set(docs.columns) and found.count() == len(cases.rows())


def test_nothing_to_learn_from(spark):
    nothing = langid.fit(cases.documents(spark, []))
    assert nothing.predict("some text") == ("und", 0.0, True)
    assert langid.predict(cases.documents(spark, []), nothing).collect() == []
    blank = langid.fit(cases.documents(spark, [(1, None, "en", None, None), (3, "12", "en", None, None), (None, "abc", "de", None, None)]))
    assert blank.predict("some text")[0] == "und"


def test_foreign_and_gibberish_are_rejected_short_and_long(spark, model):
    rnd = random.Random(8)
    clean = [t for i, t, *_ in made(600) if i >= 240]
    assert sum(model.predict(t)[2] for t in clean) <= 2
    for words in (4, 12, 300):
        for letters in ("жщъыэюёик", "ωψξφχθ", "wvyzjpxq"):
            for _ in range(5):
                text = " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(4, 9))) for _ in range(words))
                assert model.predict(text)[2], text[:40]


def test_one_odd_row_does_not_lower_the_limits(spark, model):
    odd = next(i for i in range(9000, 9100) if langid_fold(i) != 2)
    rows = [*made(), (odd, "жщъ ыэю ёжик " * 100, "xa", None, None)]
    few = langid.fit(cases.documents(spark, rows), sample=30)
    assert few.predict("ωψξ φχθ ωωψ " * 30)[2] and few.predict("wvy zjpx qqw vyz " * 4)[2]


def test_shorter_texts_have_looser_limits(model):
    for limits in model.limits:
        assert 0 < limits[3] < limits[8] < 1


def plain_counts(text):
    """n-gram counts letter by letter, in Python's own numbers."""
    text = text.lower()
    if not any(c.isalpha() for c in text):
        return None
    points = [32]
    for i, c in enumerate(text):
        if c.isalpha():
            points.append(ord(c))
        elif i and text[i - 1].isalpha():
            points.append(32)
    points.append(32)
    counts, low = Counter(), (1 << 32) - 1
    for n in range(3):
        for at in range(len(points) - n):
            x = points[at]
            for p in points[at + 1 : at + n + 1]:
                x = (x * 0x01000193 + p) & low
            counts[((((x * 0x9E3779B1) & low) + n) * 0x85EBCA6B & low) >> 19] += 1
    return counts


def plain_cosines(text, idf, centres):
    counts = plain_counts(text)
    if counts is None:
        return None, 0
    values = {at: (1 + math.log(n)) * idf[at] for at, n in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return [sum(v * c[at] for at, v in values.items()) / length for c in centres], sum(counts.values())


def test_against_a_plain_model(spark, model):
    rows = made()
    train = [(t, lang) for i, t, lang, *_ in rows if langid_fold(i) != 2]
    holding = Counter(at for t, _ in train for at in plain_counts(t))
    idf = [math.log((1 + len(train)) / (1 + holding[at])) + 1 for at in range(langid.DIMENSIONS)]
    assert max(abs(a - b) for a, b in zip(idf, model.idf, strict=True)) < 1e-9
    # Every centroid is a unit vector: a scaled sum of its members' vectors.
    assert all(abs(sum(x * x for x in c) - 1) < 1e-4 for c in model.centres)

    # The limits: of all training rows and their pieces, the value that all but one in a thousand and one more reach.
    reached = {}
    for text, lang in train:
        own = [c for c, name in zip(model.centres, model.languages, strict=True) if name == lang]
        for piece in langid.pieces(text):
            cosines, n = plain_cosines(piece, idf, own)
            if cosines:
                reached.setdefault((lang, n.bit_length() - 1), []).append(min(langid.CELLS - 1, max(0, int(langid.CELLS * max(cosines)))))
    def low(cells):
        return 0.8 * sorted(cells)[min(len(cells), 2 + int(0.001 * len(cells))) - 1] / langid.CELLS

    for lang in SYLLABLES:
        last = low([c for cells in reached.values() for c in cells])
        for k in range(langid.LENGTHS):
            own = reached.get((lang, k), [])
            cells = own if len(own) >= 100 else [c for name in SYLLABLES for c in reached.get((name, k), [])]
            last = low(cells) if len(cells) >= 100 else last
            found = {model.limits[i, k] for i, name in enumerate(model.languages) if name == lang}
            assert len(found) == 1 and abs(found.pop() - last) < 0.8 * 1.5 / langid.CELLS
    assert any(len(cells) >= 100 for cells in ([c for name in SYLLABLES for c in reached.get((name, k), [])] for k in range(langid.LENGTHS)))

    texts = [t for _, t, *_ in rows] + ["que", "жщъ ыэю", "a ba ko", "Schl, eng. ORF"]
    for r in langid.predict(cases.documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), model).collect():
        cosines, n = plain_cosines(r["text"], idf, model.centres)
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        assert r["lang_pred"] == model.languages[best] and abs(r["score"] - min(1, max(0, cosines[best]))) < 1e-6
        gap = cosines[best] - model.limits[best, n.bit_length() - 1]
        assert abs(gap) < 1e-9 or r["rejected"] == (gap < 0)


def test_a_row_that_repeats_fills_no_sample(spark):
    rows = made()
    often = next(i for i, _, lang, *_ in rows if lang == "xa" and langid_fold(i) != 2)
    many = rows + [r for r in rows if r[0] == often] * 500
    few = langid.fit(cases.documents(spark, many), sample=30)
    assert few.languages == langid.fit(cases.documents(spark, rows), sample=30).languages
