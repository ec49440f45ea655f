import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import pii
from tallyforge.llm.boosting import Boosted

from . import cases


def digits(text):
    return re.sub("[^0-9]", "", text)


def by_hand(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m.group())
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            found.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


@settings(max_examples=1500, deadline=None)
@given(st.text("+0123456789.- ()@ab%_é\n", max_size=50))
def test_rules(text):
    assert pii.base_spans(text) == by_hand(text)


@pytest.mark.parametrize("text", ["4111111111111111 x", "a.b+c@d-e.f.g@h.i", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0255.9", "+1 (555) 010-9999", "+49-30.1234567", "@a.b", "a@b"])
def test_known_texts(text):
    assert pii.base_spans(text) == by_hand(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1 " * 100_000, "1 " * 150_000 + "@" * 100, "(" * 200_000])
def test_long_texts_stay_linear(text):
    pii.base_spans(text)
    pii.candidates(text)


def made(n=600):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        number = "".join(rnd.choice("0123456789") for _ in range(16))
        parts = [cases.prose(rnd, 8), f"see {number} there", f"mail ab{i}@mail{i % 5}.example.com now", f"call +1 ({i % 900:03}) 555-{i:04}", f"{i % 256}.7.8.9", "version 2.0 of 1999"]
        rnd.shuffle(parts)
        rows.append((i, " ".join(parts[: rnd.randint(2, 6)]), "en", None, None))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(cases.documents(spark, made()))


def test_model_adds_numbers_that_look_like_confirmed_ones(spark, model):
    found = pii.find(cases.documents(spark, made()), model).collect()
    sixteen = hits = 0
    for r in found:
        spans = [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        base = [(pii.KINDS[k], a, b) for k, a, b in by_hand(r["text"])]
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == base
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))
        for m in re.finditer(r"\b[0-9]{16}\b", r["text"]):
            sixteen += 1
            hits += any(a <= m.start() and m.end() <= b for _, a, b in spans)
        assert not any(re.search(r"(?<![0-9])(1999|2\.0)(?![0-9])", r["text"][a:b]) for _, a, b in set(spans) - set(base))
    assert sixteen > 200 and hits / sixteen > 0.9


def test_redaction(spark, model):
    docs = cases.documents(spark, [(1, "write to ab3@mail3.example.com or 9.7.8.9!", None, None, None), (2, None, None, None, None)])
    found = {r["doc_id"]: r["text"] for r in pii.redact(pii.find(docs, model)).collect()}
    assert found == {1: "write to [email] or [ip]!", 2: None}


def test_odd_rows(spark, model):
    docs = cases.clashing(cases.documents(spark))
    found = pii.find(docs, model)
    assert set(found.columns) == set(docs.columns) and found.count() == len(cases.rows())
    nothing = pii.fit(cases.documents(spark, []))
    assert nothing.trees is None and pii.find(cases.documents(spark, []), nothing).collect() == []


def test_boosting():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = Boosted().fit(x[:1500], y[:1500])
    assert ((trees.predict(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("card 4111 1111 1111 1111 12/27", "card", "4111 1111 1111 1111"),
        ("card 4111 1111 1111 1111 123", "card", "4111 1111 1111 1111"),
        ("call (415) 555-0132 12 2024", "phone", "(415) 555-0132"),
        ("2024-05-01 415-555-0132", "phone", "415-555-0132"),
        ("rows 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 4111-1111-1111-1111 28", "card", "4111-1111-1111-1111"),
        ("at 12 10.20.30.40 99", "ip", "10.20.30.40"),
        ("+49 30 1234567 2024", "phone", "+49 30 1234567"),
        ("0049 30 1234567", "phone", "0049 30 1234567"),
    ],
)
def test_every_window_of_digit_groups_is_proposed(text, kind, part):
    at = text.index(part)
    assert (pii.KINDS.index(kind), at, at + len(part)) in pii.candidates(text)


def test_windows_against_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choice(["1", "22", "333", "4444", " ", "-", ". ", "x"]) for _ in range(30))
        groups = [m.span() for m in re.finditer("[0-9]+", text)]
        wanted = set()
        for i, (a, _) in enumerate(groups):
            for _, b in groups[i:]:
                n = len(digits(text[a:b]))
                if "x" in text[a:b] or re.search(r"[^0-9]{4}", text[a:b]) or re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text[a:b]):
                    continue
                wanted |= {(k, a, b) for k, low, high in ((2, 12, 19), (3, 9, 15)) if low <= n <= high}
        assert {s for s in pii.candidates(text) if s[0] > 1} == wanted


def test_many_candidates_are_scored_in_parts(model):
    text = "see 4111 1111 1111 1111 there " * 3 + "1 2 " * 30_000
    found = model.more([text, text], [pii.base_spans(text)] * 2)
    assert found[0] == found[1]


def mixed(n=900):
    """Confirmed phones, addresses and cards, with national, written-out and clean forms among them."""
    rnd = random.Random(9)
    rows, planted, clean = [], [], []
    for i in range(n):
        a, b, c = rnd.randint(200, 999), rnd.randint(200, 999), rnd.randint(1000, 9999)
        said = rnd.random() < 0.2
        phone = f"({a}) {b}-{c}" if said else f"+1 ({a}) {b}-{c}"
        mail = f"ab{i} (at) mail{i % 5} (dot) com" if rnd.random() < 0.2 else f"ab{i}@mail{i % 5}.com"
        serial = f"{rnd.randint(10, 99)}/{rnd.randint(10, 99)}/{rnd.randint(10, 99)}/{rnd.randint(1000, 9999)}"
        rows.append((i, f"{cases.prose(rnd, 4)} phone {phone} or mail {mail} for serial {serial} end", "en", None, None))
        planted += [(i, phone)] * said + [(i, mail)] * ("(at)" in mail)
        clean.append((i, serial))
    return rows, planted, clean


def test_national_phones_and_written_out_mail_are_found_and_clean_numbers_not(spark):
    rows, planted, clean = mixed()
    docs = cases.documents(spark, rows)
    found = {r["doc_id"]: {r["text"][s["start"] : s["end"]] for s in r["spans"]} for r in pii.find(docs, pii.fit(docs)).collect()}
    assert len(planted) > 200 and sum(part in found[i] for i, part in planted) / len(planted) > 0.95
    assert sum(any(part in s for s in found[i]) for i, part in clean) / len(clean) < 0.02


def test_features_are_the_same_without_what_the_rule_tests():
    for kind, plain, other in ((3, "+1 (415) 555-0132", "(415) 555-0132"), (0, "ab.c@host.com", "ab.c (at) host (dot) com"), (1, "10.20.30.40", "10.20.30.400"[:-1])):
        texts = [f"say {part} now" for part in (plain, other)]
        assert pii.features(texts[0], (kind, 4, 4 + len(plain))) == pii.features(texts[1], (kind, 4, 4 + len(other)))
    assert pii.features("a 10.20.30.240 b", (1, 2, 14)) == pii.features("a 10.20.30.940 b", (1, 2, 14))


def test_card_is_found_without_its_date(spark):
    rnd = random.Random(4)
    numbers = [" ".join(f"{rnd.randrange(10_000):04}" for _ in range(4)) for _ in range(600)]
    rows = [(i, f"card {n} is {cases.prose(rnd, 3)} 12 of 2024 or so", "en", None, None) for i, n in enumerate(numbers)]
    rows += [(1000, "card 4111 1111 1111 1111 12/27", "en", None, None), (1001, "card 4111 1111 1111 1111 123", "en", None, None)]
    docs = cases.documents(spark, rows)
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs, pii.fit(docs)).where("doc_id >= 1000").collect()}
    assert {(s["kind"], s["start"], s["end"]) for i in found for s in found[i]} == {("card", 5, 24)}


def test_a_kind_rare_in_the_sample_and_a_small_table_add_spans(spark):
    rnd = random.Random(6)

    def number(ok):
        while True:
            n = "".join(rnd.choice("0123456789") for _ in range(16))
            if pii.luhn(n) == ok:
                return n

    rows = [(i, f"{cases.prose(rnd, 6)} mail ab{i}@mail.example.com now", "en", None, None) for i in range(1500)]
    rare = [(i, f"{cases.prose(rnd, 6)} card {number(i % 2 == 0)} now", "en", None, None) for i in range(1500, 1540)]
    for given, sample in ((rows + rare, 200), (rare[:12], 8000)):
        docs = cases.documents(spark, given)
        found = pii.find(docs, pii.fit(docs, sample=sample)).where("doc_id >= 1500 AND doc_id % 2 = 1").collect()
        assert len(found) > 5 and all([s["kind"] for s in r["spans"]] == ["card"] for r in found)


def test_few_confirmed_ones_have_the_pooled_limit():
    seen = np.zeros((4, pii.CELLS), np.int64)
    seen[0, 700], seen[1, 300] = 100, 3
    limits = pii.low_limits(seen, 0.95, 0.5, 10)
    assert all(0 < m < 0.5 for m in limits) and limits[1] == limits[2] == limits[3] != np.inf
