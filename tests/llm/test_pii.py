from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnlens.llm.pii import Permutation, Pseudonyms, luhn_digit, pseudonymised
from tests.llm.frames import awkward, none

KEY = b"a key for tests"


@pytest.mark.parametrize("n", [2, 3, 10, 26, 100, 257, 1000])
def test_permutation_has_no_fixed_point_and_inverts(n):
    p = Permutation(KEY, "t", n)
    image = [p(i) for i in range(n)]
    assert sorted(image) == list(range(n)) and all(i != x for i, x in enumerate(image))
    assert [p(x, back=True) for x in image] == list(range(n))


VALUES = {
    "email": ["ann.lee@mail.example.com", "A-b_9@x.org"],
    "ip": ["10.0.0.1", "192.168.100.7"],
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0055-5555-5559", "378282246310005"],
    "phone": ["+1 (212) 555-0100", "(212) 555-0100", "+44 20 7946 0958", "212-555-0100"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "date": ["2024-02-29", "31.12.1999", "12/31/1999", "03/04/2021"],
}


@pytest.mark.parametrize("kind, value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_format_stays_and_value_moves(kind, value):
    text = f"Before {value}, after {value}."
    new, spans = Pseudonyms(KEY).replace(text)
    assert spans == [(kind, 7, 7 + len(value)), (kind, 15 + len(value), 15 + 2 * len(value))]
    a, b = new[7:7 + len(value)], new[15 + len(value):15 + 2 * len(value)]
    assert a == b != value and re.sub(r"\d", "0", re.sub("[a-zA-Z]", "a", a)) == re.sub(r"\d", "0", re.sub("[a-zA-Z]", "a", value))
    assert Pseudonyms(KEY).replace(f"x {value} y")[0] == f"x {a} y"  # linked in another text
    assert Pseudonyms(b"other").replace(text)[0] != new
    assert Pseudonyms(KEY, back=True).replace(new) == (text, spans)
    if kind == "card":
        digits = re.sub(r"\D", "", a)
        assert luhn_digit(digits[:-1]) == digits[-1]


@pytest.mark.parametrize("text", ["", "4111111111111112", "9111111111111111", "2024-13-01", "999.1.1.1", "1.2.3.4.5", "v1.2.3.4",
                                  "000-12-3456", "666-12-3456", "DE00 3704 0044 0532 0130 00", "a@b", "version 2.0.", "12345",
                                  "a4111111111111111", "1234567890123456"])
def test_what_is_not_valid_stays(text):
    assert Pseudonyms(KEY).replace(text) == (text, [])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([v for vs in VALUES.values() for v in vs] + ["a", ",", " ", "\n", "é", "77", "-", ".", "@", "+"]), max_size=12))
def test_round_trip(parts):
    text = " ".join(parts)
    new, spans = Pseudonyms(KEY).replace(text)
    assert len(new) == len(text) and Pseudonyms(KEY, back=True).replace(new, spans) == (text, spans)
    assert all(new[a:b] != text[a:b] for _, a, b in spans)


NEIGHBOURS = {
    "4111111111111111 12/25": [("card", 0, 16)],
    "4111 1111 1111 1111 123": [("card", 0, 19)],
    "4111-1111-1111-1111-123": [("card", 0, 19)],
    "123 4111 1111 1111 1111 7": [("card", 4, 23)],
    "4223 4111 1111 1111 1111": [("card", 5, 24)],
    "call +44 7911 123456": [("phone", 5, 20)],
    "+49 30 12345678": [("phone", 0, 15)],
    "555 123 4567": [("phone", 0, 12)],
    "1-212-555-0100": [("phone", 0, 14)],
    "+44 7911 123456 4111 1111 1111 1111": [("phone", 0, 15), ("card", 16, 35)],
}


@pytest.mark.parametrize("text", NEIGHBOURS)
def test_values_beside_other_numbers(text):
    new, spans = Pseudonyms(KEY).replace(text)
    assert spans == NEIGHBOURS[text] and all(new[a:b] != text[a:b] for _, a, b in spans)
    assert Pseudonyms(KEY, back=True).replace(new, spans)[0] == text


def test_a_number_after_a_card_does_not_change_its_pseudonym():
    plain = Pseudonyms(KEY).replace("4111 1111 1111 1111")[0]
    for after in (" 123", " 12/25", " 12 25", "-9"):
        assert Pseudonyms(KEY).replace("4111 1111 1111 1111" + after)[0] == plain + after


def test_the_way_back_goes_by_the_spans():
    """Numbers beside others, under many keys: the spans of the way there lead back."""
    texts = ["4223 4111 1111 1111 1111", "4111 1111 1111 1110 007", "4222 2222 2222 2 411", "DE00 4111 1111 1111 1111",
             "555 123 4222 1111 1111 1111"]
    for i in range(300):
        key = b"key %d" % i
        for text in texts:
            new, spans = Pseudonyms(key).replace(text)
            assert Pseudonyms(key, back=True).replace(new, spans) == (text, spans)


def only(text):
    new, spans = Pseudonyms(KEY).replace(text)
    assert len(spans) == 1
    return new[spans[0][1]:spans[0][2]]


def test_equal_dates_are_linked_in_all_ways_of_writing():
    for year, month, day in ((2020, 5, 4), (1999, 12, 31), (2024, 2, 29), (1901, 1, 13)):
        got = set()
        ways = [f"{year}-{month:02}-{day:02}", f"{year}/{month:02}/{day:02}", f"{day:02}.{month:02}.{year}",
                f"{day:02}/{month:02}/{year}"] + [f"{month:02}/{day:02}/{year}"] * (day > 12)
        for way in ways:
            parts = [int(x) for x in re.findall(r"\d+", only(way))]
            if parts[0] > 31:
                got.add(tuple(parts))
            elif way.startswith(f"{month:02}/") and day > 12:
                got.add((parts[2], parts[0], parts[1]))
            else:
                got.add((parts[2], parts[1], parts[0]))
        assert len(got) == 1 and (year, month, day) not in got


def test_equal_numbers_are_linked_in_all_ways_of_writing():
    digits = lambda x: re.sub(r"\D", "", x)
    home = {digits(only(x))[-10:] for x in ("+1 (212) 555-0100", "(212) 555-0100", "212-555-0100", "1-212-555-0100",
                                           "+12125550100", "212 555 0100")}
    assert len(home) == 1 and home != {"2125550100"}
    abroad = {digits(only(x)) for x in ("+44 7911 123456", "+447911123456", "+44 (7911) 123 456")}
    assert len(abroad) == 1 and next(iter(abroad)).startswith("44") and abroad != {"447911123456"}
    assert only("+15551234567").startswith("+1") and only("+420123456789").startswith("+420")


def test_what_is_beside_a_value_does_not_change_its_pseudonym():
    alone = only("555 123 4567")
    for i in range(400):
        beside = f"555 123 4567 {i:04d} 1111 1111 1111"
        new, spans = Pseudonyms(KEY).replace(beside)
        if spans[0] == ("phone", 0, 12):
            assert new[:12] == alone


def plain_find(text):
    """Values by patterns and checks of this test's own; texts in which values stand alone."""
    out = []
    for m in re.finditer(r"[^\s,;]+(?: \d[\d -]*\d)?", text):
        word = m.group()
        if re.fullmatch(r"[\w.+-]+@[\w-]+(\.[\w-]+)*\.[a-zA-Z]{2,}", word):
            out.append(("email", m.start(), m.end()))
        elif re.fullmatch(r"\d+", word) and len(word) == 16 and sum(
                int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(word)) % 10 == 0 and word[0] == "4":
            out.append(("card", m.start(), m.end()))
        elif re.fullmatch(r"(\d+)\.(\d+)\.(\d+)\.(\d+)", word) and all(
                int(x) < 256 and str(int(x)) == x for x in word.split(".")):
            out.append(("ip", m.start(), m.end()))
    return out


def test_finds_what_a_plain_reading_finds():
    import random
    rng = random.Random(4)
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 6)):
            body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
            parts.append(rng.choice([
                f"a{rng.randrange(99)}.b@c{rng.randrange(9)}.org", body + luhn_digit(body), body + "0", "x@y", "word",
                ".".join(str(rng.randrange(300)) for _ in range(4)), "v1.2"]))
        text = ", ".join(parts)
        assert Pseudonyms(KEY).replace(text)[1] == plain_find(text)


def test_key_is_needed():
    with pytest.raises(ValueError):
        Pseudonyms(b"")


def test_awkward_rows(spark):
    docs = awkward(spark, [(None, "call (212) 555-0100", None, None)] * 2)
    got = pseudonymised(docs, KEY)
    assert got.columns == [*docs.columns, "pii"]
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == docs.count()
    assert {(r["doc_id"], r["text"]) for r in rows if not r["pii"]} < before
    changed = [r for r in rows if r["pii"]]
    assert len(changed) == 2 and changed[0]["text"] == changed[1]["text"]
    assert [tuple(x) for x in changed[0]["pii"]] == [("phone", 5, 19)]
    back = pseudonymised(got, KEY, back=True).drop("pii")
    assert back.schema.names == docs.columns
    found_again = pseudonymised(got.drop("pii"), KEY, spans_col=None, back=True)
    assert sorted(map(str, found_again.collect())) == sorted(map(str, back.collect()))
    key = lambda r: str(tuple(r))
    assert sorted(map(key, back.collect())) == sorted(map(key, docs.collect()))
    assert pseudonymised(none(spark), KEY).collect() == []
