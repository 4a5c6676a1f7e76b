"""Ways to write a telephone number."""

import pytest

from quirework.llm import surrogates


@pytest.mark.parametrize("text,canonical", [
    ("+14155552671", "1:4155552671"), ("+4915112345678", "49:15112345678"), ("415.555.2671", "1:4155552671"), ("415 555 2671", "1:4155552671"), ("020 7946 0958", ":02079460958"), ("(020) 7946 0958", ":02079460958"),
    ("01 42 68 53 00", ":0142685300"), ("+49 15112345678", "49:15112345678"), ("+49 151 12345678", "49:15112345678"), ("+1 (743) 555-3824", "1:7435553824"), ("(743) 555-3824", "1:7435553824"), ("+35312345678", "353:12345678")])
def test_found_and_replaced(text, canonical):
    whole = f"call {text}, please"
    assert surrogates.find_entities(whole) == [(5, 5 + len(text), "phone", canonical)]
    new = surrogates.written("phone", surrogates.surrogate(b"key", "phone", canonical), text)
    assert new != text and [c.isdigit() for c in new] == [c.isdigit() for c in text]


@pytest.mark.parametrize("text", ["on 01.02.2024 at", "+1234567", "+1234567890123456", "115 555 2671", "415 155 2671", "sizes 100 200 3000", "1 415 555 2671 8", "010.100.100.1000.1", "no 00 12"])
def test_other_numbers_stay(text):
    assert not [e for e in surrogates.find_entities(text) if e[2] == "phone"]
