from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldmill.llm.words import ALPHANUMERIC, LOWER, UNSPACED, find_words, text_slices
from tests.llm.helpers import AWKWARD, letter_words, spaced_words


def all_words(texts, members, fold=None, target=1 << 20):
    out = []
    for low, high, data, offsets in text_slices(pa.array(texts, pa.string()), target):
        words = find_words(data, offsets, members, fold)
        assert words.rows == high - low
        for row in range(words.rows):
            out.append([words.word(i).decode() for i in range(words.first[row], words.first[row + 1])])
    return out


@pytest.mark.parametrize("target", [1, 16, 1 << 20])
def test_words_of_awkward_texts(target):
    assert all_words(AWKWARD, ALPHANUMERIC, LOWER, target) == [letter_words(t) for t in AWKWARD]
    assert all_words(AWKWARD, UNSPACED, None, target) == [spaced_words(t) for t in AWKWARD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=8))
def test_words_of_any_texts(texts):
    assert all_words(texts, ALPHANUMERIC, LOWER, 8) == [letter_words(t) for t in texts]
    assert all_words(texts, UNSPACED, None, 8) == [spaced_words(t) for t in texts]


def test_equal_windows_have_equal_hashes_wherever_they_lie():
    texts = ["a b c d e", "x a b c", "", "a b", "q a b c d"]
    (_, _, data, offsets), = text_slices(pa.array(texts))
    words = find_words(data, offsets, UNSPACED)
    at, hashes = words.windows(3)
    seen: dict[int, set[bytes]] = {}
    for i, h in zip(at.tolist(), hashes.tolist()):
        seen.setdefault(h, set()).add(words.joined(i, i + 3))
    assert all(len(x) == 1 for x in seen.values())
    assert len(at) == 3 + 2 + 3 and len(seen) == 5  # abc and bcd repeat


def test_a_slice_of_a_column_is_read_from_its_own_offset():
    column = pa.array(["no", "yes yes", None, "end"]).slice(1, 2)
    (low, high, data, offsets), = text_slices(column)
    assert (low, high, offsets.tolist(), data.tobytes()) == (0, 2, [0, 7, 7], b"yes yes")
