import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetgauge.llm.fingerprints import edited_text, fingerprint, fingerprint_documents, likeness, places_upto, sketch_of

TEXT = st.text("ab\U0001f600", max_size=90)


@settings(max_examples=150, deadline=None)
@given(TEXT, TEXT, TEXT)
def test_common_starts_equal_a_plain_walk_over_the_places(start, one, two):
    one, two = start + one, start + two
    length = next((at for at, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))  # noqa: B905
    wanted = length if one == two else max([0, *(p for p in places_upto(length).tolist())])
    read = sketch_of(fingerprint(one)[0])
    assert read.common_start(fingerprint(two)[1]) == wanted
    assert length < 32 and wanted == length or 16 * length < 17 * wanted or one == two


def test_places():
    places = places_upto(1 << 20).tolist()
    assert places[:33] == [*range(1, 33), 34] and places[-1] == 1 << 20 and sorted(set(places)) == places
    assert places_upto(0).tolist() == [] and all(places_upto(n).tolist() == [p for p in places if p <= n] for n in range(300))


@pytest.mark.parametrize("length", [4, 5, 8, 23, 24, 30, 40, 100, 255, 256, 400])
def test_an_edited_last_quarter_keeps_the_rest_alike(length):
    random.seed(length)
    text = "".join(random.choices("abcdefghijklmnopqrst", k=length))
    other = "".join(random.choices("ABCDEFGHIJKLMNOPQRST", k=length))
    own, near, far = (fingerprint(t)[1] for t in (text, edited_text(text, other), other))
    kept = length - length // 4
    assert likeness(own, near) >= kept / (2 * length - kept) - 0.05
    assert likeness(own, far) == 0.0


def test_a_short_text_within_another_shares_windows():
    passage = "the very same passage of words"
    assert likeness(fingerprint("x" + passage)[1], fingerprint("some " + passage)[1]) > 0.7
    assert likeness(fingerprint(passage)[1], fingerprint("y" * 40 + passage * 10)[1]) > 0.5


def test_short_documents_are_near_their_edits(spark):
    rows = [(0, "short text one"), (1, "ANOTHER QUITE DIFFERENT ONE"), (2, "0123"), (3, "ßßßßßßßß")]
    found = {r.doc_id: r for r in fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert all(r.near_edited >= 0.55 and r.near_next == 0.0 for r in found.values())


def test_likeness_has_no_step():
    """A text that grows by a character each time, against one with the same middle."""
    random.seed(8)
    letters = "abcdefghijklmnopqrst"
    text, tail = ("".join(random.choices(letters, k=500)) for _ in range(2))
    other = tail[:60] + text[60:]
    found = [likeness(fingerprint(text[:n])[1], fingerprint(other[:n])[1]) for n in range(150, 400)]
    assert max(abs(a - b) for a, b in zip(found, found[1:], strict=False)) < 0.06
