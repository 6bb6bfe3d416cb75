import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetgauge.llm.fingerprints import (
    PRIME,
    BASES,
    PrefixHash,
    edited_text,
    fingerprint,
    fingerprint_documents,
    likeness,
    sketch_of,
)

TEXT = st.text("ab\U0001f600", max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT, TEXT, st.integers(0, 60), st.integers(0, 60))
def test_common_extensions_equal_a_plain_walk(one, two, at, other_at):
    at, other_at, length = min(at, len(one)), min(other_at, len(two)), 0
    while at + length < len(one) and other_at + length < len(two) and one[at + length] == two[other_at + length]:
        length += 1
    first, second = PrefixHash(one), PrefixHash(two)
    assert first.common_extension(at, second, other_at) == length
    assert first.equal(at, second, other_at, length)
    assert not first.equal(at, second, other_at, length + 1)


def test_prefixes_are_polynomials():
    text = "Some text, é\U0001f600"
    for base, prefix in zip(BASES, PrefixHash(text).prefixes, strict=True):
        value = 0
        for at, char in enumerate(text):
            value = (value + (ord(char) + 1) * pow(base, at, PRIME)) % PRIME
            assert prefix[at + 1] == value


def test_likeness_follows_the_share_of_windows():
    random.seed(3)
    text = "".join(random.choices("abcdefghij ", k=6000))
    other = "".join(random.choices("abcdefghij ", k=6000))
    edited = text[:4500] + other[:1500]
    own, near, far = fingerprint(text), fingerprint(edited), fingerprint(other)
    assert likeness(own[1], own[1]) == 1.0 and likeness(own[1], far[1]) < 0.1
    assert 0.4 < likeness(own[1], near[1]) < 0.8
    assert (sketch_of(own[0]) == own[1]).all() and fingerprint(text)[0] == own[0]
    assert likeness(fingerprint("")[1], fingerprint("")[1]) == 1.0 and likeness(fingerprint("")[1], own[1]) == 0.0


def test_next_documents_across_ranges(spark, odd):
    random.seed(4)
    rows = [(i * 3, "".join(random.choices("ab é", k=random.randint(0, 200)))) for i in range(150)]
    random.shuffle(rows)
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    for table, buckets in ((plain, 7), (odd, 3), (plain.limit(1), 4)):
        order = table.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.asc_nulls_first("text"))
        order = [(r.doc_id, r.text) for r in order.select("doc_id", "text").collect()]
        wanted = []
        for at, (doc, text) in enumerate(order):
            text, following = text or "", order[(at + 1) % len(order)][1] or ""
            edited = edited_text(text, following)
            own, near, far = fingerprint(text), fingerprint(edited), fingerprint(following)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            wanted.append((doc, len(text), digest, own[0], near[0], likeness(own[1], near[1]), likeness(own[1], far[1])))
        found = [tuple(r) for r in fingerprint_documents(table, buckets).collect()]
        assert sorted(found, key=str) == sorted(wanted, key=str)
    assert fingerprint_documents(odd.limit(0)).isEmpty()


def plain_fingerprint(text):
    """A fingerprint by the letter of its definition, in whole numbers."""
    from fleetgauge.llm.fingerprints import FINE_WINDOW, KEPT, WINDOW, places_upto

    mix, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def prefix(base, n):
        return sum((ord(c) + 1) * pow(base, at, PRIME) for at, c in enumerate(text[:n])) % PRIME

    def windows(size):
        found = set()
        size = min(size, len(text))
        for at in range(len(text) - size + 1) if text else ():
            value = sum((ord(c) + 1) * pow(BASES[0], i, PRIME) for i, c in enumerate(text[at : at + size])) % PRIME
            value = (value + size) * mix & mask
            value ^= value >> 29
            found.add((value * mix & mask) >> 32)
        return sorted(found)[:KEPT]

    hashes = [[prefix(BASES[0], n) for n in places_upto(len(text)).tolist()], windows(WINDOW), windows(FINE_WINDOW)]
    whole = "".join(f"{prefix(base, len(text)):08x}" for base in BASES)
    return "-".join((f"{len(text):x}", whole, *("".join(f"{h:08x}" for h in part) for part in hashes)))


@settings(max_examples=60, deadline=None)
@given(st.text("abc \U0001f600", max_size=120))
def test_fingerprints_equal_their_definition(text):
    assert fingerprint(text)[0] == plain_fingerprint(text)
