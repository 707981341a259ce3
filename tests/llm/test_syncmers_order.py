"""Anchors of a text are sorted once, and looked at as far as needed."""

import random

from pyspark.sql import functions as F

from tests.llm.helpers import documents
from tests.llm.test_syncmers import plain_rows
from tillroll.llm import syncmers


def test_repeats_among_the_first_anchors(spark):
    """Repeated passages fill what is looked at first, so that all anchors are needed."""
    rng = random.Random(4)
    some = "".join(rng.choice("abcdefghij klm") for _ in range(400))
    docs = [(1, some[:40] * 50 + some), (2, some * 9), (3, "ab" * 900 + some), (4, some)]
    got = sorted(tuple(r) for r in syncmers.edited_fingerprints(documents(spark, docs)).collect())
    assert got == plain_rows(docs)


def test_the_anchors_of_a_text_are_sorted_once(spark, monkeypatch):
    sorts, sort = [], F.sort_array
    monkeypatch.setattr(F, "sort_array", lambda *a: sorts.append(a) or sort(*a))
    syncmers.edited_fingerprints(documents(spark, [(1, "abcdefghijkl"), (2, "xyz")]))
    # Whole texts, edited texts, and the shifts of both likenesses.
    assert len(sorts) == 4
