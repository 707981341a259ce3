"""Spelling variants against comparing all pairs, in the index and through the query."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import clashing, documents
from tillroll.llm.queries import op12_spelling
from tillroll.llm.spelling import Index, spelling_variants, vocabulary


def plain_vocabulary(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def all_near(words):
    """Near words of each word; those that share no deletion are not compared."""
    met = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            met.setdefault(key, []).append(w)
    found = {w: set() for w in words}
    for group in met.values():
        for a in group:
            found[a].update(b for b in group if near(a, b))
    return found


def plain_variants(counts):
    found, forms, rows = all_near(counts), {}, []
    for w, n in counts.items():
        best = min(found[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 5 * n else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(found[w]), counts[forms[w]] if forms[w] else None))
    return rows


def by_word(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghijklmnopqrstuvwxyzéßÿ"])
def test_index_against_all_pairs(letters):
    rng = random.Random(letters)
    for size in (1, 2, 50, 300):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 6, 7, 9, 40]))) for _ in range(size)})
        index, lengths = Index(words), np.array([len(w) for w in words])
        half, pairs = lengths // 2, set()
        for rightwards in (True, False):
            query, word = index.near(words, half if rightwards else lengths - half, rightwards)
            both = list(zip(query.tolist(), word.tolist(), strict=True))
            assert len(set(both)) == len(both)
            pairs.update(both)
        assert pairs == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)}


def test_index_of_other_words():
    index = Index(["abcdef", "abcxef", "zzz"])
    query, word = index.near(["abcdeé", "qqqqqq", "abcef"], np.array([3, 3, 2]), True)
    assert list(zip(query.tolist(), word.tolist(), strict=True)) == [(0, 0), (2, 0), (2, 1)]


@pytest.mark.parametrize("group_rows", [40_000, 7])
def test_variants_against_all_pairs(spark, group_rows):
    rng = random.Random(9)
    bases = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    counts = {}
    for base in bases:
        for _ in range(12):
            i = rng.randrange(len(base))
            word = base[:i] + rng.choice(["", base[i], rng.choice("aeé"), base[i] * 2]) + base[i + 1 :]
            counts[word] = rng.choice([5, 7, 30, 200, 1500, 9000])
    counts |= {"hothot" + "".join(rng.choice("ab") for _ in range(6)): 5 + k for k in range(60)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert by_word(spelling_variants(df, group_rows=group_rows).collect()) == by_word(plain_variants(counts))


def test_long_chains_lead_to_the_root(spark):
    counts = {"abcdefghij"[: 10 - k] + "z" * k: 5 * 6**k for k in range(9)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling_variants(df).collect()
    assert by_word(rows) == by_word(plain_variants(counts))
    assert {r["root"] for r in rows} == {"ab" + "z" * 8}


def test_vocabulary_by_the_letter(spark):
    texts = ["Çà et là LÀ-bas Ünïversal ÷×÷×÷×÷ naïveté_x99abcdefg ", "ABCDEF abcdef Abcdef", None, "", "éa" * 4 + "\U0001f600" + "İstanbul"]
    rows = [(i, (t or "") * 3 if t else t) for i, t in enumerate(texts)] + [(None, "nullid words " * 5), (3, "long" * 30_000)]
    rows += [(1000 + i, "planting variants everywhere ") for i in range(400)]
    got = {r["word"]: r["n"] for r in vocabulary(clashing(documents(spark, rows))).collect()}
    assert got == plain_vocabulary(rows) and len(got) >= 5


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert by_word(op12_spelling(spark, folder).collect()) == by_word(plain_variants(plain_vocabulary(rows)))


def test_odd_rows(spark):
    kind = "word string, n long, side int, half string, part int, best string"
    rows = [("abcdef", 5, 0, "", 0, ""), ("abcdef", 5, 0, "", 0, ""), (None, 5, 0, "", 0, ""), ("abcdeg", None, 0, "", 0, ""), ("abcdex", 50, 0, "", 0, ""), ("", 9, 0, "", 0, ""), ("x", 9, 0, "", 0, "")]
    got = by_word(spelling_variants(spark.createDataFrame(rows, kind)).collect())
    assert got == [("", None, "", 9, 1, None), ("abcdef", "abcdex", "abcdex", 10, 1, 50), ("abcdex", None, "abcdex", 50, 1, None), ("x", None, "x", 9, 1, None)]
    assert spelling_variants(spark.createDataFrame([], kind)).count() == 0
    assert vocabulary(documents(spark, [])).count() == 0
