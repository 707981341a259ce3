"""Fingerprints against a plain reading of closed syncmers, and the order of documents."""

import hashlib
import random
import re
import statistics

import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents
from tillroll.llm import syncmers
from tillroll.llm.queries import op11_fingerprints
from tillroll.llm.syncmers import edited_fingerprints, fingerprints, shown, sketch

FOLDER = "/root/testdata/sf0.01"


def signed(n):
    return n - 2**64 if n >= 2**63 else n


def string_hash(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), 42))


def pair_hash(a, b):
    """Numbers are hashed one into the other."""
    seed = xxhash.xxh64_intdigest((a % 2**64).to_bytes(8, "little"), 42)
    return signed(xxhash.xxh64_intdigest((b % 2**64).to_bytes(8, "little"), seed))


def plain_anchors(text):
    """{hash: first place}, of all closed syncmers."""
    inner = [string_hash(text[i : i + 4]) for i in range(len(text) - 3)]
    found = {}
    for i in range(len(text) - 7):
        window = inner[i : i + 5]
        if min(window) in (window[0], window[-1]):
            found.setdefault(pair_hash(inner[i], inner[i + 4]) & (2**31 - 1), i)
    return found or {string_hash(text) & (2**31 - 1): 0}


def plain_fingerprint(text):
    return sorted(plain_anchors(text).items())[:32]


def plain_shown(pairs):
    return ",".join(f"{h:08x}:{p}" for h, p in pairs)


def plain_likeness(a, b):
    least = min(x[-1][0] if len(x) >= 32 else 2**31 - 1 for x in (a, b))
    places = dict(b)
    shifts = sorted(places[h] - p for h, p in a if h in places)
    usual = shifts[len(shifts) // 2] if shifts else 0
    number = sum(abs(s - usual) <= 32 for s in shifts)
    sizes = [sum(h <= least for h, _ in x) for x in (a, b)]
    return sum(number / s if s else 0 for s in sizes) / 2


def plain_rows(docs):
    """Expected rows; ``docs`` in the order of documents."""
    rows = []
    for (doc_id, text), (_, after) in zip(docs, [*docs[1:], *docs[:1]], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, changed = plain_fingerprint(text), plain_fingerprint(edited)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        likeness = plain_likeness(own, changed), plain_likeness(own, plain_fingerprint(after))
        rows.append((doc_id, len(text), digest, plain_shown(own), plain_shown(changed), *likeness))
    return rows


def test_texts_of_all_kinds(spark):
    rng = random.Random(1)
    prose = lambda n: "".join(rng.choice("abcdé ñ日\U0001f600\n") for _ in range(n))
    texts = ["", "a", "abc", "abcd", "abcdefg", "abcdefgh", "a" * 500, "ab" * 300, *map(prose, range(6, 90)), prose(5000)]
    got = {r["doc_id"]: r["s"] for r in fingerprints(documents(spark, list(enumerate(texts)))).select("doc_id", shown(F.col("anchors")).alias("s")).collect()}
    assert got == {i: plain_shown(plain_fingerprint(t)) for i, t in enumerate(texts)}


def test_pieces_of_long_texts_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh é\U0001f600") for _ in range(3000))
    for piece in (1, 7, 8, 100, 2999, 3000):
        monkeypatch.setattr(syncmers, "_PIECE", piece)
        df = documents(spark, [(1, text)])
        [row] = df.select(shown(sketch(F.col("text"), F.char_length("text"))).alias("s")).collect()
        assert row["s"] == plain_shown(plain_fingerprint(text))


def test_query_by_the_rules(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = sorted(tuple(r) for r in op11_fingerprints(spark, FOLDER).collect())
    assert got == plain_rows(docs)
    assert statistics.mean(r[5] for r in got) > 0.7 and statistics.mean(r[6] for r in got) < 0.05


def test_no_python_in_the_plans(spark, monkeypatch):
    plans = []
    kept = syncmers.checkpointed
    monkeypatch.setattr(syncmers, "checkpointed", lambda df: plans.append(df) or kept(df))
    plans.append(op11_fingerprints(spark, "/root/testdata/sf0.001"))
    assert len(plans) == 4
    for plan in plans:
        assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().toString())


def test_copies_and_ties(spark):
    a, b = "the first of all the texts " * 9, "another one, not at all like it " * 7
    rows = [(5, a), (5, a), (5, a), (7, b), (None, a), (9, None), (9, ""), (8, b + a), (9, "x" * 200_000)]
    got = edited_fingerprints(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    # Rows of one id follow each other by the hashes of their texts.
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, string_hash(r[1])))
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    assert sorted((tuple(r) for r in got), key=key) == sorted(plain_rows(ordered), key=key)


def test_few_rows(spark):
    assert edited_fingerprints(documents(spark, [])).count() == 0
    [row] = edited_fingerprints(documents(spark, [(1, "abcdefghijkl")])).collect()
    assert tuple(row) == plain_rows([(1, "abcdefghijkl")])[0]
    [row] = edited_fingerprints(documents(spark, [(1, None)])).collect()
    assert row["near_edited"] == row["near_next"] == 1.0
