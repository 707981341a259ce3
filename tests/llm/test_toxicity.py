"""Toxicity: folding, matching, exceptions, and accuracy on documents held out."""

import random
import re

import pytest

from tests.llm.helpers import clashing, documents
from tillroll.llm.queries import op1_toxicity
from tillroll.llm.toxicity import Lexicon, fold, learn_lexicon, toxicity, without_toxic

LABELS = "doc_id long, toxic int"
LEXICON = Lexicon({"idiot.": 5.0, "scum": 3.0, "scumb": 4.0, "trash.": 2.0}, (-3.0, 2.0, 1.0))


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        (None, ""),
        ("", ""),
        ("IDIOT 1d10t id1o7 $cum tr@5h", "idiot idiot idiot scum trash"),
        ("іdіоt ｉｄｉｏｔ idi​ot", "idiot idiot idiot"),
        ("the$$$ 555-2186 10.0.0.1 a+b", "the$$$ 555-2186 10.0.0.1 a+b"),
        ("Über façon ñandú", "über façon ñandú"),
    ],
)
def test_fold(text, folded):
    assert fold(text) == folded


def plain_match(lexicon, folded):
    total = 0.0
    spared = [m.span() for p in lexicon.exceptions for m in re.finditer(rf"(?<![^\W\d_]){re.escape(p)}(?![^\W\d_])", folded)]
    for m in re.finditer(r"[^\W\d_]+", folded):
        best = max(
            (w for e, w in lexicon.weights.items() if (e[-1] == "." and m[0] == e[:-1]) or (e[-1] != "." and m[0].startswith(e))),
            default=0.0,
        )
        if not any(a <= m.start() < b for a, b in spared):
            total += best
    return total


def test_matching_against_word_by_word():
    rng = random.Random(1)
    pool = ["idiot", "idiots", "scum", "scumbag", "xscum", "trash", "trash can", "trashy", "a", "9idiot", "can"]
    for _ in range(500):
        text = rng.choice([" ", "", ", "]).join(rng.choice(pool) for _ in range(rng.randrange(6)))
        assert LEXICON.matched(text) == pytest.approx(plain_match(LEXICON, text)), text


def test_score_grows_with_matches_and_falls_with_length():
    one, two = LEXICON.score("an idiot"), LEXICON.score("an idiot and scum")
    diluted = LEXICON.score("an idiot " + "word " * 500)
    assert 0 < LEXICON.score(None) == LEXICON.score("") == LEXICON.score("fine") < diluted < one < two < 1
    assert LEXICON.score("a trash can") == LEXICON.score("fine")
    assert Lexicon({}).score("idiot") < 0.01


def test_learned_entries(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["zlurp", "zlurpish", "zlurping"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    # Copies of one toxic text do not make its words toxic.
    rows += [(1000 + i, "quiet harbour evening zlurp") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)]
    lexicon = learn_lexicon(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert "zlur" in lexicon.weights and not any(e.startswith(("harb", "even")) for e in lexicon.weights)
    assert lexicon.score("a Z1urp-ish zlurpster here") > 0.7 > 0.3 > lexicon.score("quiet harbour evening")


def test_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = op1_toxicity(spark, folder)
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    hits = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert hits / sum(r["predicted"] for r in rows) > 0.95
    assert hits / sum(r["toxic"] for r in rows) > 0.9


def test_odd_rows(spark):
    rows = [(None, "idiot"), (1, None), (1, None), (2, ""), (3, "idiot " * 100_000)]
    df = clashing(documents(spark, rows))
    got = {(r["doc_id"], r["score"] >= 0.7) for r in toxicity(df, LEXICON).collect()}
    assert got == {(None, True), (1, False), (2, False), (3, True)}
    kept = without_toxic(df, LEXICON)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 2]
    assert toxicity(documents(spark, []), LEXICON).count() == 0
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], LABELS)
    assert learn_lexicon(documents(spark, rows), one).weights == {}
    assert learn_lexicon(documents(spark, []), spark.createDataFrame([(1, 1), (2, 0)], LABELS)).weights == {}


def test_capitals_of_compatibility_forms_fold():
    bold = "".join(chr(0x1D400 + ord(c) - 65) for c in "IDIOT")
    assert fold(bold) == fold("ＩＤＩＯＴ") == "idiot" and LEXICON.score(f"you {bold}") >= 0.7
