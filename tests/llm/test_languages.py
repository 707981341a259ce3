"""Language identification: automata and phrases against plain search, held-out accuracy."""

import random
import re

import pytest

from tests.llm.helpers import clashing, documents
from tillroll.llm.languages import Model, Sample, languages, learn_languages, suffix_automaton
from tillroll.llm.queries import op8_language

SAMPLE = Sample(("aa", "bb"), ("banana bandana ananas", "cocoa coconut cacao"))


def plain_phrases(text, trained):
    """Greedy longest matches, by substring search."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in trained:
            size += 1
        at += size
        count += 1
    return count


def test_automaton_has_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(30):
        text = [rng.randrange(3) for _ in range(25)]
        moves = suffix_automaton(text)
        have = {tuple(text[i:j]) for i in range(26) for j in range(i, 26)}
        for _ in range(200):
            probe = [rng.randrange(3) for _ in range(rng.randrange(7))]
            state = 0
            for code in probe:
                state = moves[state].get(code, -1)
                if state < 0:
                    break
            assert (state >= 0) == (tuple(probe) in have)


@pytest.mark.parametrize("block, full", [(256, 1 << 24), (1, 1 << 24), (3, 0), (10_000, 0)])
def test_phrases_against_search(monkeypatch, block, full):
    monkeypatch.setattr("tillroll.llm.languages._BLOCK", block)
    rng = random.Random(2)
    model = Model(SAMPLE, full)
    trained = [t.lower() + " " for t in SAMPLE.texts]
    texts = ["".join(rng.choice("abncodtu xé") for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    found, sizes = model.phrases(texts)
    for text, counts, size in zip(texts, found.tolist(), sizes.tolist(), strict=True):
        folded = re.sub(" +", " ", f"{text} ").lstrip()
        assert size == len(folded)
        assert counts == [plain_phrases(folded, t) for t in trained]


@pytest.mark.parametrize("full, rounds", [(1 << 24, 12), (0, 12), (1 << 24, 0), (0, 1)])
def test_long_texts_have_the_phrases_of_the_plain_parser(monkeypatch, full, rounds):
    monkeypatch.setattr("tillroll.llm.languages._ROUNDS", rounds)
    rng = random.Random(5)
    long = SAMPLE.texts[0] * 40
    sample = Sample(("aa", "bb", "cc"), (*SAMPLE.texts, long))
    texts = ["".join(rng.choice("abncodtu ") for _ in range(100_000)), "banana bandana " * 7_000, (long + "x") * 100, "b"]
    found, sizes = Model(sample, full).phrases(texts)
    for text, counts, size in zip(texts, found.tolist(), sizes.tolist(), strict=True):
        folded = re.sub(" +", " ", f"{text} ").lstrip()
        assert size == len(folded)
        assert counts == [plain_phrases(folded, t.lower() + " ") for t in sample.texts]


@pytest.mark.parametrize("full", [1 << 24, 0])
def test_scripts_of_many_letters_are_told_apart(full):
    """Two languages of one script of 3,000 letters, whose words differ."""
    rng = random.Random(6)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    words = [["".join(rng.choices(letters, k=3)) for _ in range(400)] for _ in range(2)]
    text = lambda own, n: "".join(rng.choice(own) + rng.choice(["", " "]) for _ in range(n))
    model = Model(Sample(("ja", "zh"), tuple(text(own, 2000) for own in words)), full)
    assert len(model.automata[0].local) > 1500
    made = [(lang, text(own, n)) for n in (5, 50, 3000) for lang, own in zip(("ja", "zh"), words)]
    assert [p[0] for p in model.predict([t for _, t in made])] == [lang for lang, _ in made]


def test_long_texts_are_parsed_whole():
    model = Model(SAMPLE)
    found, sizes = model.phrases(["banana " * 1000 + "cocoa " * 3000])
    assert sizes[0] == 25_000 and found[0, 1] < found[0, 0]
    assert model.predict(["banana " * 100 + "coconut cacao " * 2000])[0][0] == "bb"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op8_language(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(truth)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 2000
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_sample_is_bounded_and_leaves_copies_out(spark):
    rows = [(i, f"text number {'abcdefgh'[i % 8]} of many words", "en", "s") for i in range(80)]
    rows += [(100, "ein text", "de", "s"), (101, None, "de", "s"), (102, "123 456", "de", "s"), (103, "x", None, "s")]
    sample = learn_languages(documents(spark, rows), train_documents=5, train_chars=12)
    assert sample.languages == ("de", "en")
    assert [len(t.split("\n")) for t in sample.texts] == [1, 5]
    assert all(len(part) <= 12 for part in sample.texts[1].split("\n"))


def test_odd_rows(spark):
    rows = [(None, "banana"), (1, None), (1, None), (2, ""), (3, "123 !!"), (4, "日本語"), (5, "cocoa " * 50_000), (6, "İı퟿")]
    got = sorted((r["doc_id"] or 0, r["lang_pred"]) for r in languages(clashing(documents(spark, rows)), SAMPLE).collect())
    assert got == [(0, "aa"), (1, "und"), (1, "und"), (2, "und"), (3, "und"), (4, "aa"), (5, "bb"), (6, "aa")]
    assert languages(documents(spark, []), SAMPLE).count() == 0
    nothing = learn_languages(documents(spark, []))
    assert nothing == Sample((), ())
    assert {r["lang_pred"] for r in languages(documents(spark, rows), nothing).collect()} == {"und"}
