"""The pipeline against a plain one, stage by stage, and its decisions on planted cases."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from corpus_pipeline import STAGES, drop_contaminated, drop_near_duplicates, drop_toxic, mix_sources

from tests.llm.helpers import documents
from tests.llm.test_decontamination import plain_distance
from tests.llm.test_mixing import WORD
from tests.llm.test_simhash import close, plain_components, plain_fingerprint
from tests.llm.test_tokens import plain_rows
from tillroll.llm.decontamination import ERROR_RATE, normal
from tillroll.llm.queries import TOXIC, table, toxicity_lexicon

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after each stage, written and read again in between."""
    root = tmp_path_factory.mktemp("stages")
    docs = table(spark, FOLDER, "documents")
    columns, made = docs.columns, [docs.collect()]
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, FOLDER)
        assert k == len(STAGES) - 1 or out.columns == columns
        out.write.parquet(str(root / str(k)))
        docs = spark.read.parquet(str(root / str(k)))
        made.append(docs.collect())
    return made


def test_stages_are_those_dealt():
    assert [name for name, _ in STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "tokens"]


def test_toxic_documents_go_and_others_stay(spark, stages):
    docs = table(spark, FOLDER, "documents")
    lexicon = toxicity_lexicon(docs, table(spark, FOLDER, "labels"))
    expected = [r for r in stages[0] if lexicon.score(r["text"]) < TOXIC]
    assert Counter(expected) == Counter(stages[1])
    toxic = {r["doc_id"] for r in table(spark, FOLDER, "labels").filter("toxic = 1").collect()}
    clean = {r["doc_id"] for r in table(spark, FOLDER, "labels").filter("toxic = 0").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    assert len(toxic & kept) < 0.35 * len(toxic) and len(clean - kept) < 0.01 * len(clean)


def test_one_of_each_group_stays(stages):
    rows = sorted(stages[1])
    roots = plain_components([plain_fingerprint(r["text"]) for r in rows], close)
    assert Counter(rows[i] for i in set(roots)) == Counter(stages[2])


def test_contaminated_documents_go(spark, stages):
    items = [normal(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    kept = [r for r in stages[2] if not any(i in normal(r["text"]) for i in items)]
    assert Counter(kept) == Counter(stages[3])


def test_the_mix_takes_what_is_due(stages):
    before = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in stages[3]]
    taken = Counter()
    for r in stages[4]:
        taken[r["doc_id"]] += len(WORD.findall(r["text"]))
    sizes = Counter()
    for _, text, _, source in before:
        sizes[source] += len(WORD.findall(text or ""))
    total = sum(sizes.values())
    assert abs(sum(taken.values()) - total) <= len(sizes)
    assert all(taken[d] <= 3 * len(WORD.findall(t or "")) for d, t, _, _ in before)


def test_tokens_of_every_row(stages):
    by_id = {}
    for r in stages[4]:
        by_id.setdefault(r["doc_id"], []).append(r["text"])
    alone = [(d, t[0]) for d, t in sorted(by_id.items()) if len(t) == 1]
    expected = {d: (n, crc) for d, _, n, crc in plain_rows(alone)}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in stages[5] if r["doc_id"] in expected}
    assert got == expected
    ordered = sorted(stages[5], key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted(r["doc_id"] for r in stages[4])
    ends = [r["start"] + r["n_tokens"] for r in ordered]
    assert [r["start"] for r in ordered] == [0, *ends[:-1]]


def test_run_equals_the_stages(spark, stages):
    assert Counter(corpus_pipeline.run(spark, FOLDER).collect()) == Counter(stages[5])


def test_planted_cases(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    text = lambda n: " ".join(word() for _ in range(n))
    long = text(400)
    near = long.replace(long.split()[200], "changed", 1)
    item = table(spark, FOLDER, "benchmark").first()["text"]
    leaked = f"{text(30)} {item.upper()} {text(30)}"
    texts = [long, long, near, leaked, text(50), f"{text(8)} idi0t scum moron {text(5)}", None, ""]
    docs = documents(spark, [(1001 + i, t) for i, t in enumerate(texts)])
    both = docs.unionByName(table(spark, FOLDER, "documents"))
    kept = {r["doc_id"] for r in drop_toxic(spark, both, FOLDER).collect()}
    assert {i for i in range(1001, 1009) if i not in kept} == {1006}
    distance = bin(plain_fingerprint(long) ^ plain_fingerprint(near)).count("1")
    left = {r["doc_id"] for r in drop_near_duplicates(spark, docs, FOLDER).collect()}
    assert left == {1001, 1004, 1005, 1006, 1007} | ({1003} if distance > 3 else set())
    assert plain_distance(normal(item), normal(leaked))[0] <= ERROR_RATE * len(item)
    left = {r["doc_id"] for r in drop_contaminated(spark, docs, FOLDER).collect()}
    assert left == {1001, 1002, 1003, 1005, 1006, 1007, 1008}


def test_odd_rows(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (1, None), (2, ""), (3, "x y z"), (3, "x y z")]
    kept = drop_near_duplicates(spark, documents(spark, rows), FOLDER).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 3]
    for stage in (drop_toxic, drop_near_duplicates, drop_contaminated, mix_sources):
        assert stage(spark, documents(spark, []), FOLDER).count() == 0
    assert mix_sources(spark, documents(spark, rows), FOLDER).filter("text IS NULL").count() == 0
