"""Licence recognition against a plain reading of the rules, and its SQL."""

import random
import re

import duckdb
from verification.compare import _cell

from tests.llm.helpers import clashing, documents
from tillroll.llm.licences import HINT, RULES, SENTENCES, licence_scan
from tillroll.llm.oracle import ORACLE
from tillroll.llm.queries import op3_licences


def plain_scan(text):
    """Word by word: the longest known sentence that begins here, or on to the next word."""
    words = []
    for run in re.findall("[a-z0-9.+-]+", (text or "").lower()):
        word = run.replace("licenc", "licens").strip(".+-")
        words += [word] if word else []
    sentences = sorted((tuple(s.split()), i) for s, i in SENTENCES.items())
    sentences.sort(key=lambda pair: -len(pair[0]))
    ids, at = [], 0
    while at < len(words):
        found = next(((s, i) for s, i in sentences if tuple(words[at : at + len(s)]) == s), None)
        ids += [found[1]] if found else []
        at += len(found[0]) if found else 1
    known, names = len(ids), set()
    for name, sequence in RULES:
        at = 0
        while at + len(sequence) <= len(ids):
            if tuple(ids[at : at + len(sequence)]) == sequence:
                names.add(name)
                ids[at : at + len(sequence)] = ["|"]
            at += 1
    return ",".join(sorted(names)), known, sum(i != "|" for i in ids)


def test_sentences_are_normal_and_hinted():
    for sentence in SENTENCES:
        assert re.sub("[^a-z0-9.+-]+", " ", sentence) == sentence and re.search(HINT, sentence)
        assert not any(word.strip(".+-") != word or "licenc" in word for word in sentence.split())
    used = {i for _, sequence in RULES for i in sequence}
    assert used <= set(SENTENCES.values())


def test_against_plain_reading(spark):
    rng = random.Random(1)
    pool = [*SENTENCES, "other words here", "the license of nobody", ""]
    texts = []
    for _ in range(300):
        _, sequence = rng.choice(RULES)
        chosen = [next(s for s, i in SENTENCES.items() if i == name) for name in sequence]
        chosen += [rng.choice(pool) for _ in range(rng.randrange(4))]
        if rng.random() < 0.3:
            rng.shuffle(chosen)
        wrapped = [s.capitalize() if rng.random() < 0.5 else s.upper().replace(" ", "\n", 1) for s in chosen]
        texts.append(rng.choice([". ", ".\n", "\n\n", ".\r\n\r\n"]).join(wrapped) + rng.choice(["", "."]))
    for r in licence_scan(documents(spark, list(enumerate(texts)))).collect():
        assert (r["licences"], r["n_known"], r["n_unmatched"]) == plain_scan(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_specific_rules_use_sentences_up(spark):
    bsd = [s for s, i in SENTENCES.items() if i.startswith("BSD")]
    texts = [". ".join(bsd[:3]), ". ".join(bsd), f"intro\nReleased under the MIT License.\n{bsd[0]}."]
    got = [tuple(r) for r in licence_scan(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()]
    assert got == [(0, "BSD-2-Clause", 3, 0), (1, "BSD-3-Clause", 4, 0), (2, "MIT", 2, 1)]


def test_sql_of_joined_sentences(spark):
    program = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    source = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    texts = [source, source.replace("v. 2", "v.\n2"), f"Copyright 2020 X\n{source}", program, f"{source} {program}", source.replace("2.0", "1.1"), "See v. 2 notes. Licensed under CC BY 4.0.", None, ""]
    got = licence_scan(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r["licences"] for r in got[:5]] == ["MPL-2.0", "MPL-2.0", "MPL-2.0", "GPL-3.0-or-later", "GPL-3.0-or-later,MPL-2.0"]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rows = db.execute(f"SELECT * FROM ({ORACLE['op3_licences']}) ORDER BY doc_id").fetchall()
    assert rows == [tuple(r) for r in got] == [(i, *plain_scan(t)) for i, t in enumerate(texts)]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.1"
    got = op3_licences(spark, folder)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    answer = db.execute(ORACLE["op3_licences"])
    assert got.columns == [c[0] for c in answer.description]
    rows = [tuple(r) for r in got.collect()]
    assert sorted(str([_cell(v) for v in r]) for r in rows) == sorted(str([_cell(v) for v in r]) for r in answer.fetchall())
    lines = ("Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r[0] for r in rows if r[1]} == {d for d, t in texts.items() if any(x in t for x in lines)}


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [(None, line), (1, line), (1, line), (2, None), (3, ""), (4, "word. " * 50_000 + line)]
    got = sorted((r["doc_id"] or 0, r["licences"]) for r in licence_scan(clashing(documents(spark, rows))).collect())
    assert got == [(0, "MIT"), (1, "MIT"), (1, "MIT"), (2, ""), (3, ""), (4, "MIT")]
    assert licence_scan(documents(spark, [])).count() == 0
