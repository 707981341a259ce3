"""Neighbours: recall against brute force, exact scores, ties, odd vectors."""

import random

import numpy as np

from tillroll.llm.neighbours import Index, nearest_neighbours
from tillroll.llm.queries import op2_neighbours

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    """{query id: [(distance, id), ...]} over all rows of another id."""
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], np.float64)
    found = {}
    for own, vector in queries:
        apart = np.sqrt(np.square(matrix - np.array(vector, np.float64)).sum(axis=1))
        order = [j for j in np.lexsort((ids, apart)) if ids[j] != own][:k]
        found[own] = [(float(apart[j]), int(ids[j])) for j in order]
    return found


def recall(got, expected):
    by_query = {}
    for r in got:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hits = total = 0
    for query, best in expected.items():
        rows = sorted(by_query.get(query, []))
        assert [r[0] for r in rows] == list(range(1, len(best) + 1))
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)
        hits += len({r[2] for r in rows} & {i for _, i in best})
        total += len(best)
    return hits / total


def test_recall_on_a_whole_table(spark):
    for folder in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        rows = [tuple(r)[:2] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
        expected = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
        got = op2_neighbours(spark, folder).collect()
        assert {r["query_id"] for r in got} == set(expected)
        assert recall(got, expected) >= 0.95
        vectors = {i: np.array(v, np.float64) for i, v in rows}
        for r in got:
            apart = vectors[r["query_id"]] - vectors[r["vec_id"]]
            assert r["score"] == float(np.sqrt(np.square(apart).sum()))


def test_blocks_and_copies(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, VECTORS)
    queries = [r for r in rows if r[0] % 50 == 0]
    asked = spark.createDataFrame(queries, VECTORS)
    expected = brute(rows, queries, 10)
    for size in (1, 100, 8192):
        got = nearest_neighbours(df, asked, 10, block_vectors=size).collect()
        assert recall(got, expected) >= 0.95
        tied = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0)
        assert [i for _, i in tied] == list(range(1000, 1010))


def test_small_batches(spark):
    """Vectors of a block, and its queries, that come in many batches."""
    rng = random.Random(2)
    rows = [(i, [rng.random() for _ in range(2 + i % 2)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    answers = []
    try:
        for batch in (before, "3"):
            spark.conf.set(name, batch)
            answers.append(sorted(map(tuple, nearest_neighbours(df, df, 3, block_vectors=60).collect())))
    finally:
        spark.conf.set(name, before)
    assert answers[0] == answers[1] and len(answers[0]) == 600
    assert all(a[0] % 2 == a[2] % 2 for a in answers[0])


def test_vectors_are_shuffled_once(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], VECTORS)
    plan = nearest_neighbours(df, df, 3, block_vectors=10)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and plan.count("Generate explode") == 1


def test_fewer_rows_than_wanted():
    index = Index(np.array([1, 2, 3]), np.array([[1.0, 0], [0, 1], [5, 5]]))
    ids, distances = index.nearest(1, np.array([1.0, 0]), 10)
    assert ids.tolist() == [2, 3] and distances[0] == 2**0.5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (None, [1.0, 0.5]), (8, [1.0, 2.0, 3.0]), (200, [0.0, 0.0]), (300, None),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS id", "1 AS block", "2 AS score", "3 AS rank")
    got = nearest_neighbours(df, df.filter("vec_id % 100 = 0")).collect()
    assert sorted(map(tuple, got)) == [(100, 1, 1, 0.0), (100, 2, 1, 0.0)]
    assert nearest_neighbours(df.limit(0), df).count() == 0
    assert nearest_neighbours(df, df.limit(0)).count() == 0
