"""Work of this round: evenly dealt chunks, subtrees of small nodes, files joined without moving ids."""

import numpy as np
import pytest

from riskframe import session
from riskframe.llm import orcids
from riskframe.operators import boosting, model
from riskframe.plans import training
from tests.test_boosting import FEATURES, PLAIN, SCHEMA, _rows


def _trained(df, params):
    return boosting.train(df, FEATURES, {**PLAIN, "learning_rate": 0.3, "n_estimators": 4, **params}, {"up": 1, "down": -1}, ["code"])


@pytest.mark.parametrize("params", [{"num_leaves": 20}, {"growth": "depth", "max_depth": 5}], ids=["leaf", "depth"])
def test_subtrees_of_small_nodes_equal_scans(spark, monkeypatch, params):
    df = spark.createDataFrame(_rows(1500, 5), SCHEMA).cache()
    whole = _trained(df, params)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 400)
    x = np.array([[r[f] for f in FEATURES] for r in df.collect()], float)
    scans, plain = [], boosting._sum_step
    monkeypatch.setattr(boosting, "_sum_step", lambda *a: scans.append(1) or plain(*a))
    used = []
    for rows in (0, 300, 1 << 16):
        monkeypatch.setattr(boosting, "NODE_ROWS", rows)
        scans.clear()
        got = _trained(df, params)
        used.append(len(scans))
        assert [len(t.feature) for t in got.trees] == [len(t.feature) for t in whole.trees]
        assert got.margin(x) == pytest.approx(whole.margin(x), abs=1e-9)
    # a round ends where nodes are small: at best the root and one scan more
    assert used[0] > used[1] > used[2] == 2 * len(whole.trees)


def test_large_nodes_meet_and_only_their_own_rows_are_summed(monkeypatch):
    node = lambda n: {"sums": np.array([0.0, 0.0, n])}
    assert boosting._small(node(200_000), 1) and not boosting._small(node(200_000), 3) and not boosting._small(node(300_000), 1)
    rng = np.random.default_rng(3)
    bins, g = rng.integers(0, 9, (3, 600)).astype(np.uint8), rng.normal(size=600)
    params = {**boosting.LEAFWISE, "num_leaves": 6, "min_child_samples": 5}
    way, read, plain = boosting.Growing(params, np.arange(3), np.zeros(3), 10), [], boosting._add
    monkeypatch.setattr(boosting, "_add", lambda total, bins, rows, *a: read.append(len(rows)) or plain(total, bins, rows, *a))
    chosen = boosting._grow_all(way, bins, g, np.ones(600), np.zeros(3, bool))
    assert len(chosen) == 5
    assert sorted(read) == sorted(int(n["sums"][2]) for n in way.nodes if n["split"])
    tree = way.tree(chosen)
    sizes = np.bincount(tree.leaf(bins), minlength=len(tree.feature))
    assert sizes[tree.feature < 0].tolist() == tree.cover[tree.feature < 0].tolist()


def test_edges_share_one_column_of_probabilities(spark, monkeypatch):
    seen, plain = [], boosting.F.percentile_approx
    monkeypatch.setattr(boosting.F, "percentile_approx", lambda c, p, n: seen.append(p) or plain(c, p, n))
    df = spark.createDataFrame(_rows(300, 7), SCHEMA)
    assert len(boosting.fit_binning(df, FEATURES, ["code"]).edges) == len(FEATURES)
    assert all(p is seen[0] and isinstance(p, boosting.Column) for p in seen)


def test_chunks_are_dealt_over_the_cores(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 500)
    df = spark.createDataFrame(_rows(2000, 6), SCHEMA).coalesce(1)
    state, whole = boosting.chunks(df, boosting.fit_binning(df, FEATURES, ["code"]), [0.0])
    sizes = [r["n"] for r in state.collect()]
    assert not whole and state.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sum(sizes) == 2000 and max(sizes) <= 500 and min(sizes) > 0


def test_only_reaches_the_named_leaves():
    goes = np.zeros((5, 4), bool)
    goes[0, :2], goes[2, 2] = True, True
    tree = boosting.Tree(np.array([0, -1, 0, -1, -1], np.int16), goes, np.array([1, 0, 3, 0, 0]), np.array([2, 0, 4, 0, 0]),
                         np.array([0, 1.0, 0, 2.0, 3.0]), np.zeros(5), np.zeros(5))
    bins = np.array([[0, 1, 2, 3, 2]], np.uint8)
    assert tree.leaf(bins).tolist() == [1, 1, 3, 4, 3]
    assert [(i, r.tolist()) for i, r in tree.reach(bins, np.arange(5), [4])] == [(4, [3])]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prepare_scans_a_written_frame(spark, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 100)
    rows = [(i, "train" if i % 3 else "test", i % 2, None if i % 7 == 0 else float(i), None if i % 5 == 0 else f"c{i % 4}") for i in range(450)]
    df = spark.createDataFrame(rows, "id bigint, split string, y int, amount double, kind string").coalesce(1)
    got, meta = training.prepare(df, "y")
    # one file would be one task's work in every scan
    assert len(got.inputFiles()) == 5 and all("/written-" in f for f in got.inputFiles())
    amounts = [r[3] for r in rows if r[1] == "train" and r[3] is not None]
    want = {r[0]: (float(np.median(amounts)) if r[3] is None else r[3], 4 if r[4] is None else int(r[4][1])) for r in rows}
    # 'Unknown' sorts before c0 to c3 in binary order
    want = {k: (a, 0 if c == 4 else c + 1) for k, (a, c) in want.items()}
    assert {r["id"]: (r["amount"], r["kind"]) for r in got.collect()} == want
    assert [(r["feature"], r["kind"]) for r in meta.orderBy("position").collect()] == [("amount", "numeric"), ("kind", "categorical")]


def test_folds_are_cut_from_a_written_frame(spark, monkeypatch):
    seen = []

    class Search:
        def __init__(self, **_):
            pass

        def fit(self, frame):
            seen.append(frame)
    monkeypatch.setattr(model, "CrossValidator", Search)
    df = model.stratified_folds(spark.createDataFrame([(i, float(i % 2)) for i in range(50)], "id bigint, label double"), 3)
    from pyspark.ml.classification import LogisticRegression
    model.cross_validate(df, LogisticRegression(), {"regParam": [0.1]})
    assert "Exchange" in _plan(df) and "Exchange" not in _plan(seen[0]) and "Window" not in _plan(seen[0])
    assert sorted(map(tuple, seen[0].collect())) == sorted(map(tuple, df.collect()))


def test_ids_are_not_exchanged_for_their_file(spark):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(40)], "doc_id bigint, text string")
    folder = orcids.write(docs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = orcids.read(spark, folder)
        assert "SortMergeJoin" not in _plan(read) and "BroadcastHashJoin" in _plan(read)
        rows = read.orderBy("doc_id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = 0
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == r["n_tokens"]
        at += r["n_tokens"]
    assert len(rows) == 40
