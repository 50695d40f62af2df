"""Histogram boosting and tree contributions against plain numpy."""

import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from refiscope.operators import boosting, explain, metrics, treeshap
from refiscope.plans import classifier
from refiscope.session import scratch_path

from conftest import SF

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.standard_normal((900, 3)), 2)
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + 0.6 * rng.standard_normal(900) > 0).astype(int)
    split = np.where(np.arange(900) < 600, "train", np.where(np.arange(900) < 850, "valid", "test"))
    data = [(f"L{i}", str(split[i]), int(y[i]), 1.0 if i % 7 else None, *map(float, x[i])) for i in range(900)]
    data.append(("null", "train", None, 1.0, 0.0, None, 0.0))
    return spark.createDataFrame(data, "loan_id string, split string, y int, weight double, a double, b double, c double").cache()


PARAMS = [boosting.Params(max_depth=3, learning_rate=0.3, n_trees=12, min_child_weight=2.0, subsample=1.0, feature_share=1.0),
          boosting.Params(max_depth=2, learning_rate=0.1, n_trees=7, min_child_weight=5.0, subsample=0.7, feature_share=0.67, reg_alpha=0.5),
          boosting.Params(max_depth=4, learning_rate=0.01, n_trees=300, min_child_weight=5.0)]
STOP = boosting.Stopping(patience=4, rungs=(6,))


@pytest.fixture(scope="module")
def fitted(rows):
    return boosting.fit_trials(rows.repartition(5), NAMES, PARAMS, "y", stopping=STOP)


def test_trees_do_not_depend_on_the_partitions(rows, fitted, monkeypatch):
    monkeypatch.setattr(boosting, "FAN_IN", 2)  # partial sums meet in several rounds
    again, edges = boosting.fit_trials(rows.repartition(11), NAMES, PARAMS, "y", stopping=STOP)
    for t, u in zip(fitted[0], again, strict=True):
        assert t.areas == u.areas and t.why == u.why and len(t.trees) == len(u.trees) > 0
        for x, y in zip(t.trees, u.trees, strict=True):
            assert np.array_equal(x.feature, y.feature) and np.array_equal(x.cut, y.cut) and np.array_equal(x.value, y.value)
    assert all(np.array_equal(e, f) for e, f in zip(fitted[1], edges, strict=True))


def test_trials_stop(fitted):
    trials, _ = fitted
    assert all(not t.active and t.why in ("complete", "median", "patience") for t in trials)
    assert len(trials[2].trees) < 300 and len(trials[1].areas) <= 7
    assert any(len(t.areas) > boosting.TREES_BETWEEN for t in trials)  # margins were written anew in between


def plain_tree(x, y, w, margin, p):
    """Grown row by row: all cuts between the model's bins."""
    prob = 1 / (1 + np.exp(-margin))
    g, h = np.rint(w * (prob - y) * 2**20) / 2**20, np.rint(w * prob * (1 - prob) * 2**20) / 2**20
    soft = lambda v: math.copysign(max(abs(v) - p.reg_alpha, 0), v)
    worth = lambda rows: soft(g[rows].sum()) ** 2 / (h[rows].sum() + p.reg_lambda)
    nodes, out = [np.arange(len(x))], np.zeros(len(x))
    for _ in range(p.max_depth):
        nodes_next = []
        for rows in nodes:
            best = (1e-9, None)
            for f in range(x.shape[1]):
                for c in np.unique(x[rows, f])[:-1] if len(rows) else ():
                    left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                    if min(h[left].sum(), h[right].sum()) >= p.min_child_weight:
                        gain = worth(left) + worth(right) - worth(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, (left, right))
            nodes_next += list(best[1]) if best[1] else [rows]
        nodes = nodes_next
    for rows in nodes:
        if len(rows):
            out[rows] = -soft(g[rows].sum()) / (h[rows].sum() + p.reg_lambda) * p.learning_rate
    return out


def test_trees_are_those_of_a_plain_search(rows, fitted):
    trials, edges = fitted
    data = [r for r in rows.where("split = 'train' and y is not null").collect()]
    x = boosting.binned(np.array([[r.a, r.b or 0.0, r.c] for r in data]), edges)
    y, w = np.array([r.y for r in data], float), np.array([r.weight or 1.0 for r in data])
    margin = np.zeros(len(data))
    for tree in trials[0].trees[:4]:  # all rows and features are drawn
        step = plain_tree(x.astype(int), y, w, margin, PARAMS[0])
        assert tree.margin(x) == pytest.approx(step, abs=1e-6)
        margin += step


def test_areas_are_those_of_the_scores(rows, fitted):
    trials, edges = fitted
    for t in trials:
        model = boosting.model_of(t, NAMES, edges)
        scored = rows.where("split = 'valid'").withColumn("p", boosting.probability(model))
        exact = metrics.rank_metrics(scored, "p", "y").first().auc_roc
        assert model.valid_auc == pytest.approx(exact, abs=0.01) and exact > 0.7
        back = boosting.BoostedModel.from_json(model.to_json())
        x = np.random.default_rng(1).standard_normal((50, 3))
        assert np.array_equal(model.margins(x), back.margins(x)) and back.params == model.params
        assert sum(model.importances()) == pytest.approx(1.0)


def test_edges_of_odd_tables(spark, rows):
    stop = boosting.Stopping(patience=2)
    trials, edges = boosting.fit_trials(rows.where("split = 'test'"), NAMES, PARAMS[:1], "y", stopping=stop)  # nothing to learn from
    assert [len(e) for e in edges] == [0, 0, 0] and all((t.feature < 0).all() and not t.value.any() for t in trials[0].trees)
    trials, _ = boosting.fit_trials(rows.where("split = 'train'"), NAMES, [PARAMS[1]], "y", stopping=stop)  # no validation rows
    assert trials[0].areas == [] and len(trials[0].trees) >= 7 and trials[0].why == "complete"
    model = boosting.model_of(trials[0], NAMES, boosting.bin_edges(rows, NAMES))
    assert math.isnan(model.valid_auc) and rows.limit(0).withColumn("p", boosting.probability(model)).count() == 0


def plain_shapley(model, x):
    """Over all orders' subsets, with missing features weighted by cover."""
    def value(tree, known, node=0):
        if node >= len(tree.feature):
            return tree.value[node - len(tree.feature)]
        f = tree.feature[node]
        if f < 0:
            return value(tree, known, 2 * node + 1)
        if f in known:
            return value(tree, known, 2 * node + 1 + (x[f] > model.edges[f][tree.cut[node]]))
        return sum(tree.cover[c] / tree.cover[node] * value(tree, known, c) for c in (2 * node + 1, 2 * node + 2))

    d = len(model.features)
    out = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(d):
            for s in itertools.combinations(others, k):
                weight = math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d)
                out[i] += weight * sum(value(t, {*s, i}) - value(t, set(s)) for t in model.trees)
    return out, sum(value(t, set()) for t in model.trees)


def test_contributions_are_shapley_values(spark, rows, fitted):
    trials, edges = fitted
    model = boosting.model_of(trials[0], NAMES, edges)
    expected, leaves = treeshap.boosted_leaves(model)
    got = rows.where("split = 'test'").select(*NAMES, treeshap.contributions(NAMES, leaves).alias("s")).limit(15).collect()
    for r in got:
        plain, base = plain_shapley(model, [r.a, r.b, r.c])
        assert list(r.s) == pytest.approx(plain.tolist(), abs=1e-9) and expected == pytest.approx(base)


def test_contributions_of_a_large_ensemble_add_up():
    rng = np.random.default_rng(9)
    d, depth = 12, 6
    edges = [np.sort(rng.standard_normal(40)) for _ in range(d)]
    trees = []
    for _ in range(500):
        inner = (1 << depth) - 1
        cover = np.zeros(2 * inner + 1)
        cover[0] = 1.0
        for i in range(inner):
            cover[2 * i + 1] = cover[i] * (s := rng.uniform(0.1, 0.9))
            cover[2 * i + 2] = cover[i] * (1 - s)
        trees.append(boosting.Tree(rng.integers(0, d, inner), rng.integers(0, 40, inner), rng.standard_normal(1 << depth), cover, np.ones(inner)))
    model = boosting.BoostedModel([f"f{i}" for i in range(d)], edges, trees, boosting.Params())
    expected, leaves = treeshap.boosted_leaves(model)
    x = rng.standard_normal((200, d))
    tables = treeshap.leaf_tables(leaves, d)
    assert np.abs(treeshap.batch_contributions(x, tables).sum(1) + expected - model.margins(x)).max() < 1e-6


def test_search_of_a_frame(spark, rows):
    from refiscope.plans.frame import TrainingFrame

    tf = TrainingFrame(rows.withColumn(classifier.C.LABEL, F.col("y")).drop("weight"), NAMES, None, None)
    drawn = classifier.random_params(3, seed=1, max_trees=8)
    found = classifier.search(tf, drawn, stopping=STOP)
    trials = found.trials.collect()
    assert [t.trial for t in trials] == [0, 1, 2] and sum(t.chosen for t in trials) == 1
    assert max(t.valid_auc for t in trials) == next(t.valid_auc for t in trials if t.chosen) == found.model.valid_auc
    folder = scratch_path(spark, "model")
    classifier.save(spark, found.model, folder)
    assert classifier.load(spark, folder).to_json() == found.model.to_json()
    with pytest.raises(ValueError):
        classifier.search(tf, [])


def test_a_pass_is_dealt_over_the_cores(rows, spark, monkeypatch):
    seen = []
    ran = boosting._pass
    monkeypatch.setattr(boosting, "_pass", lambda blocks, *rest: seen.append(blocks.getNumPartitions()) or ran(blocks, *rest))
    many = rows.where("loan_id <> 'null'").crossJoin(spark.range(4)).withColumn("loan_id", F.concat("loan_id", F.lit("-"), "id")).coalesce(1)
    trials, _ = boosting.fit_trials(many, NAMES, PARAMS[:1], "y", stopping=boosting.Stopping(patience=30, rungs=()))
    assert min(seen) >= min(8, spark.sparkContext.defaultParallelism)  # a small staged table is no single task
    assert len(seen) == 12 * 3 + 1  # a tree of three levels takes three passes; one more for the last area
    assert len(trials[0].trees) == 12


def test_a_task_sends_one_record_a_trial(rows, monkeypatch):
    sent, ran = [], boosting._pass

    def counted(blocks, work, column, *rest):
        part = next(blocks.glom().toLocalIterator())
        sent.append((len(work), [key for key, _ in boosting._histograms(work, column, *rest)(iter(part))]))
        return ran(blocks, work, column, *rest)

    monkeypatch.setattr(boosting, "_pass", counted)
    coded = rows.withColumn("code", F.when(F.col("a") > 0, F.col("loan_id").substr(-1, 1).cast("int")))
    boosting.fit_trials(coded, ["a", "b"], PARAMS[:2], "y", stopping=boosting.Stopping(patience=2, rungs=()), codes=["code"])
    assert sent and all(len(keys) == n and {f for _, f, _ in keys} == {boosting._JOINED} for n, keys in sent)


def test_places_by_columns_are_those_by_rows():
    rng = np.random.default_rng(3)
    cells = rng.integers(-1, 6, (400, 5)).astype(np.int32)
    tree = boosting.Tree(rng.integers(-1, 5, 15), rng.integers(0, 5, 15), np.zeros(16), np.zeros(31), np.zeros(15), first_code=3)
    for levels in (0, 2, 4, None):
        assert np.array_equal(tree.leaf_of(cells, levels), tree.leaf_of_columns(np.ascontiguousarray(cells.T), levels))


def test_places_by_columns_of_bytes_and_codes():
    rng = np.random.default_rng(5)
    for depth in (3, 6, 9):  # nine levels are not walked by masks
        inner = (1 << depth) - 1
        tree = boosting.Tree(rng.integers(-1, 3, inner), rng.integers(0, 6, inner), np.zeros(inner + 1), np.zeros(2 * inner + 1), np.zeros(inner), first_code=2)
        columns = [rng.integers(0, 256, 500).astype(np.uint8), rng.integers(0, 6, 500).astype(np.uint8), rng.integers(-1, 6, 500).astype(np.int32)]
        assert np.array_equal(tree.leaf_of(np.stack(columns, axis=1).astype(int)), tree.leaf_of_columns(columns))
    none = boosting.Tree(np.full(3, -1), np.zeros(3, int), np.zeros(4), np.zeros(7), np.zeros(3))
    assert none.leaf_of_columns([], n=7).tolist() == [0] * 7


def test_below_the_root_the_lighter_children_are_counted(rows, monkeypatch):
    last, seen, ran = {}, [], boosting._pass

    def both(blocks, work, column, n_numeric, bins, spans):
        got = ran(blocks, work, column, n_numeric, bins, spans)
        every = ran(blocks, [replace(w, counted=None) for w in work], column, n_numeric, bins, spans)[0]
        for w in work:
            numbers = lambda total, nodes: total[-2 * bins * nodes * len(w.chosen) :].reshape(len(w.chosen), 2, nodes, bins)
            whole = numbers(every[w.number], 1 << w.levels)
            if w.levels:
                assert 0 < w.nodes <= 1 << (w.levels - 1)
                assert np.array_equal(boosting._with_siblings(w, numbers(got[0][w.number], w.nodes), last[w.number]), whole)
                seen.append(w.levels)
            last[w.number] = whole
        return got

    monkeypatch.setattr(boosting, "_pass", both)
    boosting.fit_trials(rows, NAMES, [replace(p, n_trees=2) for p in PARAMS], "y", stopping=STOP)
    assert {1, 2, 3} <= set(seen)


def test_margins_are_alike_in_memory_and_in_files(rows, monkeypatch):
    grown = []
    monkeypatch.setattr(boosting, "TREES_BETWEEN", 2)
    for times in (1, 3):
        monkeypatch.setattr(boosting, "TIMES_BETWEEN_FILES", times)
        trials, _ = boosting.fit_trials(rows, NAMES, PARAMS[:1], "y", stopping=boosting.Stopping(patience=20, rungs=()))
        grown.append([(t.feature.tolist(), t.value.tolist()) for t in trials[0].trees])
    assert grown[0] == grown[1] and len(grown[0]) == 12


def test_neighbouring_leaves_share_a_table(rows, fitted):
    trials, edges = fitted
    for t in trials:
        _, leaves = treeshap.boosted_leaves(boosting.model_of(t, NAMES, edges))
        tables = treeshap.leaf_tables(leaves, len(NAMES))
        looked_up = sum(len(table.features) for table in tables)
        assert looked_up * 2 <= sum(len(path) for _, path in leaves) and max(len(table.tests) for table in tables) <= 8


def test_deep_paths_keep_their_intervals(monkeypatch):
    rng = np.random.default_rng(2)
    leaves = [(float(rng.standard_normal()), [(f, -0.5, 0.5, float(rng.uniform(0.2, 0.8))) for f in range(4)]) for _ in range(3)]
    x = rng.standard_normal((50, 5))
    plain = treeshap.batch_contributions(x, treeshap.leaf_tables(leaves, 5))
    monkeypatch.setattr(treeshap, "_TESTS", 4)  # eight cuts are too many, four intervals are not
    tables = treeshap.leaf_tables(leaves, 5)
    assert all(np.isfinite([lo, hi]).all() for table in tables for _, lo, hi in table.tests)
    assert np.abs(treeshap.batch_contributions(x, tables) - plain).max() < 1e-12


def test_named_drivers_are_averaged_without_a_row_each(rows, fitted):
    trials, edges = fitted
    model = boosting.model_of(trials[0], NAMES, edges)
    told = treeshap.with_drivers(classifier.score(model, rows), NAMES, treeshap.boosted_leaves(model)[1], columns=model.columns())
    plain = [(r.feature, pytest.approx(r.mean_abs_contribution, abs=1e-12)) for r in explain.global_importance(told, "drivers").collect()]
    assert [tuple(r) for r in explain.global_importance(told, "drivers", features=NAMES).collect()] == plain and len(plain) == 3
    assert explain.global_importance(told.limit(0), "drivers", features=NAMES).count() == 0
    means = explain.global_importance(told, "drivers", features=NAMES)
    assert means._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1  # of the means alone


def test_drivers_rank_by_size_then_name(spark):
    held = spark.createDataFrame([(0.2, -0.7, 0.2, None, 0.0)], "b double, c double, a double, e double, d double")
    arrays = [explain.driver_array({n: F.lit(1.23456) for n in held.columns}, {n: F.col(n) for n in held.columns}, plain) for plain in (True, False)]
    plan = held.select(explain.top_drivers(arrays[0], 5, keyed=True).alias("t"), explain.top_drivers(arrays[0], 2, keyed=True).alias("two"))
    r = plan.first()
    assert [d.feature for d in r.t] == ["c", "a", "b", "d", "e"] and r.two == r.t[:2]
    assert r.two == held.select(explain.top_drivers(arrays[1], 2).alias("t")).first().t and tuple(r.t[0]) == ("c", 1.2346, -0.7, "decreases_risk")
    assert "lambda" not in plan._jdf.queryExecution().optimizedPlan().toString()  # functions of elements are not compiled


def test_a_stressed_portfolio_is_dealt_over_the_cores(spark):
    from refiscope import catalog

    catalog.load()
    from refiscope.catalog.risk_queries import portfolio

    dealt = portfolio(spark, SF, dealt=True)
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    columns = ["loan_id", "current_ltv", "current_ltv_at_Tobs", "current_dscr_at_Tobs"]
    assert dealt.select(columns).exceptAll(portfolio(spark, SF).select(columns)).count() == 0
