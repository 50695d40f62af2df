"""Vocabulary codes, sparse correlations, the gate of the training frame and trees over codes."""

import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from refiscope import config as C
from refiscope.operators import boosting, encode
from refiscope.plans import classifier, frame

COLUMNS = ["kind", "town"]


@pytest.fixture(scope="module")
def rows(spark):
    """Two categorical columns, one with 1,500 values; one town and one kind decide the label."""
    rng = np.random.default_rng(8)
    data = []
    for i in range(4000):
        kind, town, x = "abcd"[rng.integers(4)], f"town {rng.integers(1500) if rng.random() < 0.6 else 7}", float(np.round(rng.standard_normal(), 2))
        p = 0.9 if town == "town 7" else 0.6 if kind == "c" else 0.2
        data.append((f"L{i}", "train" if i % 4 else "valid", int(rng.random() < p), kind if i % 50 else None, town, x))
    return spark.createDataFrame(data, "loan_id string, split string, y int, kind string, town string, x double").cache()


@pytest.fixture(scope="module")
def vocab(rows):
    return encode.vocabulary(rows.repartition(7), COLUMNS)


def test_vocabulary_is_dense_and_ordered(spark, rows, vocab):
    expected = sorted({(c, r[c]) for r in rows.collect() for c in COLUMNS if r[c] is not None})
    assert len(expected) > 1000  # no limit
    assert [(r.column_name, r.category, r.code) for r in vocab.orderBy("code").collect()] == [(*e, i) for i, e in enumerate(expected)]
    assert encode.vocabulary(rows.limit(0), COLUMNS).count() == 0


def test_codes_and_sparse_vectors(spark, rows, vocab):
    code = {(r.column_name, r.category): r.code for r in vocab.collect()}
    extra = spark.createDataFrame([("new", "train", 0, "zz", "nowhere", 0.0)], rows.schema)
    coded = encode.with_codes(rows.unionByName(extra), vocab, COLUMNS)
    got = coded.withColumn("v", encode.sparse_vector(["x"], encode.code_columns(COLUMNS))).collect()
    assert len(got) == 4001
    for r in got:
        places = sorted(([0] if r.x else []) + [1 + code[c, r[c]] for c in COLUMNS if (c, r[c]) in code])
        assert r.v.indices == places and r.v["values"] == [r.x if p == 0 else 1.0 for p in places]
        assert r.kind_code == code.get(("kind", r.kind)) and r.town_code == code.get(("town", r.town))


def test_sparse_correlations_are_those_of_indicator_columns(rows, vocab, monkeypatch):
    monkeypatch.setattr(encode, "_CATEGORIES_AT_ONCE", 100)
    coded = encode.with_codes(rows, vocab, COLUMNS)
    got = {r.feature: r.abs_corr for r in encode.sparse_correlations(coded, ["x"], encode.code_columns(COLUMNS), vocab, "y").collect()}
    train = [r for r in rows.collect() if r.split == "train"]
    y = np.array([r.y for r in train], float)
    for name, x in [("x", [r.x for r in train])] + [(f"kind_{k}", [r.kind == k for r in train]) for k in "abcd"] + [("town_town 7", [r.town == "town 7" for r in train])]:
        assert got[name] == pytest.approx(abs(np.corrcoef(np.array(x, float), y)[0, 1]), abs=1e-9)
    assert max(got, key=got.get) == "town_town 7"


def test_trees_over_codes_are_those_over_indicators(spark, rows):
    few = rows.withColumn("town", F.when(F.col("town").isin("town 7", "town 3"), F.col("town")).otherwise("other"))
    vocab = encode.vocabulary(few, COLUMNS)
    params = [boosting.Params(max_depth=3, learning_rate=0.3, n_trees=8, subsample=0.9, feature_share=1.0)]
    stop = boosting.Stopping(patience=20, rungs=())
    coded = encode.with_codes(few, vocab, COLUMNS)
    trials, edges = boosting.fit_trials(coded, ["x"], params, "y", stopping=stop, codes=encode.code_columns(COLUMNS))
    model = boosting.model_of(trials[0], ["x"], edges, encode.code_columns(COLUMNS), vocab)
    names = [f"{r.column_name}_{r.category}" for r in vocab.orderBy("code").collect()]
    wide = few.select("*", *[F.coalesce((F.col(n.split("_", 1)[0]) == n.split("_", 1)[1]).cast("double"), F.lit(0.0)).alias(n) for n in names])
    dense, dense_edges = boosting.fit_trials(wide, ["x", *names], params, "y", stopping=stop)
    plain = boosting.model_of(dense[0], ["x", *names], dense_edges)
    assert trials[0].areas == pytest.approx(dense[0].areas) and set(model.indicators) <= set(names) and {"town_town 7", "town_other"} & set(model.indicators)
    both = wide.select(boosting.probability(model).alias("p"), boosting.probability(plain).alias("q")).collect()
    assert max(abs(r.p - r.q) for r in both) < 1e-9
    back = boosting.BoostedModel.from_json(model.to_json())
    assert back.indicators == model.indicators
    missing = wide.drop("kind").select("x", "town", boosting.probability(model, ["x", "town"]).alias("p"))
    assert missing.where("p between 0 and 1").count() == few.count()


def test_trees_over_a_large_vocabulary(rows, vocab, monkeypatch):
    monkeypatch.setattr(boosting, "_BLOCK_BITS", 5)  # codes of a column meet in many blocks
    monkeypatch.setattr(boosting, "FAN_IN", 2)
    coded = encode.with_codes(rows, vocab, COLUMNS).repartition(6)
    params = [boosting.Params(max_depth=2, learning_rate=0.5, n_trees=3, subsample=1.0, feature_share=1.0, min_child_weight=2.0), boosting.Params(max_depth=3, n_trees=3, feature_share=0.6)]
    trials, edges = boosting.fit_trials(coded, ["x"], params, "y", stopping=boosting.Stopping(rungs=()), codes=encode.code_columns(COLUMNS))
    model = boosting.model_of(trials[0], ["x"], edges, encode.code_columns(COLUMNS), vocab)
    assert "town_town 7" in model.indicators and len(model.features) <= 1 + 3 * 3
    assert trials[0].areas[-1] > 0.75


def test_codes_add_up_alike_and_passes_read_kept_blocks(rows, vocab, monkeypatch):
    kept, grown = [], []
    ran = boosting._pass
    monkeypatch.setattr(boosting, "_pass", lambda blocks, *rest: kept.append(blocks.is_cached) or ran(blocks, *rest))
    coded = encode.with_codes(rows, vocab, COLUMNS).repartition(3)
    params = [boosting.Params(max_depth=3, learning_rate=0.3, n_trees=2, min_child_weight=2.0, subsample=0.7)]
    for most in (1 << 16, 0):  # all codes of a column, or those that occur
        monkeypatch.setattr(boosting, "_DENSE_CODES", most)
        trials, _ = boosting.fit_trials(coded, ["x"], params, "y", stopping=boosting.Stopping(rungs=()), codes=encode.code_columns(COLUMNS))
        grown.append([[a.tolist() for a in (t.feature, t.cut, t.value, t.cover)] for t in trials[0].trees])
    assert grown[0] == grown[1] and any(f >= 1 for t in grown[0] for f in t[0])
    assert kept and all(kept)


def labelled(spark, leak: str | None = None, one_sided: bool = False):
    rng = np.random.default_rng(3)
    data = []
    for i in range(300):
        y = int(rng.random() < 0.5) if not one_sided or i % 3 != 1 else 1
        numbers = [float(y if c == leak else rng.standard_normal()) for c in C.NUMERIC_FEATURES]
        tier = "late" if leak == "tier" and y else "ABC"[rng.integers(3)]
        data.append((f"L{i}", 2015 + i % 3 * 2, ["train", "valid", "test"][i % 3], y, "M" + str(i % 5), "office", tier, "interest_only", True, *numbers))
    ddl = f"loan_id string, origination_year int, split string, {C.LABEL} int, metro_area string, property_type string, sponsor_credit_tier string, amortization_type string, balloon_flag boolean, "
    return spark.createDataFrame(data, ddl + ", ".join(f"{c} double" for c in C.NUMERIC_FEATURES))


def test_a_planted_leak_stops_the_frame(spark):
    for build in (frame.assemble_frame, frame.assemble_sparse):
        build(labelled(spark))
        for leak in (C.NUMERIC_FEATURES[3], "tier"):
            with pytest.raises(encode.LeakageError, match="correlates"):
                build(labelled(spark, leak))
        build(labelled(spark, "tier"), gate=False)
    named = labelled(spark).withColumn("sponsor_credit_tier", F.lit("dscr_at_maturity"))
    with pytest.raises(encode.LeakageError, match="category names"):
        frame.assemble_sparse(named)


def test_one_sided_and_empty_splits_warn(spark):
    with pytest.warns(encode.DegenerateSplitWarning, match="split valid"):
        frame.assemble_sparse(labelled(spark, one_sided=True))
    with pytest.warns(encode.DegenerateSplitWarning, match="split test: 0 rows"):
        frame.assemble_frame(labelled(spark).where("split <> 'test'"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", encode.DegenerateSplitWarning)
        frame.assemble_sparse(labelled(spark))


def test_search_and_portfolio_scores_of_a_sparse_frame(spark):
    tf = frame.assemble_sparse(labelled(spark))
    found = classifier.search(tf, classifier.random_params(2, seed=1, max_trees=4))
    scored = classifier.score(found.model, tf.rows)
    portfolio = labelled(spark).drop("split", C.LABEL).withColumn("property_type", F.lit("unheard of"))
    stressed = classifier.portfolio_scorer(found.model, tf)(portfolio)
    assert scored.where("pd between 0 and 1").count() == 300 and stressed.columns == [*portfolio.columns, "pd"] and stressed.where("pd between 0 and 1").count() == 300
    assert classifier.importances(found.model).count() <= 20 and classifier.evaluate(found.model, tf).count() == 1
