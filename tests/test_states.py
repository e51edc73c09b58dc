"""Mergeable profiles, sketches, quarantined cells, sparse features and fitted state."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditmart.operators import encoding, modelset, profile, schema, states
from creditmart.plans import fitted, silver
from creditmart.sources.datamart import Datamart

MONTHS = [date(2024, m, 1) for m in (1, 2, 3)]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    rows = [(rng.choice(MONTHS), rng.gauss(50, 9), rng.choice([None, float("nan"), 1.0, 2.0]), 7, None) for _ in range(900)]
    return spark.createDataFrame(rows, "snapshot_date date, a double, b double, same int, none double").cache()


def test_merged_states_are_those_of_all_rows(data):
    names = ["a", "b", "same", "none"]
    whole = {r["column"]: r.asDict() for r in states.profile_of(states.merged(states.moments(data, names))).collect()}
    known = data.withColumn("b", F.nanvl("b", F.lit(None).cast("double")))
    want = {r["column"]: r.asDict() for r in profile.numeric_profile(known, names).collect()}
    for c in names:
        for part in ("count", "null_count", "mean", "stddev", "min", "max"):
            assert whole[c][part] == (None if want[c][part] is None else pytest.approx(want[c][part], abs=1e-9)), (c, part)
        for part in ("skewness", "kurtosis"):
            if c in ("a", "b"):
                assert whole[c][part] == pytest.approx(want[c][part])
            else:
                assert whole[c][part] is None
    once = states.merged(states.moments(data, ["a"]), ["snapshot_date"])
    assert {tuple(r) for r in states.profile_of(once, ["snapshot_date"]).select("snapshot_date", "count").collect()} == {
        tuple(r) for r in data.groupBy("snapshot_date").count().collect()
    }
    assert states.merged(states.moments(data.limit(0), names)).count() == 0


def test_sketches_of_months_merge(data):
    kept = states.sketches(data, ["a", "none"])
    assert kept.count() == 3
    row = states.quantiles_of(states.merged_sketches(kept), {"p50": 0.5, "least": 0.0}).first()
    values = np.sort([r.a for r in data.select("a").collect()])
    assert row.n == 900 and values[430] <= row.p50 <= values[470] and row.least == values[0]


def test_rejected_cells(spark):
    df = spark.createDataFrame([(1, "5", "x", "2024-01-01"), (2, "", "1.5", "soon"), (3, None, None, None), (4, "7.9", "2", "2024-02-30")], "id int, n string, v string, d string")
    typed = schema.enforce_with_rejects(df, {"n": "int", "v": "double", "d": "date"})
    assert [tuple(r)[:4] for r in typed.orderBy("id").collect()] == [
        (1, 5, None, date(2024, 1, 1)), (2, None, 1.5, None), (3, None, None, None), (4, 7, 2.0, None),
    ]
    cells = {tuple(r) for r in schema.quarantine(typed, ["id"]).collect()}
    assert cells == {(1, "v", "x", "double"), (2, "n", "", "int"), (2, "d", "soon", "date"), (4, "d", "2024-02-30", "date")}
    assert schema.quarantine(schema.enforce_with_rejects(df, {"id": "bigint"}), ["id"]).count() == 0


def test_sparse_features(spark):
    rows = [(1, "x", ["p", "q", "p"]), (2, "y", []), (3, None, None), (4, "new", ["q"])]
    df = spark.createDataFrame(rows, "id int, c string, l array<string>")
    vocab = encoding.vocabulary_table(df.where("id < 4"), ["c", "l"])
    place = {(r["column"], r["value"]): r["place"] for r in vocab.collect()}
    assert sorted(place.values()) == [0, 1, 2, 3] and {k: r for k, r in place.items()}.keys() == {("c", "x"), ("c", "y"), ("l", "p"), ("l", "q")}
    got = {r["id"]: (r["size"], r["indices"], r["values"]) for r in encoding.sparse_features(df, "id", ["c", "l"], vocab).collect()}
    p = lambda *names: sorted(place[n] for n in names)
    assert got[1] == (4, p(("c", "x"), ("l", "p"), ("l", "q")), [1.0] * 3)
    assert got[2] == (4, p(("c", "y")), [1.0]) and got[3] == (4, [], []) and got[4] == (4, p(("l", "q")), [1.0])
    many = spark.range(3000).selectExpr("cast(id as string) AS c")
    places = sorted(r["place"] for r in encoding.vocabulary_table(many, ["c"]).collect())
    assert places == list(range(3000))


def test_fitted_state_is_kept_by_version(spark, tmp_path):
    mart = Datamart(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no fitted state"):
        fitted.load(mart)
    first = silver.Fitted(1.5, {"n": (1 << 60) + 1, "r": 2.25, "none": None}, 33, silver.Vocabularies(["a, b", "c"], [], None, ["Doctor"]))
    fitted.save(mart, first, "2024-01-01")
    fitted.save(mart, silver.Fitted(None, {}, None, silver.Vocabularies()), date(2024, 2, 1))
    assert fitted.versions(mart) == ["2024-01-01", "2024-02-01"]
    assert fitted.load(mart, "2024-01-01") == first
    assert fitted.load(mart) == silver.Fitted(None, {}, None, silver.Vocabularies())
    fitted.save(mart, silver.Fitted(9.0, {"r": 1.0}, 1, silver.Vocabularies()), "2024-01-01")
    assert fitted.load(mart, "2024-01-01").balance_cut == 9.0


def test_equal_values_do_not_vary(spark):
    """Merged buffers round the mean of equal values; that is no variation."""
    names = ["seven", "tenth", "third"]
    df = spark.range(0, 100_003, 1, 13).selectExpr("date'2024-01-01' + int(id % 11) AS snapshot_date", "7 AS seven", "0.1D AS tenth", "1D / 3 AS third")
    df = df.where("hash(snapshot_date) % 3 <> 0 OR spark_partition_id() % 3 = 0")
    kept = states.moments(df, names)
    frames = [states.profile_of(kept, ["snapshot_date"]), states.profile_of(states.merged(kept)), profile.numeric_profile(df, names)]
    for r in [r for f in frames for r in f.collect()]:
        value = {"seven": 7.0, "tenth": 0.1, "third": 1 / 3}[r["column"]]
        assert (r["mean"], r["stddev"], r["skewness"], r["kurtosis"]) == (value, 0.0, None, None)
    assert modelset.fit_scaler(df, names) == {c: (pytest.approx(v), 1.0) for c, v in zip(names, (7.0, 0.1, 1 / 3))}
    assert {r["r"] for r in profile.correlations(df, names).where("i <> j").collect()} == {None}
