"""The screen from mergeable summaries against the screen from exact histograms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fipsight.operators import frequent
from fipsight.operators.frequent import chosen_histograms, feature_screen, value_summaries
from fipsight.operators.profile import feature_histogram, frequency_screen, selected_histograms

COLS = ["cat", "cont", "edge", "mixed", "none"]


def table(spark, seed=0, n=3000, parts=6):
    """Categories, a continuous column, values close to the threshold, odd values, a column without values."""
    rng = np.random.default_rng(seed)
    rows = []
    for g, m in ((None, n), ("a", n // 3), ("b", 37), ("c", 1)):
        for i in range(m):
            near = float(i % 10) if rng.random() < 0.97 else float(rng.integers(100, 2000))
            odd = [0.0, -0.0, float("nan"), None, float("inf"), 7.0][rng.integers(0, 6)] if rng.random() < 0.6 else float(rng.normal())
            rows.append((g, 2 ** 53 + 1 if m % 2 else None, float(rng.integers(0, 3)), float(rng.normal()), near, odd, None))
    return spark.createDataFrame(rows, "g string, h long, " + ", ".join(f"{c} double" for c in COLS)).repartition(parts)


def as_rows(df, *columns):
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


@pytest.mark.parametrize("share,least,capacity", [(0.1, 2, None), (0.1, 1, 10), (0.07, 3, None), (0.333, 1, 3), (0.5, 1, 2), (0.02, 2, None)])
@pytest.mark.parametrize("keys", [["g"], ["g", "h"]])
def test_equal_to_exact_histograms(spark, monkeypatch, share, least, capacity, keys):
    monkeypatch.setattr(frequent, "HELD_ROWS", 300)
    df = table(spark)
    want = frequency_screen(feature_histogram(df, keys, COLS), keys, share=share, min_values=least)
    got = feature_screen(df, keys, COLS, share=share, min_values=least, capacity=capacity)
    assert as_rows(got, *keys, "feature", "n_frequent") == as_rows(want, *keys, "feature", "n_frequent")


def test_summaries_bound_the_counts_and_do_not_grow_with_the_values(spark):
    df = table(spark, 1)
    exact = {(r.g, r.feature, str(r.value)): (r.cnt, r.n_rows) for r in feature_histogram(df, "g", COLS).collect()}
    for r in value_summaries(df, "g", COLS, 20).collect():
        assert len(r.counters) <= 20 * 6 and r.err <= r.n / 21
        told = {str(c.value): c.low for c in r.counters}
        for (g, f, v), (cnt, n) in exact.items():
            if (g, f) == (r.g, COLS[r._fi]):
                assert n == r.n and told.get(v, 0) <= cnt <= told.get(v, 0) + r.err


def test_histograms_of_the_chosen_features(spark):
    df = table(spark, 2, n=400)
    chosen = spark.createDataFrame([(None, ["cat", "mixed"]), ("a", ["cont"]), ("c", []), ("z", ["cat"])], "g string, features array<string>")
    cols = ["g", "feature", "value", "cnt", "n_rows"]
    want = selected_histograms(chosen, feature_histogram(df, "g", COLS), "g")
    assert as_rows(chosen_histograms(df, chosen, "g", COLS), *cols) == as_rows(want, *cols)


def test_empty_table_and_clashing_names(spark):
    df = table(spark, 3, n=60)
    assert feature_screen(df.where("false"), "g", COLS).count() == 0
    named = df.withColumnsRenamed({"cat": "value", "cont": "n", "edge": "low"}).withColumn("_fi", F.lit("x"))
    want = as_rows(frequency_screen(feature_histogram(df, "g", COLS[:3]), "g"), "n_frequent")
    assert as_rows(feature_screen(named, "g", ["value", "n", "low"]), "n_frequent") == want
