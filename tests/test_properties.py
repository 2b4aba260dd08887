"""Property tests with generated inputs, checked against plain Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kestrel.operators import balance, profile

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(keys=st.lists(st.integers(min_value=0, max_value=10**6), min_size=1, max_size=60), frac=st.sampled_from([0.3, 0.7, 0.9]))
def test_hash_split_partitions_rows(spark, keys, frac):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    tr, te = balance.hash_split(df, ["k"], frac)
    a, b = [r[0] for r in tr.collect()], [r[0] for r in te.collect()]
    assert Counter(a) + Counter(b) == Counter(keys)
    assert not set(a) & set(b)  # equal keys always land on the same side


def test_extreme_fractions_keep_both_sides(spark):
    df = spark.range(50_000).withColumnRenamed("id", "k")
    for frac in (0.995, 0.004):
        n = balance.hash_split(df, ["k"], frac)[0].count()
        assert abs(n / 50_000 - frac) < 0.002 and 0 < n < 50_000


@SETTINGS
@given(n=st.integers(min_value=0, max_value=30), k=st.integers(min_value=1, max_value=5))
def test_replicate_multiplies(spark, n, k):
    df = spark.range(n)
    assert balance.replicate(df, k).count() == n * k


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"])), min_size=1, max_size=40))
def test_modes_match_python(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    counts = Counter(v for v in vals if v is not None)
    rows = profile.modes(df, ["v"]).collect()
    if not counts:
        assert rows == []
        return
    best = max(counts.values())
    want = min(v for v, c in counts.items() if c == best)
    assert (rows[0]["mode"], rows[0]["n"]) == (want, best)
