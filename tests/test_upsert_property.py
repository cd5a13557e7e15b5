"""Property: a keyed upsert equals a dictionary merge, for any target and
any key-unique source (null keys match null keys), and replaying it changes
nothing."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from commerce_lake.operators.upsert import upsert_frames

keys = st.one_of(st.none(), st.integers(0, 6).map(str))
rows = st.dictionaries(keys, st.integers(0, 3).map(str), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, source=rows)
def test_upsert_is_a_dict_merge(spark, target, source):
    schema = "k string, v string"
    t = spark.createDataFrame(list(target.items()), schema)
    s = spark.createDataFrame(list(source.items()), schema)
    out = upsert_frames(t, s, ["k"])
    expected = {**target, **source}
    assert {r["k"]: r["v"] for r in out.collect()} == expected and out.count() == len(expected)
    again = upsert_frames(out, s, ["k"])
    assert {r["k"]: r["v"] for r in again.collect()} == expected and again.count() == len(expected)
