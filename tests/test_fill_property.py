"""Property test: the distributed ordered fill equals pandas ffill/bfill."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from promoscope.operators.fill import ordered_fill

DIRECTION = st.sampled_from(["forward", "backward"])


@st.composite
def tables(draw):
    n = draw(st.integers(min_value=1, max_value=60))
    keys = draw(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40)),
                         min_size=n, max_size=n, unique=True))
    vals = draw(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=n, max_size=n))
    dirs = draw(st.lists(DIRECTION, min_size=1, max_size=3))
    ranges = draw(st.integers(min_value=1, max_value=9))
    return keys, vals, dirs, ranges


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(tables())
def test_fill_matches_pandas(spark, case):
    keys, vals, dirs, ranges = case
    rows = [(a, b, v) for (a, b), v in zip(keys, vals)]
    df = spark.createDataFrame(rows, "k1 int, k2 int, v int")
    got = ordered_fill(df, ["k1", "k2"], ["v"], dirs, num_ranges=ranges)
    got = {(r.k1, r.k2): r.v for r in got.collect()}
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "v"]).sort_values(["k1", "k2"])
    for d in dirs:
        pdf["v"] = pdf["v"].ffill() if d == "forward" else pdf["v"].bfill()
    want = {(a, b): (None if pd.isna(v) else int(v)) for a, b, v in pdf.itertuples(index=False)}
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 3), st.integers(1, 3)),
                min_size=1, max_size=80),
       st.integers(min_value=1, max_value=10))
def test_top_items_matches_pandas(spark, events, k):
    from promoscope.operators.popularity import top_items
    from promoscope.schemas import TEXT_CODED_LOG
    rows = [(u, i, "c", 1, "b", 1111, a) for u, i, a in events]
    got = [tuple(r) for r in top_items(spark.createDataFrame(rows, TEXT_CODED_LOG), 1111, k=k).collect()]
    pdf = pd.DataFrame(events, columns=["u", "i", "a"]).drop_duplicates()
    c = pdf.groupby("i").size().reset_index(name="n").sort_values(["n", "i"], ascending=[False, True])
    assert got == [tuple(x) for x in c.head(k).itertuples(index=False)]
