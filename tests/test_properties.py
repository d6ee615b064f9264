"""Property: tallies are invariant under unpivot, repartitioning and row order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from periodfact.operators import BlockLayout, tally, unpivot_blocks
from periodfact.sources import positional_schema

CODES = ["LO", "PS", "LR", "RN", None]
block = st.tuples(st.sampled_from(CODES), st.integers(min_value=0, max_value=10_000))
row = st.lists(block, min_size=3, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40), parts=st.integers(min_value=1, max_value=6))
def test_tally_invariant(spark, rows, parts):
    data = [[f"a{i}"] + [x for code, votes in r for x in (code, str(votes))] for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, positional_schema(7))
    layout = BlockLayout(1, 2, {"code": 0, "votes": 1}, types={"votes": "long"}, key=("code",))
    expected: dict = {}
    for r in rows:
        for code, votes in r:
            if code is not None:
                expected[code] = expected.get(code, 0) + votes
    for frame in (df, df.repartition(parts), df.orderBy(F.rand(parts))):
        got = {x.code: x.votes for x in tally(unpivot_blocks(frame, ["c0"], layout), ["code"], "votes")
               .collect()}
        assert got == expected
