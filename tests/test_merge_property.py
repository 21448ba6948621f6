"""Property: merging random daily presence patterns equals the reference's CASE rules."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from nestmart import schemas
from nestmart.operators.merge import merge_movies

DAYS = 4
patterns = st.dictionaries(
    keys=st.integers(min_value=1, max_value=6),
    values=st.lists(st.booleans(), min_size=DAYS, max_size=DAYS),
    min_size=1, max_size=5)


def expected(presence):
    """Per film, the series the three-branch merge produces, as (day, popularity)."""
    out = {}
    for d in range(DAYS):
        for k, seen in presence.items():
            if seen[d]:
                out.setdefault(k, []).append((d, float(k * 10 + d)))
            elif k in out:
                out[k].append((d, None))          # stored but absent: placeholder
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(presence=patterns)
def test_merge_matches_reference_rules(spark, presence):
    stored = spark.createDataFrame([], schemas.MOVIES)
    for d in range(DAYS):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=d)
        rows = [(k, None, "t", "t", None, None, None, None, None, None, None, None, None,
                 [(float(k * 10 + d), 1, 1.0, 1, day)])
                for k, seen in presence.items() if seen[d]]
        staged = spark.createDataFrame(rows, schemas.MOVIES)
        stored = merge_movies(stored, staged, day.isoformat(), check_unique=False)
    got = {r.movie_id: [((m.collect_date - dt.date(2024, 1, 1)).days, m.popularity)
                        for m in r.metrics] for r in stored.collect()}
    assert got == expected(presence)
