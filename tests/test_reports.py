"""Report semantics on hand-made films, and a brute-force check on the fixture."""

import datetime as dt

import pytest

from nestmart import schemas
from nestmart.plans.reports import report_by_cast, report_by_genre, report_by_title


def m(pop, gross, day=1, votes=1, avg=1.0):
    return (pop, votes, avg, gross, dt.date(2024, 1, day))


def movies(spark, rows):
    full = [(i, None, t, t, g, [], None, None, None, c, None, None, b, ms)
            for i, t, g, b, c, ms in rows]
    return spark.createDataFrame(full, schemas.MOVIES)


def test_placeholders_do_not_move_avg_or_max(spark):
    df = movies(spark, [(1, "a", ["x"], 10, None, [m(2.0, 5), m(None, None, 2), m(4.0, 9, 3)])])
    r = report_by_title(df).first()
    assert (r.popularity, r.gross) == (3.0, 9)


def test_genre_report_is_average_of_film_averages(spark):
    df = movies(spark, [
        (1, "a", ["x"], 10, None, [m(1.0, 1), m(1.0, 1, 2), m(1.0, 1, 3)]),
        (2, "b", ["x", "y"], 30, None, [m(4.0, 4)]),
        (3, "c", [], 50, None, [m(9.0, 9)]),          # no genres -> absent
        (4, "d", ["x"], None, None, [m(9.0, 9)]),     # unknown budget -> absent
        (5, "e", ["z"], 10, None, []),                # no series -> absent
    ])
    out = {r.genre: r for r in report_by_genre(df).collect()}
    assert sorted(out) == ["x", "y"]
    assert out["x"].popularity == pytest.approx(2.5) and out["x"].budget == 20
    assert out["y"].gross == 4


def test_equal_title_genres_budget_merge(spark):
    df = movies(spark, [(1, "a", ["x"], 10, None, [m(1.0, 1)]),
                        (2, "a", ["x"], 10, None, [m(3.0, 3), m(3.0, 3, 2)])])
    r = report_by_genre(df).first()
    # one merged film: average over its three days, not over two films
    assert r.popularity == pytest.approx(7.0 / 3)


def test_cast_report_groups_whole_cast_before_cut(spark):
    top = [(7, 0), (8, 1)]
    df = movies(spark, [
        (1, "a", ["x"], 10, top + [(9, 5)], [m(1.0, 10)]),
        (2, "a", ["x"], 10, top + [(6, 6)], [m(3.0, 30)]),   # same top five, other cast
        (3, "b", ["x"], 10, [(7, 0)], [m(5.0, None)]),        # NULL gross -> left out
    ])
    credits = spark.createDataFrame([(7, "p7", 1, "A"), (9, "p9", 1, "A")], schemas.CREDITS)
    out = {r.cast_id: r for r in report_by_cast(df, credits).collect()}
    assert sorted(out) == [7]                 # 8 missing from credits, 9 beyond the cut
    assert out[7].popularity == pytest.approx(2.0) and out[7].gross == pytest.approx(20.0)


def test_genre_report_matches_brute_force_on_fixture(spark, sf_dir):
    """Explode-and-aggregate in pandas on the collected film table vs the Spark plan."""
    import pandas as pd

    from nestmart import fixtures as fx
    films = fx.film_table(spark, sf_dir)
    rows = []
    for f in films.collect():
        for e in f.metrics or []:
            rows.append((f.title, tuple(f.genres) if f.genres else None, f.movie_budget,
                         e.popularity, e.gross))
    pdf = pd.DataFrame(rows, columns=["title", "genres", "budget", "pop", "gross"])
    per = pdf.groupby(["title", "genres", "budget"], dropna=False).agg(
        pop=("pop", "mean"), gross=("gross", "max")).reset_index()
    per = per[per.budget.notna() & per.genres.notna()].explode("genres")
    want = per.groupby("genres").agg(budget=("budget", "mean"), pop=("pop", "mean"))
    got = {r.genre: r for r in report_by_genre(films).collect()}
    assert set(got) == set(want.index)
    for g, w in want.iterrows():
        assert got[g].budget == pytest.approx(w.budget)
        assert got[g].popularity == pytest.approx(w["pop"])
