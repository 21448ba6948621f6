"""Write docs/PLANS.md: the physical plans of the main operators, trimmed.

Usage: python tools/show_plans.py [sf_dir]

Stores the fixture film table and people as bucketed tables (as ``publish``
does), then records for each operator the operator tree of
``explain("formatted")`` and the scan details that matter at scale
(``PushedFilters``, ``ReadSchema``, bucketing) plus the exchange count.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nestmart import fixtures as fx  # noqa: E402
from nestmart import registry  # noqa: E402
from nestmart.operators.merge import merge_movies  # noqa: E402
from nestmart.plans import reports  # noqa: E402
from nestmart.plans.model import model_day  # noqa: E402
from nestmart.session import local_session  # noqa: E402
from nestmart.sources.tables import create_table_as, qualified  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def digest(text: str) -> str:
    tree = text.split("\n\n")[0]
    keep = [ln.strip() for ln in text.splitlines()
            if re.match(r"^\s*(PushedFilters|ReadSchema|Bucketed|SelectedBucketsCount)", ln)]
    n_ex = len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M))
    return f"```\n{tree.strip()}\n```\n\nExchanges: {n_ex}\n\n" + "".join(
        f"- `{k}`\n" for k in keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    db = registry._scratch_db(spark, "plans")
    create_table_as(fx.film_table(spark, sf), db, "movies", bucket_by="movie_id", buckets=8)
    create_table_as(fx.people(spark, sf), db, "credits", bucket_by="person_id", buckets=8)
    create_table_as(registry._day_staging(spark, sf, 1)["movies"], db, "staging_movies")
    movies = spark.table(qualified(db, "movies"))
    credits = spark.table(qualified(db, "credits"))
    staged = spark.table(qualified(db, "staging_movies"))
    clean = registry._day_clean(spark, sf, 0)
    sections = {
        "report_by_genre (stored movies table)": reports.report_by_genre(movies),
        "report_by_cast (stored movies and credits)": reports.report_by_cast(movies, credits),
        "merge_movies (stored bucketed table + staging table)":
            merge_movies(movies, staged, "2024-01-02", check_unique=False),
        "model_movies (one day, from clean frames)": model_day(clean, "2024-01-01")["movies"],
    }
    out = ["# Physical plans\n",
           f"Generated by `python tools/show_plans.py {sf}` (local[8], AQE on; the final "
           "plan may change at runtime under AQE). Stored tables are bucketed by their key "
           "as `publish` writes them.\n"]
    for title, df in sections.items():
        out.append(f"## {title}\n\n{digest(formatted(df))}")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
