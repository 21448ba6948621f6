"""The spark-submit entry point drives the same jobs."""

from nestmart import fixtures as fx
from nestmart.cli import main
from nestmart.session import scratch_path
from nestmart.sources import lake
from nestmart.sources.tables import qualified


def test_cli_run_day_calendar_and_report(spark, sf_dir, scratch_db):
    root = scratch_path(spark, "t-cli-lake")
    date = fx.day_date(0)
    lake.write_raw_json(fx.raw_movie_details(spark, sf_dir, 0), root, date, "movie_details")
    lake.write_raw_json(fx.raw_movie_credits(spark, sf_dir), root, date, "movie_credits")
    lake.write_raw_json(fx.raw_box_office(spark, sf_dir), root, date, "box_office")
    main(["run-day", "--lake", root, "--date", date, "--database", scratch_db, "--buckets", "4"])
    films = spark.table(qualified(scratch_db, "movies"))
    assert films.count() == fx.fx(spark, sf_dir, "day").where("day = 0").count()
    main(["dim-date", "--database", scratch_db])
    assert spark.table(qualified(scratch_db, "dim_date")).count() == 8401
    out = scratch_path(spark, "t-cli-report")
    main(["report", "--database", scratch_db, "--name", "genre", "--output", out])
    assert spark.read.parquet(out).count() > 0
