import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import cleaning as cl
from tidemark.operators.quality import DuplicateKeys
from tidemark.sources import files


def values(df, column):
    return [r[column] for r in df.collect()]


def test_missing_values_become_unknown(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None)], "director string, cast string, country string, rating string, other string"
    )
    row = cl.handle_missing_values(df).first()
    assert (row.director, row.cast, row.country, row.rating) == ("Unknown",) * 4
    assert row.other is None
    assert cl.handle_missing_values(df.select("other")).first().other is None


def test_dates_parse_or_become_null(spark):
    texts = ["September 9, 2019", None, "not a date", "2021-02-03", " Sep 9, 2019 ", "February 30, 2020"]
    df = spark.createDataFrame([(t,) for t in texts], "date_added string")
    assert values(cl.convert_date(df), "date_added") == [
        dt.datetime(2019, 9, 9), None, None, dt.datetime(2021, 2, 3), dt.datetime(2019, 9, 9), None,
    ]


def test_first_duplicate_is_kept(spark):
    df = spark.createDataFrame(
        [("s1", "first", 1), ("s2", "b", 2), ("s1", "later", 3), (None, "x", 4), (None, "y", 5)],
        "show_id string, title string, seq int",
    )
    kept = cl.remove_duplicates(df, "show_id", ["seq"])
    assert sorted(values(kept, "title")) == ["b", "first", "x"]
    assert cl.duplicate_summary(df).first().asDict() == {"rows_before": 5, "rows_kept": 3, "rows_removed": 2}
    assert cl.checked_catalogue(kept) is kept
    with pytest.raises(DuplicateKeys):
        cl.checked_catalogue(df)


def test_duration(spark):
    texts = ["90 min", "2 seasons", "45 mins", "1 season", None, "soon", "3 Minutes", "99999999999999999999 min"]
    out = cl.transform_duration(spark.createDataFrame([(t,) for t in texts], "duration string"))
    assert [(r.duration_value, r.duration_unit) for r in out.collect()] == [
        (90, "min"), (2, "season"), (45, "min"), (1, "season"), (None, None), (None, "soon"), (3, "min"), (None, "min"),
    ]


def test_genres(spark):
    df = spark.createDataFrame([("Comedy",), ("Drama, Action ",), (None,)], "listed_in string")
    assert values(cl.genres(df), "genres") == [["Comedy"], ["Drama", "Action"], None]
    text = spark.createDataFrame([("plain",)], "genres string")
    assert values(cl.clean_genres(text), "genres") == ["plain"]


def test_column_names(spark):
    df = spark.createDataFrame([], "`Show ID` string, Title string")
    assert cl.standardize_columns(df).columns == ["show_id", "title"]


def test_white_space(spark):
    df = spark.createDataFrame([("  Movie Title  ", 1), ("\t x y　\n", 2), (None, 3)], "title string, n int")
    assert values(cl.strip_whitespace(df), "title") == ["Movie Title", "x y", None]


def test_is_movie(spark):
    df = spark.createDataFrame([("Movie",), ("TV Show",), (None,)], "type string")
    assert values(cl.create_is_movie(df), "is_movie") == [True, False, False]


def test_whole_job_through_files(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text(
        "Show ID,Title,Type,Director,Date Added,Duration,Listed In\n"
        's1,"  A ""quoted""\ntitle ",Movie,,"September 9, 2019",90 min,"Comedy, Drama"\n'
        's1,again,Movie,X,,1 season,Drama\n'
    )
    raw = files.load_data(spark, str(source), multiline=True)
    raw = raw.withColumn("seq", F.when(F.col("Title") == "again", 2).otherwise(1))
    out = cl.clean_catalogue(raw, "show_id", ["seq"])
    paths = files.save_data(out, str(tmp_path / "out" / "titles.csv"))
    row = files.read_parquet(spark, paths["parquet"]).first()
    assert (row.title, row.director, row.duration_value, row.genres, row.is_movie) == (
        'A "quoted"\ntitle', "Unknown", 90, ["Comedy", "Drama"], True,
    )
    assert files.load_data(spark, paths["csv"], multiline=True).first().genres == '["Comedy","Drama"]'
    assert files.read_json(spark, paths["json"]).first().genres == ["Comedy", "Drama"]


def test_a_large_catalogue_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,text\n" + "".join(f'{k},"a, ""b"" {k}"\n' for k in range(60_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        split, whole = files.load_data(spark, str(tmp_path / "c.csv"), "id int, text string"), files.load_data(spark, str(tmp_path / "c.csv"), "id int, text string", multiline=True)
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() == 1
        assert split.count() == whole.count() == 60_000 and split.exceptAll(whole).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_names_and_keys(spark):
    df = spark.createDataFrame(
        [("own/repo",), ("own/a/b",), ("noslash",), ("/x",), ("x/",), (None,)], "name string"
    ).select("name", c.is_full_name("name").alias("ok"), c.owner_part("name").alias("o"), c.repo_part("name").alias("r"))
    assert [(r.ok, r.o, r.r) for r in df.collect()] == [
        (True, "own", "repo"), (True, "own", "a/b"), (False, "noslash", None), (False, "", "x"), (False, "x", ""),
        (False, None, None),
    ]
    logins = ["ok", " ok ", "", "-bad", "bad-", "a" * 39, "a" * 40, "a b", None]
    df = spark.createDataFrame([(x,) for x in logins], "login string").select(c.is_login("login").alias("ok"))
    assert values(df, "ok") == [True, True, False, False, False, True, False, False, False]
    assert spark.createDataFrame([("a/b ",)], "x string").select(c.file_key("x").alias("k")).first().k == "a_b"
