import pytest

from kinrate.sources import files


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_bad_fields_become_null_one_by_one(spark, tmp_path):
    path = write(
        tmp_path / "ratings.csv",
        "userId,movieId,rating,timestamp\n1,2,3.5,100\nx,2,4.0,5\n3,7.0,bad,\n4,5,0.0,1\n",
    )
    got = [tuple(r) for r in files.read_ratings(spark, path).collect()]
    assert got == [(1, 2, 3.5, 100), (None, 2, 4.0, 5), (3, 7, None, None), (4, 5, 0.0, 1)]


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "ratings.csv", "movieId,rating,userId\n2,3.5,1\n")
    ratings = files.read_ratings(spark, path)
    assert dict(ratings.dtypes) == {
        "userId": "bigint",
        "movieId": "bigint",
        "rating": "float",
        "timestamp": "bigint",
    }
    assert [tuple(r) for r in ratings.collect()] == [(1, 2, 3.5, None)]


def test_large_ids_keep_all_digits(spark, tmp_path):
    large = 2**53 + 1
    path = write(tmp_path / "ratings.csv", f"userId,movieId,rating\n{large},{2**31}.0,3.5\n{2**63},1e3,1\n")
    got = [tuple(r)[:3] for r in files.read_ratings(spark, path).collect()]
    assert got == [(large, 2**31, 3.5), (None, 1000, 1.0)]


def test_item_titles_keep_commas_and_quotes(spark, tmp_path):
    rows = [(1, 'A "quoted" name, with comma', "Drama|War"), (2, "Plain", None)]
    items = spark.createDataFrame(rows, "movieId int, title string, genres string")
    path = str(tmp_path / "items")
    files.write_table(items, path, "csv")
    assert sorted(tuple(r) for r in files.read_items(spark, path).collect()) == rows


def test_absent_files(spark, tmp_path):
    absent = str(tmp_path / "none")
    assert files.read_items(spark, absent) is None
    assert files.read_table(spark, absent, files.AVERAGES) is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_ratings(spark, absent)


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_tables_round_trip_and_are_replaced(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    for rows in ([(1, 2.571, 9), (2, 0.5, 1)], [(3, 4.125, 2)]):
        files.write_table(spark.createDataFrame(rows, files.AVERAGES), path, fmt)
        back = files.read_table(spark, path, files.AVERAGES, fmt)
        assert sorted(tuple(r) for r in back.collect()) == rows


def test_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_table(spark.range(1), str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        files.read_table(spark, str(tmp_path / "x"), "id bigint", "xlsx")
