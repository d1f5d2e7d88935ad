import json

from siftmine.sources import readers, writers


def test_read_survey_by_name_with_quotes(spark, tmp_path, rows):
    path = tmp_path / "survey.csv"
    path.write_text(
        'Id,SalaryType,Country,Salary\n1,Monthly,"Iran, Islamic","1,000"\n2,,Chile,\n3,NA,Peru,NA\n'
    )
    assert rows(readers.read_survey(spark, str(path))) == [
        ("Iran, Islamic", "1,000", "Monthly"), ("Chile", None, None), ("Peru", "NA", "NA"),
    ]


def test_read_ratings_drops_the_header_of_every_file(spark, tmp_path, rows):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"user_id,item_id,rating\n{name},x,4.5\n{name},y,2\n")
    expected = [("a", "x", 4.5), ("a", "y", 2.0), ("b", "x", 4.5), ("b", "y", 2.0)]
    for naive in (False, True):
        found = readers.read_ratings(spark, str(tmp_path), naive)
        assert rows(found, "user", "item") == expected


def test_read_baskets_without_header(spark, tmp_path, rows):
    (tmp_path / "baskets.csv").write_text("1,a\n1,b\n2,a\n")
    for naive in (False, True):
        found = readers.read_baskets(spark, str(tmp_path / "baskets.csv"), naive)
        assert rows(found, "basket", "item") == [("1", "a"), ("1", "b"), ("2", "a")]


def test_read_documents(spark, tmp_path):
    (tmp_path / "docs.txt").write_text("a  b\n\nc\n")
    found = readers.read_documents(spark, str(tmp_path / "docs.txt")).collect()
    assert [r["tokens"] for r in found] == [["a", "", "b"], [""], ["c"]]


def test_write_delimited_keeps_order(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "id * 2 as b").repartition(4).orderBy("id")
    writers.write_delimited(df, str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("*.csv"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert lines == [f"{i},{2 * i}" for i in range(50)]


def test_delimited_lines(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", 2.5, 2)], "x string, y double, z int")
    assert [r[0] for r in writers.delimited_lines(df).collect()] == ["a,,1", "b,2.5,2"]


def test_write_json(spark, tmp_path):
    report = spark.sql("select 'K' as algorithm, 1.5D as wsse, array(named_struct('id', 1)) as clusters")
    writers.write_report(report, str(tmp_path / "json"))
    text = "".join(f.read_text() for f in (tmp_path / "json").glob("*.json"))
    assert json.loads(text) == {"algorithm": "K", "wsse": 1.5, "clusters": [{"id": 1}]}
