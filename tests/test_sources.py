import json

from pyspark.sql import functions as F

from corpusmill.sources import readers, writers
from tests.conftest import rows


def test_json_documents(spark, tmp_path):
    for name, content in (("A", '{"x": 1}'), ("B", '{"x": '), ("_template", '{"x": 2}')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(content)
    from pyspark.sql import types as T

    df = readers.json_documents(spark, f"{tmp_path}/*/metadata.json", T.StructType([T.StructField("x", T.LongType())]))
    assert rows(df.select("folder", "x")) == [("A", 1)]


def test_markdown(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.md").write_text('---\ntitle: "T"\ntags: [a, b]\n---\nBody\n')
    (tmp_path / "d" / "b.md").write_text("# Only body")
    got = {r.name: r for r in readers.front_fields(readers.markdown_documents(spark, f"{tmp_path}/*/*.md")).collect()}
    assert got["a.md"].body == "Body\n" and got["a.md"].fields["title"] == "T"
    assert got["b.md"].front is None and got["b.md"].body == "# Only body" and got["b.md"].fields is None
    assert rows(readers.folders(spark, f"{tmp_path}/*/*.md")) == [("d",)]


def test_empty_table(spark, tmp_path):
    from pyspark.sql import types as T

    assert readers.table_or_empty(spark, str(tmp_path / "none"), T.StructType([T.StructField("x", T.LongType())])).count() == 0


def test_pictures(spark, tmp_path):
    (tmp_path / "home.png").write_bytes(b"x")
    (tmp_path / "big.png").write_bytes(b"y" * 100)
    assert [r.name for r in readers.pictures(spark, f"{tmp_path}/*.png", ["big.png", "home.png"], most_bytes=50).collect()] == ["home.png"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    writers.json_lines(df, str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first()[0]) == {"a": 1, "b": None}
    posts = spark.createDataFrame([("T", "u", None, "2024-01-01", ["x"], "Body")], "title string, url string, author string, post_date string, tags array<string>, body_text string")
    assert posts.select(writers.post_markdown(posts)).first()[0] == '---\ntitle: "T"\nurl: "u"\nauthor: null\ndate: "2024-01-01"\ntags: ["x"]\n---\n\nBody\n'
    docs = spark.createDataFrame([("b", " B "), ("a", "A")], "name string, body string")
    assert [r.text for r in writers.bundle(docs, ["a", "zz", "b"]).orderBy("place").collect()] == ["<!-- a -->\nA", "<!-- b -->\nB"]
    sec = spark.createDataFrame([("f", "d", 1, "x")], "firm string, doc string, ordinal int, body string")
    writers.section_files(sec, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where(F.col("firm") == "f").count() == 1
