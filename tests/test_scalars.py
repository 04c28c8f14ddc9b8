"""Inline goldens for the scalar functions."""

from pyspark.sql import functions as F

from conftest import one
from quarry.functions import text as X


def col_eval(spark, fn, *values, schema=None):
    names = [f"a{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], schema or ", ".join(f"{n} string" for n in names))
    return df.select(fn(*[F.col(n) for n in names]).alias("v")).first()["v"]


def test_strip_html(spark):
    assert col_eval(spark, X.strip_html, "&lt;i&gt;Fuel&lt;/i&gt; &amp;amp; oil&nbsp;price &#x2019; &copy;") \
        == "Fuel & oil price ’ &copy;"
    assert col_eval(spark, X.strip_html, "p &lt; 0.05 and q &gt; 1") == "p 1"
    assert col_eval(spark, X.decode_entities, "&#12ab; &#abc; &#x110000;") == "\x0c &#abc; &#x110000;"


def test_reconstruct_abstract(spark):
    df = spark.createDataFrame([({"b": [1], "a": [0, 3]},)], "m map<string,array<int>>")
    assert df.select(X.reconstruct_abstract(F.col("m"))).first()[0] == "a b a"
    df = spark.createDataFrame([(None,)], "m map<string,array<int>>")
    assert df.select(X.reconstruct_abstract(F.col("m"))).first()[0] == ""


def test_crossref_date(spark):
    df = spark.createDataFrame([([2024, 1, 5],), ([2024, 0, None],)], "p array<int>")
    assert [r[0] for r in df.select(X.crossref_date(F.col("p"))).collect()] == ["2024-1-5", "2024"]


def test_doi_and_keys(spark):
    assert col_eval(spark, X.normalize_doi, "https://doi.org/10.17632/63PXV64H75.4") == "10.17632/63pxv64h75"
    assert col_eval(spark, X.normalize_doi, "10.5281/zenodo.123") == "10.5281/zenodo"
    assert col_eval(spark, X.dedupe_key, "Fuel depots: a survey!", "") == "title:fuel depots a survey"
    assert col_eval(spark, X.dedupe_key, "Fuel Depots — A Survey", "") == "title:fuel depots a survey"
    assert col_eval(spark, X.dedupe_key, "LNG", "10.5281/zenodo.123") == "doi:10.5281/zenodo"
    assert col_eval(spark, X.dedupe_key, "LPG", "10.5281/zenodo.456") == "doi:10.5281/zenodo"


def test_slugify(spark):
    df = spark.createDataFrame([("10.1016/j.dib.2024.110491", "", 0), ("", "", 0)], "d string, t string, i int")
    assert [r[0] for r in df.select(X.slugify(F.col("d"), F.col("t"), F.col("i"))).collect()] == \
        ["10-1016-j-dib-2024-110491", "row-0"]


def test_path_extension(spark):
    cases = {"https://zenodo.org/records/1/files/a.CSV?download=1": ".csv", "https://ex.org/.hidden": "",
             "not a url/x.tar.gz?y=1.txt": ".gz", "https://ex.org/a%2Eparquet": ".parquet"}
    for u, e in cases.items():
        assert col_eval(spark, X.path_extension, u) == e, u


def test_file_names(spark):
    assert col_eval(spark, lambda c: X.safe_file_name(c), " a/b: c  d?.csv ") == "a-b-c-d-.csv"
    assert col_eval(spark, X.file_name_from_disposition,
                    "attachment; filename=\"x.csv\"; filename*=UTF-8''na%C3%AFve.csv") == "naïve.csv"
    assert col_eval(spark, X.with_extension, "data", "text/csv; charset=utf-8") == "data.csv"
    assert col_eval(spark, X.with_extension, "data", "image/png") == "data.dat"
    assert col_eval(spark, X.with_extension, "a.b", "text/csv") == "a.b"


def test_identity(spark):
    for u, e in {"https://doi.org/10.17632/63pxv64h75.4": "mendeley:63pxv64h75",
                 "https://data.mendeley.com/datasets/63pxv64h75/4": "mendeley:63pxv64h75",
                 "https://Osf.io/AB/": "https://osf.io/ab"}.items():
        assert col_eval(spark, X.dataset_identity, u) == e


def test_yield_rank_and_csv(spark):
    assert col_eval(spark, X.data_yield_rank, "Zenodo", "Dataset", "LNG data") == 5
    assert col_eval(spark, X.data_yield_rank, "Crossref", "journal-article", "Datasets of LNG") == 0
    vals = ['x"y', "p,q", " a ", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r[0] for r in df.select(X.csv_escape(F.col("s"))).collect()] == ['"x""y"', '"p,q"', " a ", ""]
