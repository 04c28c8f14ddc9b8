"""Deposits by repository, id and version, in both spellings; joins on a popular key."""

import json

from pyspark.sql import functions as F

from quarry.operators.deposits import deposit_files, download_outcomes, mendeley_keys, resolve_files
from quarry.operators.records import shared_deposits
from quarry.operators.skew import heavy_keys, salted_join

LINKS = "article_id string, link_number int, url string, resolved_url string"


def landed(spark):
    def body(name):
        return json.dumps([{"filename": f"{name}.csv", "size": 3, "content_details": {"download_url": f"https://f.ex.org/{name}"}}, {"filename": "gone"}])
    rows = [("abc", "1", body("abc1"), 0), ("abc", "2", body("abc2"), 1), ("abc", "2", body("late"), 2), ("def", "1", body("def1"), 0),
            ("ghi", "3", '{"message": "not an array"}', 0), ("Jk9", "4", body("jk4"), 0)]
    mendeley = spark.createDataFrame(rows, "deposit_id string, version string, body string, landed_ord int")
    none = spark.createDataFrame([], "deposit_id string, body string")
    return deposit_files(none, none, mendeley)


def metadata(spark):
    rows = [("abc", json.dumps({"doi": {"id": "10.17632/abc.2"}})), ("ghi", "no json"), ("Jk9", json.dumps({"doi": {"id": "10.17632/Jk9.4"}}))]
    return spark.createDataFrame(rows, "deposit_id string, body string")


def test_versions_in_both_spellings(spark):
    links = [("a", 1, "https://data.mendeley.com/datasets/abc/2", ""), ("a", 2, "https://doi.org/10.17632/abc.1", None),
             ("a", 3, "https://data.mendeley.com/datasets/abc", "https://doi.org/10.17632/abc.1"), ("a", 4, "https://doi.org/10.17632/def", ""),
             ("a", 5, "https://data.mendeley.com/datasets/ghi/3", ""), ("a", 6, "https://doi.org/10.17632/none.7", ""),
             ("a", 7, "https://DATA.mendeley.com/datasets/Jk9", "https://DATA.mendeley.com/datasets/Jk9"), ("a", 8, "", None)]
    df = spark.createDataFrame(links, LINKS)
    got = {}
    for r in resolve_files(df, landed(spark), metadata=metadata(spark)).orderBy("link_number", "file_index").collect():
        got.setdefault(r.link_number, []).append((r.file_index, r.url, r.file_name, r.source))
    api = lambda k, name: (k, f"https://f.ex.org/{name}", f"{name}.csv", "mendeley_api")
    assert got == {1: [api(1, "abc2")], 2: [api(1, "abc1")], 3: [api(1, "abc2"), api(2, "abc1")], 4: [api(1, "def1")], 7: [api(1, "jk4")]}
    keys = {(r.link_number): (r.deposit_id, r.version) for r in mendeley_keys(df, metadata(spark), ["article_id", "link_number"]).collect()}
    assert keys == {1: ("abc", "2"), 2: ("abc", "1"), 3: ("abc", "2"), 4: ("def", "1"), 5: ("ghi", "3"), 6: ("none", "7"), 7: ("Jk9", "4")}
    # without metadata a link that names no version means the first
    plain = {r.link_number for r in resolve_files(df, landed(spark)).collect()}
    assert plain == {1, 2, 3, 4}


def test_unresolved_versions_fall_back(spark):
    links = spark.createDataFrame([("a", 1, "https://doi.org/10.17632/abc.9", "https://data.mendeley.com/datasets/abc/9")], LINKS)
    landing = spark.createDataFrame([("a", 1, 0, "https://ex.org/x.csv", "x.csv", None, "html_link")],
                                    "article_id string, link_number int, file_ord int, url string, file_name string, size long, source string")
    assert [r.url for r in resolve_files(links, landed(spark), landing, metadata=metadata(spark)).collect()] == ["https://ex.org/x.csv"]


def parts(spark, df):
    """Rows of each task that has any, with nothing re-planned at run time."""
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def hot():
    """A third of the rows hold one key."""
    return F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))


def test_heavy_keys_and_spread(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(60_000).select("id", hot().alias("key"))
        right = left.select("key").distinct().withColumn("v", F.length("key"))
        salts = heavy_keys(left, ["key"], 64).collect()
        assert len(salts) == 1 and 21 <= salts[0]["_salts"] <= 23
        joined = salted_join(left, right, ["key"], ["id"])
        assert joined.count() == 60_000 and joined.agg(F.sum("v")).first() == left.agg(F.sum(F.length("key"))).first()
        n = parts(spark, joined)
        assert n[-1] <= 3 * n[len(n) // 2]
        plain = parts(spark, left.join(right, "key"))
        assert plain[-1] > 3 * plain[len(plain) // 2]
        # the operators: one deposit, one file and one identity that a third of all links share
        links = spark.range(30_000).select(F.col("id").cast("string").alias("article_id"), F.lit(1).alias("link_number"), F.concat(
            F.lit("https://doi.org/10.17632/"), F.when(F.col("id") % 3 == 0, F.lit("abc.2")).otherwise(F.concat(F.lit("x"), F.col("id").cast("string")))).alias("url"))
        links = links.withColumn("resolved_url", F.col("url"))
        assert resolve_files(links, landed(spark), metadata=metadata(spark)).count() == 10_000
        responses = left.select(F.col("key").alias("url")).distinct().selectExpr(
            "url", "url final_url", "200 http_status", "'text/csv' content_type", "1L content_length", "'' content_disposition", "1L byte_length", "cast(null as string) error")
        cands = left.select(F.col("id").alias("link_id"), F.lit(1).alias("file_index"), F.col("key").alias("url"), F.lit("f").alias("file_name"), F.lit("r").alias("record_id"))
        n = parts(spark, download_outcomes(cands, responses))
        assert sum(n) == 60_000 and n[-1] <= 3 * n[len(n) // 2]
        shared = shared_deposits(left.select(F.col("key").alias("identity"), F.col("id").alias("article_id")))
        assert [r.n_articles for r in shared.select("n_articles").distinct().collect()] == [20_000]
        assert len(parts(spark, shared)) > 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_join_keeps_rows_without_partner_or_key(spark):
    left = spark.createDataFrame([(k, None if k % 2 else "a") for k in range(100)] + [(200, "b")], "id long, key string")
    right = spark.createDataFrame([("a", 1), ("c", 2)], "key string, v int")
    got = salted_join(left, right, ["key"], ["id"], "left", pieces=8)
    assert got.count() == 101 and got.filter("v = 1").count() == 50
    assert salted_join(left, right, ["key"], ["id"], pieces=8).count() == 50
    assert salted_join(left.limit(0), right, ["key"], ["id"]).collect() == []


def test_written_tables_leave_no_shuffle_files(spark):
    import time

    from quarry.shared import stored
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    before = shuffled()
    assert stored(spark.range(20_000).groupBy((F.col("id") % 700).alias("k")).count(), "counts").count() == 700
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    left = shuffled() - before
    assert len(left) <= 4, left  # of the count() above alone
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_files_of_a_link_are_shuffled_once_for_their_numbers(spark):
    links = spark.createDataFrame([("a", 1, "https://ex.org/x.csv", "https://ex.org/x.csv"), ("a", 2, "https://ex.org/p", "")], LINKS)
    landing = spark.createDataFrame([("a", 2, k, f"https://ex.org/{k}", "f", None, "html_link") for k in range(3)] + [("a", 1, 0, "https://ex.org/y", "y", None, "html_link")],
                                    "article_id string, link_number int, file_ord int, url string, file_name string, size long, source string")
    files = resolve_files(links, landed(spark), landing)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, plan
    assert sorted((r.link_number, r.file_index, r.url) for r in files.collect()) == [(1, 1, "https://ex.org/x.csv"), *[(2, k + 1, f"https://ex.org/{k}") for k in range(3)]]


def test_deposits_and_data_files_in_any_spelling(spark):
    from quarry.functions import text as X
    urls = ["HTTPS://ZENODO.ORG/Records/12", "x 10.5281/ZENODO.7", "https://figshare.com/articles/dataset/t/9", "https://FIGSHARE.com/ndownloader/articles/3", "10.6084/M9.FigShare.4",
            "https://DATA.mendeley.com/DATASETS/aB1/2", "10.17632/xy.3", "https://zenodo.org/", "", None, "https://e.org/a.CSV", "https://e.org/a%2Ecsv", "https://e.org/a.csv.html", "https://e.org/csv", "https://e.org/.csv"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "k int, u string").select(
        "k", X.zenodo_record_id("u").alias("z"), X.figshare_article_id("u").alias("f"), X.mendeley_ref("u").alias("m"), X.is_data_file_url("u").alias("d"))
    got = sorted(df.collect())
    assert [r.z for r in got if r.z] == ["12", "7"] and [r.f for r in got if r.f] == ["9", "3", "4"]
    assert [tuple(r.m) for r in got if r.m] == [("aB1", "2"), ("xy", "3")]
    assert [urls[r.k] for r in got if r.d] == ["https://e.org/a.CSV", "https://e.org/a%2Ecsv"]


def test_references_are_read_without_lambdas(spark):
    """Which deposits a link names is compiled code: no interpreted function runs for each link."""
    from quarry.operators.deposits import deposit_refs, inspected_urls
    key = ["article_id", "link_number"]
    df = spark.createDataFrame([("a", 1, "https://zenodo.org/records/5", "https://doi.org/10.17632/abc.2"), ("a", 2, "", None), ("a", 3, None, "https://x.org"),
                                ("a", 4, "https://figshare.com/articles/dataset/t/9", "https://figshare.com/articles/dataset/t/9")], LINKS)
    refs = deposit_refs(inspected_urls(df, key), key)
    assert "lambda" not in refs._jdf.queryExecution().analyzed().toString()
    assert sorted((r.link_number, r.ui, r.repo, r.deposit_id, r.named) for r in refs.collect()) == [(1, 0, "zenodo", "5", ""), (1, 1, "mendeley", "abc", "2"), (4, 0, "figshare", "9", "")]
    assert sorted((r.link_number, r.ui) for r in inspected_urls(df, key).collect()) == [(1, 0), (1, 1), (3, 0), (4, 0)]
