"""What plans must not do: run jobs while a query is built, number rows in one task, lose order."""

import random

from pyspark.sql import functions as F

from quarry.operators.copies import attach_lookups, choose_copy, effective_copies, select_targets
from quarry.operators.deposits import download_outcomes
from quarry.operators.discover import rank
from quarry.operators.records import assemble_records, substantial_tables, thin_tables
from quarry.plans.catalog import QUERIES, load_all
from quarry.shared import numbered

SF = "/root/testdata/sf0.001"


def test_no_shuffle_runs_while_a_query_is_built(spark):
    load_all()
    tracker = spark.sparkContext.statusTracker()
    for name in ("w02_keep_best", "discover_responses", "c28_variants", "x06_dataset_links", "t01_rank", "t02_targets"):
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, SF)
        for job in tracker.getJobIdsForGroup(name):  # footers only
            assert all(tracker.getStageInfo(s).numTasks == 1 for s in tracker.getJobInfo(job).stageIds), name
    spark.sparkContext.setJobGroup("", "")


def _jobs(spark, group, build):
    spark.sparkContext.setJobGroup(group, group)
    built = build()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    return built, jobs


def test_numbering_runs_no_job_while_it_is_built(spark):
    rows = [("t", "Zenodo", "dataset", k % 5, f"u{k}", k, "table", str(k % 7), f"r{k}") for k in range(90)]
    df = spark.createDataFrame(rows, "title string, source string, kind string, score int, url string, item_ord int, "
                                     "evidenceType string, rows string, recordId string")
    for name, f in (("rank", rank), ("targets", select_targets), ("some", lambda d: select_targets(d, limit=3)),
                    ("most", substantial_tables), ("fewest", thin_tables)):
        built, jobs = _jobs(spark, f"number-{name}", lambda: f(df))  # noqa: B023
        assert not jobs, name
        built.collect()


def test_numbered_over_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("v")).repartition(7)
    got = numbered(df, [(F.col("v"), True)], "rank").collect()
    assert sorted((r["rank"], r.v) for r in got) == [(k, 999 - k) for k in range(1000)]
    assert numbered(df.limit(0), [(F.col("v"), False)], "rank").collect() == []


def test_numbered_with_nulls_ties_and_a_hot_key(spark):
    # a third of all rows share their first key, another key is null often, some rows are equal throughout
    rng = random.Random(3)
    rows = [(5 if rng.random() < 0.34 else rng.choice([None, *range(10)]), rng.choice([None, "a", "B", "b", "Z", "é", ""]), rng.choice([None, rng.random()]), k // 2)
            for k in range(6000)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d int").repartition(5)
    got = numbered(df, [(F.col("a"), True), (F.collate(F.col("b"), "UNICODE"), False), (F.col("c"), True), (F.col("d"), False)], "n")
    assert got.columns == ["a", "b", "c", "d", "n"] and got.schema["n"].dataType.typeName() == "long"
    want = [tuple(r) for r in df.orderBy(F.col("a").desc(), F.collate(F.col("b"), "UNICODE"), F.col("c").desc(), "d").collect()]
    found = sorted((tuple(r) for r in got.collect()), key=lambda r: r[4])
    assert [r[4] for r in found] == list(range(6000))
    assert [r[:4] for r in found] == want


def test_numbering_spreads_rows_over_tasks(spark):
    df = spark.range(40000).select((F.col("id") % 3).alias("hot"), F.col("id"))
    got = numbered(df, [(F.col("hot"), True), (F.col("id"), False)], "n")
    part = got.groupBy(F.spark_partition_id()).count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # no small buckets put together
    try:
        assert max(r["count"] for r in part.collect()) < 40000 * 0.45
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_targets_are_numbered_and_unlimited(spark):
    rows = [("t" if k % 2 else "data t", "Zenodo", "dataset", 60 + k % 3, f"u{k}", k) for k in range(90)]
    df = spark.createDataFrame(rows, "title string, source string, kind string, score int, url string, item_ord int")
    got = sorted(select_targets(df).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(90))
    assert [(-r.yield_rank, -r.score, r.item_ord) for r in got] == sorted((-r.yield_rank, -r.score, r.item_ord) for r in got)
    assert [r.url for r in sorted(select_targets(df, limit=5).collect(), key=lambda r: r.position)] == [r.url for r in got[:5]]


def test_first_landed_lookup_and_blank_dois(spark):
    art = spark.createDataFrame([(1, "d"), (2, ""), (3, None)], "article int, doi string")
    look = spark.createDataFrame([("d", "europepmc_search", 2, '{"resultList":{"result":[{"pmcid":"B"}]}}'), ("d", "europepmc_search", 1, '{"resultList":{"result":[{"pmcid":"A"}]}}'),
                                  ("", "europepmc_search", 0, '{"resultList":{"result":[{"pmcid":"X"}]}}')], "doi string, kind string, landed_ord int, body string")
    assert sorted((r.article, r.pmcid, r.oa_url) for r in attach_lookups(art, look).collect()) == [(1, "A", ""), (2, "", ""), (3, "", "")]


def test_articles_without_copies_stay(spark):
    rows = [("a", 0, None, None, None, None), ("b", None, None, None, None, None), ("c", 0, "static", "u", 0, None)]
    df = spark.createDataFrame(rows, "article_id string, cand_ord int, mode string, final_url string, n_tables int, error string")
    got = {r.article_id: (r.loaded, [e.message for e in r.errors]) for r in choose_copy(effective_copies(df, ["article_id", "cand_ord"])).collect()}
    assert got["a"] == (False, ["no landed copy", "no reachable copy (1 candidate(s))"])
    assert got["b"] == (False, ["no reachable copy (0 candidate(s))"]) and got["c"][0] is False


def test_one_outcome_per_candidate(spark):
    cands = spark.createDataFrame([(1, 1, "u", "f", "r")], "link_id int, file_index int, url string, file_name string, record_id string")
    resp = [("u", "u", 500, 2), ("u", "u", 200, 1), ("v", "v", None, 1)]
    df = spark.createDataFrame([(*r, "text/csv", 1, None, 1, None) for r in resp], "url string, final_url string, http_status int, landed_ord int, content_type string, content_length long, content_disposition string, byte_length long, error string")
    assert [r.error for r in download_outcomes(cands, df).collect()] == [None]
    assert [r.error for r in download_outcomes(cands.withColumn("url", F.lit("v")), df).collect()] == ["no HTTP status"]


def test_records_of_one_slug_keep_their_own_tables(spark):
    art = spark.createDataFrame([(1, "same"), (2, "same")], "position int, article_id string").selectExpr("*", "true attempted", "true loaded", "'m' mode", "'u' final_url")
    t = spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (2, 2, "z")], "position int, table_number int, caption string")
    none = spark.createDataFrame([], "position int, figure_number int, link_number int")
    got = assemble_records(art, t, none.drop("link_number"), none.drop("figure_number"), key="position").collect()
    assert {r.position: [x.caption for x in r.extraction.tables] for r in got} == {1: ["x"], 2: ["y", "z"]}


def test_an_index_is_escaped_once_and_reads_back(spark):
    """The JSON of a text's inverted index is escaped as a whole, not token by token; odd tokens come back, in order."""
    import json

    from pyspark.sql import functions as F

    from quarry.functions.text import reconstruct_abstract
    from quarry.plans.synth import inverted_index_json
    assert str(inverted_index_json(F.col("t"))).count("to_json") == 1
    texts = ['say "hi" \\ a\x01b 10 2 01 10 é\U0001f600 </p> say', "", " \n ", "one", None, "b a b a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("j", inverted_index_json(F.col("t")))
    back = df.withColumn("back", reconstruct_abstract(F.from_json("j", "map<string,array<int>>"))).orderBy("i").collect()
    assert [r.back for r in back] == ['say "hi" \\ a\x01b 10 2 01 10 é\U0001f600 </p> say', "", "", "one", "", "b a b a"]
    assert json.loads(back[5].j) == {"a": [1, 3], "b": [0, 2]}
    clash = spark.sql("SELECT from_json('{\"x\":[0,1],\"b\":[1],\"7\":[0],\"3\":[2]}', 'map<string,array<int>>') m")
    assert clash.select(reconstruct_abstract("m")).first()[0] == "x b 3"
