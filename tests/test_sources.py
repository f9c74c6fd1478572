import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from swayline.operators import curves, reports
from swayline.plans import pipeline
from swayline.sources import star_tables, storage, tables
from swayline.sources.storage import materialise, new_path, work_dir
from tests.test_features import CFG, tables as member_tables


def write_split(spark, folder, prefix=""):
    for name, df in vars(member_tables(spark)).items():
        tables.write_table(df, f"{folder}/{prefix}{name}.csv", "csv")


def test_csv_split_round_trip(spark, tmp_path):
    write_split(spark, tmp_path, "test_")
    got = tables.read_split(spark, str(tmp_path), "test_")
    want = member_tables(spark)
    for name in ("app_usage", "web_visits", "claims", "churn_labels"):
        a, b = getattr(got, name), getattr(want, name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert pipeline.prepare(got, CFG).count() == 3


def test_malformed_csv_stops_the_job(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("member_id,signup_date,churn,outreach\n1,2025-01-01,yes,0\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "labels.csv"), tables.CHURN_LABELS).collect()


def test_csv_reads_dates(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("member_id,signup_date,churn,outreach\n1,2025-01-31,1,0\n2,,0,1\n")
    rows = tables.read_csv(spark, str(tmp_path / "labels.csv"), tables.CHURN_LABELS).collect()
    assert rows[0]["signup_date"] == dt.date(2025, 1, 31) and rows[1]["signup_date"] is None


def test_materialise_cuts_the_plan(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    saved = materialise(df, "counts")
    assert sorted(saved.collect()) == sorted(df.collect())
    assert "Aggregate" not in saved._jdf.queryExecution().toString()
    assert new_path(spark, "x") != new_path(spark, "x") and work_dir(spark) == work_dir(spark)


class Session:
    """The two places a working folder is looked up in."""

    def __init__(self, named=None, context=None, master="spark://host:7077"):
        self.conf = SimpleNamespace(get=lambda key, default=None: named or default)
        self.sparkContext = SimpleNamespace(getCheckpointDir=lambda: context, master=master)


def test_work_dir_is_the_one_the_cluster_names():
    assert work_dir(Session("hdfs://shared/work/")) == "hdfs://shared/work"
    assert work_dir(Session(None, "hdfs://shared/ctx")) == "hdfs://shared/ctx"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session())


def test_contact_list_written_and_read_back(spark, tmp_path):
    rows = [(i, i % 2, (i // 2) % 2, (i * 37 % 11) / 8.0) for i in range(60)]
    scores = spark.createDataFrame(rows, "member_id long, y int, treatment int, uplift double")
    listed = pipeline.contact_list(scores, curve_descending=False)
    n = curves.optimal_target(scores, descending=False).first()["optimal_n"]
    path = tables.write_table(listed, str(tmp_path / "ranked"), "csv")
    back = tables.read_csv(spark, path, listed.schema).orderBy("rank").collect()
    assert [r["rank"] for r in back] == list(range(1, n + 1))
    assert [r["prioritization_score"] for r in back] == sorted(r["prioritization_score"] for r in back)


def test_interaction_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 1, 0), (2, 5, 7, 0, 1)], "member_id long, total_web_visits int, a int, treatment int, y int")
    wide = pipeline.with_interactions(df, ["a", "missing"])
    assert wide.columns[-2:] == ["outreach_x_a", "clinical_x_total_web_visits"]
    assert [(r["outreach_x_a"], r["clinical_x_total_web_visits"]) for r in wide.orderBy("member_id").collect()] == [(3, 2), (0, 0)]


def test_interactions_are_chosen_on_train_and_added_to_both(spark):
    rows = [(i, i % 2, (i * 7) % 5, i % 3, i % 2, (i // 2) % 2) for i in range(40)]
    train = spark.createDataFrame(rows, "member_id long, a int, b int, c int, treatment int, y int")
    left, right, chosen = pipeline.choose_interactions(train, train.limit(5), threshold=0.5)
    assert chosen == ["a"]
    assert left.columns == right.columns == [*train.columns, "outreach_x_a"]


def test_long_scores_feed_the_comparison(spark):
    class Constant:
        def __init__(self, column):
            self.column = column

        def score(self, df, out="uplift"):
            return df.withColumn(out, F.col(self.column).cast("double"))

    rows = [(i, i % 7, (i * 3) % 11, i % 2, (i // 3) % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "member_id long, a int, b int, treatment int, y int")
    scores = pipeline.long_scores({"one": Constant("a"), "two": Constant("b")}, df)
    got = {r["model"]: r for r in reports.model_comparison(scores).collect()}
    assert got["one"]["max"] == 6.0 and got["two"]["max"] == 10.0
    alone = curves.qini_auc(Constant("b").score(df)).first()["qini_auc"]
    assert got["two"]["qini_auc"] == pytest.approx(alone)


def test_csv_as_it_comes(spark, tmp_path):
    """Another column order, extra columns, quoted line breaks and quotes, zone suffixes."""
    (tmp_path / "web_visits.csv").write_text('title,extra,member_id,timestamp,url,description\n"a ""b"",\nc",x,1,05/07/2025,u,\n')
    row, = tables.read_csv(spark, str(tmp_path / "web_visits.csv"), tables.WEB_VISITS, multi_line=True).collect()
    assert tuple(row) == (1, "u", 'a "b",\nc', None, "05/07/2025")
    (tmp_path / "app_usage.csv").write_text("timestamp,member_id,event_type\n2025-07-01T10:00:00Z,1,session\n2025-07-01 10:00:00+02:00,2,session\n"
                                            "2025-07-01 10:00:00,3,session\n2025-07-01,4,session\n,5,session\n")
    got = {r["member_id"]: str(r["timestamp"]) for r in tables.read_csv(spark, str(tmp_path / "app_usage.csv"), tables.APP_USAGE).collect()}
    assert got == {1: "2025-07-01 10:00:00", 2: "2025-07-01 08:00:00", 3: "2025-07-01 10:00:00", 4: "2025-07-01 00:00:00", 5: "None"}
    (tmp_path / "bad.csv").write_text("timestamp,member_id,event_type\nsoon,1,session\n")
    with pytest.raises(Exception, match="not a timestamp"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), tables.APP_USAGE).collect()
    (tmp_path / "less.csv").write_text("member_id,event_type\n1,session\n")
    with pytest.raises(ValueError, match="timestamp"):
        tables.read_csv(spark, str(tmp_path / "less.csv"), tables.APP_USAGE)


def test_visit_times_with_parts_missing(spark):
    from swayline.config import DAY_FIRST_FORMATS, YEAR_FIRST_FORMATS
    from swayline.functions.columns import lenient_timestamp
    day_first = {"05/07/2025 10:11:12": "2025-07-05 10:11:12", "5/7/2025 10:11": "2025-07-05 10:11:00", "05-07-2025": "2025-07-05 00:00:00",
                 "5/7/2025 9:01:02.5": "2025-07-05 09:01:02.500000", "13/13/2025": None, "2025-07-05": None}
    year_first = {"2025-07-05 10:11:12": "2025-07-05 10:11:12", "2025-7-5T9:05": "2025-07-05 09:05:00", "2025-07-05": "2025-07-05 00:00:00",
                  "2025-07-05T10:11:12.123456": "2025-07-05 10:11:12.123456", "05/07/2025": None}
    for formats, cases in ((DAY_FIRST_FORMATS, day_first), (YEAR_FIRST_FORMATS, year_first)):
        df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("at", lenient_timestamp(F.col("t"), formats))
        assert {r["t"]: r["at"] and str(r["at"]) for r in df.collect()} == cases


def star(spark, folder, parts=6, lines=40):
    """Tables of a star schema under ``folder``; a page, a part and an order repeat, and lines without a part or an order exist."""
    day = "date_add(DATE '1998-01-01', cast(id % 300 as int))"
    made = {
        "part": (parts, ["id % {0} p_partkey".format(parts - 1), "concat('Brand#', id % 4) p_brand", "concat('T', id % 3, 'xx') p_type"]),
        "orders": (9, ["id % 8 o_orderkey", "id % 3 o_custkey"]),
        "lineitem": (lines, ["if(id % 11 = 0, null, id % 10) l_orderkey", "if(id % 7 = 0, null, id % 8) l_partkey", f"{day} l_shipdate"]),
        "pages": (7, ["id % 6 page_id", "concat('http://a/', id) url"]),
        "events": (30, ["id event_id", "id % 3 user_id", "'view' event_type", "TIMESTAMP_NTZ '2024-01-02 00:00:00' ts"]),
    }
    for name, (n, columns) in made.items():
        spark.range(n).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("rows, joins", [(100_000, "BroadcastHashJoin"), (4, "SortMergeJoin")])
def test_source_tables_are_broadcast_by_rows_not_by_file_size(spark, tmp_path, monkeypatch, rows, joins):
    folder = star(spark, tmp_path)
    monkeypatch.setattr(storage, "BROADCAST_ROWS", rows, raising=False)
    table = lambda name: star_tables.table(spark, folder, name)
    plain = table("lineitem").join(table("part"), F.expr("l_partkey = p_partkey")).join(table("orders"), F.expr("l_orderkey = o_orderkey"))
    want = sorted(map(tuple, plain.select("o_custkey", "p_brand", "p_type", "l_shipdate").collect()))
    claims = star_tables.claims(spark, folder)
    assert sorted(map(tuple, claims.collect())) == want
    visits = star_tables.web_visits(spark, folder)
    assert visits.count() == 30 + 5 - 4  # five events meet the page that is there twice, four meet none
    for found in (claims, visits):
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert joins in plan and (joins == "BroadcastHashJoin" or "BroadcastHashJoin" not in plan)


def test_claims_come_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    """Distinct counts hold several rows for each claim of a task, so tasks follow rows, not compressed bytes."""
    folder = star(spark, tmp_path, lines=4000)
    monkeypatch.setattr(star_tables, "TASK_LINES", 100, raising=False)
    claims = star_tables.claims(spark, folder)
    held = claims.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert claims.rdd.getNumPartitions() == 40 and held < claims.count() / 4
