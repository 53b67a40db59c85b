"""Functions on small literals; expected values follow the documented behaviour."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from taskspire.functions import categories, events, names, text, times
from taskspire.schema import TASK, cast_task, field_types


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


def col(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_data_format(spark):
    got = col(spark, ["mc16.1.a.deriv.DAOD_X.r1", "a.b.c.d.e", "user.x.y.z.q.w.AOD.t1", "user.x.y.z.q.w.v", None], names.data_format)
    assert got == ["DAOD_X", None, "AOD", None, None]


def test_scope_and_container(spark):
    assert col(spark, ["mc16:a.b", "mc16.a", "user.me.x", "group.phys.x", None], names.scope) == ["mc16", "mc16", "user.me", "group.phys", None]
    assert col(spark, ["mc16:a.b_tid01_00", "a.b"], names.container) == ["a.b", "a.b"]


def test_hashtags_and_steps(spark):
    assert col(spark, ["A, b B ,c", None], names.hashtags) == [["a", "b b", "c"], None]
    df = spark.createDataFrame([(["AOD", "LOG"], "r1"), (["LOG"], "r1"), (["AOD"], None)], "f array<string>, t string")
    assert [r[0] for r in df.select(names.format_steps("f", "t")).collect()] == [["AOD:r1"], None, None]
    assert col(spark, ["a.b.c", None], names.name_tags) == ["c", None]


def test_tokens(spark):
    assert col(spark, ["mc16_13TeV.Up silon..x", None], names.name_tokens) == [["mc16", "13tev", "upsilon", "x"], None]


@pytest.mark.parametrize(
    "tags, name, want",
    [
        ([], None, ["Uncategorized"]),
        (["btagging", "diphoton", "qcd"], None, ["BTag", "GammaJets", "Multijet"]),
        (["diboson", "zz", "ww"], None, ["Diboson"]),
        ([], "nothing.nothing.3topjetstanb_wenu_", ["TTbarX", "Wjets", "Multijet", "SUSY"]),
        (None, "a.b", ["Uncategorized"]),
        (["none"], "a.b.ttbar", ["TTbar"]),
    ],
)
def test_categories(spark, tags, name, want):
    df = spark.createDataFrame([(tags, name)], "h array<string>, n string")
    assert df.select(categories.physics_category("h", "n")).first()[0] == want


@pytest.mark.parametrize("category, words", list(categories.BY_HASHTAG.items()))
def test_each_hashtag(spark, category, words):
    df = spark.createDataFrame([([w],) for w in words], "h array<string>")
    assert all(category in r[0] for r in df.select(categories.physics_category("h", F.lit(None).cast("string"))).collect())


FIELDS = "taskid long, chain_id long, step_name string, n_files_to_be_used int, n_events_per_job long, n_files_per_job int, requested_events long, primary_input_events long, processed_events long, total_events long, total_req_events long, parent_taskname string, parent_total_events long"


def test_events(spark):
    rows = [
        (1, 1, "Evgen", 7, 10, 2, None, None, 5, 9, None, None, None),
        (2, 2, "evgen", None, 10, 2, None, None, 5, 9, 0, None, None),
        (3, 1, "Simul", None, None, None, 10, 8, 4, 9, None, "a.recon.b", 20),
        (4, 1, "Simul", None, None, None, 10, None, 4, 9, None, "a.deriv.b", 20),
        (5, 5, "Simul", None, None, None, None, None, 4, 9, None, None, None),
        (6, 6, "Simul", None, None, None, 10, 8, 4, 9, 40, None, None),
    ]
    df = spark.createDataFrame(rows, FIELDS).withColumn("input_events", events.input_events()).withColumn("input_events_v2", events.input_events_v2()).withColumn("processed_events_v2", events.processed_events_v2())
    got = [tuple(r) for r in df.orderBy("taskid").select("input_events", "input_events_v2", "processed_events_v2").collect()]
    assert got == [(35, None, 9), (5, None, 9), (8, 20, 8), (10, 10, 4), (None, None, None), (8, 40, 16)]


def test_chain(spark):
    df = spark.createDataFrame([(3, "1,2:a.b:7,3"), (4, None), (5, "x,5"), (6, "6")], "taskid long, chain_data string")
    got = [tuple(r) for r in events.with_chain(df).orderBy("taskid").select("chain_data", "chain_id", "parent_taskname", "parent_total_events").collect()]
    assert got == [([1, 2, 3], 1, "a.b", 7), ([4], 4, None, None), ([5], 5, None, None), ([6], 6, None, None)]


def test_times(spark):
    assert [times.interval_seconds(x) for x in ("1d", "8h", "15m", "30", "-1d")] == [86400, 28800, 900, 30, -86400]
    with pytest.raises(ValueError):
        times.interval_seconds("1w")
    t = F.lit(datetime(2020, 5, 6, 7, 8, 9))
    assert one(spark, F.date_format(times.round_time(t, timedelta(days=1)), "yyyy-MM-dd HH")) == "2020-05-06 00"
    assert one(spark, F.date_format(times.round_time(t, timedelta(hours=6)), "yyyy-MM-dd HH")) == "2020-05-06 06"
    assert datetime.strptime(one(spark, F.date_format(times.round_time(t, timedelta(days=7)), "yyyy-MM-dd")), "%Y-%m-%d").toordinal() % 7 == 1
    with pytest.raises(ValueError):
        times.round_time(t, timedelta(hours=7))
    assert one(spark, F.size(times.days_between(F.lit("2020-01-01"), F.lit("2020-01-03")))) == 3
    assert one(spark, F.size(times.days_between(F.lit("2020-01-03"), F.lit("2020-01-01")))) == 0
    assert one(spark, times.years(F.lit("2015 and 2017"))) == ["2015", "2016", "2017"]
    assert times.api_time("2020-01-02") == datetime(2020, 1, 2)
    assert times.now_minus(60, "Europe/Paris", datetime(2020, 1, 1, 12, tzinfo=timezone.utc)) == datetime(2020, 1, 1, 12, 59)
    assert times.months_or_days(datetime(2020, 1, 31), datetime(2020, 2, 1), "i_") == ["i_2020.01.31", "i_2020.02.01"]
    assert times.months_or_days(datetime(2020, 1, 1), datetime(2020, 3, 1), "i_") == ["i_2020.01.*", "i_2020.02.*", "i_2020.03.*"]


def test_strings(spark):
    assert col(spark, ["a\nb", "it's", 'say "x"', "plain", "é\\"], text.clean_string) == ["a\\nb", "it\\'s", "say x", "plain", "\\\\"]
    assert one(spark, text.journal_id(F.lit("TI TLE"), F.lit("1"), F.lit("2018"))) == "TITLE_1_2018"
    assert one(spark, text.journal_id(*(F.lit(None).cast("string"),) * 3)) == ""
    assert one(spark, text.first_starting(F.array(F.lit("x"), F.lit(None), F.lit("arXiv:1")), "arXiv")) == "arXiv:1"
    assert one(spark, text.without_ligatures(F.lit("eﬃcient ﬂow"))) == "efficient flow"
    assert one(spark, text.project_year(F.lit("data16_13TeV"))) == "2016"
    assert one(spark, text.range_ids(F.lit("104920-3"))) == ["104920", "104921", "104922", "104923"]
    assert one(spark, text.range_ids(F.lit("1234"))) == ["1234"]


def test_facts(spark):
    t = F.lit("Data collected in 2015-2016 with mc12a and mc11c. XX-20-2015-A is EXOT-2015-03. A 13 TeV pp collisions sample of 3.2 fb−1")
    f = text.facts(t, t)
    got = spark.range(1).select(*(c.alias(k) for k, c in f.items())).first()
    assert got["campaigns"] == ["mc11c", "mc12a"] and got["energy"] == "13 TeV" and got["luminosity"] == "3.2 fb-1"
    assert got["collisions"] == "proton-proton" and got["years"] == ["2015", "2016"]
    assert got["project_simulated"] == "mc11c_13TeV" and got["projects_real"] == ["data15_13TeV", "data16_13TeV"]


def test_links(spark):
    t = F.lit("Note A https://x.org/record/1\nNote A https://x.org/record/2\nB https://x.org/record/3\nC https://y.org/record/4")
    assert one(spark, text.links(t)) == {}
    assert one(spark, text.links(t, "x.org")) == {"Note A ": "https://x.org/record/2", "B ": "https://x.org/record/3"}


def test_dataset_names():
    got = text.dataset_names("see mc12_8TeV.1000[1/2].Pythia.merge.AOD.e1_r2 and data12_8TeV.00200805.physics_Muons.merge.")
    assert ("montecarlo", "mc12_8TeV.10001.Pythia.merge.AOD.e1_r2") in got and ("montecarlo", "mc12_8TeV.10002.Pythia.merge.AOD.e1_r2") in got
    assert [f for f, _ in got].count("realdata") == 1
    assert text.dataset_names(None) == [] and text.dataset_names("") == []
    assert text.dataset_names("so INTERVAL7! and data12_8TeV.INTERVAL3!.physics_Muons.merge") == [("realdata", "data12_8TeV.INTERVAL3!.physics_Muons.merge")]
    assert text.dataset_names("see mc12 8TeV.100001.Pythia.merge.AOD.e1 r2") == [("montecarlo", "mc12_8TeV.100001.Pythia.merge.AOD.e1_r2")]
    two = text.dataset_names("data12_8TeV.[104920-3].physics_Muons.[1/2].AOD")
    assert two == [("realdata", "data12_8TeV.104920.physics_Muons.1.AOD"), ("realdata", "data12_8TeV.104921.physics_Muons.2.AOD")]
    assert text.expand_interval("[104920-3]") == ["104920", "104921", "104922", "104923"] and text.expand_interval("[12-9]") == [str(i) for i in range(12, 20)] and text.expand_interval("[12-05]") == []
    assert text.expand_interval("[0-9999999999]") == []
    assert text.expand_interval("[9-12]") == ["09", "10", "11", "12"] and text.expand_interval("[01\\02]") == ["01", "02"]


def test_variant_path(spark):
    v = F.parse_json(F.lit('{"a": {"b.c": 5}}'))
    assert one(spark, text.by_path(v, 'a."b.c"')) == "5" and one(spark, text.by_path(v, "a.z")) is None
    assert one(spark, text.first_known("N_", F.lit(""), F.lit(None).cast("string"), F.lit("q"))) == "N_q"


def test_cast_task(spark):
    df = spark.createDataFrame([("5", "01-02-2020 03:04:05", "x", 1)], "taskid string, start_time string, hashtag_list string, extra int")
    got = cast_task(df)
    assert dict(got.dtypes)["hashtag_list"] == "array<string>" and got.columns[-1] == "extra" and set(field_types(TASK)) <= set(got.columns)
    assert got.select("taskid", "start_time", "hashtag_list").first()[:] == (5, datetime(2020, 2, 1, 3, 4, 5), ["x"])
