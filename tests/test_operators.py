"""Operators on small tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from taskspire.operators import adjust, chain, consistency, enrich, extract, search, selection, stats, steps, tables, triples, units, upsert
from taskspire.plans.api import Engine, InvalidCategoryName, InvalidParameter, MethodExists, MethodNotFound, MissedParameter, NoDataFound, Result
from taskspire.plans.model import tasks

DS = "array<struct<name:string,data_format:string,events:long,bytes:long,deleted:boolean>>"
TASK = f"taskid long, step_name string, status string, ctag string, project string, primary_input string, taskname string, hashtag_list array<string>, output_formats array<string>, start_time timestamp, end_time timestamp, task_timestamp timestamp, input_events long, requested_events long, processed_events long, total_events long, input_bytes long, toths06 long, toths06_failed long, chain_id long, chain_data array<long>, output_dataset {DS}"


@pytest.fixture(scope="module")
def some(spark):
    d = lambda *a: datetime(2020, 1, *a)
    s = lambda f, b, x: (f"n.{f}", f, b // 10, b, x)
    rows = [
        (1, "Evgen", "done", "r1", "mc16", "mc.AOD.x", "mc16.1.Upsilon.e.r1", ["mc16a", "w"], ["AOD", "DAOD"], d(1), d(3), d(3), 100, 100, 95, 99, 50, 10, 1, 1, [1], [s("AOD", 100, False), s("DAOD", 50, True)]),
        (2, "Evgen", "failed", "r1", "mc16", "mc.AOD.x", "mc16.2.zmumu.e.r1", None, ["AOD"], d(2), d(1), d(2), None, 10, None, None, 0, 5, 5, 1, [1, 2], None),
        (3, "Deriv Merge", "running", "r2", "mc16", "mc.rpvll.x", "mc16.3.ttbar.d.r2", ["mc16a"], None, d(2), None, d(4), 0, None, 5, 5, None, None, None, 1, [1, 2, 3], []),
        (4, None, None, None, None, None, None, [], [], None, None, None, None, None, None, None, None, None, None, None, None, [s("DAOD_X", 30, False), s("DAOD_X", 20, True)]),
    ]
    return spark.createDataFrame(rows, TASK)


def ids(df):
    return sorted(r[0] for r in df.select("taskid").collect())


def test_selection(some):
    pick = lambda p, **k: ids(some.where(selection.selection(some, p, **k)))
    assert pick({"status": "done"}) == [1]
    assert pick({"status": {"!": ["done"]}}) == [2, 3, 4]
    assert pick({"htag": ["w", "x"]}) == [1] and pick({"htag": None}) == [2, 4] and pick({"htag": {"!": [None]}}) == [1, 3]
    assert pick({"htag": {"&": ["w", "mc16a"]}}, allow_all=True) == [1]
    assert pick({"status": ["done", None]}) == [1, 4]
    with pytest.raises(NotImplementedError):
        pick({"htag": {"&": ["w"]}})
    for bad in ({}, {"nothing": 1}, {"status": {"?": [1]}}):
        with pytest.raises(selection.SelectionError):
            pick(bad)
    assert selection.by_prefix(["a", "!b", "&c", "|d"]) == {"|": ["a", "d"], "!": ["b"], "&": ["c"]}
    assert ids(some.where(selection.not_bad())) == [1, 3, 4]
    assert ids(some.where(selection.incomplete("step_name", "end_time"))) == [3, 4]


def test_units(some):
    got = units.aggregate(some, [], ["count", "input_events", "hs06", "input", "output", "output__bytes", "task_duration", "status"]).first()
    assert (got["count"], got["input_events"], got["hs06"], got["input"], got["output"], got["output__bytes"]) == (4, 100, 15, 1, 2, 130)
    assert got["task_duration"] == 2 * 86_400_000 and got["status"] == {"done": 1, "failed": 1, "running": 1}


def test_steps(some):
    assert sorted(r[0] for r in steps.with_step(some, "ctag_format").select("step").collect()) == ["AOD:r1", "AOD:r1", "DAOD:r1"]
    with pytest.raises(ValueError):
        steps.with_step(some, "other")
    order = [r[0] for r in some.sparkSession.createDataFrame([("Zzz",), ("Deriv",), ("Evgen",)], "s string").orderBy(steps.step_order(F.col("s"))).collect()]
    assert order == ["Evgen", "Deriv", "Zzz"]
    assert steps.top(some.groupBy("step_name").agg(F.count("*").alias("n")), ["step_name"], "n", 1).first()[0] == "Evgen"


def test_statistics(some):
    got = {r["step"]: r for r in stats.step_statistics(some).collect()}
    assert set(got) == {"Evgen", "Deriv Merge"}
    assert got["Evgen"]["percent_done"] == 99.0 and got["Evgen"]["step_status"] == "StepDone" and got["Evgen"]["output_bytes"] == 100 and got["Evgen"]["finished_gap"] == 1
    assert got["Deriv Merge"]["step_status"] == "Unknown" and got["Deriv Merge"]["percent_pending"] == 100
    compat = {r["step"]: r for r in stats.step_statistics(some, es_compat=True).collect()}
    assert compat["Evgen"]["finished_gap"] == 100 and compat["Evgen"]["running_events"] == 0
    c = {r["step"]: r for r in stats.campaign_summary(some, datetime(2020, 1, 4, 12)).collect()}
    assert c["Evgen"]["input_events"] == 100 and c["Evgen"]["output_ds"] == 15 and c["Evgen"]["ratio_ds"] == 0.15 and c["Deriv Merge"]["ratio_ds"] is None and c["Deriv Merge"]["updated_24h"] == 1
    assert "ratio_ds" not in stats.campaign_summary(some, datetime(2020, 1, 4), events_src="task").columns


def test_derivations(some):
    flat = {r["output"]: r for r in stats.derivations_flat(some).collect()}
    assert set(flat) == {"AOD", "DAOD_X"} and flat["DAOD_X"]["tasks"] == 1 and flat["DAOD_X"]["output_bytes"] == 30 and flat["AOD"]["ratio"] == 2.0 and flat["DAOD_X"]["ratio"] == 0
    nested = {r["output"]: r["tasks"] for r in stats.derivations_nested(some).collect()}
    assert nested == {"AOD": 1, "DAOD_X": 1}
    assert sorted(r[0] for r in stats.output_formats(some).collect()) == ["AOD", "DAOD_X"]


def test_running_days(some):
    now = datetime(2020, 1, 4)
    got = sorted((r[0], str(r[1]), r[2]) for r in stats.running_days(some, ["mc16a"], now).collect())
    assert got == [("Deriv Merge", f"2020-01-0{i}", 1) for i in (2, 3, 4)] + [("Evgen", f"2020-01-0{i}", 1) for i in (1, 2, 3)]
    assert {r[0] for r in stats.running_days(some, None, now, start=datetime(2020, 1, 2)).collect()} == {"Evgen"}
    assert {r[0] for r in stats.running_days(some, None, now, end=datetime(2020, 1, 1)).collect()} == {"Evgen"}


def test_chain(spark, some):
    keep = lambda df: spark.createDataFrame(df.collect(), df.schema)
    links = [(1, None), (2, 1), (3, 2), (4, 3), (5, 99), (6, 6), (7, 8), (8, 9), (9, 7)]
    got = {r[0]: r[1] for r in chain.lineage(spark.createDataFrame(links, "taskid long, parent long"), keep).collect()}
    assert got == {1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [1, 2, 3, 4], 5: [5], 6: [6], 7: [9, 8, 7][-3:], 8: [7, 9, 8], 9: [8, 7, 9]} or all(len(set(p)) == len(p) and p[-1] == k for k, p in got.items())
    parent = dict(links)
    for k, path in got.items():
        walk, seen = [k], {k}
        while parent.get(walk[0]) in parent and parent[walk[0]] not in seen:
            walk.insert(0, parent[walk[0]])
            seen.add(walk[0])
        assert path == walk, k
    assert {r[0]: r[1] for r in chain.chain_of(some, 2).collect()} == {1: [2], 2: [3], 3: []}


def test_search(some):
    assert ids(search.keyword_search(some, ["evgen", "r1"])) == [1, 2]
    assert ids(search.keyword_search(some, ["mc16.*.upsi*"])) == [1]
    assert search.keyword_search(some, ["evgen"], 1, 1).count() == 1
    assert len(search.keyword_search(some, ["done"], None, 1).first()["output_dataset"]) == 1
    with pytest.raises(ValueError):
        search.keyword_search(some, [])


def test_engine(some):
    e = Engine(some, some.limit(0), clock=lambda: datetime(2020, 1, 4))
    assert [r["step"] for r in e.call("/step/stat", status="!zzz").data.collect()] == ["Evgen", "Deriv Merge"]
    assert e.call("//task//chain/", tid=2).data.count() == 3
    assert e.call("/task/kwsearch", kw="evgen", analysis=True).data.count() == 0
    assert e.call("/task/kwsearch", kw="evgen").meta["total"]() == 2
    assert e.call("/nested/task/deriv", project="mc16", amitag="r1").data.count() == 1
    assert e.call("/task/deriv", project="mc16", amitag="r1").data.count() == 1
    assert "warning" in e.call("/nested/task/chain", tid=2).meta
    assert e.call("/campaign/stat", pr=None, status="done") if "pr_id" in some.columns else True
    assert e.call("/task/info").data.count() == 4 and e.call("/").data.count() == len(e.methods)
    e.add("/own/*", lambda: e.info())
    assert e.call("/own/x").data.count() == len(e.methods)
    for error, path, p in ((MethodNotFound, "/x", {}), (MissedParameter, "/task/hist", {}), (NoDataFound, "/task/chain", {"tid": 77}), (InvalidParameter, "/step/stat", {"step_type": "x", "status": "a"}), (MissedParameter, "/step/stat", {})):
        with pytest.raises(error):
            e.call(path, **p)


def test_responses(some):
    e = Engine(some, some.limit(0), clock=lambda: datetime(2020, 1, 4))
    got = e.respond("/task/kwsearch", kw="evgen")
    assert got["status"] == "OK" and got["total"] == 2 and len(got["data"]) == 2 and "timeout" not in got
    codes = {"/x": 471, "/nothing/info": 461, "/task/hist": 473, "/task/kwsearch": 473}
    assert {p: e.respond(p)["code"] for p in codes} == codes
    assert e.respond("/task/kwsearch", kw="a", size="many")["code"] == 474 and e.respond("/task/hist", htags="a", rtype="img")["code"] == 470
    with pytest.raises(MethodExists):
        e.add("/task//hist", e.info)
    with pytest.raises(InvalidCategoryName):
        e.add("/a b/c", e.info)

    def slow(n):
        import time

        time.sleep(3)
        return n

    from pyspark.sql.functions import udf

    e.add("/slow", lambda: Result(some.select(udf(slow, "long")(F.col("taskid").cast("long"))), {"timeout": 0.3}))
    late = e.respond("/slow")
    assert late["status"] == "failed" and late["code"] == 470


def test_bins(spark):
    from taskspire.operators import stats

    days = spark.createDataFrame([("a", date(2020, 1, 1), 1), ("a", date(2020, 1, 2), 2), ("b", date(2020, 1, 11), 4)], "step string, day date, tasks long")
    assert {tuple(r) for r in stats.binned_days(days, 2).collect()} == {("a", date(2020, 1, 1), 3), ("b", date(2020, 1, 6), 4)}
    assert stats.binned_days(days.limit(1), 5).collect()[0]["tasks"] == 1 and stats.binned_days(days.limit(0), 5).count() == 0


def test_records(spark):
    from taskspire.functions import records as R

    rows = [('{"doi": null, "keywords": [{"term": null}], "report_number": [null, {"internal": "i"}], "primary_report_number": [null, 5, "arXiv:1"]}',), ("{}",), (None,), ("[1]",)]
    v = spark.createDataFrame(rows, "j string").select(F.try_parse_json("j").alias("v"))
    c = F.col("v")
    got = [tuple(r) for r in v.select(R.dois(c), R.keyword_list(c), R.internal_number(c), R.arxiv_code(c), R.journals(c)).collect()]
    assert got == [(None, [], "i", "arXiv:1", None)] + [(None,) * 5] * 3


def test_extract(spark):
    rows = spark.createDataFrame([(1, "input", "b"), (1, "input", "a"), (1, "output", "c"), (2, "output", "d")], "taskid int, type string, datasetname string")
    assert {r[0]: (r[1], r[2]) for r in extract.squash(rows).collect()} == {1: (["a", "b"], ["c"]), 2: (None, ["d"])}
    a, b = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, s string, n int"), spark.createDataFrame([(2, "z"), (3, None)], "k int, s string")
    assert sorted(tuple(r) for r in extract.full_outer_update(a, b, "k").collect()) == [(1, "x", 5), (2, "z", 6), (3, None, None)]
    jobs = spark.createDataFrame([(1, "finished", 5), (1, "failed", 2), (1, "closed", 9), (2, "failed", 1)], "jeditaskid int, jobstatus string, hs06sec int")
    assert sorted(tuple(r) for r in extract.status_sums(jobs).collect()) == [(1, 5, 2, 7), (2, 0, 1, 1)]
    with pytest.raises(KeyError):
        extract.kind_of(F.lit(1), "x; drop")


def test_enrich(spark):
    t = spark.createDataFrame([(1, ["a", "b", "a"], "p"), (2, [], None), (3, None, "q")], "taskid int, output array<string>, primary_input string")
    facts = enrich.dataset_facts(spark.createDataFrame([("a", "5", "50"), ("p", "7", "null")], "name string, events string, bytes string"))
    got = {r["taskid"]: r for r in enrich.with_datasets(t, facts).collect()}
    assert [(d["name"], d["events"], d["deleted"]) for d in got[1]["output_dataset"]] == [("a", 5, False), ("b", None, True), ("a", 5, False)]
    assert got[1]["primary_input_events"] == 7 and got[1]["primary_input_deleted"] and got[1]["_incomplete"]
    assert got[2]["output_dataset"] is None and not got[2]["_incomplete"] and got[3]["primary_input_deleted"]
    sets = spark.createDataFrame([("mc16:mc16.x_tid1", "AOD"), ("data:data.x", "AOD"), ("mc15:mc15.y", None)], "name string, data_format string")
    params = spark.createDataFrame([("mc16.x", "kFactor", "1.5"), ("mc15.y", "kFactor", "2")], "name string, param string, value string")
    assert {r["name"]: r["k_factor"] for r in enrich.with_parameters(sets, params, {"kFactor": "k_factor"}).collect()} == {"mc16:mc16.x_tid1": "1.5", "data:data.x": None, "mc15:mc15.y": "2"}
    papers = spark.createDataFrame([(1, "A", [10, 11]), (2, "B", [])], "id int, code string, notes array<int>")
    notes = spark.createDataFrame([(10, "N"), (11, "M")], "id int, code string")
    records = spark.createDataFrame([("A", 2, "second"), ("A", 1, "first"), ("N", 3, "note")], "code string, record_id int, record string")
    got = {r["id"]: r for r in enrich.assemble_papers(papers, notes, records).collect()}
    assert got[1]["record"] == "first" and [x["note_id"] for x in got[1]["supporting_notes"]] == [10] and got[2]["record"] is None
    files = spark.createDataFrame([([("a.pdf", None, 1), ("b.txt", None, 2), ("c.PDF", "x fulltext", 1), ("d.pdf", "figure", 9)],)], "f array<struct<url:string,description:string,version:int>>")
    assert files.select(enrich.pdf_choice("f")).first()[0] == "c.PDF"


def test_upserts(spark):
    store = spark.createDataFrame([("1", "a", 1, None), ("2", "b", 2, True)], "_id string, s string, n int, _update_required boolean")
    new = spark.createDataFrame([("2", None, 5, True), ("3", "c", None, True), ("1", "z", None, False)], "_id string, s string, n int, _incomplete boolean")
    assert sorted(tuple(r) for r in upsert.partial_upsert(store, new).collect()) == [("1", "z", 1, False), ("2", "b", 5, True), ("3", "c", None, True)]
    whole = spark.createDataFrame([("2", "x", 1), ("2", "y", 2), ("4", "w", 1)], "_id string, s string, version int")
    assert sorted(tuple(r) for r in upsert.index_upsert(store.select("_id", "s"), whole).collect()) == [("1", "a"), ("2", "y"), ("4", "w")]
    r = upsert.routed(upsert.action(spark.createDataFrame([("a", True), (None, None)], "_index string, _update boolean")), {"a": "tasks"}, "other").collect()
    assert sorted(tuple(x) for x in r) == [("other", None, "index"), ("tasks", True, "update")]


def test_consistency(spark):
    a, b = spark.createDataFrame([("1", 1, None), ("2", 2, "x"), ("3", 3, "y")], "_id string, n int, s string"), spark.createDataFrame([("1", 1, None), ("2", 5, None)], "_id string, n int, s string")
    assert sorted(tuple(r) for r in consistency.differences(a, b).collect()) == [("2", "different", "n,s"), ("3", "missing", None)]
    assert sorted(tuple(r) for r in consistency.compare(a, b, ("uid", "_id")).collect()) == [("2", "different"), ("3", "only_a")]


def test_triples(spark):
    p = spark.createDataFrame([("A", "full", "data16_13TeV", "x\ny", "open")], "period string, periodLevel string, projectName string, description string, status string")
    got = triples.data_periods(p.union(p.withColumn("period", F.lit("B"))))
    assert got.where("o = '<http://example.org/graph#Project>'").count() == 1 and got.where("o = '2016'").count() == 2
    lines = [r[0] for r in triples.turtle(got.where("p like '%hasDescription%'")).collect()]
    assert lines[0].endswith('"x y" .')
    e = triples.listed_entities(spark.createDataFrame([("# no",), ("mc16",), ("",)], "value string"), "Project")
    assert e.count() == 2
    d = spark.createDataFrame([(1, [("mc", "a"), ("mc", "b")])], "id int, d array<struct<family:string,name:string>>")
    assert triples.content(d, "id", F.col("d")).count() == 6
    j = spark.createDataFrame([(1, ["10.1", "10.1", None])], "id int, doi array<string>")
    assert triples.multi_valued(j, F.lit("<s>"), "hasDOI", F.col("doi")).count() == 1


def test_tables(spark):
    cells = [("Dataset ID", 0, 10, 90, 100), ("Name", 20, 30, 90, 100), ("104920", 1, 9, 80, 88), ("x", 21, 29, 80, 88), ("104921", 1, 9, 70, 78), ("y", 21, 25, 71, 79), ("text only", 0, 50, 50, 60)]
    lines = spark.createDataFrame([("p", 1, float(a), float(b), float(c), float(d), t) for t, a, b, c, d in cells], "paper string, page int, x0 double, x1 double, y0 double, y1 double, text string")
    got = tables.reconstruct(lines)
    assert got.count() == 6 and got.where("row_no = 2 and column_no = 0").first()["text"] == "104921"
    captions = spark.createDataFrame([("p", 1, 1, "Table 1: samples")], "paper string, page int, table_no int, caption string")
    assert [(r["column_no"], r["share"]) for r in tables.dataset_tables(got, captions).collect()] == [(0, 1.0)]


def test_adjust(spark):
    raw = spark.createDataFrame([(3, "A, w", "AOD.LOG", "mc16.3.zmumu.e.r7", "1,2:a.b.c:9,3", "Simul", "r7", 10, 8, 4, 9, None, None, None, None, datetime(2020, 1, 2, 3)), (0, *(None,) * 15)], "taskid long, hashtag_list string, output_formats string, taskname string, chain_data string, step_name string, ctag string, requested_events long, primary_input_events long, processed_events long, total_events long, total_req_events long, n_files_to_be_used int, n_events_per_job long, n_files_per_job int, task_timestamp timestamp")
    got = adjust.adjust(raw)
    r = got.first()
    assert got.count() == 1 and r["phys_category"] == ["Wjets"] and r["ctag_format_step"] == ["AOD:r7"] and r["input_events"] == 8 and r["input_events_v2"] == 9 and r["processed_events_v2"] == 3 and r["ami_tags"] == "r7"
    assert adjust.progress(got).first()["_id"] == "1577923200000_3"


def test_plans_push_down(spark, small):
    plan = tasks(spark, small).select("taskid", "status").where("taskid = 5")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,5)" in plan and "l_comment" not in plan
