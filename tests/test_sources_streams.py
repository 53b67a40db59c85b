"""Sources, sinks, windows, streams and topologies."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from taskspire.sources import files, sinks, windows
from taskspire.streaming import stateful
from taskspire.streaming.topology import Topology


def write(folder, name, text):
    (folder / name).write_text(text)


def test_unclosed_tails(spark, tmp_path):
    import gzip

    (tmp_path / "a.json").write_text("a\nb\na")
    (tmp_path / "b.json").write_text("a\n\nc\n")
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(b"x\n\nx\n"))
    (tmp_path / "d.json.gz").write_bytes(gzip.compress(b"y\ny"))
    read = lambda kind, end="\n": sorted((r["source"].rsplit("/", 1)[-1], r["value"]) for r in files.messages(spark, str(tmp_path), kind, end).collect())
    files.EXTENSIONS["any"] = "*"
    try:
        assert read("any") == [("a.json", "a"), ("a.json", "b"), ("b.json", ""), ("b.json", "a"), ("b.json", "c"), ("c.json.gz", ""), ("c.json.gz", "x"), ("c.json.gz", "x"), ("d.json.gz", "y")]
    finally:
        del files.EXTENSIONS["any"]
    (tmp_path / "e.txt").write_text("uEOMvEOMu")
    assert read("text", "EOM") == [("e.txt", "u"), ("e.txt", "v")]


def test_backward_windows_resume(spark, tmp_path):
    from datetime import datetime

    offset, seen = windows.Offset(spark, str(tmp_path / "o")), []
    t = lambda h: datetime(2020, 1, 1, h)

    def load(df):
        if len(seen) == 2 and not crashed:
            crashed.append(1)
            raise OSError("broken off")
        seen.append(tuple(df.first()))

    crashed: list[int] = []
    run = lambda: windows.run_windows(offset, t(0), t(5), -3600, lambda a, b: spark.createDataFrame([(a.hour, b.hour)], "a int, b int"), load)
    with pytest.raises(OSError):
        run()
    assert run() == 3 and seen == [(4, 5), (3, 4), (2, 3), (1, 2), (0, 1)] and run() == 0


def test_messages(spark, tmp_path):
    write(tmp_path, "a.json", '{"a": 1}\n[2]\nbroken\n')
    write(tmp_path, "b.json", '{"a": 2}\n{"a": 3}\nunfinished')
    write(tmp_path, "c.txt", "other\n")
    raw = files.messages(spark, str(tmp_path))
    assert raw.count() == 5
    good, bad = files.parsed(raw, "a int")
    assert sorted(r["a"] for r in good.collect()) == [1, 2, 3] and bad.count() == 2


def test_message_ends(spark, tmp_path):
    write(tmp_path, "a.json", '{"a":\n1}EOM{"a": 2}EOMtail')
    assert sorted(r["value"] for r in files.messages(spark, str(tmp_path), end="EOM").collect()) == ['{"a":\n1}', '{"a": 2}']
    assert files.messages(spark, str(tmp_path), end="").count() == 1


def test_command_source(spark):
    spark.dataSource.register(files.CommandSource)
    got = spark.read.format("command").option("command", """echo '[{"paper": {"id": 5}}, {"x": 1}]'""").option("key", "paper.id").load()
    assert sorted((r["key"] or "", r["value"]) for r in got.collect()) == [("", '{"x": 1}'), ("5", '{"paper": {"id": 5}}')]


def test_windows(spark, tmp_path):
    t = lambda h: datetime(2020, 1, 1, h)
    assert list(windows.windows(t(0), t(5), 7200)) == [(t(0), t(2)), (t(2), t(4)), (t(4), t(5))]
    assert list(windows.windows(t(0), t(5), 7200, clip=False)) == [(t(0), t(2)), (t(2), t(4))]
    assert list(windows.windows(t(0), t(3), -7200)) == [(t(1), t(3)), (t(0), t(1))]
    with pytest.raises(ValueError):
        list(windows.windows(t(0), t(1), 0))
    offset, seen = windows.Offset(spark, str(tmp_path / "offset")), []
    run = lambda end: windows.run_windows(offset, t(0), end, 3600, lambda a, b: spark.createDataFrame([(a, b)], "a timestamp, b timestamp"), lambda df: seen.append(df.first()[0]))
    assert run(t(2)) == 2 and run(t(3)) == 1 and run(t(3)) == 0 and seen == [t(0), t(1), t(2)]
    assert "pr_id = :request" in windows.tasks_query("analysis")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "tasks", "index", 5, False), ("2", "tasks", "update", 6, True), ("3", "tasks", "update", 7, False)], "_id string, _index string, _action string, n int, _incomplete boolean")
    lines = {r[0].split("\n")[0]: r[0].split("\n")[1] for r in sinks.bulk_lines(df).collect()}
    assert lines['{"index":{"_index":"tasks","_id":"1"}}'] == '{"n":5}'
    assert lines['{"update":{"_index":"tasks","_id":"2"}}'] == '{"doc":{"n":6},"upsert":{"n":6,"_update_required":true}}'
    assert lines['{"update":{"_index":"tasks","_id":"3"}}'] == '{"doc":{"n":7},"doc_as_upsert":true}'
    sinks.write_new(df, str(tmp_path / "x"))
    with pytest.raises(Exception, match="exist"):
        sinks.write_new(df, str(tmp_path / "x"))
    good, failed = sinks.split_failed(df.withColumn("_error", F.when(F.col("n") > 6, "bad")))
    assert good.count() == 2 and failed.count() == 1
    seen = []
    sinks.fan_out(df, lambda d: seen.append(d.count()), lambda d: seen.append(d.where("n > 5").count()))
    assert seen == [3, 2]


def stream(spark, tmp_path, rows, schema):
    at = str(tmp_path / "in")
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(at)
    return files.file_stream(spark, at, schema, files_a_batch=1)


def drain(df, name, mode="append", tmp=None):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_first_of_key(spark, tmp_path):
    s = stream(spark, tmp_path, [[("a", 1)], [("a", 2), ("b", 3)]], "key string, n int")
    assert sorted(r[0] for r in drain(stateful.first_of_key(s, "key"), "firsts", tmp=tmp_path).collect()) == ["a", "b"]


def test_changed(spark, tmp_path):
    t = lambda h: datetime(2020, 1, 1, h)
    rows = [("k", t(1), "x"), ("k", t(2), "x"), ("k", t(3), "y"), ("l", t(1), "x"), ("k", t(4), "x")]
    schema = "key string, at timestamp, value string"
    batch = stateful.changed_batch(spark.createDataFrame(rows, schema), "key", ["at"], "value")
    want = sorted((r["key"], r["at"]) for r in batch.collect())
    assert want == [("k", t(1)), ("k", t(3)), ("k", t(4)), ("l", t(1))]
    got = drain(stateful.changed(stream(spark, tmp_path, [rows[:2], rows[2:]], schema)), "changes", tmp=tmp_path)
    assert sorted((r["key"], r["at"]) for r in got.collect()) == want


def test_snapshots(spark, tmp_path):
    t = lambda d, h: datetime(2020, 1, d, h)
    rows = [(1, t(1, 1), 5), (1, t(1, 9), 6), (2, t(1, 2), 7), (1, t(2, 1), 8)]
    schema = "taskid int, ts timestamp, n int"
    want = sorted((r["day"], r["taskid"], r["n"]) for r in stateful.daily_snapshots(spark.createDataFrame(rows, schema), "taskid", "ts", "n").collect())
    assert want == [(t(1, 0), 1, 6), (t(1, 0), 2, 7), (t(2, 0), 1, 8)]
    got = drain(stateful.daily_snapshots(stream(spark, tmp_path, [rows], schema), "taskid", "ts", "n", "1 hour"), "snaps", "complete", tmp_path)
    assert sorted((r["day"], r["taskid"], r["n"]) for r in got.collect()) == want


def test_each_batch(spark, tmp_path):
    s, seen = stream(spark, tmp_path, [[(1,)], [(2,)]], "n int"), []
    sinks.each_batch(s, lambda df, i: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination(120)
    assert sum(seen) == 2


def test_topology(spark):
    p = {"sources": "s,u", "s.topics": "a,b", "u.topics": "c", "processors": "q,p", "p.class": "double", "p.parents": "s", "q.class": "double", "q.parents": "p,u", "sinks": "k", "k.topic": "out", "k.parents": "q"}
    t = Topology.of(p)
    got = t.build(lambda topics: spark.createDataFrame([(len(topics),)], "n int"), {"double": lambda df: df.withColumn("n", F.col("n") * 2)})
    assert sorted(r[0] for r in got["out"].collect()) == [2, 8]
    with pytest.raises(ValueError):
        Topology.of({**p, "p.parents": "q"})
    with pytest.raises(ValueError):
        Topology.of({**p, "k.parents": "zzz"})


def test_batches_and_errors(spark):
    df = spark.range(0, 10, 1, 1).select(F.col("id").cast("string").alias("value"))
    sizes = lambda n: [r["n"] for r in sinks.send_batches(df, lambda t: t, n).collect()]
    assert sizes(4) == [4, 4, 2] and sizes(-1) == [1] * 10 and sizes(0) == [10]
    assert sinks.send_batches(df.limit(0), lambda t: t).count() == 0
    answers = spark.createDataFrame([(2, '{"items":[{"index":{"_id":"1","status":200}},{"update":{"_id":"2","status":409,"error":{"reason":"old"}}}]}')], "n long, response string")
    assert [tuple(r) for r in sinks.bulk_errors(answers).collect()] == [("update", "2", 409, "old")]


def test_retrying():
    tried = []

    def call(x):
        tried.append(x)
        if len(tried) < 3:
            raise OSError
        return x

    assert sinks.retrying(call, 3, 0)(7) == 7 and tried == [7, 7, 7]
    tried.clear()
    with pytest.raises(OSError):
        sinks.retrying(call, 2, 0)(7)


def test_poll_and_reset(spark, tmp_path):
    def run():
        seen = []
        q = sinks.poll(stream(spark, tmp_path, [], "k string"), lambda d, n: seen.append(d.count()), str(tmp_path / "c"), "1 second")
        q.processAllAvailable()
        q.stop()
        return sum(seen)

    spark.createDataFrame([("a",), ("b",)], "k string").write.json(str(tmp_path / "in"))
    assert run() == 2 and run() == 0
    assert sinks.reset(spark, str(tmp_path / "c")) and not sinks.reset(spark, str(tmp_path / "c"))
    assert run() == 2


def test_source_and_settings(spark, tmp_path, monkeypatch):
    import io

    (tmp_path / "a.json").write_text('{"n":1}\n{"n":2}\n')
    (tmp_path / "rows.js").write_text('[{"n":1},\n{"n":2}]')
    assert files.source(spark, "f", str(tmp_path)).count() == 2
    monkeypatch.setattr("sys.stdin", io.StringIO(f"{tmp_path}/a.json\n\n"))
    assert files.source(spark, "h").count() == 2
    monkeypatch.setattr("sys.stdin", io.StringIO("x\0y\0z"))
    assert [r["value"] for r in files.source(spark, "s", end="\0").collect()] == ["x", "y"]
    for kind, path, end in (("f", None, "\n"), ("q", "x", "\n"), ("s", None, "")):
        with pytest.raises(ValueError):
            files.source(spark, kind, path, end=end)
    assert files.json_rows(spark, str(tmp_path / "rows.js"), "n int").count() == 2
    got = files.settings("# r\nexport A='x y'\nB = 1\n\n[es]\nhost=h=1\n; no\n[empty]\n")
    assert got == {"": {"A": "x y", "B": "1"}, "es": {"host": "h=1"}, "empty": {}}
