"""Files, datasets, versions, slices, served views and flows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import flow
from tidemark.sources import facts, files
from tidemark.sources.dataset import Dataset
from tidemark.sources.fs import FileSystem
from tidemark.sources.history import History
from tidemark.sources.scratch import Scratch
from tidemark.sources.serving import VIEWS, BatchViews, SpeedViews
from tidemark.sources.timeline import WEEK_SECONDS as W
from tidemark.sources.timeline import Timeline

ROWS = T.StructType([T.StructField("a", T.LongType()), T.StructField("p", T.IntegerType())])


def numbers(spark, n=10, p=None):
    part = F.lit(p) if p is not None else F.col("id") % 2
    return spark.range(n).select(F.col("id").alias("a"), part.cast("int").alias("p"))


# -- files


def test_lines(spark, folder, rows_of):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    files.write_lines(df, f"{folder}/t", parts=1)
    assert rows_of(files.read_lines(spark, f"{folder}/t")) == [("1\t",), ("2\tx",)]
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_lines(df, f"{folder}/t")
    files.write_lines(df, f"{folder}/t", mode="UPDATE", compression="ENABLE")
    assert files.read_lines(spark, f"{folder}/t", order_key="at").count() == 4
    with pytest.raises(ValueError):
        files.read_lines(spark, f"{folder}/t.zip")


@pytest.mark.parametrize("header", [False, True])
def test_delimited_there_and_back(spark, folder, rows_of, header):
    df = spark.createDataFrame([(1, "a,b", 'q"x'), (2, None, "c"), (3, " d ", "")], "i int, s string, u string")
    files.write_delimited(df, f"{folder}/d", ",", '"', header=header)
    found = files.read_delimited(
        spark, f"{folder}/d", None if header else df.columns, ",", '"', types=["int", "string", "string"]
    )
    assert found.columns == df.columns
    assert rows_of(found) == sorted([(1, "a,b", 'q"x'), (2, None, "c"), (3, " d ", None)], key=repr)


def test_delimited_rules(spark, folder, rows_of):
    lines = ["1,a,2", "2,b", "3,c,x", "4,d,5,more", ",,"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{folder}/d")

    def read(**options):
        return files.read_delimited(spark, f"{folder}/d", ["k", "s", "n"], ",", **options)

    typed = {"types": ["int", "string", "int"]}
    good, bad = read(trap=True)
    assert rows_of(bad) == [("2,b",)]
    assert ("4", "d", "5,more") in rows_of(good)
    good, bad = read(trap=True, safe=False, **typed)
    assert rows_of(bad) == [("2,b",), ("3,c,x",), ("4,d,5,more",)]
    assert rows_of(good) == sorted([(1, "a", 2), (0, None, 0)], key=repr)
    lenient = rows_of(read(strict=False, **typed))
    assert (2, "b", 0) in lenient and (3, "c", None) in lenient
    with pytest.raises(Exception, match="malformed line"):
        read().collect()


def test_tables_and_pairs(spark, folder, rows_of):
    df = spark.createDataFrame([("x", "y")], "k string, v string")
    files.write_key_value_bytes(df, f"{folder}/b", "k", "v")
    assert [(bytes(k), bytes(v)) for k, v in files.read_key_value_bytes(spark, f"{folder}/b").collect()] == [(b"x", b"y")]
    files.write_key_values(df, f"{folder}/v", value="v")
    assert files.read_table(spark, [f"{folder}/v"]).columns == ["value"]
    with pytest.raises(ValueError):
        files.write_key_values(df, f"{folder}/none")
    files.discard_rows(df)
    with pytest.raises(ValueError):
        files.read_nothing()


def test_template_sink_keeps_fields(spark, folder):
    files.template_sink(numbers(spark), f"{folder}/t", ["p"], keep_fields=True)
    assert set(FileSystem(spark, folder).list(f"{folder}/t")) >= {"p_path=0", "p_path=1"}
    assert files.read_table(spark, f"{folder}/t/p_path=1").select("p").distinct().count() == 1


# -- datasets


def test_dataset(spark, folder, rows_of):
    d = Dataset.create(spark, f"{folder}/d", ROWS, ("p",), valid="p IN (0, 1)")
    assert d.is_empty()
    d.append(numbers(spark))
    assert rows_of(d.read()) == rows_of(numbers(spark))
    assert len(list(d)) == 10
    part = d.read("p = 1")
    assert part.count() == 5
    assert "PartitionFilters: [isnotnull(p" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileExistsError):
        Dataset.create(spark, f"{folder}/d", ROWS)
    with pytest.raises(ValueError):
        Dataset.create(spark, f"{folder}/d", ROWS, fail_on_exists=False)
    with pytest.raises(ValueError):
        d.append(spark.range(1))
    with pytest.raises(Exception, match="outside the layout"):
        d.append(numbers(spark, p=7))
    with pytest.raises(FileNotFoundError):
        Dataset.open(spark, f"{folder}/nothing")
    d.set_metadata("note", "hello")
    again = Dataset.open(spark, f"{folder}/d")
    assert again.spec == d.spec
    assert (again.metadata("note"), again.metadata("other"), again.metadata_names()) == ("hello", None, ["note"])
    assert again.delete_metadata("note") and again.metadata("note") is None


def test_snapshot_and_moves(spark, folder, rows_of):
    d = Dataset.create(spark, f"{folder}/d", ROWS, ("p",))
    d.append(numbers(spark))
    snapshot = d.snapshot()
    d.append(numbers(spark, 3, p=5))
    assert snapshot.read().count() == 10
    d.delete_snapshot(snapshot)
    assert d.read().count() == 3
    e = d.empty_copy(f"{folder}/e")
    e.absorb(d)
    assert (d.read().count(), e.read().count()) == (0, 3)
    e.copy_append(e)
    assert e.read().count() == 6
    gz = e.coerce(f"{folder}/gz", "gzip")
    assert all(".gz.parquet" in f for f, _ in gz.files())
    gz.absorb(e)  # other compression: copied
    assert (e.read().count(), gz.read().count()) == (6, 12)
    with pytest.raises(ValueError):
        gz.move_append(e)
    gz.clear()
    assert gz.is_empty()


def test_consolidate(spark, folder, rows_of):
    d = Dataset.create(spark, f"{folder}/d", ROWS, ("p",))
    for _ in range(3):
        d.append(numbers(spark))
    d.append(numbers(spark, 2, p=9))
    before = rows_of(d.read())
    assert len(d.files()) == 7
    assert d.consolidate() == 6
    assert len(d.files()) == 3
    assert rows_of(d.read()) == before
    assert d.consolidate() == 0


def test_a_change_dies_before_or_after_its_commit(spark, folder, rows_of, monkeypatch):
    d = Dataset.create(spark, f"{folder}/d", ROWS, ("p",))
    other = d.empty_copy(f"{folder}/e")
    d.append(numbers(spark))
    other.append(numbers(spark, 4, p=3))

    def die(*_):
        raise KeyboardInterrupt

    # Before: nothing happened.
    with pytest.raises(Exception, match="outside the layout"):
        d.replace(other.read().select("a", F.when(F.raise_error(F.lit("outside the layout")).isNull(), 3).alias("p")), d.snapshot())
    d = Dataset.open(spark, f"{folder}/d")
    assert rows_of(d.read()) == rows_of(numbers(spark)) and len(FileSystem(spark, folder).list(f"{folder}/d")) == 3
    d.drop_unfinished()
    assert rows_of(d.read()) == rows_of(numbers(spark)) and len(FileSystem(spark, folder).list(f"{folder}/d")) == 2
    # After: it is there, and what it replaced is not, though the folders still are.
    for gone, want in ((d.snapshot(), numbers(spark, 4, p=3)), (other.snapshot(), numbers(spark, 8, p=3))):
        with monkeypatch.context() as m:
            m.setattr(Dataset, "settle", die)
            with pytest.raises(KeyboardInterrupt):
                d.replace(numbers(spark, 4, p=3), gone)
        rows = d.read()
        assert rows.count() == want.count() and rows.where("p <> 3").isEmpty()
        d = Dataset.open(spark, f"{folder}/d")
        assert d.read().count() == want.count()
    assert other.read().count() == 0
    assert not FileSystem(spark, folder).glob(folder, "*/change=*/_replaces")


def test_ingest_after_a_crash_takes_nothing_twice(spark, folder, monkeypatch):
    from tidemark import schema

    new, master = facts.open_new_data(spark, f"{folder}/new"), facts.open_master(spark, f"{folder}/master")
    views = spark.range(5).select(
        schema.user_person("id").alias("person"), F.lit("u").alias("url"), F.col("id").alias("nonce"), F.lit(1).alias("ts")
    )
    facts.append_facts(new, views, schema.PAGE_VIEW)
    settle = Dataset.settle
    calls = []

    def first_only(self):
        calls.append(self)
        if len(calls) > 1:
            raise KeyboardInterrupt
        settle(self)

    with monkeypatch.context() as m:
        m.setattr(Dataset, "settle", first_only)
        with pytest.raises(KeyboardInterrupt):
            facts.ingest(master, new)
    assert master.read().count() == 5
    facts.append_facts(new, views, schema.PAGE_VIEW)
    assert facts.ingest(master, new) == 1
    assert (master.read().count(), new.read().count()) == (10, 0)


@pytest.mark.parametrize("change", ["append", "snapshot", "absorb", "ingest", "consolidate", "clear"])
def test_calls_of_the_file_system_do_not_grow_with_the_files(spark, folder, monkeypatch, change):
    """The same few calls for a change of three files and for one of sixty."""

    def calls(files):
        d = Dataset.create(spark, f"{folder}/{files}", ROWS, ("p",))
        many = spark.range(120).select(F.col("id").alias("a"), (F.col("id") % files).cast("int").alias("p"))
        d.append(many)
        assert len(d.files()) == files
        seen = []
        with monkeypatch.context() as m:
            for name in ("exists", "mkdirs", "delete", "rename", "list", "glob", "write_text", "read_text", "files"):
                method = getattr(FileSystem, name)
                m.setattr(FileSystem, name, lambda self, *a, f=method, n=name, **k: seen.append(n) or f(self, *a, **k))
            if change == "append":
                d.append(many)
            elif change == "snapshot":
                d.delete_snapshot(d.snapshot())
            elif change == "absorb":
                d.empty_copy(f"{folder}/to-{files}").absorb(d)
            elif change == "ingest":
                Dataset.create(spark, f"{folder}/master-{files}", ROWS, ("p",)).replace(d.read(), d.snapshot())
            elif change == "consolidate":
                d.append(many)
                assert d.consolidate() == 2 * files
            else:
                d.clear()
        return seen

    assert calls(3) == calls(60)


def test_facts_outside_the_kinds_are_refused(spark, folder):
    from tidemark import schema

    master = facts.open_master(spark, f"{folder}/m")
    views = spark.range(1).select(
        schema.user_person("id").alias("person"), F.lit("u").alias("url"), F.col("id").alias("nonce"), F.lit(1).alias("ts")
    )
    wrong = schema.to_facts(views.withColumn("value_kind", F.lit(9)), schema.PAGE_VIEW)
    with pytest.raises(Exception, match="outside the layout"):
        master.append(wrong)
    facts.append_facts(master, views, schema.PAGE_VIEW)
    plan = facts.read_kinds(master, schema.EQUIV)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "unit" in plan.split("PartitionFilters: [")[1][:60]


# -- versions and slices


def test_history(spark, folder):
    store = History(spark, f"{folder}/v")
    assert store.latest() is None and store.numbers() == []
    with pytest.raises(FileNotFoundError, match="empty"):
        store.read()
    for number in (5, 7, 9):
        store.add(spark.range(number), number, keep=None)
    assert (store.latest(), store.latest(8), store.latest(4)) == (9, 7, None)
    assert store.read().count() == 9 and store.read(5).count() == 5
    with pytest.raises(FileExistsError):
        store.add(spark.range(1), 7)
    # What fails is not listed, and leaves no folder.
    names = FileSystem(spark, folder).list(f"{folder}/v")
    with pytest.raises(KeyError):
        with store.adding(11) as (_, path):
            spark.range(3).write.parquet(path)
            assert store.latest() == 9
            raise KeyError
    with pytest.raises(FileNotFoundError, match="nothing was written"):
        with store.adding(11):
            pass
    assert FileSystem(spark, folder).list(f"{folder}/v") == names
    store.trim(-1)
    assert store.numbers() == [5, 7, 9]
    store.trim(2)
    assert store.numbers() == [7, 9]
    store.forget([7, 100])
    assert store.add(spark.range(1)) > 9 and len(store.numbers()) == 2
    with pytest.raises(FileNotFoundError):
        store.read(7)


def test_timeline(spark, folder, rows_of):
    line = Timeline.create(spark, f"{folder}/s", T.StructType([T.StructField("a", T.LongType())]))
    rows = spark.range(4).select(F.col("id").alias("a"))
    assert line.span() == (None, None) and line.read_closed().count() == 0
    # One pass fills several slices, in two weeks.
    line.add(rows, F.when(F.col("a") < 2, W).when(F.col("a") < 3, W + 60).otherwise(2 * W))
    assert sorted(map(tuple, line.slices().collect())) == [(W, W, False), (W, W + 60, False), (2 * W, 2 * W, False)]
    with pytest.raises(ValueError, match="not closed"):
        line.read(W)
    line.close([W, 2 * W + 5])
    assert line.span() == (W, 2 * W + 5) and line.span(W) == (W, W) and line.span(0) == (None, None)
    assert rows_of(line.read(W)) == [(0, W, W), (1, W, W)] == rows_of(line.read_closed())
    assert line.read(2 * W + 5).count() == 0
    line.close(line.slices().where("slice_start = 2 * 604800"))
    assert rows_of(line.read_closed().select("a")) == [(0,), (1,), (3,)]
    for late in (W, 0, 2 * W + 5, F.lit(None)):
        with pytest.raises(Exception, match="no open slice"):
            line.add(rows, late)

    newer = Timeline.create(spark, f"{folder}/n", T.StructType([T.StructField("a", T.LongType())]))
    newer.add(rows, 3 * W)
    newer.close([3 * W])
    opened = Timeline.open(spark, f"{folder}/s")
    opened.extend(newer)
    assert opened.span()[1] == 3 * W and opened.read_closed().count() == 7
    for move in (False, True):
        with pytest.raises(ValueError, match="not newer"):
            opened.extend(newer, move)
    # Compaction of one slice leaves the others.
    before = {p for p, _ in opened.rows.files() if f"slice_start={3 * W}" not in p}
    opened.consolidate(3 * W)
    assert {p for p, _ in opened.rows.files() if f"slice_start={3 * W}" not in p} == before
    assert opened.read(3 * W).count() == 4


def test_control_characters_and_blank_lines_under_a_header(spark, folder, rows_of):
    spark.createDataFrame([("a\u0001b",), ("1\u0001x\ty",), ("2\u0001",)], "value string").coalesce(1).write.text(f"{folder}/c")
    found = files.read_delimited(spark, f"{folder}/c", delimiter="\u0001")
    assert rows_of(found) == [("1", "x\ty"), ("2", None)]
    df = spark.createDataFrame([("x\u0001y", "z"), ("q", None)], "k string, v string")
    files.write_delimited(df, f"{folder}/h", header=True, parts=2)
    assert rows_of(files.read_delimited(spark, f"{folder}/h")) == rows_of(df)
    spark.createDataFrame([("k\tv",), ("",), ("1\t2",)], "value string").coalesce(1).write.text(f"{folder}/b")
    good, bad = files.read_delimited(spark, f"{folder}/b", trap=True)
    assert rows_of(good) == [("1", "2")] and rows_of(bad) == [("",)]


def test_many_quotes(spark, folder, rows_of):
    value = 'a,""' * 10_000
    lines = [f'"{value}",t', 'x,"y,z"', 'p,q', 'u,"a\u0001,\u0002b",c\u0001']
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{folder}/q")
    found = files.read_delimited(spark, f"{folder}/q", ["k", "v"], ",", '"')
    assert rows_of(found) == sorted(
        [("a,\"" * 10_000, "t"), ("x", "y,z"), ("p", "q"), ("u", '"a\u0001,\u0002b",c\u0001')], key=repr
    )


def test_opening_leaves_a_running_change_alone(spark, folder, monkeypatch):
    stored = Dataset.create(spark, f"{folder}/d", ROWS, ["p"])
    gone = Dataset.create(spark, f"{folder}/e", ROWS, ["p"])
    gone.append(numbers(spark))
    add = Dataset._add

    def open_and_add(self, *given):
        FileSystem(spark, folder).mkdirs(f"{folder}/d/change=1-unfinished/p=1")
        Dataset.open(spark, f"{folder}/d")
        name = add(self, *given)
        Dataset.open(spark, f"{folder}/d")
        return name

    monkeypatch.setattr(Dataset, "_add", open_and_add)
    stored.replace(gone.read(), gone.snapshot())
    assert stored.read().count() == 10 and gone.is_empty()
    assert "change=1-unfinished" in FileSystem(spark, folder).list(f"{folder}/d")


# -- served views and flows


def test_served_views(spark, folder):
    served = BatchViews(spark, f"{folder}/views", keep=2)
    with pytest.raises(FileNotFoundError):
        served.read(VIEWS[0])
    served.publish(VIEWS[0], spark.range(1))
    with pytest.raises(RuntimeError, match="without a new version"):
        served.replace()
    for n in range(2, 6):
        for view in VIEWS:
            served.publish(view, spark.range(n))
        if n > 2:
            assert served.read(VIEWS[0]).count() == n - 1  # not live yet
        served.replace()
        assert all(served.read(view).count() == n for view in VIEWS)
    assert len(History(spark, f"{folder}/views/{VIEWS[1]}").numbers()) == 2
    with pytest.raises(ValueError):
        served.publish("other", spark.range(1))


def test_speed_views(spark, folder):
    speed = SpeedViews(spark, f"{folder}/speed")
    for view in VIEWS:
        for number in (0, 1):
            spark.range(3).write.parquet(speed.path(view, number))
    assert speed.current() == 1 and speed.update() == 0
    count = lambda view, n: spark.read.parquet(speed.path(view, n)).count()
    assert [count(v, 1) for v in VIEWS] == [0, 0, 0] and [count(v, 0) for v in VIEWS] == [3, 3, 3]
    assert spark.read.parquet(speed.path(VIEWS[0], 1)).columns == ["id"]
    assert SpeedViews(spark, f"{folder}/speed").update() == 1
    assert count(VIEWS[0], 0) == 0


def test_flow(spark, folder):
    source, sink = f"{folder}/in", f"{folder}/out"
    assert not flow.sinks_exist(spark, [sink]) and not flow.sinks_fresh(spark, [source], [sink])
    files.write_table(spark.range(5), source)
    kept = flow.checkpoint(spark.read.parquet(source), sink=sink)
    assert kept.count() == 5 and flow.sinks_exist(spark, [sink]) and flow.sinks_fresh(spark, [source], [sink])
    files.write_table(spark.range(6), source, "REPLACE")
    assert not flow.sinks_fresh(spark, [source], [sink])
    with pytest.raises(FileNotFoundError):
        flow.sinks_fresh(spark, [f"{folder}/missing"], [sink])
    deep = f"{folder}/deep"
    files.write_table(spark.range(5), f"{deep}/a=1/b=1")
    files.write_table(spark.range(5), sink, "REPLACE")
    assert flow.sinks_fresh(spark, [deep], [sink])
    files.write_table(spark.range(6), f"{deep}/a=1/b=1", "UPDATE")
    assert not flow.sinks_fresh(spark, [deep], [sink])
    assert flow.run_unless(True, lambda: 1) is None and flow.run_unless(False, lambda: 1) == 1
    scratch = Scratch(spark, "flow")
    assert flow.checkpoint(spark.range(3), scratch).count() == 3
    assert flow.assemble(spark.range(9), lambda d: d.where("id > 3"), lambda d: d.limit(2)).count() == 2


def lines_with_offsets(data: bytes) -> list[tuple[int, str]]:
    """Offsets and lines straight from the bytes: a line ends with a feed, a return, or both."""
    found, start, at = [], 0, 0
    while at < len(data):
        if data[at] in b"\r\n":
            found.append((start, data[start:at].decode()))
            at += 2 if data[at : at + 2] == b"\r\n" else 1
            start = at
        else:
            at += 1
    return found + ([(start, data[start:].decode())] if start < len(data) else [])


OFFSET_FILES = {
    "plain": b"a\nbb\n\nccc\n", "no_end": "é\nü".encode(), "windows": "ä\r\n\r\nb\r\n".encode(),
    "mac": b"a\rbb\r\rc\r", "mixed": b"a\rb\r\nc\n\rd\r\r\n\n", "empty": b"", "one": b"\n",
    "many": "".join(f"{'x' * (i % 50)}ß{i}\n" for i in range(4000)).encode(),
}


@pytest.mark.parametrize("block", ["134217728", "777"])
def test_byte_offsets_of_lines(spark, tmp_path, block):
    """Files of any line ends, read whole or in many blocks, several to a task."""
    for name, data in OFFSET_FILES.items():
        (tmp_path / name).write_bytes(data)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = files.read_offsets(spark, [str(tmp_path), str(tmp_path)], with_path=True).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    got = {name: sorted((r["offset"], r["line"]) for r in found if r["path"].endswith("/" + name)) for name in OFFSET_FILES}
    assert got == {name: lines_with_offsets(data) for name, data in OFFSET_FILES.items()}


def test_every_reading_of_a_file_loses_its_header(spark, folder, rows_of):
    for name, rows in (("a", [(1, "x"), (2, "y")]), ("b", [(3, "z")]), ("c", [])):
        made = spark.createDataFrame(rows, "k int, s string").coalesce(1)
        files.write_delimited(made, f"{folder}/{name}", ",", header=True)
    paths = [f"{folder}/{name}" for name in "abcaa"]
    got = files.read_delimited(spark, paths, ["k", "s"], ",", types=["int", "string"], header=True)
    assert rows_of(got) == sorted([(1, "x"), (2, "y")] * 3 + [(3, "z")])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_headers_of_files_in_many_blocks(spark, folder, rows_of):
    made = spark.range(3000).selectExpr("id AS k", "repeat('y', id % 40) AS s").repartition(3)
    files.write_delimited(made, f"{folder}/big", "|", header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        got = files.read_delimited(spark, f"{folder}/big", delimiter="|", types=["long", "string"])
        assert rows_of(got.selectExpr("k", "coalesce(s, '') AS s")) == rows_of(made)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_views_of_a_batch_go_live_together(spark, folder, monkeypatch):
    """At every file-system call of a switch, a reader of several views sees one batch."""
    served = BatchViews(spark, f"{folder}/views", keep=2)

    def publish(n):
        for view in VIEWS:
            served.publish(view, spark.range(n))

    publish(1)
    served.replace()
    old = served.live()
    publish(2)
    seen = []

    def looked(method):
        def call(self, *args, **named):
            sizes = {served.live().read(view).count() for view in VIEWS} if not busy else set()
            seen.extend([sizes] if sizes else [])
            busy.append(1)
            try:
                return method(self, *args, **named)
            finally:
                busy.pop()

        return call

    busy = []
    for name in ("replace_text", "write_text", "delete", "rename"):
        monkeypatch.setattr(FileSystem, name, looked(getattr(FileSystem, name)))
    served.replace()
    monkeypatch.undo()
    assert seen and all(sizes in ({1}, {2}) for sizes in seen)
    assert {served.read(view).count() for view in VIEWS} == {2}
    assert {old.read(view).count() for view in VIEWS} == {1}  # what was taken stays as it was
    served.register()
    assert spark.sql("SELECT (SELECT count(*) FROM page_view) + (SELECT count(*) FROM bounce_view)").first()[0] == 4


def test_files_are_copied_in_balance(spark, tmp_path):
    """Big and small files in folders; every task gets as many of each size; bytes and places stay."""
    import zlib

    from pyspark import TaskContext

    source, target = tmp_path / "a", tmp_path / "b"
    for i in range(24):
        (source / f"p={i % 3}").mkdir(parents=True, exist_ok=True)
        (source / f"p={i % 3}" / f"f{i}.bin").write_bytes(bytes([i]) * (100_000 if i < 8 else i - 7))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(source)).select("path", "length")
    done = files.copy_files(listed, str(source), str(target), tasks=4)
    rows = done.collect()
    want = {str(p.relative_to(source)): p.read_bytes() for p in source.rglob("*.bin")}
    assert {r["path"]: (r["length"], r["crc32"]) for r in rows} == {k: (len(v), zlib.crc32(v)) for k, v in want.items()}
    assert {str(p.relative_to(target)): p.read_bytes() for p in target.rglob("*") if p.is_file()} == want

    def bytes_of_task(batches):
        import pyarrow as pa

        sizes = [sum(b.column("length").to_pylist()) for b in batches]
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([sum(sizes)])], names=["task", "bytes"])

    shares = done.mapInArrow(bytes_of_task, "task bigint, bytes bigint").collect()
    assert len(shares) == 4 and all(200_000 <= r["bytes"] < 200_100 for r in shares)
    assert not files.can_copy("viewfs://nowhere/a", str(target))


def test_a_copy_is_complete_or_not_there(spark, folder, rows_of, monkeypatch):
    d = Dataset.create(spark, f"{folder}/d", ROWS, ("p",))
    assert d.copy_to(f"{folder}/none").is_empty()
    for _ in range(3):
        d.append(numbers(spark))
    d.append(numbers(spark).where("false"))
    d.set_metadata("note", "x")
    copy = d.copy_to(f"{folder}/e")
    assert rows_of(copy.read()) == rows_of(d.read()) and copy.metadata("note") == "x"
    assert [f.rsplit("/d/")[-1] for f, _ in d.files()] == [f.rsplit("/e/")[-1] for f, _ in copy.files()]
    copy.append(numbers(spark))
    assert (copy.read().count(), d.read().count()) == (40, 30)

    def die(self, path, text, overwrite=True):
        raise KeyboardInterrupt

    half = d.empty_copy(f"{folder}/half")
    with monkeypatch.context() as m:
        m.setattr(FileSystem, "write_text", die)
        with pytest.raises(KeyboardInterrupt):
            half._copy_files(d)
    assert half.is_empty()
    half.drop_unfinished()
    assert half.is_empty() and FileSystem(spark, folder).list(f"{folder}/half") == ["_meta"]
    monkeypatch.setattr("tidemark.sources.dataset.can_copy", lambda *_: False)
    assert rows_of(d.copy_to(f"{folder}/rows").read()) == rows_of(d.read())


def test_a_scratch_nobody_closes_goes_with_the_driver(spark):
    left, closed = Scratch(spark, "left"), Scratch(spark, "closed")
    stored = left.save(spark.range(3), "t")
    assert stored.count() == 3
    closed.close()
    left._left()
    assert not FileSystem(spark, left.root).exists(left.root)
    left.close()
