"""Landed pages, sets of tables, keyed stores and the feed table function on small cases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import rank
from millrace.sources import landed, markup, tablesets
from millrace.streaming import queues
from millrace.streaming.upserts import KeyedStore


def put(root, series, page, body):
    os.makedirs(f"{root}/series={series}/page={page}")
    with open(f"{root}/series={series}/page={page}/part-0.json", "w") as out:
        out.write(body if isinstance(body, str) else json.dumps(body))


def answer(values, more):
    return {"results": [{"x": v} for v in values], "page_metadata": {"hasNext": more}}


@pytest.fixture
def service(tmp_path):
    put(tmp_path, "a", 1, answer([1, 2], True))
    put(tmp_path, "a", 2, answer([3], False))
    put(tmp_path, "a", 3, answer([9], True))  # left over from an earlier scan
    put(tmp_path, "b", 1, answer([1], True))
    put(tmp_path, "b", 2, "{broken")
    put(tmp_path, "b", 10, answer([], True))
    put(tmp_path, "c", 1, answer([1], True))
    put(tmp_path, "d%20e", 1, {"results": [{"x": "é"}]})
    put(tmp_path, "l", 1, [1, 2])
    return str(tmp_path)


@pytest.mark.parametrize("most", [1, 2, 64])
def test_pages_are_read_in_ranges_and_end_where_the_service_says(spark, service, most):
    pages = landed.landed_pages(spark, service, taskpages=most)
    assert pages.rdd.getNumPartitions() == {1: 9, 2: 5, 64: 1}[most]
    got = sorted((r["series"], r["page"], json.loads(r["item"])["x"]) for r in landed.scanned(pages).collect())
    assert got == [("a", 1, 1), ("a", 1, 2), ("a", 2, 3), ("b", 1, 1), ("c", 1, 1), ("d e", 1, "é")]
    ends = {r["series"]: (r["last"], r["complete"]) for r in landed.last_pages(pages).collect()}
    assert ends == {"a": (2, True), "b": (10, False), "c": (None, False), "d e": (1, True), "l": (None, False)}
    assert {(r["series"], r["page"]) for r in pages.where("fault IS NOT NULL").collect()} == {("b", 2), ("l", 1)}


def test_options_choose_files_before_any_is_opened(spark, service):
    every = landed.landed_pages(spark, service, taskpages=1)
    cases = [({"first": 2, "last": 2}, "page = 2", 2), ({"first": 3}, "page > 2", 2), ({"series": ["d e"]}, "series = 'd e'", 1), ({"series": ["a", "b"], "last": 1}, "page = 1 AND series IN ('a', 'b')", 2), ({"series": []}, "false", 1), ({"first": 77}, "false", 1)]
    for options, condition, n in cases:
        chosen = landed.landed_pages(spark, service, taskpages=1, **options)
        assert chosen.rdd.getNumPartitions() == n, options
        assert sorted(map(str, chosen.collect())) == sorted(map(str, every.where(condition).collect())), options
        assert every.count() == 10  # what one query chose holds for no other


def test_an_empty_folder_has_no_pages(spark, tmp_path):
    assert landed.landed_pages(spark, str(tmp_path)).count() == 0


def contents(spark, path):
    return {k: sorted(map(tuple, v.collect())) for k, v in tablesets.read_together(spark, path).items()}


def test_a_set_of_tables_appears_whole_or_not_at_all(spark, tmp_path):
    path = f"{tmp_path}/set"
    one = spark.createDataFrame([(1, ' a"b\r\nc, d\\ ', None), (2, "", "x")], 'id int, `t"x,y` string, u string')
    two = spark.createDataFrame([], "k string")
    tablesets.write_together({"one": one, "two": two}, path)
    first = {"one": [("1", ' a"b\r\nc, d\\ ', ""), ("2", "", "x")], "two": []}
    assert contents(spark, path) == first and tablesets.read_together(spark, path)["one"].columns == ["id", 't"x,y', "u"]
    files = sorted(os.listdir(path))
    bad = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tablesets.write_together({"one": spark.range(5), "two": bad}, path)
    assert contents(spark, path) == first and sorted(os.listdir(path)) == files
    tablesets.write_together({"three": spark.range(3, numPartitions=3)}, path)
    assert contents(spark, path) == {"three": [("0",), ("1",), ("2",)]}
    with pytest.raises(Exception, match="overwrite"):
        spark.createDataFrame([("three", "x")], "table string, line string").write.format("table_set").mode("append").option("headers", "{}").save(path)


def test_batches_may_come_late_again_and_out_of_order(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, ts int, v string").schema
    store = KeyedStore(spark, str(tmp_path), schema, ["k"], ["ts"], 4)
    assert store.rows().collect() == []
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    store.upsert(rows((1, 5, "a"), (2, 1, "b"), (None, 1, "z"), (1, 5, "a")), 0)
    second = rows((1, 3, "late"), (2, 2, "new"), (3, None, "n"))
    expected = [(1, 5, "a"), (2, 2, "new"), (3, None, "n")]
    for _ in range(2):  # the same batch again doubles nothing
        store.upsert(second, 1)
        assert sorted(map(tuple, store.rows().collect())) == expected
    store.upsert(rows((None, 9, "z")), 2)
    store.upsert(rows(), 3)
    assert sorted(os.listdir(f"{tmp_path}/commits")) == ["batch=0", "batch=1"]
    store.upsert(rows((3, 1, "n1"), (3, 1, "n2")), 4)  # a tie: the greater row
    assert sorted(map(tuple, store.rows().collect())) == [*expected[:2], (3, 1, "n2")]
    assert len([f for f in os.listdir(f"{tmp_path}/rows/batch=4") if f.startswith("bucket=")]) == 1


def test_a_batch_without_its_commit_is_not_seen(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, ts int").schema
    store = KeyedStore(spark, str(tmp_path), schema, ["k"], ["ts"], 2)
    store.upsert(spark.createDataFrame([(1, 1)], schema), 0)
    spark.createDataFrame([(1, 9, 0), (1, 9, 1)], "k int, ts int, bucket int").write.partitionBy("bucket").parquet(f"{tmp_path}/rows/batch=1")
    assert [tuple(r) for r in store.rows().collect()] == [(1, 1)]
    store.upsert(spark.createDataFrame([(1, 2)], schema), 1)
    assert [tuple(r) for r in store.rows().collect()] == [(1, 2)]


def test_the_feed_function_in_sql(spark):
    markup.register_functions(spark)
    bodies = [(1, b"<rss><item><title>T</title><link>u</link></item><item><link>v</link></item></rss>"), (2, b"<rss><item>"), (3, None), (4, b""), (5, b"<feed/>")]
    spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in bodies], "kind int, body binary").createOrReplaceTempView("landed_bodies")
    sql = "SELECT b.kind, f.kind, f.url FROM landed_bodies b, LATERAL feed_entries(b.body, {}) f ORDER BY 1, 3"
    assert [tuple(r) for r in spark.sql(sql.format("false")).collect()] == [(1, "rss", "u"), (1, "rss", "v"), *[(i, "invalido", "") for i in (2, 3, 4)]]
    assert [tuple(r) for r in spark.sql(sql.format("true")).collect()][0:2] == [(1, "rss", "u"), (2, "invalido", "")]
    spark.catalog.dropTempView("landed_bodies")


def test_lots_over_several_runs_do_what_lots_one_by_one_do(spark, tmp_path):
    schema = "queue long, lot long, item long, position long, result string"
    queue = [(q, i) for q in (1, 2) for i in range(8)]
    said = {(q, lot, i): ["done", "limit", "outside", None][(q + 3 * lot + i * i) % 4] for q, i in queue for lot in (1, 2, 3, 4, 5)}
    runs = [
        [(q, None, i, i, None) for q, i in queue if i < 6] + [(3, None, 7, 1, None)],
        [(q, 1, i, None, said[q, 1, i]) for q, i in queue] + [(3, 1, 99, None, "done"), (4, 1, 1, None, "done")],
        [(q, None, i, i, None) for q, i in queue if i >= 6] + [(q, lot, i, None, said[q, lot, i]) for lot in (3, 2) for q, i in queue],
        [(q, lot, i, None, said[q, lot, i]) for lot in (4, 5) for q, i in queue],
    ]
    for run in runs:
        spark.createDataFrame([r for r in run if r[1] is None or r[4]], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
        got = queues.run_lots(spark.readStream.schema(schema).parquet(f"{tmp_path}/landed"), 3, f"{tmp_path}/lots")
    rows = sorted(map(tuple, got.collect()))
    waiting = {(q, i): i for q, i in queue if i < 6}
    expected = []
    for lot in (1, 2, 3, 4, 5):
        if lot == 2:
            for q in (1, 2):
                top = max(p for (k, _), p in waiting.items() if k == q)
                waiting |= {(q, i): top + i for i in (6, 7)}
        before = dict(waiting)
        table = spark.createDataFrame([(q, i, p) for (q, i), p in waiting.items()], "q long, item long, pos long")
        results = spark.createDataFrame([(q, i, said[q, lot, i]) for q, i in queue], "q long, item long, result string").where("result IS NOT NULL")
        for q, item, pos, state in map(tuple, rank.queue_after(table, results, ["q"], "item", "pos", 3).select("q", "item", "pos", "state").collect()):
            if state != "queued":
                del waiting[q, item]
            waiting = waiting | {(q, item): pos} if state == "queued" else waiting
            if state != "queued" or pos != before[q, item]:
                expected.append((q, lot, item, state))
    assert rows == sorted(expected)


def test_a_batch_of_texts_is_written_slice_by_slice(tmp_path):
    import tracemalloc

    import pyarrow as pa

    n, text = 4_000, "x" * 5_000
    batch = pa.record_batch([pa.array(["t"] * n), pa.array([text] * n)], names=["table", "line"])
    writer = tablesets.TableSet({"path": f"file://{tmp_path}/set", "headers": '{"t": "line"}'}).writer(None, True)
    tracemalloc.start()
    files = writer.write(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    with open(f"{tmp_path}/set/{files.of['t']}") as f:
        assert sum(1 for _ in f) == n + 1
    assert peak < 4_000_000, peak


def test_files_of_several_landed_pages(spark, tmp_path):
    os.makedirs(f"{tmp_path}/series=a/pages=1-3")
    with open(f"{tmp_path}/series=a/pages=1-3/part-0.txt", "w") as f:
        f.write('1\t{"results":[1,2],"page_metadata":{"hasNext":true}}\n3\t{"results":[3],"page_metadata":{"hasNext":false}}\n2\t{"results":[4\n')
    got = sorted((r["page"], r["ord"], r["item"], r["fault"]) for r in landed.landed_pages(spark, f"file://{tmp_path}").collect())
    assert got == [(1, 0, "1", None), (1, 1, "2", None), (2, -1, None, "JSONDecodeError"), (3, 0, "3", None)]
    assert [r["item"] for r in landed.landed_pages(spark, f"file://{tmp_path}", first=3).collect()] == ["3"]


class Values:
    """State of one queue in memory, which counts the calls."""

    def __init__(self):
        self.value, self.held, self.calls = None, {}, 0

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            if name == "get":
                return self.value
            if name == "exists":
                return self.value is not None
            if name == "update":
                self.value = args[0]
            elif name == "clear":
                self.value = None
            elif name == "getValue":
                return self.held[args[0]]
            elif name == "updateValue":
                self.held[args[0]] = args[1]
            elif name == "removeKey":
                del self.held[args[0]]
            return None

        return call


class Handle:
    def __init__(self):
        self.states = []

    def getValueState(self, *_):
        self.states.append(Values())
        return self.states[-1]

    getMapState = getValueState


def work(processor, batches):
    """What lots give for batches of (lot, item, position, result), and the same from a plain list."""
    got, want, waiting = [], [], []
    for batch in batches:
        got += [tuple(r) for r in processor.handleInputRows((1,), iter([queues.Row(queue=1, lot=a, item=b, position=c, result=d) for a, b, c, d in batch]), None)]
        waiting += [b for _, b in sorted((c, b) for a, b, c, _ in batch if a is None)]
        for lot in sorted({a for a, *_ in batch if a is not None}):
            said = {b: d for a, b, _, d in batch if a == lot}
            for item in waiting[: processor.size]:
                result = said.get(item)
                if result is None:
                    continue
                waiting.remove(item)
                want.append((1, lot, item, "queued" if result == "limit" else result))
                if result == "limit":
                    waiting.append(item)
                    break
    return got, want, waiting


@pytest.mark.parametrize("size", [1, 3, 64, 100, 1000])
def test_long_queues_keep_their_order_over_blocks(size):
    import random

    deal = random.Random(size)
    handle, processor = Handle(), queues.Lots(size)
    processor.init(handle)
    batches, n, lot = [], 0, 0
    for _ in range(40):
        put = deal.choice([0, 0, 1, 63, 64, 65, 300])
        batch = [(None, i, i, None) for i in range(n, n + put)]
        n += put
        for _ in range(deal.randrange(4)):
            lot += 1
            batch += [(lot, i, None, deal.choice(["done", "done", "outside", "limit" if deal.random() < 0.2 else "done", None])) for i in range(n)]
        batches.append([r for r in batch if r[0] is None or r[3]])
    got, want, waiting = work(processor, batches)
    assert got == want
    head, tail, front = handle.states[0].value or (0, 0, [])
    assert [*front, *[i for b in range(head, tail) for i in handle.states[1].held[b,][0]]] == waiting and len(handle.states[1].held) == tail - head


def test_a_short_queue_needs_two_calls_to_the_state_a_batch():
    handle, processor = Handle(), queues.Lots(3)
    processor.init(handle)
    got, want, _ = work(processor, [[(None, i, i, None) for i in range(20)] + [(lot, i, None, "done") for lot in (1, 2) for i in range(20)], [(3, i, None, "limit") for i in range(20)]])
    assert got == want and len(got) == 7
    assert sum(s.calls for s in handle.states) <= 4
