"""Stateful stream functions: replays are idempotent, late chunks dropped."""

import pandas as pd
from pyspark.sql import functions as F

from quire.streaming import streams as st


class FakeState:
    """A group state; ``hasTimedOut`` and the duration can be looked at."""

    def __init__(self):
        self.value, self.hasTimedOut, self.duration = None, False, None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.duration = ms


class FakeHandle:
    """The two states of an ordered processor, kept in memory."""

    class Value:
        def __init__(self):
            self.v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    class List:
        def __init__(self):
            self.rows = []

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def clear(self):
            self.rows = []

    def getValueState(self, name, schema, ttl=None):
        return FakeHandle.Value()

    def getListState(self, name, schema, ttl=None):
        return FakeHandle.List()


def run_processor(p, key, rows, columns):
    frames = [pd.DataFrame(rows, columns=[p.key, "id", *columns])]
    return [tuple(r) for out in p.handleInputRows((key,), iter(frames), None) for r in out.itertuples(index=False)]


def chat(lateness):
    p = st.ChatHistory("user", lateness, None)
    p.init(FakeHandle())
    return p


def sink(told):
    """The last version of each row: (key, id, ...rest, version)."""
    last = {}
    for row in told:
        if row[-1] >= last.get(row[1], (-1,))[-1]:
            last[row[1]] = row
    return {i: r[2:-1] for i, r in last.items()}


def test_chat_history_replay_and_late_events():
    p, cols = chat(1 << 40), ["clear", "text"]
    first = [("u", 1, False, "a"), ("u", 5, False, "e")]
    told = run_processor(p, "u", first, cols)
    assert sink(told) == {1: (0, 1, "a"), 5: (0, 2, "a\ne")}
    assert run_processor(p, "u", first, cols) == []  # replayed
    told += run_processor(p, "u", [("u", 3, False, "c"), ("u", 4, True, "x"), ("u", 6, False, None), ("u", 7, False, "g")], cols)
    assert sink(told) == {1: (0, 1, "a"), 3: (0, 2, "a\nc"), 4: (1, 0, ""), 5: (1, 1, "e"), 7: (1, 2, "e\ng")}


def test_chat_history_with_bounded_lateness():
    p, cols = chat(3), ["clear", "text"]
    told = run_processor(p, "u", [("u", 1, False, "a"), ("u", 2, True, None), ("u", 9, False, "i")], cols)
    assert [r[0] for r in p.held.rows] == [9]  # 1 and 2 are final, 9 may still move
    told += run_processor(p, "u", [("u", 2, False, "late"), ("u", 7, False, "g")], cols)  # 2 is too late, 7 is not
    assert sink(told) == {1: (0, 1, "a"), 2: (1, 0, ""), 7: (1, 1, "g"), 9: (1, 2, "g\ni")}


def test_state_does_not_grow_with_the_events():
    p = st.RunState("run", 10, 5, None)
    p.init(FakeHandle())
    for k in range(0, 2000, 20):
        run_processor(p, 1, [(1, e, float(e % 7)) for e in range(k, k + 20)], ["loss"])
        assert len(p.held.rows) <= 6


def test_run_state_equals_a_batch(spark):
    """Random order within the lateness, NaN values: the last versions equal
    one pass over the sorted run."""
    import random
    rng = random.Random(4)
    events = [(e, float("nan") if rng.random() < 0.2 else round(rng.random() * 9, 2)) for e in range(230)]
    mixed = sorted(events, key=lambda x: x[0] + rng.random() * 15)
    p = st.RunState("run", 20, 40, None)
    p.init(FakeHandle())
    told = []
    for k in range(0, 230, 23):
        told += run_processor(p, 7, [(7, *x) for x in mixed[k:k + 23]], ["loss"])
    want, best, best_step = {}, None, None
    for k in range(0, 230, 20):
        total = 0.0
        for i, (e, x) in enumerate(events[k:k + 20]):
            if x != x:
                total += total / (1 + i)
            else:
                total += x
                if best is None or x > best:
                    best, best_step = x, e
        n = len(events[k:k + 20])
        want[k // 20] = (n, total / n, best, best_step)
    got = sink(told)
    assert got.keys() == want.keys()
    for k, (n, loss, top, step) in want.items():
        assert got[k][0] == n and abs(got[k][1] - loss) < 1e-9 and got[k][2:] == (top, step)


def test_chunk_state_out_of_order_and_late():
    fn = st._chunk_state_fn("</s>", "request_id", 1000)
    s = FakeState()
    b1 = pd.DataFrame({"seq": [1], "text": ["llo</s>x"], "last": [False]})
    out = pd.concat(list(fn(("r",), iter([b1]), s)))  # waits for chunk 0, but is known
    assert out["text"].tolist() == [""] and out["done"].tolist() == [False]
    b2 = pd.DataFrame({"seq": [0], "text": ["he"], "last": [False]})
    out = pd.concat(list(fn(("r",), iter([b2]), s)))
    assert out["text"].tolist() == ["hello"] and out["done"].tolist() == [True] and s.duration == 1000
    late = pd.DataFrame({"seq": [2], "text": ["y"], "last": [True]})
    assert list(fn(("r",), iter([late]), s)) == []
    s.hasTimedOut = True
    assert list(fn(("r",), iter([]), s)) == [] and not s.exists  # the tombstone is gone


def test_streams_over_several_micro_batches(spark, tmp_path):
    """Three files, one micro-batch each, with ids out of order and text keys."""
    parts = [[("u1", 1, False), ("u1", 5, False), ("u2", 2, False)], [("u1", 3, True), ("u1", 4, False)],
             [("u2", 1, True), ("u1", 6, False), ("u2", 3, False)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "user string, event_id long, clear boolean").coalesce(1) \
            .write.parquet(f"{tmp_path}/e/{i}")
    ev = spark.readStream.schema("user string, event_id long, clear boolean").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(f"{tmp_path}/e")
    h = st.chat_history_stream(ev, user="user", text=F.concat(F.lit("m"), F.col("event_id").cast("string")),
                               is_clear=F.col("clear"), lateness=100, ttl=3_600_000)
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(key, "false")  # a stream with time to live has no end of its own
    try:
        st.run_available_now(h, f"{tmp_path}/eo", f"{tmp_path}/ec")
    finally:
        spark.conf.unset(key)
    got = {(r["user"], r["event_id"]): (r["segment"], r["history_len"], r["history"])
           for r in st.latest(spark.read.parquet(f"{tmp_path}/eo"), ["user", "event_id"]).collect()}
    want = {}
    for user in ("u1", "u2"):
        seg, texts = 0, []
        for e, clear in sorted((e, c) for rows in parts for u, e, c in rows if u == user):
            seg, texts = (seg + 1, []) if clear else (seg, [*texts, f"m{e}"])
            want[user, e] = (seg, len(texts), "\n".join(texts))
    assert got == want

    chunks = [[("a", 1, "lo", False), ("b", 0, "never ", False)], [("a", 0, "hel", False), ("b", 2, "gap", False)],
              [("a", 2, "#x", False), ("c", 0, "end", True)]]
    for i, rows in enumerate(chunks):
        spark.createDataFrame(rows, "k string, seq long, t string, last boolean").coalesce(1).write.parquet(f"{tmp_path}/c/{i}")
    cs = spark.readStream.schema("k string, seq long, t string, last boolean").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", True).parquet(f"{tmp_path}/c")
    a = st.chunk_assembly_stream(cs, "#", key="k", seq="seq", text="t", last="last")
    st.run_available_now(a, f"{tmp_path}/co", f"{tmp_path}/cc")
    out = st.assembled(spark.read.parquet(f"{tmp_path}/co")).collect()
    assert {r["request_id"]: (r["text"], r["done"]) for r in out} == {
        "a": ("hello", True), "b": ("never ", False), "c": ("end", True)}


def test_dealt_batches(spark):
    df = spark.range(50).repartition(3)
    for drop, n in ((True, 48), (False, 50)):
        rows = st.deal_batches(df, ["id"], 3, 4, drop_last=drop).collect()
        assert len(rows) == n and all(r["group"] == r["id"] // 12 and r["shard"] == r["id"] // 4 % 3 for r in rows)


def test_dealt_stream_over_several_micro_batches(spark, scratch):
    """Rows that a micro-batch leaves over are dealt with those of the next."""
    start = 0
    for k, n in enumerate((50, 5, 3, 40)):
        spark.range(start, start + n).coalesce(1).write.parquet(f"{scratch}/in/k={k}")
        start += n
    s = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True) \
        .parquet(f"{scratch}/in")
    st.dealt_stream(s, ["id"], 3, 4, f"{scratch}/out", f"{scratch}/ckpt")
    rows = spark.read.parquet(f"{scratch}/out").collect()
    assert {r["epoch"] for r in rows} == {0, 3}  # two micro-batches are shorter than a group
    places = {}
    for r in rows:
        places[r["group"], r["shard"]] = places.get((r["group"], r["shard"]), 0) + 1
    assert places == {(g, w): 4 for g in range(98 // 12) for w in range(3)}
    assert len({r["id"] for r in rows}) == 96
    left = spark.read.parquet(f"{scratch}/ckpt/carried/3/rows").count()
    assert left == 2


def test_monitor_reports_open_windows(spark, scratch):
    spark.createDataFrame([(1, 0, "2024-01-01 10:00:00", 2.0), (1, 1, "2024-01-02 00:30:00", 4.0)],
                          "user_id long, event_id long, ts string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{scratch}/in")
    s = spark.readStream.schema("user_id long, event_id long, ts timestamp, value double").parquet(f"{scratch}/in")
    st.run_versions(st.run_monitor_stream(s, "ts", "user_id", "value", step="event_id"), f"{scratch}/out", f"{scratch}/ckpt")
    got = st.latest(spark.read.parquet(f"{scratch}/out").drop("epoch"), ["user_id", "window_start"]).collect()
    assert sorted((str(r["window_start"])[:10], r["samples"], r["best_value"]) for r in got) == [
        ("2024-01-01", 1, 2.0), ("2024-01-02", 1, 4.0)]


def test_table_stream_reads_a_file_or_a_folder(spark, scratch):
    """A table may be one file or a folder of several; other tables beside it
    are left alone."""
    from pathlib import Path
    spark.range(20).repartition(3).write.parquet(f"{scratch}/in/documents.parquet")
    spark.range(5).write.parquet(f"{scratch}/in/more_documents.parquet")
    spark.range(7).coalesce(1).write.parquet(f"{scratch}/one")
    (part,) = Path(f"{scratch}/one").glob("*.parquet")
    Path(f"{scratch}/in/labels.parquet").write_bytes(part.read_bytes())
    for name, n, most in (("documents", 20, None), ("documents", 20, 1), ("labels", 7, None)):
        out = st.scratch_dir(spark, "t")
        st.run_available_now(st.table_stream(spark, f"{scratch}/in", name, most), out + "/data", out + "/ckpt")
        assert sorted(r["id"] for r in spark.read.parquet(out + "/data").collect()) == list(range(n))


def test_stream_queries_over_folders(spark, scratch):
    """The stream queries on tables of several files give every row."""
    from quire.plans import catalog
    q = catalog.queries()
    spark.createDataFrame([(i // 4, i % 4, "user" if i % 2 else "", f"t{i}") for i in range(40)],
                          "conv_id long, turn int, role string, text string").repartition(3).write.parquet(f"{scratch}/conversations.parquet")
    spark.createDataFrame([(i, f"line {i} " * 20 + "\nmore") for i in range(50)], "doc_id long, text string") \
        .repartition(3).write.parquet(f"{scratch}/documents.parquet")
    assert q["stream_ingest"](spark, scratch).count() == 20
    assert q["stream_scores"](spark, scratch).count() == 40
    assert sorted(r["doc_id"] for r in q["stream_batches"](spark, scratch).collect()) == list(range(42))
    got = {r["request_id"]: r["text"] for r in q["stream_chunks"](spark, scratch).collect()}
    assert got == {i: f"line {i} " * 20 for i in range(50)}
