"""Structured Streaming jobs.

* X1/X2 are stateless: the batch expressions (P4, E2, P12, I1) applied to a
  file stream, written by a checkpointed file sink (exactly-once).
* X3 and the whole-run monitor of X4 keep per-key state with
  ``transformWithState`` (``Ordered``): a summary of final events and a list of
  those that may still get a late one before them, with time to live. They emit
  versions of a row; ``latest`` reads the last version of each.
* X5 keeps chunks behind a gap per request and emits only new text.
* The windowed X4 is a watermarked tumbling-window aggregate: a window leaves
  the state store when the watermark passes its end. In append mode it is emitted
  then; in update mode (``run_versions``) open windows are there too, as versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from quire.operators import prep as pp
from quire.session import cut_lineage, ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A file stream over one test table (its parquet schema, explicit), which
    may be one file or a folder of files. A stream takes a path as a folder; a
    pattern (of this one name) may match either."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def run_available_now(df: DataFrame, out_dir: str, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append") -> None:
    """Drive a stream over everything available, checkpointed, then stop."""
    q = (df.writeStream.format(fmt).option("path", out_dir).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, output_mode: str = "append") -> None:
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# ------------------------------------------------------------- X1 / X2 ---

def prepare_stream(stream: DataFrame, prompt: str, response: str, prefix: str | None = None) -> DataFrame:
    """Stateless preparation of an unsized input: P4 filter, P12 prefix."""
    return pp.filter_complete(stream, prompt, response).withColumn(
        "prompt", pp.with_prefix(F.col(prompt), prefix))


def shard_stream(stream: DataFrame, key: str, world: int) -> DataFrame:
    """Q8: unsized input dealt to workers by a stable hash of the key (MD5,
    so that other engines deal alike)."""
    spot = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return stream.withColumn("shard", (spot % world).cast("int"))


def deal_batches(batch: DataFrame, order_cols, world: int, batch_size: int, drop_last: bool = False) -> DataFrame:
    """Q8 over one whole table (a stream: ``dealt_stream``): the rows in order
    are cut into groups of ``world * batch_size``; worker k takes the k-th block
    of each group. The short last group goes (``drop_last``) or is dealt as
    far as it reaches. Adds ``group``, ``shard``."""
    from quire.operators.order import with_row_index
    group = world * batch_size
    idx = with_row_index(batch, order_cols, name="__i")
    if drop_last:
        idx = idx.where(F.col("__i") < (batch.count() // group) * group)
    return idx.withColumns({"group": F.floor(F.col("__i") / group).cast("long"),
                            "shard": (F.floor(F.col("__i") / batch_size) % world).cast("int")}).drop("__i")


def dealt_stream(stream: DataFrame, order_cols, world: int, batch_size: int, out_dir: str, checkpoint: str) -> None:
    """Q8 over a whole stream into ``out_dir``: as ``deal_batches``, with the
    rows of a micro-batch behind those of the ones before. The rows after the
    last full group (fewer than ``world * batch_size``) and the number of
    groups dealt so far wait in the checkpoint folder, by epoch, for the next
    micro-batch; so only the short group at the end of the stream is not
    dealt. A replayed epoch writes the same folders again."""
    from quire.operators.order import with_row_index
    group = world * batch_size
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)

    def sink(batch: DataFrame, epoch: int) -> None:
        spark, done = batch.sparkSession, 0
        rows = batch.withColumns({"__turn": F.lit(1), "__was": F.lit(0).cast("long")})
        if epoch > 0:
            before = f"{checkpoint}/carried/{epoch - 1}"
            done = spark.read.parquet(before + "/groups").first()["n"]
            rows = rows.unionByName(spark.read.parquet(before + "/rows").withColumn("__turn", F.lit(0)))
        idx = cut_lineage(with_row_index(rows, ["__turn", "__was", *order_cols], name="__i"))
        full = idx.count() // group
        idx.where(F.col("__i") < full * group).withColumns({
            "group": (F.floor(F.col("__i") / group) + done).cast("long"),
            "shard": (F.floor(F.col("__i") / batch_size) % world).cast("int")}).drop("__i", "__turn", "__was") \
            .write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
        here = f"{checkpoint}/carried/{epoch}"
        idx.where(F.col("__i") >= full * group).drop("__turn", "__was").withColumnRenamed("__i", "__was") \
            .coalesce(1).write.mode("overwrite").parquet(here + "/rows")
        spark.range(1).select(F.lit(done + full).cast("long").alias("n")).coalesce(1) \
            .write.mode("overwrite").parquet(here + "/groups")
    run_foreach_batch(stream, sink, checkpoint)


def run_versions(df: DataFrame, out_dir: str, checkpoint: str) -> None:
    """Drive an aggregate in update mode: each micro-batch writes the rows it
    changed with its number as ``version`` (read back with ``latest``)."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("version", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
    run_foreach_batch(df, sink, checkpoint, "update")


def latest(df: DataFrame, keys) -> DataFrame:
    """The last version of each row of an X3 / X5 sink."""
    rest = [c for c in df.columns if c not in (*keys, "version")]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("__r"))
    return best.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


# ------------------------------------------------------- X3 / X4: ordered state

FIRST = -(1 << 62)
OUT_ROWS = 1024  # of an output frame


def use_rocksdb(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, None) or ""):
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Ordered(StatefulProcessor):
    """Per key a fold over events in the order of their ids, when events may
    come late.

    The state is one summary of the events that are final, and a list of those
    within ``lateness`` of the highest id seen, as only these may still get an
    earlier one before them. A micro-batch puts its events in their places,
    folds on from the summary, and emits the rows from its first new event on
    with a higher ``version`` (``latest`` reads the last one of each). Events
    that are known, or lie below the final ones, change nothing, so replays are
    idempotent. With ``ttl`` a key that has been idle for so long is forgotten;
    such a stream goes on by processing time, so ``availableNow`` ends it only
    with ``spark.sql.streaming.noDataMicroBatches.enabled`` off."""

    SUMMARY: str
    VALUE: str
    EMPTY: tuple
    COLUMNS: list[str]

    def __init__(self, key: str, lateness: int, ttl: int | None):
        self.key, self.lateness, self.ttl = key, lateness, ttl

    def init(self, handle) -> None:
        self.summary = handle.getValueState("summary", f"done long, version long, {self.SUMMARY}", self.ttl)
        self.held = handle.getListState("held", f"id long, {self.VALUE}", self.ttl)

    def close(self) -> None:
        pass

    def fold(self, summary: tuple, ident: int, value: tuple) -> tuple:
        raise NotImplementedError

    def row(self, summary: tuple, ident: int, value: tuple, last: bool) -> tuple | None:
        """What is to be told behind an event; ``last``: the last one known."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done, version, *summary = self.summary.get() if self.summary.exists() else (FIRST, 0, *self.EMPTY)
        held = {row[0]: tuple(row[1:]) for row in self.held.get()}
        fresh: dict[int, tuple] = {}
        for pdf in rows:
            for ident, *value in pdf.drop(columns=self.key).itertuples(index=False, name=None):
                if ident > done and ident not in held:
                    fresh.setdefault(int(ident), tuple(None if x is None or x is pd.NA else x for x in value))
        if not fresh:
            return
        every, first, version = held | fresh, min(fresh), version + 1
        edge, final, summary, out = max(every) - self.lateness, (done, tuple(summary)), tuple(summary), []
        order = sorted(every)
        for ident in order:
            summary = self.fold(summary, ident, every[ident])
            if ident >= first and (told := self.row(summary, ident, every[ident], ident == order[-1])) is not None:
                out.append((key[0], *told, version))
                if len(out) == OUT_ROWS:
                    yield pd.DataFrame(out, columns=[self.key, *self.COLUMNS, "version"])
                    out = []
            if ident <= edge:
                final = ident, summary
        open_ = [(e, *every[e]) for e in order if e > edge]
        if open_:
            self.held.put(open_)
        else:
            self.held.clear()
        self.summary.update((final[0], version, *final[1]))
        if out:
            yield pd.DataFrame(out, columns=[self.key, *self.COLUMNS, "version"])


def _ordered(events: DataFrame, processor: Ordered, types: str) -> DataFrame:
    """``events``: key, id, values."""
    use_rocksdb(events.sparkSession)
    kind = dict(events.dtypes)[processor.key]
    return events.groupBy(processor.key).transformWithStateInPandas(
        processor, f"`{processor.key}` {kind}, {types}, version long", "Append",
        "None" if processor.ttl is None else "ProcessingTime")


class ChatHistory(Ordered):
    SUMMARY = "segment long, turns long, history string"
    VALUE = "clear boolean, text string"
    EMPTY = (0, 0, "")
    COLUMNS = ["event_id", "segment", "history_len", "history"]

    def fold(self, summary, ident, value):
        segment, turns, history = summary
        clear, text = value
        if clear:
            return segment + 1, 0, ""
        if not text:
            return summary
        return segment, turns + 1, f"{history}\n{text}" if turns else text

    def row(self, summary, ident, value, last):
        return (ident, *summary) if value[0] or value[1] else None


def chat_history_stream(events: DataFrame, user: str = "user_id", event: str = "event_id", text=None, is_clear=None,
                        lateness: int = 1 << 40, ttl: int | None = None) -> DataFrame:
    """Per event of a user the number of its segment, the turns in it and
    its history as text (one turn a line); a clear command starts a new
    history, NULL and empty texts are skipped (same rule as the batch W2). A
    late event is put in its place and the rows behind it are emitted again
    with a higher ``version``. The state of a user is the history of the open
    segment and the events within ``lateness`` ids of the highest; ``ttl`` (in
    milliseconds) forgets users that have been idle for so long."""
    ev = events.select(F.col(user), F.col(event).cast("long").alias("id"), F.coalesce(is_clear, F.lit(False)).alias("clear"),
                       text.alias("text"))
    return _ordered(ev, ChatHistory(user, lateness, ttl), "event_id long, segment long, history_len long, history string")


class RunState(Ordered):
    """The samples so far, the sum of the open interval by the NaN rule (a NaN
    counts as the mean so far), the best value and its step."""
    SUMMARY = "samples long, total double, best double, best_step long"
    VALUE = "loss double"
    EMPTY = (0, 0.0, None, None)
    COLUMNS = ["interval", "samples", "loss", "best_value", "best_step"]

    def __init__(self, key: str, interval: int, lateness: int, ttl: int | None):
        super().__init__(key, lateness, ttl)
        self.interval = interval

    def fold(self, summary, ident, value):
        samples, total, best, best_step = summary
        place, loss = samples % self.interval, value[0]
        total = total if place else 0.0
        if loss is None or loss != loss:
            total += total / (1 + place)
        else:
            total += loss
            if best is None or loss > best:
                best, best_step = loss, ident
        return samples + 1, total, best, best_step

    def row(self, summary, ident, value, last):
        samples, total, best, best_step = summary
        here = (samples - 1) % self.interval + 1
        if not last and here < self.interval:
            return None
        return (samples - 1) // self.interval, here, total / here, best, best_step


def run_state_stream(events: DataFrame, run: str, step: str, value: str, interval: int, lateness: int = 1 << 40,
                     ttl: int | None = None) -> DataFrame:
    """X4 over whole runs: per run and interval of ``interval`` samples the
    loss by the NaN rule (W3, W4) and the best value of the run so far with its
    step (W5, greater is better), carried on from interval to interval. Steps
    may come late by ``lateness``; the state of a run is four numbers and the
    samples within that. The open interval is there as a version, too."""
    ev = events.select(F.col(run), F.col(step).cast("long").alias("id"), F.col(value).cast("double").alias("loss"))
    return _ordered(ev, RunState(run, interval, lateness, ttl),
                    "interval long, samples long, loss double, best_value double, best_step long")


# ------------------------------------------------------------------ X4 ---

def run_monitor_stream(events: DataFrame, ts: str, run: str, value: str, window: str = "1 day",
                       delay: str = "1 hour", step: str | None = None) -> DataFrame:
    """Per run and tumbling window the samples, the mean loss (W3), the
    best value (W5, greater is better) and samples per second (A12); with
    ``step`` also the loss by the NaN rule (W4). Watermarked: finished
    windows are appended and leave the state store."""
    from quire.operators.runs import nan_filtered_sum
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    x = F.col(value)
    clean = F.when(~F.isnan(x), x)
    secs = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1e6)
    more = [] if step is None else [F.sort_array(F.collect_list(F.struct(F.col(step).alias("s"), x.cast("double").alias("l")))).alias("xs")]
    out = (events.withWatermark(ts, delay)
           .groupBy(F.window(F.col(ts), window).alias("w"), F.col(run))
           .agg(F.count(F.lit(1)).alias("samples"), F.avg(clean).alias("mean_value"), F.max(clean).alias("best_value"),
                secs.alias("runtime"), *more))
    cols = [run, F.col("w.start").alias("window_start"), "samples", "mean_value", "best_value",
            F.when(F.col("runtime") > 0, F.col("samples") / F.col("runtime")).alias("samples_per_second")]
    if step is not None:
        cols.append((nan_filtered_sum(F.col("xs")) / F.col("samples")).alias("filtered_loss"))
    return out.select(*cols)


# ------------------------------------------------------------------ X5 ---

_X5_STATE = "next_seq long, stopped boolean, pending string"


def _chunk_state_fn(stop: str, key_name: str, expire: int | None):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # a tombstone, or a request that has been idle for long
            state.remove()
            return
        known = state.exists
        nxt, stopped, pending = state.get if known else (0, False, "{}")
        start, parts = nxt, []
        buf = {int(k): tuple(v) for k, v in json.loads(pending).items()}
        for p in pdfs:
            for s, t, last in zip(p["seq"], p["text"], p["last"]):
                if int(s) >= nxt and not stopped:
                    buf[int(s)] = (t or "", bool(last))
        while nxt in buf and not stopped:
            chunk, last = buf.pop(nxt)
            pos = chunk.find(stop)
            parts.append(chunk if pos < 0 else chunk[:pos])
            stopped = last or pos >= 0  # the final chunk ends the request
            nxt += 1
        # once stopped only a tombstone is kept (late chunks are dropped)
        state.update((nxt, stopped, "{}" if stopped else json.dumps(buf)))
        if expire is not None:
            state.setTimeoutDuration(expire)
        if parts or not known:
            yield pd.DataFrame({key_name: [key[0]], "seq": [start], "text": ["".join(parts)], "done": [stopped]})
    return fn


def chunk_assembly_stream(chunks: DataFrame, stop: str, key: str = "request_id", seq: str = "seq",
                          text: str = "text", last: str | None = None, expire: int | None = None) -> DataFrame:
    """Per request, buffer chunks in sequence order and emit the new text
    (from chunk ``seq`` on) whenever it grows, ``done`` once the stop string
    appears or the chunk flagged ``last`` arrives (as I4); chunks after that
    are dropped. The state holds chunks behind a gap only. ``assembled`` joins
    what was emitted. A request that never ends is there with ``done`` false, up
    to its first gap. ``expire`` (in milliseconds) forgets requests, and the
    marks of ended ones, that have been idle for so long."""
    c = chunks.select(F.col(key).alias("request_id"), F.col(seq).cast("long").alias("seq"),
                      F.col(text).alias("text"), (F.col(last) if last else F.lit(False)).alias("last"))
    kind = dict(c.dtypes)["request_id"]
    return c.groupBy("request_id").applyInPandasWithState(
        _chunk_state_fn(stop, "request_id", expire), f"request_id {kind}, seq long, text string, done boolean",
        _X5_STATE, "append", GroupStateTimeout.NoTimeout if expire is None else GroupStateTimeout.ProcessingTimeTimeout)


def assembled(pieces: DataFrame, key: str = "request_id") -> DataFrame:
    """The text of each request of an X5 sink (request_id, text, done)."""
    parts = F.sort_array(F.collect_list(F.struct("seq", "text")))
    return pieces.groupBy(key).agg(parts.alias("parts"), F.max("done").alias("done")).select(
        key, F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "done")
