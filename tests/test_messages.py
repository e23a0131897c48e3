import glob
import itertools

from pyspark.sql import functions as F

import registered.queries
from registered.queries import queries
from registered.tables import Tables
from spanloom.operators import decode
from spanloom.sources.events import messages_from_spans
from spanloom.sources.messages import load_messages, read_message_files


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_spans_travel_as_columns_and_are_written_once(tables):
    """The wire format is eight times as large: it is made after the spans were gathered, once a message."""
    gathered = plan(messages_from_spans(tables.spans))
    below = gathered[gathered.index("Project") :]
    assert "stringValue" in gathered and "stringValue" not in below
    assert "collect_list(struct(trace_id" in gathered
    # A second copy of the plan would write every message again for the damaged ones.
    assert "Union" not in plan(tables.messages)


def test_stored_messages_are_compressed_and_dealt_out(spark, tables):
    files = glob.glob(f"{tables.message_files}/*.json*")
    assert len(files) == 8 and all(f.endswith(".gz") for f in files)
    assert "RepartitionByExpression [partition" in plan(load_messages(spark, tables.message_files))
    stream = read_message_files(spark, tables.message_files)._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [partition" in stream
    # The order of the spans in a message may differ from one run to the next.
    columns = [F.length("value"), "topic", "partition", "offset"]
    stored = load_messages(spark, tables.message_files).select(*columns)
    assert stored.exceptAll(tables.messages.select(*columns)).count() == 0
    damaged = stored.filter(F.col("offset") >= 1 << 41)
    assert damaged.count() > 0 and damaged.filter(F.length("value") > 200).count() == 0


def test_the_parts_of_two_streams_are_compressed(spark, sf_dir, tmp_path, monkeypatch):
    names = itertools.count()
    monkeypatch.setattr("registered.queries.scratch_dir", lambda _, name: f"{tmp_path}/{name}-{next(names)}")
    assert queries()["j01_two_streams"](spark, sf_dir).count() == 4
    for part in (0, 1):
        files = glob.glob(f"{tmp_path}/stream-{part}-*/*.json*")
        assert files and all(f.endswith(".gz") for f in files)


def test_messages_are_not_searched_for_the_trace_they_were_made_of(tables):
    assert "get_json_object(value" not in plan(tables.messages)
    trace = F.get_json_object("value", "$.resourceSpans[0].scopeSpans[0].spans[0].traceId")
    copied = F.substring(trace, 2, 20).cast("bigint") % 13 == 0
    whole = tables.messages.filter(F.col("offset") < 1 << 41).select("offset", copied.alias("copied"))
    damaged = tables.messages.filter(F.col("offset") >= 1 << 41).select(F.col("offset") - (1 << 41))
    assert whole.filter("copied").select("offset").exceptAll(damaged).count() == 0
    assert damaged.exceptAll(whole.filter("copied").select("offset")).count() == 0


def test_a_replayed_batch_is_decoded_once(spark, sf_dir, monkeypatch):
    calls, once = [], decode.dead_letters
    monkeypatch.setattr(decode, "dead_letters", lambda *a: calls.append(a) or once(*a))
    row = queries()["s02_replay"](spark, sf_dir).collect()
    assert len(calls) == 1
    assert [(r.error, r.ingested_at.minute) for r in row] == [("malformed JSON", 1)] and row[0].messages > 0


def test_message_files_are_bounded_and_batches_stay(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("registered.tables._written", {})
    monkeypatch.setattr("registered.tables.SPANS_A_FILE", 50)
    small = Tables(spark, sf_dir)
    parts = small.message_parts
    assert parts > 8 and parts % 8 == 0 and parts * 50 >= small.events.count()
    assert len(glob.glob(f"{small.message_files}/*.json.gz")) == parts
    assert [r.batches for r in queries()["j10_bounded_batch"](spark, sf_dir).collect()] == [4]


def test_the_text_of_messages_is_not_shuffled(tables):
    shuffled = tables.messages._jdf.queryExecution().executedPlan().toString()
    assert shuffled.count("Exchange hashpartitioning(trace_id") == shuffled.count("Exchange") == 1


def test_windowed_states_neither_decode_again_nor_keep_sketches(spark, sf_dir, monkeypatch):
    seen, run = [], registered.queries._run_stream

    def look(t, stream, name):
        seen.append((stream.columns, stream._jdf.queryExecution().analyzed().toString()))
        return run(t, stream, name)

    monkeypatch.setattr("registered.queries._run_stream", look)
    found = queries()["j04_windowed_states"](spark, sf_dir)
    assert sum(r.spans for r in found.collect()) == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    [(columns, analyzed)] = seen
    assert not {"traces", "ttft", "duration"} & set(columns) and "from_json" not in analyzed
