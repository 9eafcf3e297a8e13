import datetime
import json

import pytest
from pyspark.sql import functions as F

from skein.operators import words as w
from skein.operators.order import advanced_since_previous
from skein.plans import stream_queries
from skein.sources.streams import stream_lines, stream_table, with_arrival_time
from skein.streaming import operators as op
from skein.streaming import sinks

SCHEMA = "seq bigint, user string, ts timestamp_ntz"


def drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def at(day, second=0):
    return datetime.datetime(2024, 1, day, 0, 0, second)


ONE = [(3, "a", at(2)), (1, "a", at(1)), (2, "b", at(5)), (4, "a", at(1))]
TWO = [(6, "b", at(6)), (5, "a", at(3)), (7, "a", at(3)), (8, "c", at(1))]


def events(spark, folder):
    return stream_table(spark, f"{folder}/*", SCHEMA, max_files_per_trigger=1)


@pytest.mark.parametrize("kind", ["state", "batch", "overall"])
def test_advances_over_batches_and_a_restart(spark, tmp_path, kind):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        stream = events(spark, source)
        if kind == "state":
            found = op.advanced_since_previous_stream(stream, "user", "ts", "seq")
            sinks.finish(sinks.to_parquet(found, out, mark, availableNow=True))
        else:
            key = "user" if kind == "batch" else None
            sinks.finish(sinks.advances_by_batch(stream, out, "ts", "seq", key, checkpoint=mark,
                                                 sizes={"block_rows": 2}, availableNow=True))

    drop(spark, source, "one", ONE)
    run()
    drop(spark, source, "two", TWO)
    run()
    both = spark.createDataFrame(ONE + TWO, SCHEMA)
    expected = advanced_since_previous(both, "ts", ["seq"], None if kind == "overall" else "user")
    found = spark.read.parquet(out if kind == "state" else f"{out}/rows")
    pick = lambda frame: sorted((r.seq, r.event_date, r.previous_date) for r in frame.collect())
    assert pick(found) == pick(expected)
    assert len(pick(found)) >= 3


def test_running_counts_equal_the_batch_result(spark, tmp_path):
    source, mark, out = (str(tmp_path / n) for n in ("in", "check", "out"))
    (tmp_path / "in").mkdir()
    texts = ["Ahoj, jak se dneska mas?\nAhoj, mam se dobre", "bla bla blabla\ntest\nbla test"]
    for mode in ("complete", "update"):
        for number, text in enumerate(texts):
            (tmp_path / "in" / f"{number}.txt").write_text(text)
            lines = stream_lines(spark, source, max_files_per_trigger=1)
            counted = op.running_word_count(lines) if mode == "complete" else op.running_letter_count(lines)
            sinks.finish(sinks.write_batches(counted, f"{out}-{mode}", mode, f"{mark}-{mode}", availableNow=True))
    batch = spark.read.text(source)
    words = {r.word: r.n for r in sinks.latest_batch(spark, f"{out}-complete").collect()}
    assert words == {r.word: r.n for r in w.clean_word_count(batch, "value").collect()}
    letters = {r.letter: r.n for r in sinks.latest_per_key(spark, f"{out}-update", ["letter"]).collect()}
    assert letters == {r.letter: r.n for r in w.first_letter_count(batch, "value").collect()}


def test_windows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop(spark, source, "one", [(1, "war", at(1, 0)), (2, "war", at(1, 20)), (3, "x", at(1, 50))])
    stream = events(spark, source)
    closed = op.windowed_word_count(stream, "30 seconds", "15 seconds", "ts", "0 seconds", "user")
    sinks.finish(sinks.to_parquet(closed, out, availableNow=True))
    found = {(r.window_start.second, r.word): r.n for r in spark.read.parquet(out).collect()}
    assert found == {(45, "war"): 1, (0, "war"): 2, (15, "war"): 1}
    by_arrival = op.windowed_word_count(stream_lines(spark, source))
    assert by_arrival.isStreaming and by_arrival.columns == ["window_start", "window_end", "word", "n"]


def test_json_branches_and_csv(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    rows = [{"title": "a", "text": "in a war", "comment_count": 3}, {"title": "b", "comment_count": "bad"},
            {"title": "c", "text": "x", "comment_count": 1}]
    (source / "1.txt").write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    lines = with_arrival_time(stream_lines(spark, str(source)))
    parsed = op.parse_json_stream(lines, "title string, text string, comment_count int", keep=["event_time"])
    sinks.finish(sinks.to_csv(op.active_rows(parsed), str(out / "active"), availableNow=True))
    assert [r.value for r in spark.read.text(str(out / "active")).collect()] == ["a;3"]

    def write(frame, name, batch_id):
        frame.write.mode("overwrite").parquet(f"{out}/m{name}/batch={batch_id}")

    outputs = {"titles": lambda b: b.select("title").dropna(), "active": lambda b: op.active_rows(b)}
    sinks.finish(sinks.run_sinks(parsed, outputs, write, availableNow=True))
    assert spark.read.parquet(f"{out}/mtitles").count() == 3
    assert spark.read.parquet(f"{out}/mactive").count() == 1
    counted = op.windowed_match_counts(parsed, "1 minute", "10 seconds")
    sinks.finish(sinks.write_batches(counted, f"{out}/w", "complete", availableNow=True))
    windows = sinks.latest_batch(spark, f"{out}/w").agg(F.count("*"), F.max("total_articles"),
                                                        F.max("matching_articles")).first()
    assert tuple(windows) == (6, 3, 1)


def test_text_sinks(spark, tmp_path):
    counted = spark.createDataFrame([("a", 2)], "letter string, n int")
    sinks.write_text(counted, str(tmp_path / "letters"))
    assert [r.value for r in spark.read.text(str(tmp_path / "letters")).collect()] == ["(a,2)"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("x")
    sinks.finish(sinks.to_console(stream_lines(spark, str(tmp_path / "in")), availableNow=True))


def test_parts_of_a_table_are_batches_of_many_files(spark, tmp_path):
    spark.range(1000).repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    seen = []

    def run(stream, checkpoint):
        def save(batch, number):
            seen.append((number, *batch.selectExpr("count(*)", "min(id % 3)", "max(id % 3)", "count(distinct file)").first()))
        return stream.withColumn("file", F.input_file_name()).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    stream_queries.in_parts(spark, str(tmp_path), "events", F.col("id") % 3, 3, run)
    assert [one[:4] for one in seen] == [(0, 334, 0, 0), (1, 333, 1, 1), (2, 333, 2, 2)]
    assert all(one[4] > 1 for one in seen)
