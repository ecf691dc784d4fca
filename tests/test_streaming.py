import pytest
from school import SCHEMAS, attempt, frame, tables

from coursetrail.operators import completion
from coursetrail.operators.completion import latest_attempt
from coursetrail.plans import outputs
from coursetrail.sinks.user_table import UserTable
from coursetrail.streaming import activity

BATCHES = [
    [attempt("a", "x", 1.0, at=2), attempt("a", "y", 5.0, at=2), attempt("b", "x", 3.0, at=1)],
    [attempt("a", "x", 2.0, at=4), attempt("c", "x", 3.0, done=0, at=4), attempt("b", "z", None, at=3)],
    [attempt("a", "x", 9.0, at=3), attempt("b", "x", 3.0, at=1), attempt("c", "w", 4.0, at=9)],
]
EXPECTED = {("a", "x", 2.0), ("a", "y", 5.0), ("b", "x", 3.0), ("b", "z", None), ("c", "w", 4.0)}


def source(spark, folder, batches):
    for number, rows in enumerate(batches):
        frame(spark, "learning_activities", rows).coalesce(1).write.mode("append").parquet(folder)
    schema = SCHEMAS["learning_activities"]
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("batches", [BATCHES, BATCHES[::-1]])
def test_table_follows_the_stream(spark, tmp_path, batches):
    stream = source(spark, str(tmp_path / "in"), batches)
    table = UserTable(spark, str(tmp_path / "out"), buckets=4)
    seen = []
    query = activity.keep_completion_table(stream, table, str(tmp_path / "check"),
                                           then=lambda users: seen.append({r[0] for r in users.collect()}))
    query.awaitTermination(120)
    assert query.exception() is None
    assert {(r.user_id, r.lesson_id, r.score) for r in table.read().collect()} == EXPECTED
    assert set().union(*seen) == {"a", "b", "c"}
    batch = spark.read.schema(SCHEMAS["learning_activities"]).parquet(str(tmp_path / "in"))
    wanted = latest_attempt(activity.finished(batch))
    assert table.read().select(*wanted.columns).exceptAll(wanted).isEmpty()


def test_running_aggregate(spark, tmp_path):
    stream = source(spark, str(tmp_path / "in"), BATCHES)
    query = (activity.latest_attempts(stream).writeStream.outputMode("complete").format("memory").queryName("latest")
             .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert {(r.user_id, r.lesson_id, r.score) for r in spark.table("latest").collect()} == EXPECTED


def test_stream_refreshes_the_outputs_of_its_users(spark, tmp_path):
    old = tables(spark, learning_activities=[], facilitator_learning_activities=[])
    targets = outputs.Targets(UserTable(spark, str(tmp_path / "lesson"), buckets=4))
    outputs.refresh(old, targets)
    stream = source(spark, str(tmp_path / "in"), [[attempt("learner", "l1", 50.0)], [attempt("idle", "l5", 7.0)]])
    store = UserTable(spark, str(tmp_path / "store"), buckets=4)

    def then(users):
        outputs.refresh(old.with_tables(learning_activities=store.read()), targets, outputs.Scope(user_ids=users))

    activity.keep_completion_table(stream, store, str(tmp_path / "check"), then).awaitTermination(300)
    done = {(r.user_id, r.lesson_id) for r in targets.lesson.read().filter("completed = 1").collect()}
    assert done == {("learner", "l1"), ("idle", "l5")}


@pytest.mark.parametrize("batches", [BATCHES, BATCHES[::-1]])
def test_changed_users_of_both_logs_once(spark, tmp_path, batches):
    logs = [source(spark, str(tmp_path / name), part) for name, part in (("learner", batches), ("staff", [[attempt("a", "s", 1.0), attempt("d", "s", 2.0, at=5)]]))]
    query = (activity.changed_users(logs, "30 days").writeStream.format("memory").queryName("changed").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert sorted(r.user_id for r in spark.table("changed").collect()) == ["a", "b", "c", "d"]


def test_state_of_changed_users_shrinks_behind_the_watermark(spark, tmp_path):
    rows = [[attempt(f"u{i}", "x", 1.0, at=1) for i in range(20)], [attempt("late", "x", 1.0, at=20)], [attempt("last", "x", 1.0, at=21)]]
    stream = activity.changed_users([source(spark, str(tmp_path / "in"), rows)], "2 days")
    query = (stream.writeStream.format("memory").queryName("shrinking").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) >= 20 and kept[-1] <= 2
    assert spark.table("shrinking").count() == 22
