"""Plans and skew: what must hold when a table is too large for one task."""

import re

from pyspark.sql import functions as F
from school import tables

from coursetrail.operators import allocation, completion, incremental
from coursetrail.plans import outputs


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(plan, key):
    return len(re.findall(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)", plan))


def test_users_and_completions_meet_in_one_arrangement(spark, tmp_path):
    """Completed lessons are hashed on the user once; the user side is not hashed again after the expansion."""
    t = tables(spark)
    for name in ("users", "student_details", "learning_activities", "facilitator_learning_activities"):
        t[name].write.parquet(str(tmp_path / name))
    t = t.with_tables(**{n: spark.read.parquet(str(tmp_path / n)) for n in (
        "users", "student_details", "learning_activities", "facilitator_learning_activities")})
    plan = plan_of(outputs.lesson_level_full(t))
    assert shuffles(plan, "done_by") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # From the exchange of the users upwards only windows and joins follow, no further exchange of their rows.
    top = plan[:plan.index("done_by")]
    assert not re.search(r"Exchange hashpartitioning\(user_id#\d+L?, subject_id", top)


def test_attempts_are_reduced_before_they_are_shuffled(spark):
    t = tables(spark)
    plan = plan_of(completion.by_lesson(completion.completed(t, "learner")))
    assert plan.index("partial_max") > plan.index("Exchange") and "max(score" in plan[:plan.index("Exchange")]
    plan = plan_of(completion.latest_attempt(completion.completed(t, "learner")))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    t = tables(spark)
    t.learning_activities.write.parquet(str(tmp_path / "log"))
    t = t.with_tables(learning_activities=spark.read.parquet(str(tmp_path / "log")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(incremental.changed_users(t, "2024-01-03"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "EqualTo(completed,1)" in scan and "GreaterThan(completed_at,2024-01-03" in scan
    assert "score" not in scan.split("Batched")[0]


def test_a_hot_user_and_a_hot_lesson_change_nothing_but_time(spark):
    """A third of all attempts belong to one user, a third to one lesson; values are checked by rule."""
    n = 60_000
    ids = spark.range(n)
    user = F.when(F.col("id") < n / 3, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
    lesson = F.when(F.col("id") >= 2 * n / 3, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 499).cast("string")))
    log = ids.select(
        user.alias("user_id"), lesson.alias("lesson_id"), (F.col("id") % 101).cast("double").alias("score"),
        F.lit(1.0).alias("rating"), F.lit(2).cast("bigint").alias("duration"), F.lit(1).alias("completed"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("completed_at"))
    t = tables(spark).with_tables(learning_activities=log)
    results = completion.by_lesson(completion.completed(t, "learner"))
    assert results.agg(F.sum("duration")).first()[0] == 2 * n
    assert results.filter("user_id = 'hot'").count() == 499
    newest = completion.latest_attempt(completion.completed(t, "learner"))
    assert newest.count() == results.count()
    assert newest.agg(F.max("completed_at")).first() == log.agg(F.max("completed_at")).first()


def test_a_hot_centre_is_split(spark, monkeypatch):
    """Most users in one centre, mapping tables beyond the broadcast bound: several tasks share the centre."""
    from coursetrail.sources import tables as module
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8",
    }
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        t = tables(spark)
        empty = {c: F.lit(None).cast(t.users.schema[c].dataType) for c in t.users.columns}
        people = spark.range(0, 20_000, 1, 8).select(*[{
            "id": F.concat(F.lit("u"), F.col("id").cast("string")), "type": F.lit(3), "status": F.lit(1),
            "name": F.md5(F.col("id").cast("string")),
            "centre_id": F.when(F.col("id") % 10 < 8, "c1").otherwise(F.concat(F.lit("x"), (F.col("id") % 97).cast("string"))),
        }.get(c, empty[c]).alias(c) for c in t.users.columns])
        result = outputs.lesson_level_full(t.with_tables(users=people))
        rows = result.groupBy("user_id").agg(F.max("total_allocated").alias("n"))
        assert [tuple(r) for r in rows.groupBy("n").count().orderBy("n").collect()] == [(0, 4_000), (6, 16_000)]
        rows.collect()
        assert "skew=true" in plan_of(rows)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tasks_of_the_expansion_follow_the_predicted_rows(spark, monkeypatch):
    def tasks():
        plan = allocation.combined(tables(spark))._jdf.queryExecution().executedPlan().toString()
        return int(plan.split("REPARTITION_BY_NUM")[0].rpartition("hashpartitioning(user_id")[2].split("), ")[0].split(", ")[-1])

    assert tasks() == 4
    monkeypatch.setattr(allocation, "ROWS_PER_TASK", 5)
    assert tasks() > 20


def test_rows_of_a_task_fit_a_sort_in_memory(spark):
    """512 bytes a row, 512 MB a task."""
    t, rows = tables(spark), 400_000_000
    assert t.known(f"user x lesson rows of {allocation.LESSON_CATEGORY}", lambda: rows) == rows
    assert rows / allocation._spread(t, allocation.LESSON_CATEGORY) * 512 <= 512 << 20


def above_lessons(frame):
    """For each place where user x lesson rows arise, the operators they pass, from there to the root."""
    path, found = [], []
    for line in plan_of(frame).split("\n"):
        name = re.sub(r"^[ :|+\-]*(\*\(\d+\) )?", "", line)
        depth = len(line) - len(re.sub(r"^[ :|+\-]*", "", line))
        path = [(d, n) for d, n in path if d < depth]
        if name.startswith("Generate inline"):
            found.append([n.split(" ")[0].split("(")[0] for _, n in reversed(path)])
        path.append((depth, name))
    return found


def test_allocated_lessons_meet_their_results_where_they_arise(spark):
    t = tables(spark)
    (above,) = above_lessons(completion.with_completion(allocation.combined(t, keep_slice=True), t))
    assert "ShuffledHashJoin" in above and not {"Exchange", "Sort", "Window"} & set(above)


def test_exploded_lessons_are_counted_before_anything_is_shuffled(spark):
    found = above_lessons(completion.merge_exploded(tables(spark)))
    assert found
    for above in found:
        moved = next(i for i, name in enumerate(above) if name in ("Exchange", "Sort", "Window", "SortMergeJoin", "BroadcastExchange"))
        assert {"HashAggregate", "ShuffledHashJoin"} & set(above[:moved])


def test_raw_path_rows_are_deduplicated_where_they_arise(spark):
    t = tables(spark)
    rows = allocation.non_ple(t).unionByName(allocation.ple(t)).unionByName(allocation.staff(t))
    found = above_lessons(allocation.one_per_lesson(rows))
    assert len(found) == 3 and all("Exchange" not in above for above in found)


def test_lessons_beyond_a_broadcast_are_dealt_by_subject_and_slice(spark, monkeypatch):
    from coursetrail.sources import tables as module

    def results():
        t = tables(spark)
        frames = [allocation.combined(t), allocation.staff(t), completion.merge(t), completion.merge_exploded(t),
                  completion.with_completion(allocation.combined(t, keep_slice=True), t).drop(allocation.SLICE)]
        return [sorted(map(str, frame.collect())) for frame in frames], frames

    small, _ = results()
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(allocation, "ROWS_PER_TASK", 2)
    monkeypatch.setattr(allocation, "BLOCK", 2)
    large, frames = results()
    assert large == small and large[2] == large[3]
    assert re.search(rf"hashpartitioning\(subject_id#\d+, {allocation.SLICE}#\d+, \d+\), REPARTITION_BY_NUM", plan_of(frames[0]))
    # One subject's users are in several slices.
    t = tables(spark)
    assert allocation._slices(t, allocation.LESSON_CATEGORY)[0].agg(F.max("slices")).first()[0] > 1
    (above,) = above_lessons(completion.with_completion(allocation.combined(t, keep_slice=True), t))
    assert not {"Exchange", "Sort", "Window"} & set(above)


def test_results_meet_blocks_of_lessons_and_not_single_lessons(spark, monkeypatch):
    """The results of `allocation_completion` are joined below the expansion, in both plans, and give what the join above it gives."""
    from coursetrail.registry import queries
    from coursetrail.sources import tables as module
    monkeypatch.setattr(queries, "CATEGORY", allocation.LESSON_CATEGORY)

    def check(**moved):
        t = tables(spark).with_tables(**moved)
        found = queries.allocation_completion(t)
        plain = completion.with_completion(allocation.combined(t, all_types=False, keep_slice=True), t).select(*found.columns)
        rows = sorted(map(str, found.collect()))
        assert rows == sorted(map(str, plain.collect())) and found.filter("completed = 1").count() > 0
        (above,) = above_lessons(queries.allocation_completion(t))
        assert set(above) <= {"Project", "AdaptiveSparkPlan"}, above
        return rows

    def twice(t):
        return {n: t[n].union(t[n]) for n in ("lessons", "users", "learning_activities", "facilitator_learning_activities")}

    small, doubled = check(), check(**twice(tables(spark)))
    assert len(doubled) > len(small)
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(allocation, "ROWS_PER_TASK", 2)
    monkeypatch.setattr(allocation, "BLOCK", 2)
    assert check() == small and check(**twice(tables(spark))) == doubled


def test_merged_results_meet_blocks_of_lessons(spark):
    t = tables(spark)
    allocated = allocation.combined(t, results=completion.to_meet(t, "union"))
    rows = completion.with_completion(allocated, t, "union")
    plain = completion.with_completion(allocation.combined(t), t, "union")
    assert rows.columns == plain.columns and sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))


def test_folded_path_rows_are_deduplicated_by_block(spark, monkeypatch):
    """What `allocation_dedup` does: blocks are compared as a whole, and lessons one by one only where another row may hold them too."""
    from school import lesson, profile, school, user

    from coursetrail.registry import queries
    from coursetrail.sources import tables as module
    monkeypatch.setattr(queries, "CATEGORY", allocation.LESSON_CATEGORY)
    base = school()
    changed = {
        # Ids of several users, of one role and of two; two active users without an id.
        "users": base["users"] * 2 + [user("batched", 2, mt=1), user("both", 1),
                                    *((None, *user("nameless", kind)[1:]) for kind in (2, 3))],
        "student_details": base["student_details"] * 2 + [profile("ple", "b1"), profile("both", "b1")],
        # Ids of several lessons: in two subjects, in one subject with another place, as they are, and without an id.
        "lessons": base["lessons"] + [lesson("l1", "s2", 7, facilitator=1), lesson("l2", "s1", 9, master=1), lesson("l5", "s2", 1),
                                      lesson(None, "s1", 5, title="x"), lesson(None, "s2", 4, title="x")],
        "centre_subject": base["centre_subject"] * 2,
    }

    def check():
        t = tables(spark, **changed)
        raw = [path(t) for path in (allocation.non_ple, allocation.ple, allocation.staff)]
        plain = allocation.one_per_lesson(raw[0].unionByName(raw[1]).unionByName(raw[2])).collect()
        found = queries.allocation_dedup(t).collect()
        assert len({(r["user_id"], r["lesson_id"]) for r in found}) == len(found) > 20
        # Two users without an id are equal in all that decides between them.
        told = [sorted(str(r if r["user_id"] else (r["lesson_id"], r["subject_id"])) for r in rows) for rows in (found, plain)]
        assert told[0] == told[1]
        return told[0]

    above = above_lessons(queries.allocation_dedup(tables(spark)))
    assert [a for a in above if not {"Exchange", "Sort", "Window"} & set(a)], above
    small = check()
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(allocation, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(allocation, "BLOCK", 2)
    assert check() == small


def test_exploded_lessons_meet_results_in_blocks(spark):
    """Lessons are counted without a join of single lessons, and looked up one by one only in blocks that hold a result."""
    merged = completion.merge_exploded(tables(spark))
    counted = [above for above in above_lessons(merged) if "HashAggregate" in above and "Join" not in "".join(above[:above.index("HashAggregate")])]
    assert len(counted) == 1 and "LeftSemi" in plan_of(merged)


def test_the_prediction_is_the_number_of_raw_rows(spark):
    """Tasks are cut by it: counting every lesson of a centre for all its users made them five times as many."""
    t = tables(spark)
    allocation._spread(t, allocation.LESSON_CATEGORY)
    predicted = t.known(f"user x lesson rows of {allocation.LESSON_CATEGORY}", lambda: None)
    assert predicted == sum(path(t).count() for path in (allocation.non_ple, allocation.ple, allocation.staff))


def test_users_pass_by_block_after_block(spark, monkeypatch):
    """What is written repeats: in a task, users with the same lessons follow each other."""
    from itertools import groupby

    from coursetrail.sources import tables as module
    monkeypatch.setattr(allocation, "BLOCK", 1)

    def runs(*keys):
        rows = allocation.combined(tables(spark)).select(F.spark_partition_id().alias("task"), "*").collect()
        of = [tuple(r[k] for k in ("task", *keys)) for r in rows]
        return len(list(groupby(of))), len(set(of))

    found, least = runs("subject_id")
    assert found == least
    monkeypatch.setattr(module, "BROADCAST_ROWS", 1)
    # Here blocks are the streamed side, so they come first in the plan, and the users of the slice follow.
    join = plan_of(allocation.combined(tables(spark))).partition(f"SortMergeJoin [subject_id#")[2]
    below = join[join.index(f"{allocation.SLICE}#"):]
    assert below.index("collect_list(lesson") < below.index("is_master_trainer")
