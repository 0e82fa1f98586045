"""Commits by several writers: the state table, the audit table, the manifest of a run."""

from pyspark.sql import functions as F

from quayside.plans.manifest import RunManifest
from quayside.sinks import audit_log
from quayside.sinks.audit_log import AuditLog, append_audit, read_audit
from quayside.sinks.commits import CommitLog
from quayside.sinks.state import StateTable, mark_processed, merge_changes, store_watermark

STATE = "asset_id string, is_processed string, incremental_column_value string"


def test_a_number_is_committed_once(spark, folder):
    one, other = CommitLog(spark, f"{folder}/log"), CommitLog(spark, f"{folder}/log")
    assert one.newest() == 0 and one.commit(1, {"by": "one"}) and not other.commit(1, {"by": "other"})
    assert other.newest() == 1 and other.body(1) == {"by": "one"} and other.commit(2, {"by": "ö"})
    assert one.bodies() == [{"by": "one"}, {"by": "ö"}]


def test_interleaved_replaces_lose_no_update(spark, folder):
    state = StateTable(spark, f"{folder}/state")
    first = state.replace(spark.createDataFrame([("a", "false", "1"), ("b", "false", "1"), ("c", "true", None)], STATE))
    runs = spark.createDataFrame([("a", "false")], "asset_id string, is_processed string")
    one = mark_processed(state.read(first), runs)
    two = store_watermark(state.read(first), "a", 9)
    assert (state.replace(one, base=first), state.replace(two, base=first)) == (2, 3)
    assert sorted(map(tuple, state.read().collect())) == [("a", "Success", "9"), ("b", "false", "1"), ("c", "true", None)]


def test_a_commit_between_read_and_write_is_merged(spark, folder, monkeypatch):
    state, other = StateTable(spark, f"{folder}/state"), StateTable(spark, f"{folder}/state")
    state.replace(spark.createDataFrame([("a", "false", "1"), ("b", "false", "1")], STATE))
    written = state._write

    def write(rows):
        monkeypatch.setattr(state, "_write", written)
        other.update_processed("b", "false")  # the other writer is first
        return written(rows)

    monkeypatch.setattr(state, "_write", write)
    state.update_processed("a", "false")
    assert sorted(map(tuple, state.read().collect())) == [("a", "Success", "1"), ("b", "Success", "1")]


def test_merging_rows_that_come_and_go(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "asset_id string, v int")
    base = rows(("keep", 1), ("mine", 1), ("theirs", 1), ("gone", 1), ("they_drop", 1), ("both", 1), (None, 1))
    mine = rows(("keep", 1), ("mine", 2), ("theirs", 1), ("they_drop", 1), ("both", 2), ("new", 5), (None, 1))
    theirs = rows(("keep", 1), ("mine", 1), ("theirs", 3), ("gone", 1), ("both", 3), ("other", 6), (None, 4))
    got = {r["asset_id"]: r["v"] for r in merge_changes(base, mine, theirs).collect()}
    assert got == {"keep": 1, "mine": 2, "theirs": 3, "both": 2, "new": 5, "other": 6, None: 4}


def _records(spark, ids, day="2024-06-01"):
    return spark.createDataFrame([(i, "same", day) for i in ids], "run int, text string, ingestion_date string")


def test_equal_records_of_different_runs_are_stored_each(spark, folder):
    path = f"{folder}/audit"
    for ids in ([1, 2], [2, 3], [1, 2, 3, 3]):
        append_audit(_records(spark, ids), path, ["run"], keep_identity=False)
    assert read_audit(spark, path).columns == ["text", "ingestion_date"] and read_audit(spark, path).count() == 3
    append_audit(_records(spark, [9, 9]), f"{folder}/plain")
    assert read_audit(spark, f"{folder}/plain").count() == 1


def test_appends_read_their_own_days_only(spark, folder, monkeypatch):
    log = AuditLog(spark, f"{folder}/audit")
    log.append(_records(spark, [1], "2024-01-01"), ["run", "ingestion_date"])
    log.append(_records(spark, [1], None), ["run", "ingestion_date"])
    read, seen = AuditLog._read, []
    monkeypatch.setattr(AuditLog, "_read", lambda self, files: seen.append(list(files)) or read(self, files))
    assert log.append(_records(spark, [1, 2], "2024-01-02"), ["run", "ingestion_date"]) == 2 and seen == []
    assert log.append(_records(spark, [2, 3], "2024-01-02"), ["run", "ingestion_date"]) == 1
    assert [len(files) for files in seen] == [1] and "2024-01-02" in seen[0][0]


def test_an_append_that_another_overtakes_stores_nothing_twice(spark, folder, monkeypatch):
    log, other = AuditLog(spark, f"{folder}/audit"), AuditLog(spark, f"{folder}/audit")
    write = log._write

    def overtaken(records, days):
        monkeypatch.setattr(log, "_write", write)
        other.append(_records(spark, [1, 2]), ["run"])
        return write(records, days)

    monkeypatch.setattr(log, "_write", overtaken)
    assert log.append(_records(spark, [2, 3]), ["run"]) == 1
    assert sorted(r["run"] for r in log.read().collect()) == [1, 2, 3]


def test_compaction_and_lists(spark, folder, monkeypatch):
    monkeypatch.setattr(audit_log, "LIST_EVERY", 3)
    log = AuditLog(spark, f"{folder}/audit")
    for i in range(7):
        log.append(_records(spark, [i], f"2024-01-0{1 + i % 2}"), ["run"])
    assert len(log.files()) == 7 and log.compact("2024-01-01") and len(log.files(["2024-01-01"])) == 1
    fresh = AuditLog(spark, f"{folder}/audit")
    assert fresh.files() == log.files() and fresh.read().count() == 7
    assert len(fresh.vacuum()) == 4 and fresh.read().agg(F.count_distinct("run")).first()[0] == 7
    assert log.append(_records(spark, [0, 8], "2024-01-01"), ["run"]) == 1  # what was compacted is still known


def test_what_an_attempt_takes_over(spark, folder):
    def attempt(print_, *stages, outcome=None):
        run, made = RunManifest(spark, f"{folder}/run"), []
        if run.begin(print_):
            for name in stages:
                run.stage(name, lambda name=name: made.append(name) or {"of": name})
            if outcome:
                run.end(outcome)
        return run.attempt, run.resumed, made

    assert attempt("x", "a", "b") == (1, False, ["a", "b"])
    assert attempt("x", "a", "b", "c") == (2, True, ["c"])
    assert attempt("y", "a") == (3, False, ["a"])  # another input
    assert attempt("x", "a", outcome="failed") == (4, False, ["a"])
    assert attempt("x", "a", "b", outcome="success") == (5, False, ["a", "b"])  # an ended attempt is no part of a new one
    assert attempt("x", "a", "b") == (5, True, [])  # ended well: nothing to do


def test_a_repeated_append_writes_nothing_and_keys_alone_are_moved(spark, folder, monkeypatch):
    log = AuditLog(spark, f"{folder}/audit")
    assert log.append(_records(spark, [1, 2]), ["run"]) == 2 and log.append(_records(spark, [3]), ["run"]) == 1
    wrote, write, tables, durable = [], log._write, [], audit_log.durable
    monkeypatch.setattr(log, "_write", lambda *given: wrote.append(given) or write(*given))
    monkeypatch.setattr(audit_log, "durable", lambda df, label: tables.append(df.columns) or durable(df, label))
    for again in ([1, 2], [3], [3, 2, 1]):  # a batch, or all of the day
        assert log.append(_records(spark, again), ["run"]) == 0 and not wrote
    assert log.append(_records(spark, [4, 5]), ["run"]) == 2 and len(wrote) == 1
    assert log.append(_records(spark, [3, 3, 6, 6, 7]), ["run"]) == 2
    assert log.append(_records(spark, [1]), ["run"]) == 0  # part of a batch
    assert sorted(r["run"] for r in log.read().collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert all(set(columns) == {audit_log.RECORD_KEY, "known"} for columns in tables)


def test_odd_days_have_folders(spark, folder):
    log = AuditLog(spark, f"{folder}/audit")
    for _ in range(2):
        log.append(_records(spark, [1], "2024/01/01 10:00").union(_records(spark, [2], "")).union(_records(spark, [3], None)), ["run"])
    assert sorted(r["run"] for r in log.read().collect()) == [1, 2, 3]
    assert log.append(_records(spark, [1, 4], "2024/01/01 10:00"), ["run"]) == 1


def test_tables_with_whole_digests_are_known(spark, folder):
    digest = F.sha2(F.to_json(F.struct("run"), {"ignoreNullFields": "false"}), 256)
    name = f"{audit_log.DAY}=2024-01-01/{audit_log.BATCH}=old"
    log = AuditLog(spark, f"{folder}/audit")
    _records(spark, [1, 2], "2024-01-01").withColumn(audit_log.RECORD_ID, digest).write.parquet(f"{folder}/audit/{name}")
    log.commits.commit(1, {"add": {name: "2024-01-01"}, "records": 2})
    assert log.append(_records(spark, [2, 3], "2024-01-01"), ["run"]) == 1
    assert log.append(_records(spark, [3, 1], "2024-01-01"), ["run"]) == 0
    assert sorted(r["run"] for r in log.read().collect()) == [1, 2, 3]


def test_compaction_makes_files_of_bounded_size(spark, folder, monkeypatch):
    monkeypatch.setattr(audit_log, "FILE_BYTES", 1500)
    log = AuditLog(spark, f"{folder}/audit")
    for i in range(4):
        log.append(_records(spark, [i]), ["run"])
    assert log.compact("2024-06-01") and len(log.files()) == 1
    assert len(log.read().inputFiles()) > 1 and log.read().count() == 4
