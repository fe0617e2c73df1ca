"""Tables change together: a failure between any two steps leaves readers the old rows or the new ones."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ringtrail import schemas
from ringtrail.plans.pipeline import Pipeline
from ringtrail.sources import switching, tables

NAMES = ["silver/account", "silver/party"]


class Crash(Exception):
    pass


def filled(spark, root, mark):
    p = Pipeline(spark, str(root))
    save(p, mark)
    return p


def save(p, mark):
    with p._at_once():
        for name in NAMES:
            schema = schemas.TABLES[name]
            row = tuple(mark if f.dataType.simpleString() == "string" else None for f in schema.fields)
            p._save(name, p.spark.createDataFrame([row] * 3, schema))


def marks(spark, root):
    """What a reader sees in each table, by a pipeline of its own."""
    p = Pipeline(spark, str(root))
    return [{r[0] for r in p.table(n).collect()} for n in NAMES]


def crash_after(monkeypatch, moves):
    """Let so many folders move, then end as a killed driver does."""
    move, done = switching._move, []

    def some(spark, change):
        if len(done) == moves:
            raise Crash
        move(spark, change)
        done.append(change)

    monkeypatch.setattr(switching, "_move", some)


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_crash_after_the_commit_leaves_the_new_rows(spark, tmp_path, monkeypatch, moves):
    p = filled(spark, tmp_path, "old")
    crash_after(monkeypatch, moves)
    if moves < 2:
        with pytest.raises(Crash):
            save(p, "new")
    else:
        save(p, "new")
    assert marks(spark, tmp_path) == [{"new"}, {"new"}]
    monkeypatch.undo()
    save(Pipeline(spark, str(tmp_path)), "newer")
    assert marks(spark, tmp_path) == [{"newer"}, {"newer"}]
    assert not list((tmp_path / switching.FOLDER).glob("*.json"))


def test_a_crash_between_taking_away_and_moving_leaves_the_new_rows(spark, tmp_path, monkeypatch):
    p = filled(spark, tmp_path, "old")

    def half(spark, change):
        switching.file_system(spark, change.path)[0].delete(switching.file_system(spark, change.path)[1], True)
        raise Crash

    monkeypatch.setattr(switching, "_move", half)
    with pytest.raises(Crash):
        save(p, "new")
    assert marks(spark, tmp_path) == [{"new"}, {"new"}]


def test_a_crash_before_the_commit_leaves_the_old_rows(spark, tmp_path):
    p = filled(spark, tmp_path, "old")
    schema = schemas.TABLES[NAMES[0]]
    with pytest.raises(Crash), p._at_once():
        p._save(NAMES[0], spark.createDataFrame([("new", "new", "new", None)][:0], schema))
        raise Crash
    assert marks(spark, tmp_path) == [{"old"}, {"old"}]
    assert not [f for f in Path(tmp_path).rglob("_new-*")]
    # A draft of a note is no commit.
    (tmp_path / switching.FOLDER).mkdir(exist_ok=True)
    (tmp_path / switching.FOLDER / "x.draft").write_text('[["gone", "silver/account"]]')
    assert marks(spark, tmp_path) == [{"old"}, {"old"}]


def test_findings_of_one_assessment_change_together(spark, tmp_path, monkeypatch):
    p = Pipeline(spark, str(tmp_path))

    def rows(n, assessment):
        frame = spark.range(1, n + 1).withColumnRenamed("id", "finding_id").withColumn("assessment_id", F.lit(assessment))
        return {name.split("/")[1]: lambda name=name: tables.add_missing_columns(frame, schemas.TABLES[name]) for name in ("silver/finding", "silver/finding_entity", "silver/finding_edge")}

    def counts():
        reader = Pipeline(spark, str(tmp_path))
        return [sorted((r[0], r[1]) for r in reader.table(f"silver/{n}").groupBy("assessment_id").count().collect()) for n in ("finding", "finding_entity", "finding_edge")]

    p._save_findings("one_v1", **rows(2, "one_v1"))
    p._save_findings("two_v1", **rows(3, "two_v1"))
    crash_after(monkeypatch, 1)
    with pytest.raises(Crash):
        p._save_findings("one_v1", **rows(5, "one_v1"))
    assert counts() == [[("one_v1", 5), ("two_v1", 3)]] * 3
    monkeypatch.undo()
    switching.finish(spark, str(tmp_path))
    assert counts() == [[("one_v1", 5), ("two_v1", 3)]] * 3
    p.clear_findings()
    assert not (tmp_path / "silver" / "finding").exists()


def test_moves_can_be_repeated(spark, tmp_path):
    p = filled(spark, tmp_path, "old")
    report, change = tables.write_fresh(p.table(NAMES[0]), f"{tmp_path}/{NAMES[0]}")
    assert report.rows == 3
    switching.commit(spark, str(tmp_path), [change])
    switching._move(spark, change)
    assert marks(spark, tmp_path) == [{"old"}, {"old"}]
