"""Tables that change together, all or nothing.

New contents are written beside the tables, into folders that readers do not see. A small file, the note,
then says which folder takes the place of which table; its appearance is the commit. From then on readers
take the new folders, and whoever writes next finishes the moves if the writer did not. Before it, nothing
has changed. One writer at a time per root; readers may come at any time and move nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ringtrail.staging import file_system

FOLDER = "_switches"


@dataclass(frozen=True)
class Change:
    """A finished folder that takes the place of a table or partition; None takes the table away."""

    fresh: str | None
    path: str


def fresh_folder(path: str) -> str:
    """A hidden folder beside a table."""
    parent, _, _ = path.rstrip("/").rpartition("/")
    return f"{parent}/_new-{uuid.uuid4().hex}"


def _notes(spark: SparkSession, root: str) -> list[tuple[str, list[Change]]]:
    """(file, changes) of every commit whose moves are not known to be done."""
    fs, folder = file_system(spark, f"{root}/{FOLDER}")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        if status.getPath().getName().endswith(".json"):
            with_stream = fs.open(status.getPath())
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(with_stream, "UTF-8")
            finally:
                with_stream.close()
            out.append((status.getPath().toString(), [Change(*c) for c in json.loads(text)]))
    return sorted(out)


def pending(spark: SparkSession, root: str) -> list[Change]:
    """Committed changes whose new folder has not been moved yet, and tables still to be taken away."""
    out = []
    for _, changes in _notes(spark, root):
        for change in changes:
            fs, place = file_system(spark, change.fresh or change.path)
            if fs.exists(place):
                out.append(change)
    return out


def _move(spark: SparkSession, change: Change) -> None:
    """A step that can be repeated: the old table goes only while the new one is there to be moved."""
    fs, target = file_system(spark, change.path)
    if change.fresh is None:
        fs.delete(target, True)
        return
    _, source = file_system(spark, change.fresh)
    if not fs.exists(source):
        return
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"cannot move {change.fresh} to {change.path}")


def finish(spark: SparkSession, root: str) -> None:
    """Do what commits before have left to do. For writers, before they start."""
    for note, changes in _notes(spark, root):
        for change in changes:
            _move(spark, change)
        fs, place = file_system(spark, note)
        fs.delete(place, False)


def commit(spark: SparkSession, root: str, changes: Sequence[Change]) -> None:
    """Make all changes at once."""
    if not changes:
        return
    name = uuid.uuid4().hex
    fs, draft = file_system(spark, f"{root}/{FOLDER}/{name}.draft")
    _, note = file_system(spark, f"{root}/{FOLDER}/{name}.json")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps([[c.fresh, c.path] for c in changes]).encode()))
    out.close()
    if not fs.rename(draft, note):
        raise OSError(f"cannot write {note}")
    for change in changes:
        _move(spark, change)
    fs.delete(note, False)
