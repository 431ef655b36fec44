"""Merging the small files that micro-batches leave, safely under readers and the stream.

A landed table has a directory per date and micro-batch (``streaming/ingest.py``).
``compact`` writes the rows of a date's small directories into few files of a target size,
in a directory of their own, and then publishes one note that names what the new
directory replaces.  ``live_paths`` reads the notes: before the note is there the new
directory does not count, afterwards the replaced ones do not, so every reader that
resolves the table through ``read_layer`` sees each row once, at any moment.  ``vacuum``
removes replaced directories later, when nobody reads them any more.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

from ..session import hadoop_path, list_names, path_exists, read_text, remove_path, write_text

NOTES = "_replaced"
MERGED = "batch=merged-"


def _date_dir(root: str, date) -> str:
    return f"{root.rstrip('/')}/partition_date={date}"


def _notes(spark: SparkSession, root: str, date) -> dict[str, list[str]]:
    """Published notes of a date: merged directory -> the directories it replaces."""
    folder = f"{root.rstrip('/')}/{NOTES}/{date}"
    return {f"batch={n}": json.loads(read_text(spark, f"{folder}/{n}"))
            for n in list_names(spark, folder) if "." not in n}


def live_batches(spark: SparkSession, root: str, date) -> list[str]:
    """The directories of a date that hold its rows now."""
    notes = _notes(spark, root, date)
    gone = {b for replaced in notes.values() for b in replaced}
    return [n for n in list_names(spark, _date_dir(root, date))
            if n.startswith("batch=") and n not in gone
            and (not n.startswith(MERGED) or n in notes)]


def live_paths(spark: SparkSession, root: str, date=None) -> list[str] | None:
    """Paths to read a landed table by; None if it was never compacted (read the root)."""
    if not path_exists(spark, f"{root.rstrip('/')}/{NOTES}"):
        return None
    dates = [str(date)] if date is not None else [
        n.partition("=")[2] for n in list_names(spark, root) if n.startswith("partition_date=")]
    out = []
    for d in dates:
        batches = live_batches(spark, root, d)
        plain = [n for n in list_names(spark, _date_dir(root, d)) if n.startswith("part-")]
        out += [f"{_date_dir(root, d)}/{b}" for b in batches]
        out += [f"{_date_dir(root, d)}/{f}" for f in plain]
    return out


def _size(spark: SparkSession, path: str) -> int:
    fs, p = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def _settled(batches: list[str]) -> list[str]:
    """The batches which their streams won't repeat: all but each query's newest."""
    newest: dict[str, str] = {}
    for b in batches:
        if not b.startswith(MERGED):
            query = b.rpartition("-")[0]
            newest[query] = max(newest.get(query, b), b)
    return [b for b in batches if b not in newest.values()]


def compact(spark: SparkSession, root: str, date, target_bytes: int = 256 << 20) -> str | None:
    """Merge a date's small directories; the new directory's name, None if there was nothing to do.

    Directories of half the target or more stay, as does each stream's newest batch, which
    the stream may still repeat.  The rest becomes ``bytes / target + 1`` files at most:
    the scan is cut into small splits which are put together without a shuffle.
    """
    sizes = {b: _size(spark, f"{_date_dir(root, date)}/{b}") for b in _settled(
        live_batches(spark, root, date))}
    small = sorted(b for b, size in sizes.items() if size < target_bytes / 2)
    if len(small) < 2:
        return None
    files = sum(sizes[b] for b in small) // target_bytes + 1
    rows = spark.read.parquet(*(f"{_date_dir(root, date)}/{b}" for b in small))
    name = f"{MERGED}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows.coalesce(files).write.parquet(f"{_date_dir(root, date)}/{name}")
    write_text(spark, f"{root.rstrip('/')}/{NOTES}/{date}/{name.partition('=')[2]}",
               json.dumps(small))
    return name


def vacuum(spark: SparkSession, root: str, older_than_s: float = 86_400) -> list[str]:
    """Remove directories that were replaced, or left unpublished, more than ``older_than_s``
    ago, and the notes that are then of no use; what was removed."""
    base, out = root.rstrip("/"), []

    def old(path: str) -> bool:
        fs, p = hadoop_path(spark, path)
        return fs.getFileStatus(p).getModificationTime() < (time.time() - older_than_s) * 1000

    for d in (n.partition("=")[2] for n in list_names(spark, root) if n.startswith("partition_date=")):
        notes = _notes(spark, root, d)
        there = set(list_names(spark, _date_dir(root, d)))
        for merged, replaced in notes.items():
            if old(f"{base}/{NOTES}/{d}/{merged.partition('=')[2]}"):
                out += [f"{_date_dir(root, d)}/{b}" for b in replaced if b in there]
        out += [f"{_date_dir(root, d)}/{b}" for b in there if b.startswith(MERGED)
                and b not in notes and old(f"{_date_dir(root, d)}/{b}")]
        for path in out:
            remove_path(spark, path)
        there = set(list_names(spark, _date_dir(root, d)))
        for merged, replaced in notes.items():
            if merged not in there and not there & set(replaced):
                remove_path(spark, f"{base}/{NOTES}/{d}/{merged.partition('=')[2]}")
    return out


__all__ = ["compact", "vacuum", "live_paths", "live_batches"]
