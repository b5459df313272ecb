"""Outputs of a run that appear together.

A run writes below ``_runs`` in its output folder, where readers of the folder do not look.
Committing makes one empty mark beside what was written; from then on the run counts. Its
outputs are then moved into place one by one. If the job dies before the mark, the earlier
outputs stay; if it dies after it, ``finish`` moves what is left, as the next run does
before it begins and ``run_batch``'s readers may do at any time.

One run at a time may write to a folder. Moving is a rename, or a copy in stores without one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RUNS, MARK = "_runs", ".committed"


def _store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(part.rstrip("/") for part in parts))


def _move(fs, source, target) -> None:
    """Put ``source`` in the place of ``target``; done again after a crash it ends the same."""
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not move {source.toString()} to {target.toString()}")


class StagedRun:
    """A place for the outputs of one run; ``commit`` makes them the outputs of the folder."""

    def __init__(self, spark: SparkSession, output_dir: str):
        finish(spark, output_dir)
        self.spark, self.output_dir = spark, output_dir
        self.name = uuid.uuid4().hex
        self.folder = f"{output_dir.rstrip('/')}/{RUNS}/{self.name}"

    def replace(self, name: str, by: str) -> None:
        """Within the run, let the output ``by`` take the place of ``name``."""
        fs = _store(self.spark, self.output_dir)
        _move(fs, _path(self.spark, self.folder, by), _path(self.spark, self.folder, name))

    def commit(self) -> None:
        fs = _store(self.spark, self.output_dir)
        fs.createNewFile(_path(self.spark, self.folder + MARK))
        finish(self.spark, self.output_dir)


def finish(spark: SparkSession, output_dir: str) -> bool:
    """Complete a commit that was cut short and clear what uncommitted runs left; whether there was one."""
    fs, runs = _store(spark, output_dir), _path(spark, output_dir, RUNS)
    if not fs.exists(runs):
        return False
    marks = [entry.getPath() for entry in fs.listStatus(runs) if entry.getPath().getName().endswith(MARK)]
    for mark in marks:
        run = _path(spark, output_dir, RUNS, mark.getName().removesuffix(MARK))
        for output in fs.listStatus(run) if fs.exists(run) else ():
            _move(fs, output.getPath(), _path(spark, output_dir, output.getPath().getName()))
        fs.delete(run, True)
        fs.delete(mark, False)
    fs.delete(runs, True)
    return bool(marks)
