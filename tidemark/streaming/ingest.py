"""New landing files into keyed history, each file exactly once.

A run writes only what its files say: one collapsed row per key, under a folder
named by the micro-batch. A repeated batch overwrites its own folder, so a retry
cannot count twice. The current state is the merge of the newest version of the
base with the later deltas; the merge is associative, so compaction may happen at
any time, and sightings may arrive late.

    <root>/delta/epoch=<n>     rows of micro-batch n
    <root>/base/version=<v>    everything up to some micro-batch, merged
    <root>/current             names the newest version and the last micro-batch in it

`current` is one small file, replaced by a rename once its version is written, so
a reader sees the old state or the new one. It finds the state by folder names
alone. Compaction keeps the version before the new one, and its deltas, for readers
that are still on them, and removes what is older.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.history import collapse_sightings, merge_states


@dataclass(frozen=True)
class Version:
    """A written base, the micro-batches it holds (up to `upto`), and those its predecessor held."""

    number: int = 0
    upto: int = -1
    before: int = -1


def _file_context(spark: SparkSession):
    hadoop = spark._jvm.org.apache.hadoop
    return hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration()), hadoop.fs


def _place(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _place(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbered(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the complete folders `<name>=<n>`, by their names; no file is read."""
    fs, at = _file_system(spark, folder), _place(spark, folder)
    if not fs.exists(at):
        return []
    numbers = []
    for status in fs.listStatus(at):
        label, _, number = status.getPath().getName().partition("=")
        if label == name and fs.exists(_place(spark, f"{folder}/{name}={number}/_SUCCESS")):
            numbers.append(int(number))
    return sorted(numbers)


def current_version(spark: SparkSession, root: str) -> Version:
    """What `current` names; version 0, with nothing in it, before the first compaction."""
    path = f"{root}/current"
    if not _file_system(spark, path).exists(_place(spark, path)):
        return Version()
    return Version(**json.loads(spark.read.text(path).first()[0]))


def _name_version(spark: SparkSession, root: str, version: Version) -> None:
    """Replaces `current` in one step."""
    files, fs = _file_context(spark)
    fresh = f"{root}/current-{version.number}"
    out = _file_system(spark, fresh).create(_place(spark, fresh), True)
    out.write(bytearray(json.dumps(asdict(version)).encode()))
    out.close()
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(_place(spark, fresh), _place(spark, f"{root}/current"), options)


def ingest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    root: str,
    key: str,
    mutable: list[str],
    day: str,
    order: str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    frozen: tuple[str, ...] = (),
) -> None:
    """Processes every landing file not seen by an earlier run, then stops."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write_delta(batch: DataFrame, epoch: int) -> None:
        rows = collapse_sightings(batch, key, mutable, day, order, frozen)
        rows.write.mode("overwrite").parquet(f"{root}/delta/epoch={epoch}")

    run = (
        reader.load(landing).writeStream.foreachBatch(write_delta)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()


def _state(spark: SparkSession, root: str, version: Version, epochs: list[int], key: str, mutable: list[str], frozen: tuple[str, ...]) -> DataFrame:
    folders = [f"{root}/delta/epoch={n}" for n in epochs]
    if version.number:
        folders.append(f"{root}/base/version={version.number}")
    return merge_states(spark.read.parquet(*folders), key, mutable, frozen)


def current(spark: SparkSession, root: str, key: str, mutable: list[str], frozen: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: first and last sighting, the newest mutable and the oldest frozen values."""
    version = current_version(spark, root)
    later = [n for n in _numbered(spark, f"{root}/delta", "epoch") if n > version.upto]
    return _state(spark, root, version, later, key, mutable, frozen)


def compact(spark: SparkSession, root: str, key: str, mutable: list[str], frozen: tuple[str, ...] = ()) -> Version:
    """Folds all deltas into a new version, names it, and removes what only older versions need."""
    old = current_version(spark, root)
    later = [n for n in _numbered(spark, f"{root}/delta", "epoch") if n > old.upto]
    if not later:
        return old
    new = Version(old.number + 1, later[-1], old.upto)
    state = _state(spark, root, old, later, key, mutable, frozen)
    state.write.mode("overwrite").parquet(f"{root}/base/version={new.number}")
    _name_version(spark, root, new)
    remove_superseded(spark, root)
    return new


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Deletes versions older than the one before the current one, and the deltas that one holds."""
    version = current_version(spark, root)
    gone = [f"{root}/base/version={n}" for n in _numbered(spark, f"{root}/base", "version") if n < version.number - 1]
    gone += [f"{root}/delta/epoch={n}" for n in _numbered(spark, f"{root}/delta", "epoch") if n <= version.before]
    for folder in gone:
        _file_system(spark, folder).delete(_place(spark, folder), True)
    return gone
