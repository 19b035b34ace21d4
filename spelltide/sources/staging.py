"""Tables that are written before they count: intermediates of a job, and results on their way to a target."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from spelltide.sources.scratch import drop_path, file_system, hadoop_path, scratch_path

#: Folders of the innermost open scope.
_OPEN: ContextVar[list[str] | None] = ContextVar("spelltide_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Whatever `staged` writes inside the block is deleted when the block ends, also by an error.

    Frames that read such tables are of no use afterwards, so write the result inside.
    """
    folders: list[str] = []
    token = _OPEN.set(folders)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in folders:
            drop_path(spark, path)


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame as Parquet under the shared folder and read it again.

    Cuts the lineage: a lost executor costs a re-read, not the work before. Spark then knows the table's size,
    and a join of it comes straight from an exchange of its own, which AQE can split. The folder goes
    with the enclosing `scratch_scope`, or without one when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    folders = _OPEN.get()
    if folders is not None:
        folders.append(path)
    df.write.options(**options).parquet(path)
    if folders is None:
        file_system(spark, path).deleteOnExit(hadoop_path(spark, path))
    return spark.read.schema(df.schema).parquet(path)


def staging_path(target: str) -> str:
    """A hidden folder beside the target, so that publishing is a rename within one file system."""
    parent, slash, name = target.rstrip("/").rpartition("/")
    if not name or parent.endswith((":", ":/")):
        raise ValueError(f"{target} is the root of a store, name a folder in it")
    return f"{parent}{slash}_staging-{name}-{uuid.uuid4().hex}"


class _Moves:
    """Renames that are undone together when one of them fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.fs, self.done = spark, file_system(spark, root), []
        self.aside = f"{staging_path(root)}-old"

    def path(self, text: str):
        return hadoop_path(self.spark, text)

    def exists(self, text: str) -> bool:
        return self.fs.exists(self.path(text))

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")
        self.done.append((source, target))

    def set_aside(self, target: str, name: str) -> None:
        if self.exists(target):
            self.move(target, f"{self.aside}/{name}")

    def undo(self) -> None:
        for source, target in reversed(self.done):
            self.fs.rename(self.path(target), self.path(source))

    def files(self, folder: str) -> Iterator[tuple[str, str]]:
        """Folder, relative to the given one, and name of every data file below it."""
        todo = [""]
        while todo:
            inside = todo.pop()
            for status in self.fs.listStatus(self.path(f"{folder}/{inside}" if inside else folder)):
                name = status.getPath().getName()
                if status.isDirectory():
                    todo.append(f"{inside}/{name}" if inside else name)
                elif not name.startswith(("_", ".")):
                    yield inside, name


def publish(spark: SparkSession, staging: str, target: str, mode: str, dynamic: bool = False) -> None:
    """Put a staged folder in the place of the target, or what it holds into it.

    `overwrite` replaces the whole target by one rename; with `dynamic`, only the partition folders that the staged
    one has, by one rename each. `append` adds the staged files; Spark's file names are unique. What is replaced is
    set aside and deleted at the end. If a rename fails, those before are undone and the target is as it
    was. Readers can meet a moment without the folder that is being replaced.
    """
    target = target.rstrip("/")
    moves = _Moves(spark, target)
    try:
        if mode == "append" or dynamic:
            held = sorted(set(moves.files(staging)))
            folders = sorted({inside for inside, _ in held})
            if dynamic:
                for i, inside in enumerate(folders):
                    place = f"{target}/{inside}".rstrip("/")
                    moves.set_aside(place, str(i))
                    moves.move(f"{staging}/{inside}".rstrip("/"), place)
            else:
                for inside, name in held:
                    place = f"{inside}/{name}".lstrip("/")
                    moves.move(f"{staging}/{place}", f"{target}/{place}")
        else:
            moves.set_aside(target, "target")
            moves.move(staging, target)
    except Exception:
        moves.undo()
        raise
    finally:
        drop_path(spark, moves.aside)
