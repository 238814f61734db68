"""Changes of a dataset of plain files that come as a whole or, after a lost run, not at all.

Replacing: the new dataset is written next to the old one, then swapped in. Two renames are
not one: readers may find no target in between, and a crash there is mended by the next run.
Replacing some folders: the new ones wait in a hidden folder of the dataset, whose last name
says that all of them are there; from then on the next run finishes what one has left. Adding under the name of a run: the files are written next to the dataset and
moved in one by one; the same run, repeated, goes on where it was lost, and adds nothing once
it is done. Where rename copies (object stores) use a table format instead.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrameWriter, SparkSession

from eclusa import journal
from eclusa.errors import SinkError
from eclusa.functions.locations import Files

# Lies in a fresh dataset from before it takes its place until the old one is gone.
FRESH = "_mesclado"

# Holds the folders that are still to take their places; in those that replace nothing but
# an old folder lies this file.
PARTS, EMPTY = ".partes", "_vazia"

# Files in a target that name the last micro-batch each stream has merged into it.
BATCH_MARK = "_lote-"

# Lies in what a run adds once all of it is written, and in the target once all of it is moved.
WRITTEN, ADDED = "_escrito", "_execucao-"


def siblings(target: str) -> tuple[str, str] | None:
    """Where the fresh dataset is written, and where the old one waits during the swap."""
    parent, _, name = target.rstrip("/").rpartition("/")
    if not name or parent.endswith(("/", ":")):
        return None
    return f"{parent}/.{name}.{uuid.uuid4().hex}", f"{parent}/.{name}.antes"


def replace(spark: SparkSession, out: DataFrameWriter, target: str, marks: tuple[str, ...] = ()) -> None:
    """Write next to the target, then swap by rename; if the write fails, the target stays.

    ``marks`` are names of empty files that come with the dataset.
    """
    found = siblings(target)
    if found is None:
        raise SinkError(f"{target} has no folder around it to prepare the new dataset in")
    files = Files(spark, target)
    fresh, old = found
    try:
        out.save(fresh)
        for name in marks:
            files.touch(f"{fresh}/{name}")
        # Whoever finds this file knows that the dataset around it is whole.
        files.touch(f"{fresh}/{FRESH}")
        if not files.rename(target, old):
            raise SinkError(f"cannot move {target} aside")
        if not files.rename(fresh, target):
            files.rename(old, target)
            raise SinkError(f"cannot move the new dataset to {target}")
    finally:
        files.remove(fresh)
    files.remove(old)
    files.remove(f"{target}/{FRESH}")


def replace_folders(
    spark: SparkSession,
    out: DataFrameWriter,
    target: str,
    folders: Sequence[str],
    depth: int,
    marks: tuple[str, ...] = (),
) -> None:
    """Write the target's partitions anew, ``depth`` folders deep; if the write fails, it stays.

    ``folders`` are those that what is written stands for, relative to the target; the ones
    it has no rows for go. ``marks`` are names of empty files that come with the change, in
    place of those that the target has.
    """
    files, fresh = Files(spark, target), f"{target}/{PARTS}-{uuid.uuid4().hex}"
    try:
        out.save(fresh)
        for folder in set(folders) - set(files.folders(fresh, depth)):
            files.make_folder(f"{fresh}/{folder}")
            files.touch(f"{fresh}/{folder}/{EMPTY}")
        for name in marks:
            files.touch(f"{fresh}/{name}")
        files.touch(f"{fresh}/{WRITTEN}-{depth}")
        if not files.rename(fresh, f"{target}/{PARTS}"):
            raise SinkError(f"cannot keep the new folders of {target}")
    finally:
        files.remove(fresh)
    _place_folders(files, target)


def _place_folders(files: Files, target: str) -> None:
    """Put the waiting folders in their places. Done again from the start if it is interrupted."""
    waiting = f"{target}/{PARTS}"
    depth = int(files.names(waiting, f"{WRITTEN}-")[0].rpartition("-")[2])
    for folder in files.folders(waiting, depth):
        files.remove(f"{target}/{folder}")
        if files.exists(f"{waiting}/{folder}/{EMPTY}"):
            files.remove_empty(target, folder)
            files.remove(f"{waiting}/{folder}")
            continue
        files.make_folder(f"{target}/{folder}".rpartition("/")[0])
        if not files.rename(f"{waiting}/{folder}", f"{target}/{folder}"):
            raise SinkError(f"cannot move {folder} into {target}")
    marks = files.names(waiting, BATCH_MARK)
    for name in marks:
        files.touch(f"{target}/{name}")
    for name in set(files.names(target, BATCH_MARK)) - set(marks):
        files.remove(f"{target}/{name}")
    # Renamed first, as a folder half removed would not say any more how deep it is.
    done = f"{target}/{PARTS}-{uuid.uuid4().hex}"
    if not files.rename(waiting, done):
        raise SinkError(f"cannot put away {waiting}")
    files.remove(done)


def restore_interrupted(spark: SparkSession, target: str) -> None:
    """Finish, or take back, a change that a lost run has left half done."""
    files = Files(spark, target)
    if files.exists(f"{target}/{PARTS}"):
        journal.info("placing the folders of a lost run", target=target)
        _place_folders(files, target)
    found = siblings(target)
    if found is None:
        return
    old = found[1]
    if not files.exists(old):
        return
    if files.exists(f"{target}/{FRESH}"):
        journal.info("removing what a swap has replaced", target=target)
        files.remove(old)
        files.remove(f"{target}/{FRESH}")
        return
    if files.exists(target):
        raise SinkError(f"{old} is left from an interrupted swap; compare it and remove it")
    journal.info("restoring target of an interrupted swap", target=target)
    files.rename(old, target)


def add_once(spark: SparkSession, out: DataFrameWriter, target: str, run: str) -> bool:
    """Add files to the target under the name of a run; False if that run has done so already.

    A run lost while it writes leaves nothing behind, and is written again when it is repeated;
    one lost while files are moved is finished, not written again, so that every file is
    moved once. The files' names begin with the run's mark.
    """
    found = siblings(target)
    if found is None:
        raise SinkError(f"{target} has no folder around it to prepare the new files in")
    files, mark = Files(spark, target), hashlib.sha256(run.encode()).hexdigest()[:32]
    if files.exists(f"{target}/{ADDED}{mark}"):
        journal.info("run has been added already", target=target, run=run)
        return False
    staging = f"{found[1].removesuffix('.antes')}.{mark}"
    if not files.exists(f"{staging}/{WRITTEN}"):
        files.remove(staging)
        out.mode("overwrite").save(staging)
        files.touch(f"{staging}/{WRITTEN}")
    for folder, name in files.below(staging):
        place = f"{target}/{folder}" if folder else target
        files.make_folder(place)
        if not files.rename(f"{staging}/{folder}/{name}", f"{place}/{mark}-{name}"):
            raise SinkError(f"cannot move {name} to {place}")
    files.make_folder(target)
    files.touch(f"{target}/{ADDED}{mark}")
    files.remove(staging)
    return True
