"""Versioned tables: ``{folder}/{name}_v{number}.{csv|parquet}``.

A writer claims a number with a file of its own, ``.{name}_v{number}.claim-{id}``, which names the owner and the
time, and then lists the number's claims. It owns the number if it finds no other: of two writers at
least one sees the other, so both can't win, and it withdraws and tries the next number. This needs a store that lists
what was written, but none that creates files exclusively. The claim stays; once the version is whole, it says so.

A reader takes the newest version that is whole. One that is not is being written if its claim is young;
with an old claim, or one marked as failed, its writer died, and reading raises rather than give an older table.
"""

from __future__ import annotations

import getpass
import json
import re
import socket
import time
import uuid
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weekloom.sources.read import load_data

#: Seconds a writer may take before it counts as dead.
PATIENCE = 6 * 3600
#: Numbers a writer tries before it gives up.
ATTEMPTS = 50


@dataclass(frozen=True)
class Claim:
    """What a writer says about its number. ``state`` is ``writing``, ``published`` or ``failed``."""

    number: int
    path: str
    owner: str
    started: float
    state: str


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    file_type: str
    complete: bool
    writing: bool = False
    owner: str = "unknown"
    started: float | None = None


class _Folder:
    """A folder on any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.root = self.path(folder)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def listed(self) -> list:
        return list(self.fs.listStatus(self.root)) if self.fs.exists(self.root) else []

    def write(self, name: str, content: dict) -> None:
        self.fs.mkdirs(self.root)
        out = self.fs.create(self.path(self.root, name), True)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()

    def read(self, path) -> dict:
        source = self.fs.open(path)
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8") or "{}")
        except ValueError:
            return {}  # a claim that is being rewritten
        finally:
            source.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(self.root, name), False)


def list_claims(spark: SparkSession, folder: str, name: str) -> list[Claim]:
    """Claims of exactly ``name``, lowest number first."""
    where, found = _Folder(spark, folder), []
    pattern = re.compile(rf"\.{re.escape(name)}_v(\d+)\.claim-\w+")
    for status in where.listed():
        match = pattern.fullmatch(status.getPath().getName())
        if match:
            said = where.read(status.getPath())
            started = said.get("started", status.getModificationTime() / 1000)
            found.append(Claim(int(match[1]), status.getPath().toString(), said.get("owner", "unknown"), started, said.get("state", "writing")))
    return sorted(found, key=lambda claim: (claim.number, claim.path))


def list_versions(spark: SparkSession, folder: str, name: str, patience: float = PATIENCE) -> list[Version]:
    """Versions of exactly ``name``, lowest first, on any Hadoop file system.

    A folder counts as complete once Spark has left its ``_SUCCESS`` marker; a plain file always does. One that is not
    is being written while its claim, or without a claim its temporary folder, is younger than ``patience`` seconds.
    A number that was claimed, and of which nothing is there, is listed too unless its writer gave it up.
    """
    where = _Folder(spark, folder)
    pattern = re.compile(rf"{re.escape(name)}_v(\d+)\.(csv|parquet)")
    claims = {claim.number: claim for claim in list_claims(spark, folder, name)}
    now, found = time.time(), {}
    for status in where.listed():
        path = status.getPath()
        match = pattern.fullmatch(path.getName())
        if match:
            number = int(match[1])
            claim, temporary = claims.get(number), where.path(path, "_temporary")
            complete = status.isFile() or where.fs.exists(where.path(path, "_SUCCESS"))
            started = claim.started if claim else None
            if claim is None and not complete and where.fs.exists(temporary):
                started = where.fs.getFileStatus(temporary).getModificationTime() / 1000
            failed = claim is not None and claim.state == "failed"
            writing = not complete and not failed and started is not None and now - started < patience
            owner = claim.owner if claim else "unknown"
            found[number] = Version(number, path.toString(), match[2], complete, writing, owner, started)
    for number, claim in claims.items():
        if number not in found and claim.state == "writing":
            path = f"{folder.rstrip('/')}/{name}_v{number}"
            found[number] = Version(number, path, "", False, now - claim.started < patience, claim.owner, claim.started)
    return [found[number] for number in sorted(found)]


def reserve_version(spark: SparkSession, folder: str, name: str) -> Claim:
    """Claim the next version's number. A number whose write failed stays taken."""
    where, number = _Folder(spark, folder), 0
    owner = f"{getpass.getuser()}@{socket.gethostname()} {spark.sparkContext.applicationId}"
    for attempt in range(ATTEMPTS):
        number = max(number + 1, next_version(spark, folder, name))
        mine = f".{name}_v{number}.claim-{uuid.uuid4().hex}"
        said = {"owner": owner, "started": time.time(), "state": "writing"}
        where.write(mine, said)
        others = [c for c in list_claims(spark, folder, name) if c.number == number and not c.path.endswith(mine)]
        if not others and not _written(where, name, number):
            return Claim(number, f"{folder.rstrip('/')}/{mine}", owner, said["started"], "writing")
        where.delete(mine)
    raise FileExistsError(f"other writers have taken {ATTEMPTS} numbers of '{name}' in {folder}, up to {number}")


def settle(spark: SparkSession, claim: Claim, state: str) -> None:
    """Say in the claim that its version is ``published``, or that its write has ``failed``."""
    folder, _, name = claim.path.rpartition("/")
    _Folder(spark, folder).write(name, {"owner": claim.owner, "started": claim.started, "state": state, "settled": time.time()})


def _written(where: _Folder, name: str, number: int) -> bool:
    return any(s.getPath().getName() in (f"{name}_v{number}.csv", f"{name}_v{number}.parquet") for s in where.listed())


def next_version(spark: SparkSession, folder: str, name: str) -> int:
    """One more than the highest written or claimed, so a deleted version never frees its number."""
    pattern = re.compile(rf"\.?{re.escape(name)}_v(\d+)\.(csv|parquet|reserved|claim-\w+)")
    names = [status.getPath().getName() for status in _Folder(spark, folder).listed()]
    return max((int(m[1]) for n in names if (m := pattern.fullmatch(n))), default=0) + 1


def read_latest(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: T.StructType | str | None = None,
    patience: float = PATIENCE,
    **options,
) -> DataFrame:
    """The newest version of ``name``. One that is still being written is passed over with a warning; one that
    is neither being written nor whole is an error, as the newest data are missing."""
    versions = list_versions(spark, folder, name, patience)
    while versions and versions[-1].writing:
        skipped = versions.pop()
        warnings.warn(f"{skipped.path} is being written by {skipped.owner}; an older version is read", stacklevel=2)
    if not versions:
        raise FileNotFoundError(f"no version of '{name}' in {folder}")
    newest = versions[-1]
    if not newest.complete:
        begun = "" if newest.started is None else f", begun by {newest.owner} {time.time() - newest.started:.0f} seconds ago"
        raise RuntimeError(f"{newest.path}{begun}, has no _SUCCESS marker: its write failed, or markers are switched off")
    return load_data(spark, newest.path, newest.file_type, schema, **options)
