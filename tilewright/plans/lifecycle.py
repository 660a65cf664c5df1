"""Lifecycle of built tables: create, publish by switching a pointer, retire old versions, clean up.

All file access goes through Hadoop's file system API, so any store that Spark writes to will do.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from .config import Manifest

_VERSION = re.compile(r".*_\d{8}_\d{4}")
_SCRATCH = re.compile(r"[a-z0-9]+://[^/]*/tmp/.+|file:/+tmp/.+")


class Store:
    """Small files and folders under a target folder."""

    def __init__(self, spark: SparkSession, target: str):
        self._jvm, self.target = spark._jvm, target.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name if "://" in name or name.startswith(("/", "file:")) else f"{self.target}/{name}")

    def _fs(self, name: str):
        return self._path(name).getFileSystem(self._conf)

    def exists(self, name: str) -> bool:
        return self._fs(name).exists(self._path(name))

    def write(self, name: str, text: str, overwrite: bool = True) -> None:
        out = self._fs(name).create(self._path(name), overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        source = self._fs(name).open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def rename(self, old: str, new: str) -> None:
        """Rename, replacing what is there in one step: a reader sees the one file or the other."""
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(kinds, 1)
        how[0] = kinds.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(new).getUri(), self._conf)
        context.rename(self._fs(old).makeQualified(self._path(old)), self._fs(new).makeQualified(self._path(new)), how)

    def delete(self, name: str) -> bool:
        return self._fs(name).delete(self._path(name), True)

    def folders(self) -> list[str]:
        if not self.exists(self.target):
            return []
        return sorted(s.getPath().getName() for s in self._fs(self.target).listStatus(self._path(self.target)) if s.isDirectory())

    def files(self, source: str) -> list[str]:
        """Paths of the data files below a folder, or below all that a glob matches; hidden files and folders are left out."""
        fs, out = self._fs(source), []
        for top in fs.globStatus(self._path(source)) or []:
            root = top.getPath().toString()
            found = fs.listFiles(top.getPath(), True)
            while found.hasNext():
                path = found.next().getPath().toString()
                if not any(part.startswith(("_", ".")) for part in path[len(root) :].split("/")):
                    out.append(path)
        return sorted(out)


def is_glob(source: str) -> bool:
    return bool(re.search(r"[*?\[{]", source))


def create(store: Store, manifest: Manifest) -> None:
    """Make a version's folder with its manifest; a version that is there already is an error."""
    if store.exists(manifest.table):
        raise FileExistsError(manifest.table)
    store.write(f"{manifest.table}/manifest.json", manifest.to_json(), overwrite=False)


def load(store: Store, table: str) -> Manifest:
    return Manifest.from_json(store.read(f"{table}/manifest.json"))


@contextlib.contextmanager
def locked(store: Store, name: str) -> Iterator[None]:
    """A lock file held for the block, released whatever happens; another holder is an error."""
    lock = f"{name}.lock"
    try:
        store.write(lock, uuid.uuid4().hex, overwrite=False)
    except Exception as e:
        raise BlockingIOError(f"{name} is locked") from e
    try:
        yield
    finally:
        store.delete(lock)


@contextlib.contextmanager
def pinned(store: Store, source: str) -> Iterator[list[str]]:
    """The source's files as they are now, with the source locked for the block.

    Whoever replaces files of the source must take the same lock; files that only arrive don't matter, as the list is fixed.
    """
    with locked(store, "source"):
        if not (files := store.files(source)):
            raise FileNotFoundError(f"no data files in {source}")
        yield files


def live(store: Store) -> dict[str, str | None]:
    """The live table of each mode, null where none has been published."""
    out: dict[str, str | None] = {}
    for mode in ("tiles", "points"):
        out[mode] = json.loads(store.read(f"live_{mode}.json"))["table"] if store.exists(f"live_{mode}.json") else None
    return out


def publish(store: Store, manifest: Manifest) -> None:
    """Make a version the live one of its mode; each mode has a pointer file of its own, so the other is untouched."""
    draft = f".live_{manifest.mode}.{uuid.uuid4().hex}"
    store.write(draft, json.dumps({"table": manifest.table}))
    store.rename(draft, f"live_{manifest.mode}.json")


def retire(store: Store, manifest: Manifest, keep: int = 2) -> list[str]:
    """Drop versions of this mode older than the newest ``keep``; never the live ones nor this run's."""
    prefix = f"{manifest.config.table_prefix}_{manifest.mode}"
    versions = [n for n in store.folders() if n.startswith(prefix) and _VERSION.fullmatch(n) and len(n) == len(prefix) + 14]
    spare = {manifest.table, *filter(None, live(store).values())}
    dropped = [n for n in sorted(versions, reverse=True)[keep:] if n not in spare]
    for name in dropped:
        store.delete(name)
    return dropped


def clean(store: Store, folder: str) -> bool:
    """Delete a working folder, only if it lies below a tmp folder."""
    return bool(_SCRATCH.fullmatch(folder)) and ".." not in folder and store.delete(folder)
