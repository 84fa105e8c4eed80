"""Numbered commit documents: the small state that says which written files count.

A folder holds one JSON document per version, closed by the digest of its text. Each version
is created only if it is absent: of two writers of one version one fails with
``CommitConflict`` and nothing is lost. There is no delete and no rename, so at no moment is
the state absent. Readers take the highest complete version; a document that a crash cut off
does not count, and its number is taken over once it is older than the lease."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession

from clickflow.sources import fs

#: Seconds after which an unfinished document is taken for a crashed writer's.
LEASE_SECONDS = 600


class CommitConflict(RuntimeError):
    """Another writer has committed (or is committing) the same version."""


def _file(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/{version:012d}.json"


def _sealed(doc: dict) -> str:
    text = json.dumps(doc, sort_keys=True)
    return f"{text}\n{hashlib.sha256(text.encode()).hexdigest()}"


def _opened(text: str | None) -> dict | None:
    """The document in ``text`` if it is complete."""
    body, _, seal = (text or "").strip().rpartition("\n")
    return json.loads(body) if body and hashlib.sha256(body.encode()).hexdigest() == seal else None


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all documents in the folder, complete or not, in order."""
    found = [n.removesuffix(".json") for n in fs.names(spark, folder) if n.endswith(".json")]
    return sorted(int(n) for n in found if n.isdigit())


def read(spark: SparkSession, folder: str, version: int) -> dict | None:
    return _opened(fs.read_text(spark, _file(folder, version)))


def head(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """The highest complete version and its document; (0, None) when there is none."""
    for v in reversed(versions(spark, folder)):
        doc = read(spark, folder, v)
        if doc is not None:
            return v, doc
    return 0, None


def commit(spark: SparkSession, folder: str, version: int, doc: dict, lease: float = LEASE_SECONDS) -> None:
    """Write ``doc`` as ``version``; fails if that version or a later one is there."""
    last = versions(spark, folder)
    if last and last[-1] > version:
        raise CommitConflict(f"{folder}: version {last[-1]} is already there, {version} came too late")
    path = _file(folder, version)
    if last and last[-1] == version and read(spark, folder, version) is None and fs.age_seconds(spark, path) > lease:
        fs.delete(spark, path)
    try:
        fs.create_text(spark, path, _sealed(doc))
    except FileExistsError as ex:
        raise CommitConflict(f"{folder}: version {version} was committed by another writer") from ex
