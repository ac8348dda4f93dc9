"""Files that tasks write and read themselves, on any store that ``pyarrow.fs`` reaches by URI.

A task writes under a name of its own attempt and moves the whole file to its final name, which is
the same for every attempt and holds the same bytes. Readers take the names from a manifest, never
from a listing, so what a lost or speculative attempt left behind is not seen.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext

PENDING = "_pending"


# What Spark calls stores that ``pyarrow.fs`` knows by another scheme.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def known_uri(uri: str) -> str:
    scheme, separator, rest = uri.partition("://")
    return f"{SCHEMES.get(scheme, scheme)}{separator}{rest}"


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(known_uri(uri))


def task() -> tuple[int, int]:
    """The number of this task's partition, and of its attempt."""
    context = TaskContext.get()
    return context.partitionId(), context.taskAttemptId()


@contextmanager
def publishing(folder: str, name: str):
    """An output stream whose file appears as folder/name once it is complete."""
    where, root = store(folder)
    where.create_dir(f"{root}/{PENDING}", recursive=True)
    pending = f"{root}/{PENDING}/{task()[1]}-{name}"
    with where.open_output_stream(pending, compression=None) as out:
        yield out
    where.move(pending, f"{root}/{name}")


@contextmanager
def reading(folder: str, name: str):
    """A seekable input file."""
    where, root = store(folder)
    with where.open_input_file(f"{root}/{name}") as source:
        yield source
