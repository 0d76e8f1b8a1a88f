"""Files that tasks write to and read from the shared folder, on any store of Arrow's."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs as arrow_fs
from pyspark import TaskContext


def store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system behind ``uri`` and the path in it."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            uri = "s3://" + uri[len(scheme) :]
    return arrow_fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str) -> Iterator:
    """Write a file that gets its name when it is whole.

    A repeated or speculative attempt of the task replaces it by the same content.
    """
    system, path = store(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    task = TaskContext.get()
    unfinished = f"{path}.{task.taskAttemptId() if task else 0}.tmp"
    with system.open_output_stream(unfinished) as out:
        yield out
    system.move(unfinished, path)


@contextmanager
def existing_file(uri: str) -> Iterator:
    """A file to read ranges from."""
    system, path = store(uri)
    with system.open_input_file(path) as source:
        yield source
