"""Files that tasks write to and read from the shared folder.

A file gets its name only when it is whole: tasks write under a name of their own and
rename. A repeated or speculative task writes the same bytes again, so whichever attempt
comes last leaves the same file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from starfold.llm.common import file_system
from starfold.session import ship_by_value

ship_by_value(__name__)


@contextmanager
def whole_file(folder: str, name: str) -> Iterator:
    """A binary stream that becomes ``folder/name`` when the block ends well."""
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out:
        yield out
    fs.move(attempt, f"{path}/{name}")


def open_file(folder: str, name: str):
    """A readable, seekable file of the folder."""
    fs, path = file_system(folder)
    return fs.open_input_file(f"{path}/{name}")
