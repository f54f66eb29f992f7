"""Files of our own formats in the shared folder, written by tasks and committed by a manifest.

A task writes each file under a name that no other attempt has and returns a row that names it. The
rows are saved as a table; only files that this table names count. So a task that is repeated after
a lost executor, or run twice, leaves at most a file that nobody reads.
"""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs


def new_file(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_out(uri: str) -> BinaryIO:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_in(uri: str) -> BinaryIO:
    """For reading at any place."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)
