"""Single files that tasks write themselves."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable


def file_writer(folder: str) -> Callable[[str, bytes], None]:
    """``put(name, content)`` for a folder on a file system that Arrow knows, or a local path; called in tasks.

    A file is written under a name of its own and renamed, so a repeated attempt replaces the same
    file and no reader sees half of one.
    """
    from pyarrow import fs

    if ":" in folder and not folder.startswith("file:"):
        files, root = fs.FileSystem.from_uri(folder)
    else:
        files, root = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    files.create_dir(root, recursive=True)

    def put(name: str, content: bytes) -> None:
        own = f"{root}/.{uuid.uuid4().hex}-{os.getpid()}"
        with files.open_output_stream(own) as out:
            out.write(content)
        files.move(own, f"{root}/{name}")

    return put
