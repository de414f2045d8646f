"""Binary files in shared folders, from any task."""

from __future__ import annotations


def open_file(path: str, write: bool = False):
    """A stream on ``path``, a URI of a file system that pyarrow knows; folders are made."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    if not write:
        return system.open_input_file(inner)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)
