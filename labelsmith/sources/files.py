"""Byte access to files of any store that pyarrow can open, for readers and writers that need positions.

Paths are URIs (``file:``, ``s3:``, ``gs:``, ``hdfs:``) or plain absolute paths. Used on the driver
to list files and inside tasks to read ranges or write; nothing whole passes through the driver.
"""

from __future__ import annotations

import posixpath
import sys

from pyarrow import fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path within it; ``file:/x`` is read like ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def data_files(path: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the data file at ``path`` or of those below the folder, by name.

    Names that begin with ``_`` or ``.`` are not data, as for Spark's own sources; empty files are left out.
    """
    store, inner = opened(path)
    here = store.get_file_info(inner)
    if here.type == fs.FileType.NotFound:
        return []
    infos = [here] if here.is_file else store.get_file_info(fs.FileSelector(inner, recursive=True))
    shown = lambda name: not any(x[:1] in ("_", ".") for x in posixpath.relpath(name, inner).split("/") if x != ".")
    return sorted((i.path, i.size) for i in infos if i.is_file and i.size and shown(i.path))


def reachable(path: str) -> bool:
    """Whether pyarrow knows the path's store; where it doesn't, Spark's own readers are used."""
    try:
        opened(path)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def uri(of: str, inner: str) -> str:
    """The full name of a path found below ``of``, as Spark's ``_metadata`` writes it."""
    return f"{of.split('://', 1)[0] if '://' in of else 'file'}://{inner}"


def ranges(files: list[tuple[str, int]], width: int) -> list[tuple[str, int, int, int]]:
    """``(path, begin, end, file size)`` of byte ranges of at most ``width``."""
    return [(p, a, min(a + width, n), n) for p, n in files for a in range(0, n, width)]
