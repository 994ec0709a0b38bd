"""File systems that tasks can open by the paths Spark lists."""

from __future__ import annotations

import re

from pyarrow import fs

_ADDRESS = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$")


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it.

    Spark writes addresses without escapes, so only scheme and authority are taken as one.
    """
    match = _ADDRESS.match(path)
    if match is None or match.group(1) == "file":
        return fs.LocalFileSystem(), match.group(3) if match else path
    scheme, authority, rest = match.groups()
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return system, f"{root.rstrip('/')}{rest or ''}" if root.strip("/") else rest or "/"
