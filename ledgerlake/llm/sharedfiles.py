"""Binary arrays in the shared folder, memory-mapped by workers.

Tasks write arrays under a temporary name and rename them, so a task that
runs twice leaves the same file. A folder on a file system that every machine
mounts (``file:``) is mapped in place; from any other store a worker fetches
an array once into its own temporary folder and maps that copy.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np

_MAPS: dict[tuple[str, str], np.ndarray] = {}


def local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri if "://" not in uri else None


def put(uri: str, data: bytes) -> None:
    path = local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
        return
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)


def mapped(uri: str, kind: str) -> np.ndarray:
    """The array at ``uri``; a file that is missing is an empty array."""
    if (uri, kind) not in _MAPS:
        path = local(uri)
        if path is None:
            from pyarrow import fs
            store, there = fs.FileSystem.from_uri(uri)
            path = os.path.join(tempfile.gettempdir(), f"map-{uuid.uuid5(uuid.NAMESPACE_URL, uri).hex}")
            if not os.path.exists(path) and store.get_file_info(there).is_file:
                part = f"{path}.{uuid.uuid4().hex}"
                with store.open_input_stream(there) as f, open(part, "wb") as out:
                    while block := f.read(1 << 24):
                        out.write(block)
                os.replace(part, path)
        there = os.path.exists(path) and os.path.getsize(path)
        _MAPS[uri, kind] = np.memmap(path, kind, "r") if there else np.zeros(0, kind)
    return _MAPS[uri, kind]
