"""File access for Python-side readers and writers: local paths and any
filesystem pyarrow knows (HDFS, S3, GCS, ...) by URI."""

from __future__ import annotations

import glob
import os
import shutil
from urllib.parse import unquote


def _fs_and_path(uri: str):
    if uri.startswith("file:"):
        return None, "/" + unquote(uri[len("file:"):]).lstrip("/")
    if "://" not in uri:
        return None, uri
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def open_input(uri: str):
    filesystem, path = _fs_and_path(uri)
    if filesystem is None:
        return open(path, "rb")
    return filesystem.open_input_stream(path)


def open_random(uri: str):
    """A file that can seek."""
    filesystem, path = _fs_and_path(uri)
    if filesystem is None:
        return open(path, "rb")
    return filesystem.open_input_file(path)


def file_sizes(uris: list[str]) -> dict[str, int]:
    """Bytes of each file (0 for one that is not there), asked for in one call per file system."""
    out = {u: 0 for u in uris}
    remote: dict = {}
    for u in out:
        filesystem, path = _fs_and_path(u)
        if filesystem is None:
            out[u] = os.path.getsize(path) if os.path.isfile(path) else 0
        else:
            remote.setdefault(u[:len(u) - len(path)], (filesystem, []))[1].append((u, path))
    for filesystem, found in remote.values():
        for (u, _), info in zip(found, filesystem.get_file_info([p for _, p in found])):
            out[u] = info.size or 0
    return out


def count_empty(folder: str, suffix: str) -> int:
    """Files without a byte under a folder: Spark's file sources pass over them."""
    filesystem, path = _fs_and_path(folder)
    if filesystem is None:
        return sum(os.path.getsize(os.path.join(root, f)) == 0
                   for root, _dirs, files in os.walk(path) for f in files if f.endswith(suffix))
    from pyarrow import fs
    found = filesystem.get_file_info(fs.FileSelector(path, recursive=True))
    return sum(i.type == fs.FileType.File and i.size == 0 and i.path.endswith(suffix) for i in found)


def open_output(uri: str):
    filesystem, path = _fs_and_path(uri)
    if filesystem is None:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        return open(path, "wb")
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(path)


def delete_folder(uri: str) -> None:
    """The folder and all in it, if it is there."""
    filesystem, path = _fs_and_path(uri)
    if filesystem is None:
        if os.path.isdir(path):
            shutil.rmtree(path)
        return
    from pyarrow import fs
    if filesystem.get_file_info(path).type == fs.FileType.Directory:
        filesystem.delete_dir(path)


def list_files(spec: str, suffixes: tuple[str, ...] = ()) -> list[str]:
    """Comma-separated files, folders (recursive) or globs -> sorted files."""
    out: list[str] = []
    for part in [p.strip() for p in spec.split(",") if p.strip()]:
        filesystem, path = _fs_and_path(part)
        if filesystem is None:
            if os.path.isdir(path):
                for root, _dirs, files in os.walk(path):
                    out += [os.path.join(root, f) for f in files]
            else:
                out += glob.glob(path) or [path]
        else:
            from pyarrow import fs
            info = filesystem.get_file_info(path)
            prefix = part[: len(part) - len(path)] if part.endswith(path) else ""
            if info.type == fs.FileType.Directory:
                sel = fs.FileSelector(path, recursive=True)
                out += [prefix + i.path for i in filesystem.get_file_info(sel) if i.type == fs.FileType.File]
            else:
                out.append(part)
    if suffixes:
        out = [p for p in out if p.endswith(suffixes)]
    return sorted(set(out))
