"""Renames and existence checks on whatever file system a path names, on the driver or in a task."""

from __future__ import annotations

import os
from urllib.parse import urlsplit

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path on it. Special characters in the path are taken as they are."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    parts = urlsplit(path)
    if parts.scheme == "file":
        return fs.LocalFileSystem(), path.removeprefix("file://")
    root = f"{parts.scheme}://{parts.netloc}/"
    filesystem, prefix = fs.FileSystem.from_uri(root)
    return filesystem, prefix.rstrip("/") + "/" + path[len(root) :]


def exists(path: str) -> bool:
    filesystem, name = resolve(path)
    return filesystem.get_file_info(name).type != fs.FileType.NotFound


def move(source: str, target: str) -> None:
    """Rename, creating the parent directory of the target."""
    filesystem, name = resolve(target)
    filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
    filesystem.move(resolve(source)[1], name)


def make_directory(path: str) -> None:
    filesystem, name = resolve(path)
    filesystem.create_dir(name, recursive=True)


def delete_directory(path: str) -> None:
    filesystem, name = resolve(path)
    if filesystem.get_file_info(name).type != fs.FileType.NotFound:
        filesystem.delete_dir(name)


def subdirectories(path: str) -> list[str]:
    """Base names of the directories directly below ``path``."""
    filesystem, name = resolve(path)
    selector = fs.FileSelector(name, allow_not_found=True)
    return [info.base_name for info in filesystem.get_file_info(selector) if info.type == fs.FileType.Directory]


def files_at(path: str) -> list[str]:
    """The path itself if it is a file; if a directory, the data files in it; else nothing."""
    filesystem, name = resolve(path)
    kind = filesystem.get_file_info(name).type
    if kind == fs.FileType.File:
        return [path]
    if kind == fs.FileType.NotFound:
        return []
    inside = filesystem.get_file_info(fs.FileSelector(name))
    return [
        f"{path}/{info.base_name}"
        for info in inside
        if info.type == fs.FileType.File and info.base_name.startswith("part-")
    ]


def file_names(path: str) -> list[str]:
    """Base names of the files directly in a directory."""
    filesystem, name = resolve(path)
    selector = fs.FileSelector(name, allow_not_found=True)
    return [info.base_name for info in filesystem.get_file_info(selector) if info.type == fs.FileType.File]


def put_if_absent(path: str, data: bytes) -> bool:
    """Write a small file whole unless there is one; whether it was written.

    A local file system decides between writers by itself. Others are asked first, so two writers at the very same moment need
    a store that refuses the second.
    """
    filesystem, name = resolve(path)
    filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
    if isinstance(filesystem, fs.LocalFileSystem):
        # Written aside and linked, so that the file shows up whole.
        aside = f"{name.rsplit('/', 1)[0]}/_{os.getpid()}-{os.urandom(8).hex()}"
        with open(aside, "wb") as out:
            out.write(data)
        try:
            os.link(aside, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True
    if filesystem.get_file_info(name).type != fs.FileType.NotFound:
        return False
    with filesystem.open_output_stream(name) as out:
        out.write(data)
    return True


def delete_file(path: str) -> None:
    filesystem, name = resolve(path)
    if filesystem.get_file_info(name).type == fs.FileType.File:
        filesystem.delete_file(name)


def delete_if_empty(path: str) -> None:
    filesystem, name = resolve(path)
    if filesystem.get_file_info(name).type == fs.FileType.Directory and not filesystem.get_file_info(fs.FileSelector(name)):
        filesystem.delete_dir(name)


def read(path: str) -> bytes:
    filesystem, name = resolve(path)
    with filesystem.open_input_stream(name) as source:
        return source.read()


def copy_file(source: str, target: str) -> None:
    """Copy a file on one file system, creating the parent directory of the target."""
    filesystem, name = resolve(target)
    filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
    filesystem.copy_file(resolve(source)[1], name)


def files_below(path: str) -> list[str]:
    """Paths, from ``path`` on, of all files below a directory."""
    filesystem, name = resolve(path)
    selector = fs.FileSelector(name, allow_not_found=True, recursive=True)
    start = len(name.rstrip("/")) + 1
    return [info.path[start:] for info in filesystem.get_file_info(selector) if info.type == fs.FileType.File]
