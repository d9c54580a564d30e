"""Small files and folders of any file system that pyarrow knows: local paths, file://, hdfs://, s3://."""

from __future__ import annotations

import uuid

from pyarrow import fs


def at(path) -> tuple[fs.FileSystem, str]:
    path = str(path)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def exists(path) -> bool:
    system, place = at(path)
    return system.get_file_info(place).type != fs.FileType.NotFound


def is_folder(path) -> bool:
    system, place = at(path)
    return system.get_file_info(place).type == fs.FileType.Directory


def names(folder) -> list[str]:
    """Names in a folder, none if it is not there."""
    system, place = at(folder)
    return sorted(i.base_name for i in system.get_file_info(fs.FileSelector(place, allow_not_found=True)))


def remove(path) -> None:
    """A file or a whole folder; nothing if it is not there."""
    system, place = at(path)
    kind = system.get_file_info(place).type
    if kind == fs.FileType.Directory:
        system.delete_dir(place)
    elif kind != fs.FileType.NotFound:
        system.delete_file(place)


def read_text(path) -> str:
    system, place = at(path)
    with system.open_input_stream(place) as f:
        return f.read().decode()


def write_text(path, text: str) -> None:
    """Replaces a file as a whole."""
    system, place = at(path)
    folder = place.rpartition("/")[0]
    if folder:
        system.create_dir(folder, recursive=True)
    own = f"{folder}/.{uuid.uuid4().hex}" if folder else f".{uuid.uuid4().hex}"
    with system.open_output_stream(own) as f:
        f.write(text.encode())
    system.move(own, place)
