"""Small files a driver keeps beside its tables: manifests that appear whole or not at all."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs

from tallyline.sources.folder import file_system


def write_json(path: str, content: dict) -> None:
    """Write a JSON file under a name of its own and move it into place."""
    target, file = file_system(path)
    folder, _, _ = file.rpartition("/")
    target.create_dir(folder, recursive=True)
    part = f"{folder}/.{uuid.uuid4().hex}"
    with target.open_output_stream(part) as out:
        out.write(json.dumps(content).encode())
    target.move(part, file)


def read_json(path: str) -> dict | None:
    """The content of a JSON file, or None if there is none."""
    target, file = file_system(path)
    if target.get_file_info(file).type != fs.FileType.File:
        return None
    with target.open_input_stream(file) as source:
        return json.loads(source.read())


def names_in(path: str) -> list[str]:
    """Names of the files and folders directly in a folder, but for hidden ones; none if it is absent."""
    target, folder = file_system(path)
    found = target.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(x.base_name for x in found if not x.base_name.startswith("."))


def remove(path: str) -> None:
    """Remove a file or a folder with all in it; an absent one does not matter."""
    target, file = file_system(path)
    kind = target.get_file_info(file).type
    if kind == fs.FileType.Directory:
        target.delete_dir(file)
    elif kind == fs.FileType.File:
        target.delete_file(file)
