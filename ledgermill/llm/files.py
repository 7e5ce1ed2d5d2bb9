"""Binary files in a folder that all executors reach, by any URI that pyarrow knows."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs

#: Schemes of Hadoop's connectors and what pyarrow calls the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def known_uri(uri: str) -> str:
    """``uri`` with a scheme that pyarrow knows; a plain path is a local file's."""
    scheme, there, rest = uri.partition("://")
    if there:
        return f"{SCHEMES.get(scheme, scheme)}://{rest}"
    return "file://" + uri.removeprefix("file:")


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(known_uri(uri))


def own_name(stem: str, ending: str) -> str:
    """A name no other attempt of a task uses."""
    return f"{stem}-{uuid.uuid4().hex}{ending}"


def open_new(uri: str):
    """A stream into a new file; folders are made."""
    fs, path = resolve(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def put(uri: str, content: bytes) -> None:
    """Write a file in one go: readers see all of it or, before that, nothing or an older one."""
    fs, path = resolve(uri)
    folder, name = path.rsplit("/", 1)
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(content)
    fs.move(part, path)


def open_random(uri: str):
    fs, path = resolve(uri)
    return fs.open_input_file(path)


def content(uri: str) -> bytes:
    with open_random(uri) as file:
        return file.read()
