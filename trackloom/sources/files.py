"""Single files by path or URI, as workers open and replace them.

Spark's readers list and split folders; a media file that an annotator opens and a record that is replaced in place are
single files, reached through Arrow's file systems. Cluster paths name some of them by schemes of Hadoop's connectors.
"""

from __future__ import annotations

import functools
import os
import posixpath
import uuid

from pyarrow import fs

# --- fixed values: Hadoop's connector schemes, and what the same store is called here ---
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "wasb": "abfs", "wasbs": "abfss"}
#: Schemes that every node has mounted as a local folder.
MOUNTED = {"file": "", "dbfs": "/dbfs"}
#: Stores in which an object appears whole when its stream is closed, and a rename is a copy.
OBJECT_STORES = ("s3", "gcs", "abfs")
# ----------------------------------------------------------------------------------------


def split_uri(uri: str) -> tuple[str, str, str]:
    """Scheme, authority and path; a plain path has neither of the first two."""
    scheme, colon, rest = uri.partition(":")
    if not colon or not scheme or "/" in scheme:
        return "", "", uri
    if not rest.startswith("//"):
        return scheme, "", rest
    authority, _, path = rest[2:].partition("/")
    return scheme, authority, "/" + path


@functools.lru_cache(maxsize=64)
def _filesystem(scheme: str, authority: str) -> tuple[fs.FileSystem, str]:
    """One file system per store and worker, and what stands before its paths."""
    known = SCHEMES.get(scheme, scheme)
    region = os.environ.get("AWS_REGION") or os.environ.get("AWS_DEFAULT_REGION")
    if known == "s3" and region:  # else the bucket's region is asked for over the network
        return fs.S3FileSystem(region=region), authority
    if known.startswith("abfs"):  # container@account.host
        container, _, account = authority.partition("@")
        return fs.AzureFileSystem(account.partition(".")[0]), container
    return fs.FileSystem.from_uri(f"{known}://{authority}/")


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    scheme, authority, path = split_uri(uri)
    if not scheme or scheme in MOUNTED:
        return _local(), MOUNTED.get(scheme, "") + path
    store, root = _filesystem(scheme, authority)
    return store, root.rstrip("/") + path


@functools.lru_cache(maxsize=1)
def _local() -> fs.FileSystem:
    return fs.LocalFileSystem()


def read_file(uri: str) -> bytes:
    store, path = locate(uri)
    with store.open_input_file(path) as f:
        return f.read()


def read_range(uri: str, begin: int, length: int) -> bytes:
    """So many bytes from a place on; fewer at the end of the file."""
    store, path = locate(uri)
    with store.open_input_file(path) as f:
        size = f.size()
        return f.read_at(max(0, min(length, size - begin)), begin) if begin < size else b""


def check_openable(uri: str) -> None:
    """Raises if the scheme of a path has no file system here, so that a run ends before its first file and not with errors only."""
    try:
        locate(uri)
    except Exception as exc:
        raise ValueError(f"no file system for {uri!r} on this machine: {exc}") from exc


def replace_file(uri: str, content: bytes, staging: str | None = None) -> None:
    """Write a file whole: readers see the old content or the new one, never a part.

    A file system with renames gets the content under a name of its own first, in ``staging`` or beside the file, and
    moves it over the old one. An object store shows an object only when it is complete.
    """
    store, path = locate(uri)
    if store.type_name in OBJECT_STORES:
        with store.open_output_stream(path) as f:
            f.write(content)
        return
    folder, name = posixpath.split(path)
    held = locate(staging)[1] if staging else folder
    store.create_dir(held, recursive=True)
    store.create_dir(folder, recursive=True)
    part = f"{held}/.{name[:100]}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(part) as f:
        f.write(content)
    store.move(part, path)


def drop_folder(uri: str) -> None:
    """Remove a folder of staged files, if it is there."""
    store, path = locate(uri)
    if store.get_file_info(path).type == fs.FileType.Directory:
        store.delete_dir(path)


def child_names(uri: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    store, path = locate(uri)
    return sorted(i.base_name for i in store.get_file_info(fs.FileSelector(path, allow_not_found=True)))
