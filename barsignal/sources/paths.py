"""Opening files of Spark's paths from Python inside tasks."""

from __future__ import annotations

import os
import re

import pyarrow.fs


def arrow_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a Spark path and the path inside it.

    Local paths are taken literally: no character of them is decoded. The
    object store's connector names (``s3a``, ``s3n``) stand for ``s3``.
    """
    if re.match(r"file:|/", path):
        return pyarrow.fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", path).lstrip("/")
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)
    scheme, rest = re.match(r"([^:]+)://(.*)$", re.sub(r"^s3[an]:", "s3:", path)).groups()
    if scheme == "s3":
        return pyarrow.fs.S3FileSystem(), rest
    authority = rest.partition("/")[0]
    fs, _ = pyarrow.fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, "/" + rest.partition("/")[2]
