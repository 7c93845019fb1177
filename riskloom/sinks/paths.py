"""Refusal of output paths whose overwrite would touch the input."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable
from urllib.parse import urlparse

from pyspark.sql import SparkSession

GLOB = re.compile(r"[*?\[{]")


def _qualified(path: str) -> str:
    """The path with scheme, host and working folder, as the session's file systems see it.

    A wildcard and what follows it is left out first.
    """
    spark = SparkSession.getActiveSession()
    url = urlparse(path)
    if spark is None or (url.scheme and url.path.startswith("/")):
        return path
    fixed = "/".join(_until_wildcard(path.split("/")))
    if path.startswith("/"):
        fixed = f"/{fixed.lstrip('/')}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(fixed or ".")
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(hadoop).toString()


def _until_wildcard(names: list[str]) -> list[str]:
    first = next((i for i, name in enumerate(names) if GLOB.search(name)), len(names))
    return names[:first]


def _parts(path: str) -> tuple[str, list[str]]:
    """Scheme and folder names of a path, up to the first name with a wildcard."""
    url = urlparse(path)
    names = [n for n in posixpath.normpath(posixpath.join("/", url.path)).split("/") if n]
    return url.scheme, _until_wildcard(names)


def check_output(output: str, inputs: Iterable[str]) -> None:
    """Raise if the output is an input, holds one, or lies inside one.

    Paths are qualified first, so relative ones and such without a scheme count as what they
    mean. A host may have several names, so hosts are not compared: the same folders on two
    hosts are refused as well. Only a local and a remote folder of one name may differ.
    """
    output_scheme, out = _parts(_qualified(output))
    for path in inputs:
        scheme, source = _parts(_qualified(path))
        shared = min(len(out), len(source))
        apart = (output_scheme == "file") != (scheme == "file") and "" not in (output_scheme, scheme)
        if not apart and out[:shared] == source[:shared]:
            raise ValueError(f"output {output} overlaps input {path}; overwriting would delete it")
