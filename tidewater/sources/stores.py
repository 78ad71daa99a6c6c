"""Files that Spark's own readers and writers cannot name, opened through
Arrow's file systems (local, HDFS, S3) from inside tasks."""

from __future__ import annotations

import re

from tidewater._shipping import by_value

by_value(__name__)


def file_system(uri: str):
    """(Arrow file system, path inside it) of a URI as Hadoop prints it
    (unescaped) or a plain path."""
    from pyarrow import fs

    local = re.sub("^file:/+", "/", uri)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(uri.replace(" ", "%20"))
