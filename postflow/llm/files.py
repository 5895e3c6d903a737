"""Files in the shared folder, opened inside tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (``file:``, ``hdfs:``, ``s3:``, ...) or a plain local path."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, partition: int, suffix: str) -> str:
    """A name no other attempt of the task uses; readers only open names that finished tasks
    returned."""
    return f"{prefix}-{partition:05d}-{uuid.uuid4().hex[:12]}{suffix}"
