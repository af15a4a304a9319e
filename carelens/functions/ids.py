"""Name-based UUIDs (version 5) as a built-in expression."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid5(namespace: str, name: Column) -> Column:
    """Equals ``uuid.uuid5(namespace, name)`` for any UTF-8 name."""
    prefix = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(prefix, F.encode(name, "UTF-8")))
    # RFC 9562: the version nibble becomes 5, the two top variant bits become binary 10.
    variant = F.substring(digest, 17, 1)
    variant = F.translate(variant, "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
