"""Hash keys for hubs, links and satellites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the OID namespace of RFC 4122.
OID_NAMESPACE = "6ba7b812-9dad-11d1-80b4-00c04fd430c8"


def _digest(text: Column, namespace: str) -> Column:
    return F.md5(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(text.cast("string"), "UTF-8")))


def _layout(digest: Column) -> Column:
    """The digest with version and variant bits set, in groups of 8-4-4-4-12 digits."""
    # The two top bits of hex digit 17 become binary 10, the two low bits stay.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-3"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def uuid3(text: Column | str, namespace: str = OID_NAMESPACE) -> Column:
    """Name-based UUID, version 3: MD5 of namespace and text with version and variant bits set."""
    return _layout(_digest(F.col(text) if isinstance(text, str) else text, namespace))


def uuid3_each(texts: Column, namespace: str = OID_NAMESPACE) -> Column:
    """``uuid3`` of every element of an array.

    Lambda bodies do not share subexpressions, so the digests are made in one
    pass and laid out in the next.
    """
    digests = F.transform(texts, lambda text: _digest(text, namespace))
    return F.transform(digests, _layout)


def hash_key(*columns: Column | str) -> Column:
    """MD5 of the values joined by ``:``; NULL if any value is NULL."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(":"), part)
    return F.md5(joined)
