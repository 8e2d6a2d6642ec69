"""Text and JSON columns, and the key path of an asset URI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes whose last path segment may carry ";parameters".
PARAMETER_SCHEMES = ("ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps",
                     "sip", "sips", "mms", "sftp", "tel")
# Key of an empty URI, and name of a segment with nothing printable.
UNKNOWN_ASSET = "unknown_asset"
EMPTY_SEGMENT = "seg"

# Our own rule for a plausible address; nothing outside this library defines one.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def json_or_default(text: Column, schema: str, field: str, default: Column) -> Column:
    """A field of a JSON text, or ``default`` when it is missing or unreadable."""
    return F.coalesce(F.from_json(text, schema)[field], default)


def missing_keys(text: Column, fields: list[str]) -> Column:
    """The required keys that a JSON object text lacks, in alphabetical order."""
    wanted = F.array(*[F.lit(f) for f in sorted(fields)])
    present = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    return F.array_except(wanted, present)


def tail(text: Column, n: int) -> Column:
    """The last ``n`` characters, without running through a text of megabytes.

    A character takes one to four bytes. When the last ``n`` bytes and three
    more count as that many characters, the last ``n`` bytes are the answer: a
    character cut in two can only be among the three. Otherwise the characters
    of the last ``4 * n`` bytes are counted.
    """
    data = text.cast("binary")
    near = F.substring(data, -(n + 3), n + 3)
    single = F.length(near.cast("string")) == F.length(near)
    return (F.when(single, F.substring(data, -n, n).cast("string"))
            .otherwise(F.right(F.substring(data, -4 * n, 4 * n).cast("string"), F.lit(n))))


def clean_name(name: Column) -> Column:
    """Outer blanks dropped, inner runs of blanks made one, words capitalized."""
    return F.initcap(F.trim(F.regexp_replace(name, r"\s+", " ")))


def is_email(text: Column) -> Column:
    return F.coalesce(text.rlike(EMAIL_PATTERN), F.lit(False))


def key_segment(text: Column) -> Column:
    """Letters, digits and single inner underscores only."""
    cleaned = F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_|_$", "")
    return F.when(cleaned == "", F.lit(EMPTY_SEGMENT)).otherwise(cleaned)


def asset_key(uri: Column) -> Column:
    """Key path of a URI: scheme, host, then the path cut at ``/`` and ``.``.

    Query and fragment are dropped. Text without a scheme is one segment.
    Regular expressions are used because ``parse_url`` rejects URIs with blanks.
    """
    plain = F.regexp_replace(F.regexp_replace(uri, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    host = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    path = F.when(scheme.isin(*PARAMETER_SCHEMES),
                  F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)
    pieces = F.filter(F.concat(F.array(scheme, host), F.split(path, r"[/.]")),
                      lambda piece: piece != "")
    return (F.when(F.coalesce(uri, F.lit("")) == "", F.array(F.lit(UNKNOWN_ASSET)))
            .when(scheme == "", F.array(key_segment(uri)))
            .otherwise(F.transform(pieces, key_segment)))
