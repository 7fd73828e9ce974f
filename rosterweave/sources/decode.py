"""SC16: bytes of unknown charset as text."""

from __future__ import annotations

import codecs
import gzip
import io
import re
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: Charsets tried in this order after those that header and document name.
FALLBACKS = ("utf-8", "utf-8-sig", "cp932", "shift_jis", "euc_jp", "iso2022_jp", "latin-1")
_named = re.compile(rb"""(?:charset|encoding)\s*=\s*["']?\s*([A-Za-z0-9_\-]+)""", re.IGNORECASE)


def decode(content: bytes | None, content_type: str | None = None) -> str:
    """The first charset that decodes strictly: the header's, the document's own (in its first 4096 bytes), the fallbacks; else UTF-8 with replacements."""
    if not content:
        return ""
    named = [m.group(1).decode("ascii") for m in (_named.search((content_type or "").encode()), _named.search(content[:4096])) if m]
    for charset in [*named, *FALLBACKS]:
        try:
            return content.decode(codecs.lookup(charset).name)
        except (LookupError, UnicodeDecodeError):
            continue
    return content.decode("utf-8", "replace")


@F.pandas_udf(StringType())
def decoded(content: pd.Series, content_type: pd.Series) -> pd.Series:
    return pd.Series([decode(bytes(c) if c is not None else None, t) for c, t in zip(content, content_type, strict=True)])


def unpack(content: bytes | None) -> bytes | None:
    """SC14: the bytes of a gzip file, as far as they are whole; other bytes as they are."""
    if not content or content[:2] != b"\x1f\x8b":
        return content
    reader, out = gzip.GzipFile(fileobj=io.BytesIO(content)), bytearray()
    try:
        while part := reader.read1(1 << 16):
            out += part
    except (OSError, EOFError, zlib.error):
        pass  # what came before the damage
    return bytes(out)


@F.pandas_udf(BinaryType())
def unpacked(content: pd.Series) -> pd.Series:
    return pd.Series([unpack(bytes(c)) if c is not None else None for c in content])
