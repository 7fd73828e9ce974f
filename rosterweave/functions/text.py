"""Text functions on columns. A blank string stands for "no value" everywhere; nulls are read as blank."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

C = Column | str

#: Eight characters that are not seen: zero-width, direction marks, soft hyphen, word joiner.
INVISIBLE = "[\\x{200b}\\x{200c}\\x{200d}\\x{200e}\\x{200f}\\x{feff}\\x{00ad}\\x{2060}]"


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(c: C, use: Callable[[Column], Column]) -> Column:
    """use(c), with c evaluated once however often use names it (inside array functions Spark evaluates each mention anew)."""
    return F.element_at(F.transform(F.array(col(c)), use), 1)


def text(c: C) -> Column:
    """The value as a string, '' for null."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def trim(c: C) -> Column:
    """Without white space at both ends, in Unicode's sense (F.trim takes spaces alone)."""
    return F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")


def is_blank(c: C) -> Column:
    return trim(c) == ""


def filled(c: C) -> Column:
    return trim(c) != ""


def first_filled(*columns: C) -> Column:
    """The first that is not blank, else ''."""
    return F.coalesce(*[F.when(filled(c), text(c)) for c in columns], F.lit(""))


def squeeze(c: C) -> Column:
    """Runs of white space as one space, none at the ends."""
    return trim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def clean(c: C, masked: str = "????") -> Column:
    """Entities decoded, white space squeezed; text that holds the mask is blank."""
    out = squeeze(unescape(c))
    return F.when(F.contains(out, F.lit(masked)), F.lit("")).otherwise(out)


def without_invisible(c: C) -> Column:
    return F.regexp_replace(text(c), INVISIBLE, "")


def ascii_key(c: C) -> Column:
    """a-z and 0-9 of the lower-cased text."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def alnum_key(c: C) -> Column:
    """Letters and digits of any script, in lower case."""
    return F.lower(F.regexp_replace(text(c), r"[^\p{L}\p{N}]", ""))


def any_of(c: Column, words, test=F.contains) -> Column:
    """Whether the test holds for any of the words."""
    out = F.lit(False)
    for w in words:
        out = out | test(c, F.lit(w))
    return out


def alternation(words) -> str:
    """A pattern that matches any of the words literally."""
    return "|".join("".join(ch if ch.isalnum() or ch in " -_/@" else "\\" + ch for ch in w) for w in words)


@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else html.unescape(v))


def unescape(c: C) -> Column:
    """HTML entities decoded. Only rows with a '&' reach Python."""
    t = text(c)
    return F.when(F.contains(t, F.lit("&")), _unescape(F.when(F.contains(t, F.lit("&")), t))).otherwise(t)


COMMON_ENTITIES = {"&nbsp;": " ", "&#39;": "'", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def unescape_common(c: C, entities: dict[str, str] = COMMON_ENTITIES) -> Column:
    """The commonest entities, or those given, decoded where they are whole, without leaving the JVM. &amp; comes last. For use inside array functions."""
    out = text(c)
    for entity, char in entities.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


@F.pandas_udf(StringType())
def _fold_marks(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else "".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch)))


def fold_marks(c: C) -> Column:
    """Compatibility forms and accents folded away. Only rows beyond ASCII reach Python."""
    t = text(c)
    plain = F.octet_length(t) == F.char_length(t)
    return F.when(plain, t).otherwise(_fold_marks(F.when(~plain, t)))


def _single_folds() -> tuple[str, str]:
    """Letters of the basic plane that fold to one other character, and those characters."""
    pairs = []
    for n in range(0x80, 0x10000):
        folded = "".join(ch for ch in unicodedata.normalize("NFKD", chr(n)) if not unicodedata.combining(ch))
        if len(folded) == 1 and folded != chr(n):
            pairs.append((chr(n), folded))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FOLDED, _FOLDS_TO = _single_folds()


def fold_letters(c: C) -> Column:
    """Accents and widths folded away without leaving the JVM; letters that fold to several (ligatures) stay. For use inside array functions."""
    t = text(c)
    return F.when(F.octet_length(t) == F.char_length(t), t).otherwise(F.translate(F.regexp_replace(t, r"\p{M}", ""), _FOLDED, _FOLDS_TO))


def middle_cut(c: C, most: int, marker: str = "\n...\n") -> Column:
    """The first and last half of texts that are longer than `most`."""
    t = text(c)
    half = most // 2
    return F.when(F.char_length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, half), F.lit(marker), F.right(t, F.lit(half))))


def number(c: C) -> Column:
    """An integer written with commas, 0 if it is none."""
    return F.coalesce(F.regexp_replace(trim(c), ",", "").try_cast("long"), F.lit(0).cast("long"))


def pages_of(count: C, per_page: int, most: int | None = None) -> Column:
    pages = F.ceil(col(count) / per_page).cast("long")
    return F.least(pages, F.lit(most)) if most else pages


def distinct_filled(*values: C) -> Column:
    """Values that are not blank, trimmed, the first of each."""
    return F.array_distinct(F.filter(F.array(*[trim(v) for v in values]), lambda v: v != ""))


def tokens_supported(name: C, quote: C, share: float = 0.5) -> Column:
    """Whether at least `share` of the name's tokens occur in the quote."""
    parts = F.filter(F.split(F.lower(squeeze(name)), " "), lambda t: t != "")
    hits = F.filter(parts, lambda t: F.contains(F.lower(text(quote)), t))
    return (F.size(parts) > 0) & (F.size(hits) >= share * F.size(parts))
