"""Text clean-up expressions (T1–T4).  All built-in, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NA tokens a default pandas CSV read turns into nulls.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_only(c: Column | str) -> Column:
    """Drop every character that is not 0-9."""
    return F.regexp_replace(_col(c), r"[^0-9]", "")


def clean_id(c: Column | str) -> Column:
    """Keep digits, empty -> NULL, to BIGINT; overflow -> NULL."""
    return digits_only(c).try_cast("bigint")


def strip_all(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of any kind (Spark ``trim`` only
    removes spaces)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def squash_spaces(c: Column | str) -> Column:
    """Strip, then collapse each whitespace run to one space."""
    return F.regexp_replace(strip_all(c), r"\s+", " ")


def title_case(c: Column | str) -> Column:
    """Python ``str.title`` semantics.

    Every letter that follows a non-letter (or starts the string) is upper
    case, every other letter lower case ("men's t-shirt a/b 3d" ->
    "Men'S T-Shirt A/B 3D"); ``initcap`` differs on apostrophes, hyphens,
    slashes and digits.  The string is cut in front of each letter that
    follows a non-letter; each piece gets its first character upper-cased.
    """
    pieces = F.split(F.lower(_col(c)), r"(?<=[^\p{L}])(?=\p{L})")
    cap = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))
    )
    return F.when(_col(c).isNull(), F.lit(None)).otherwise(F.array_join(cap, ""))


def canonical_category(c: Column | str, enabled: bool = True) -> Column:
    """Strip, collapse whitespace, title case."""
    if not enabled:
        return _col(c)
    return title_case(squash_spaces(c))


def null_na_tokens(c: Column | str) -> Column:
    """Trap 29: the default NA token list of a pandas read becomes NULL."""
    return F.when(_col(c).isin(*PANDAS_NA_TOKENS), F.lit(None)).otherwise(_col(c))
