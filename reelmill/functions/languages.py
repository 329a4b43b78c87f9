"""Caption language preferences."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmill.functions.text import strip

# Languages asked for when the preference is empty, the automatic
# caption code, and how many codes a request may carry.
DEFAULT_CODES = ("en", "asr")
AUTOMATIC = "asr"
MAX_CODES = 10


def split_preference(preference: Column) -> Column:
    """Comma list -> trimmed non-empty items."""
    parts = F.transform(F.split(preference, ","), strip)
    return F.filter(parts, lambda p: p != "")


def normalise_languages(
    codes: Column, most: int = MAX_CODES, default: tuple[str, ...] = DEFAULT_CODES
) -> Column:
    """Region-free distinct codes in order, at most ``most``, never empty."""

    def base(raw: Column) -> Column:
        code = F.lower(strip(F.coalesce(raw, F.lit(""))))
        automatic = (code == AUTOMATIC) | code.startswith(AUTOMATIC + "-")
        return F.when(automatic, code).otherwise(F.substring_index(code, "-", 1))

    kept = F.filter(F.transform(F.coalesce(codes, F.array()), base), lambda c: c != "")
    first = F.slice(F.array_distinct(kept), 1, most)
    return F.when(F.size(first) > 0, first).otherwise(
        F.array(*[F.lit(code) for code in default])
    )
