"""Text normalisation as column expressions (whole texts, no Python UDF)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space. This is the Unicode
# White_Space property plus the separators 0x1C-0x1F; the regex engine's own \s
# is ASCII only and would miss most of them. The rare ones sit behind one range
# test, so that ordinary characters are done with a single table look-up.
_RARE = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CLASS = rf"\t-\r\x1c-\x20\x85\xa0[\u1680-\u3000&&[{_RARE}]]"

_RUN = rf"[{SPACE_CLASS}]+"
_ENDS = rf"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+\z"
_VISIBLE = rf"[^{SPACE_CLASS}]"


def has_content(text: Column) -> Column:
    """Something is left after squeezing; cheaper than squeezing in a filter."""
    return F.coalesce(text.rlike(_VISIBLE), F.lit(False))


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, _RUN, " "))


def strip(text: Column) -> Column:
    """Remove white space at both ends (F.trim alone only knows the blank)."""
    return F.regexp_replace(text, _ENDS, "")


def first_truthy(*values) -> Column:
    """First value that is neither null nor the empty string."""
    *head, last = [v if isinstance(v, Column) else F.lit(v) for v in values]
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in head], last)


def slugify(name: Column) -> Column:
    """Lower case, other characters to single hyphens, never empty."""
    hyphened = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-")
    return first_truthy(F.regexp_replace(hyphened, r"^-|-\z", ""), "channel")


def content_hash(text: Column) -> Column:
    """T5: SHA-256 hex of the squeezed, lower-cased text; null counts as ''."""
    return F.sha2(F.lower(squeeze(F.coalesce(text, F.lit("")))), 256)


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a let for expressions).

    Naming a computed array inside a lambda over itself would compute the whole
    array again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def kept_lines(texts: Column) -> Column:
    """Squeezed non-empty lines, without a line equal to the one kept before."""
    lines = F.transform(F.filter(F.coalesce(texts, F.array()), has_content), squeeze)
    return _bind(
        lines,
        lambda a: F.filter(a, lambda t, i: (i == 0) | (t != F.get(a, i - 1))),
    )


def flatten_segments(texts: Column) -> Column:
    """``array<string>`` of captions in order -> transcript text."""
    return F.array_join(kept_lines(texts), "\n")
