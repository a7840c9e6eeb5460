"""Text helpers: request paths and escaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacements of HTML text escaping, ``&`` first (fixed values).
HTML_ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&#34;"),
    ("'", "&#39;"),
    ("+", "&#43;"),
    ("\0", "�"),
)

# What turns form encoding into path encoding (fixed values).
_FORM_TO_PATH = (
    ("+", "%20"),
    ("*", "%2A"),
    ("%7E", "~"),
    ("%24", "$"),
    ("%26", "&"),
    ("%2B", "+"),
    ("%2C", ","),
    ("%2F", "/"),
    ("%3A", ":"),
    ("%3B", ";"),
    ("%3D", "="),
    ("%40", "@"),
)


def _replace_all(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def html_escape(text: Column) -> Column:
    return _replace_all(text, HTML_ESCAPES)


def decode_path(path: Column) -> Column:
    """Percent-decoded request path; NULL where an escape is broken.

    A path that is not in the canonical encoding (say, with ``%2F`` in a segment) is routed as it
    was written, so it stays undecoded here too.
    """
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    canonical = _replace_all(F.url_encode(plain), _FORM_TO_PATH)
    decoded = F.when(plain.isNotNull(), F.when(canonical == path, plain).otherwise(path))
    return F.when(path.contains("%"), decoded).otherwise(path)
