"""Column expressions for artist names, ids and report formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace()).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                 "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# (?U) makes \s and the classes Unicode-aware in Java regex; plain \w would be
# ASCII and delete letters such as "ó".
_NOT_WORDISH = r"(?U)[^\p{L}\p{N}_\s\-']"
_SPACE_RUN = r"(?U)\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c) -> Column:
    """Lower -> strip -> drop chars outside [word, space, '-', '\''] -> collapse spaces.

    There is deliberately no second strip: "! foo" becomes " foo" and an
    all-punctuation name becomes "" (kept, not null).
    """
    x = F.btrim(F.lower(_c(c)), F.lit(PY_WHITESPACE))
    x = F.regexp_replace(x, _NOT_WORDISH, "")
    return F.regexp_replace(x, _SPACE_RUN, " ")


def query_key(c, clean: bool = False) -> Column:
    """The lookup normalisation of a query string (lower + strip only)."""
    if clean:
        return clean_name(c)
    return F.btrim(F.lower(_c(c)), F.lit(PY_WHITESPACE))


def short_user_id(c) -> Column:
    """First 20 characters followed by '...'."""
    return F.concat(F.substring(_c(c), 1, 20), F.lit("..."))


def short_run_id(c) -> Column:
    """First 8 characters of a run id."""
    return F.substring(_c(c), 1, 8)


def title_name(c) -> Column:
    """Python-style title case: upper after any non-letter, lower elsewhere."""
    # initcap only capitalises after spaces; split on letter runs instead.
    s = _c(c)
    words = F.split(F.lower(s), r"(?<=[^\p{L}])|(?=[^\p{L}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                             F.substring(w, 2, 1 << 30))), "")


def thousands(c) -> Column:
    """Integer with thousands separators."""
    return F.format_number(_c(c).cast("double"), 0)


def medal(rank_col) -> Column:
    """Medal for ranks 1-3, the plain number otherwise (fixed values)."""
    r = _c(rank_col)
    return (F.when(r == 1, F.lit("🏆")).when(r == 2, F.lit("🥈")).when(r == 3, F.lit("🥉"))
            .otherwise(r.cast("string")))


def percent1(c) -> Column:
    """Similarity x 100 with one decimal."""
    return F.format_number(_c(c) * 100.0, 1)


def score2(c) -> Column:
    """Score with two decimals."""
    return F.format_number(_c(c), 2)
