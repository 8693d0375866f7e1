"""Token matching and highlighting on text columns.

The analyzer: lower-case, each CJK ideograph is a token of its own, any
other run of letters or digits is one token.  Everything is a regular
expression evaluated in the JVM; the query keyword is tokenized by the
same expression on a literal, which Catalyst folds to a constant.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern and the CJK ideograph range it splits
# into single-character tokens.
CJK_RANGE = r"\x{4e00}-\x{9fff}"
TOKEN_PATTERN = r"([" + CJK_RANGE + r"]|[\p{L}\p{N}&&[^" + CJK_RANGE + r"]]+)"
_WORD_CHAR = r"[\p{L}\p{N}&&[^" + CJK_RANGE + r"]]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c) -> Column:
    """Array of tokens of a text column (empty array for null)."""
    return F.coalesce(F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN), F.lit(1)),
                      F.array().cast("array<string>"))


def query_tokens(q: str) -> Column:
    return F.array_distinct(tokens(F.lit(q)))


def match_all(c, q: str) -> Column:
    """Every token of ``q`` occurs in the column.  An empty keyword
    matches nothing (an empty token set would otherwise match all rows)."""
    qt = query_tokens(q)
    return (F.size(qt) > 0) & (F.size(F.array_except(qt, tokens(c))) == 0)


def match_any(c, q: str) -> Column:
    """At least one token of ``q`` occurs in the column."""
    return F.arrays_overlap(tokens(c), query_tokens(q)) == F.lit(True)


def exact_term(c, value: str) -> Column:
    """C11: exact (keyword) equality."""
    return _col(c) == F.lit(value)


def _python_tokens(q: str) -> list[str]:
    """Tokens of a parameter string, used only to build the highlight
    pattern (a plan-time constant, never applied to data)."""
    out = []
    for m in re.finditer(r"[一-鿿]|[^\W_一-鿿]+", (q or "").lower()):
        if m.group(0) not in out:
            out.append(m.group(0))
    return out


def highlight(c, q: str, pre: str = "<em>", post: str = "</em>") -> Column:
    """Wrap each occurrence of a query token in ``pre``/``post``.

    ASCII-like tokens only match as whole tokens; CJK tokens match any
    single ideograph occurrence (word boundaries do not exist between
    CJK characters).  The keyword is quoted, so regex characters in it are
    literal.
    """
    toks = _python_tokens(q)
    if not toks:
        return _col(c)
    alts = []
    for t in sorted(toks, key=len, reverse=True):
        quoted = r"\Q" + t + r"\E"
        if re.fullmatch(r"[一-鿿]", t):
            alts.append(quoted)
        else:
            alts.append(r"(?<!" + _WORD_CHAR + r")" + quoted + r"(?!" + _WORD_CHAR + r")")
    pattern = "(?iu)(" + "|".join(alts) + ")"
    rep = pre.replace("\\", "\\\\").replace("$", "\\$") + "$1" + post.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_col(c), F.lit(pattern), F.lit(rep))
