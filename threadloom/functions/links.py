"""Links: absolute form, host, and the canonical key used to recognise repeated work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.binding import let


def absolute_link(c: Column, base: str | Column) -> Column:
    """``base`` put before site-relative links; null and empty links give null."""
    root = F.lit(base.rstrip("/")) if isinstance(base, str) else base
    return (
        F.when(c == "", F.lit(None))
        .when(c.rlike("^https?://"), c)
        .when(c.startswith("//"), F.concat(F.lit("https:"), c))
        .otherwise(F.concat(root, F.lit("/"), F.ltrim(c, F.lit("/"))))
    )


def host(c: Column) -> Column:
    return F.nullif(
        F.regexp_extract(F.lower(c), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")
    )


def canonical_url(c: Column) -> Column:
    """Key under which two links mean the same page.

    No fragment, lower-case scheme and host, "/" for an empty path, query arguments sorted
    (blank ones kept, empty pieces dropped), escapes in upper case.
    """
    return let(let(F.regexp_replace(c, r"(?s)#.*$", ""), _parts), _joined)


_HEAD = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)"


def _parts(plain: Column) -> Column:
    """Scheme with host, path, and the query arguments in order."""
    args = F.filter(
        F.split(F.regexp_extract(plain, r"(?s)^[^?]*\?(.*)$", 1), "&"), lambda a: a != ""
    )
    args = F.transform(args, lambda a: F.when(a.contains("="), a).otherwise(F.concat(a, F.lit("="))))
    return F.array(
        F.lower(F.regexp_extract(plain, _HEAD, 1)),
        F.regexp_extract(plain, rf"(?s){_HEAD.replace('(', '(?:', 1)}?([^?]*)", 1),
        F.array_join(F.array_sort(args), "&"),
    )


def _joined(parts: Column) -> Column:
    head, path, query = parts[0], parts[1], parts[2]
    url = F.concat(
        head,
        F.when((path == "") & (head != ""), "/").otherwise(path),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
    )
    return let(url, _upper_escapes)


def _upper_escapes(url: Column) -> Column:
    # Escapes are rare, so only links that have one pay for the split.
    upper = F.array_join(
        F.transform(
            F.split(url, "%", -1),
            lambda x, i: F.when(i == 0, x).otherwise(
                F.concat(F.upper(F.left(x, F.lit(2))), F.substring(x, F.lit(3), F.length(x)))
            ),
        ),
        "%",
    )
    return F.when(url.contains("%"), upper).otherwise(url)
