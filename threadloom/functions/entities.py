"""HTML character references decoded with built-in expressions, so text never leaves the JVM."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.binding import let

# The HTML 4 names, and the names HTML 5 added to them; both come from the standard library.
HTML4 = {name: chr(cp) for name, cp in html.entities.name2codepoint.items()} | {"apos": "'"}
HTML5_EXTRA = {
    name[:-1]: chars
    for name, chars in html.entities.html5.items()
    if name.endswith(";") and name[:-1] not in HTML4
}

# Numeric references 128..159 mean Windows-1252 characters when browsers read them.
_CP1252 = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
_CP1252_FROM = "".join(a for a, b in _CP1252 if b)
_CP1252_TO = "".join(b for a, b in _CP1252 if b)


# Forms of a reference behind its "&". Hexadecimal code points are padded to eight digits.
_NAME = "[A-Za-z][A-Za-z0-9]*"
_REFERENCE = f"^(?:#(?:[xX][0-9a-fA-F]+|[0-9]+)|{_NAME});?"
_DECIMAL = "^#0*([0-9]{1,9})(?![0-9])"
_HEX = "^#[xX]0*([0-9a-fA-F]{1,8})(?![0-9a-fA-F])"
_CHARACTER = "(?i)^(?!0{8}|0000d[89a-f])00(?:0.|10).{4}$"


def _map(table: dict[str, str]) -> Column:
    """The table as one literal; Catalyst folds it into a map when it plans the query."""
    text = "\x1e".join(f"{name}\x1f{char}" for name, char in sorted(table.items()))
    return F.str_to_map(F.lit(text), F.lit("\x1e"), F.lit("\x1f"))


def _from_code(piece: Column) -> Column:
    """The character of a numeric reference; U+FFFD when there is no such character."""
    code = F.coalesce(
        F.conv(F.regexp_extract(piece, _DECIMAL, 1), 10, 16), F.regexp_extract(piece, _HEX, 1)
    )
    valid = F.nullif(F.regexp_extract(F.lpad(code, 8, "0"), _CHARACTER, 0), F.lit(""))
    return F.coalesce(F.decode(F.unhex(valid), "UTF-32"), F.lit("\ufffd"))


def decode_entities(c: Column, html5: bool = False, bare: bool = False) -> Column:
    """Decode ``&name;`` and ``&#n;`` references once, from left to right.

    ``html5`` adds the HTML 5 names and the Windows-1252 reading of 128..159; ``bare`` also
    accepts a known name that ends without a semicolon. Unknown names stay as they are.
    """
    known, extra = _map(HTML4), _map(HTML5_EXTRA) if html5 else None

    def piece_text(piece: Column, i: Column) -> Column:
        name = F.regexp_extract(piece, f"^({_NAME})" + ("" if bare else ";"), 1)
        named = F.try_element_at(known, name)
        coded = _from_code(piece)
        if html5:
            named = F.coalesce(named, F.try_element_at(extra, name))
            coded = F.translate(coded, _CP1252_FROM, _CP1252_TO)
        char = F.when(piece.rlike("^#[xX]?[0-9a-fA-F]") & piece.rlike(_REFERENCE), coded).otherwise(named)
        decoded = F.concat(char, F.regexp_replace(piece, _REFERENCE, ""))
        return F.when(i == 0, piece).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), piece)))

    def decoded(text: Column) -> Column:
        pieces = F.transform(F.split(text, "&", -1), piece_text)
        return F.when(text.rlike("&[#A-Za-z]"), F.array_join(pieces, "")).otherwise(text)

    return let(c, decoded)
