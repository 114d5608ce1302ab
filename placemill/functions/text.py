from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that survive stripping, besides whitespace.
_KEPT = string.ascii_letters + string.digits + ".,&"
# Whitespace as Java's regular expressions see it, and as Python's str.strip() and \s see it.
_ASCII_SPACE = "\t\n\x0b\x0c\r "
_UNICODE_SPACE = "".join(
    map(
        chr,
        (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B))
        + (0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)

# The classes name each character: Java looks those below 256 up in one table, but tries ranges one after the other.
# For the same reason the few characters above 256 are only tried when the table has said no.
_ASCII_LOSES = f"[^{_KEPT}{_ASCII_SPACE}]"
_UNICODE_LOSES = (
    f"[[^{_KEPT}{''.join(c for c in _UNICODE_SPACE if ord(c) < 256)}]"
    f"&&[^{''.join(c for c in _UNICODE_SPACE if ord(c) >= 256)}]]"
)


def normalise_text(value: Column | str, *, strip_chars: bool = False, unicode: bool = False) -> Column:
    """Lower and trim; with ``strip_chars`` then delete everything but ASCII letters, digits, ``.,&`` and whitespace.

    Trimming takes off blanks only and comes before the deletion, so ``'- Foo'`` becomes ``' foo'``. With ``unicode``
    both steps use Unicode whitespace: tabs and line breaks are trimmed, a no-break space is kept inside the text.
    """
    text = F.trim(F.lower(value), F.lit(_UNICODE_SPACE)) if unicode else F.trim(F.lower(value))
    return F.regexp_replace(text, _UNICODE_LOSES if unicode else _ASCII_LOSES, "") if strip_chars else text
