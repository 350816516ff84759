"""Words of a text, the same in SQL expressions and in Arrow kernels.

All dealt operators that split texts use one of two rules: runs without ASCII white space, or runs of ASCII
letters, digits and any non-ASCII character. Lower case means A-Z only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACED_WORD = r"[^\x20\x09-\x0D]+"
# Both letter cases; on lower-cased text it finds the same words as without A-Z.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# For bytes.translate: A-Z to a-z; the second also turns every ASCII byte outside words to a blank.
_KEPT = (string.ascii_letters + string.digits).encode()
PLAIN_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEPT else 32 for b in range(256)
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words by ``PLAIN_WORD``."""
    return text.translate(PLAIN_TABLE).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Lower-cased words by ``SPACED_WORD``; bytes.lower and bytes.split know ASCII only."""
    return text.lower().split()
