"""The alphabet in which byte-level tokenizers write bytes, and cuts of words that their rules never cross."""

from __future__ import annotations

import re
from itertools import count

# Letters that every version of the Unicode tables counts as letters.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
# Such a run, if an ASCII character other than a letter follows, is one pre-token.
RUN = rf"[{LATIN}]+(?=[\x00-\x40\x5b-\x60\x7b-\x7f]|\Z)"


def _alphabet() -> list[str]:
    """Printable Latin-1 characters stand for themselves, all other bytes for the characters from 256 on."""
    spare = count(256)
    return [
        chr(b) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD else chr(next(spare)) for b in range(256)
    ]


ALPHABET = _alphabet()
_TABLE = {b: c for b, c in enumerate(ALPHABET)}


def spell(text: str) -> str:
    """``text`` in the byte-level alphabet."""
    return text.encode().decode("latin-1").translate(_TABLE)


def leading_run(pattern: str = "") -> re.Pattern:
    """Matches ``pattern`` and a run of letters at the start of a word."""
    return re.compile(pattern + RUN)
