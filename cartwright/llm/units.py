"""Cutting text where byte-level pre-tokens always end, and remembering what the pieces encode to.

A pre-token of the patterns used here never has white space right after another
character. So a text may be cut wherever white space follows a character that is
none: each piece encodes alone to what it encodes to inside the text. Whether a
place is such a cut depends on its two characters only.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# The Unicode property White_Space, which the patterns' \s stands for.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

# Pieces remembered per Python worker, and the longest worth remembering.
REMEMBERED, LONGEST = 300_000, 64


class Remembered(dict):
    """Piece -> what ``encode`` makes of it; forgets everything when full."""

    def __init__(self, encode: Callable[[str], object], most: int = REMEMBERED):
        super().__init__()
        self.encode = encode
        self.most = most

    def __missing__(self, piece: str):
        value = self.encode(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value
