"""Segments of a text that a byte-level BPE tokenizer never joins.

The splitting pattern of such tokenizers (``public_tokenizers.PATTERN``) has no
match that holds a white-space character after another character, so the place
between a character that is surely not white space and a space or line break is
always a token boundary; no part of the pattern looks behind, and only white
space looks ahead.  Texts are cut there.  A special string has no white space
and is therefore never cut.
"""

from __future__ import annotations

import re

_SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# White space other than space and line break, for either of two regex engines.
_ODD = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
_SURE = re.compile(r"(?<=[!-~¡-ᙿ])(?=[ \n])")


def segments(text: str) -> list[str]:
    """Pieces whose concatenation is ``text`` and whose tokens are those of ``text``."""
    if _ODD.search(text):
        return _SURE.split(text)
    return _SEGMENT.findall(text)
