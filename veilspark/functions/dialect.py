"""Turn the Python-style patterns of ``constants`` into JVM patterns with the same matches.

What differs between the two regex engines is fixed here by rule: ``\\b`` (the
JVM's notion of a word character depends on its release), ``\\s`` (four control
characters), and letter ranges without case (special letters such as the Kelvin
sign, which the JVM only finds through the lower-case range).  ``start`` names the characters
a match can begin with; as a lookahead it rejects most positions in one step
and changes no match.
"""

from __future__ import annotations

from veilspark import constants as K

_WORD = r"[\p{L}\p{N}_]"
_EDGE = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
_SPACE = r"[\s\x1c-\x1f]"

_STARTS = {
    "phone": "[+(0-9]",
    "ssn": r"\d",
    "credit_card": "[3-6]",
    "ip_address": "[0-9]",
    "zip_code": r"\d",
    "date_of_birth": "[0-9]",
    "name": "[A-Z]",
}


def jvm_pattern(pattern: str, flags: str = "", start: str | None = None) -> str:
    body = pattern.replace(r"\b", _EDGE).replace(r"\s", _SPACE)
    if "i" in flags:
        body = body.replace("A-Z", "A-Za-z")
    if start:
        body = f"(?={start})(?:{body})"
    return f"(?{flags}U){body}"


def detection_regex(name: str) -> str:
    pattern, flags = K.DETECTION_PATTERNS[name]
    return jvm_pattern(pattern, flags, _STARTS.get(name))


def mask_regex(name: str) -> str:
    pattern, flags = K.MASK_PATTERNS[name]
    start = "[0-9]" if name == "credit_card" else _STARTS.get(name)
    return jvm_pattern(pattern, flags, start)
