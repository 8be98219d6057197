"""Slow, plain-Python answers the Spark results are compared with."""

import random
import re

from veilspark import constants as K


def compiled(entry):
    pattern, flags = entry
    return re.compile(pattern, re.I if "i" in flags else 0)


DETECT = {n: compiled(p) for n, p in K.DETECTION_PATTERNS.items()}
MASKS = {n: compiled(p) for n, p in K.MASK_PATTERNS.items()}
COMBINE = {n: re.compile(p, re.I | re.S) for n, p in K.COMBINATION_PATTERNS.items()}


def spans(pattern, text):
    return [(m.start(), m.end(), m.group()) for m in pattern.finditer(text)]


def entities(text, order=None):
    """(start, rank, end, type, text) of one cell; the first source of a span wins."""
    best = {}
    for rank, name in enumerate(order or DETECT, 1):
        for start, end, hit in spans(DETECT[name], text):
            best.setdefault((start, end), (start, rank, end, name, hit))
    return sorted(best.values(), key=lambda e: (e[0], e[1]))


def mask_by_spans(text, found):
    """``found`` as (start, rank, end, ...); later starts first, stale ends kept."""
    for start, _, end, *_ in sorted(found, key=lambda e: (-e[0], e[1])):
        text = text[:start] + K.MASK + text[end:]
    return text


def mask_all(text):
    text = mask_by_spans(text, entities(text))
    for pattern in MASKS.values():
        text = pattern.sub(K.MASK, text)
    for name in DETECT["name"].findall(text):
        text = text.replace(name, K.MASK)
    return text


PIECES = [
    "123-45-6789", "123 45 6789", "000-12-3456", "4111111111111111", "4532-1234-5678-9012",
    "(555) 123-4567", "+1 555.111.2222", "555 123 4567", "10001", "10001-1234",
    "12/31/2000", "2024-01-01", "192.168.1.100", "john.doe@mail.com", "x@y.zz|q", "John Doe",
    "Mary Ann Lee", "José García", "José Garcia", "Garciá Lopez", "Acme Data Corp",
    "A Corp", "Big Inc", "include", "LLC", " Company", "12 Main Street", "7 Oak Ave", "9 b",
    "é", "ß", "_", "²", "½", "٣٤٥", "ſ", "K", "\x1c", "\n", "\t", " ", " ", "  ", ".", "-",
    ",", "1", "22", "333", "4444", "55555", "a", "Z", "word", "UPPER", "Title", "😀", "中文",
]


def noisy_texts(n, seed, longest=14):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        glue = rng.choice(["", " ", " ", " ", "\n"])
        out.append(glue.join(rng.choice(PIECES) for _ in range(rng.randint(1, longest))))
    return out
