"""Statistics of one document, in one pass over its words; the quality rules and the quality classifier read them."""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np

SYMBOLS = b"#*$%&|<>"
_BEYOND_ASCII = bytes(range(128, 256))
_NO_LETTER = bytes(b for b in range(128) if not bytes([b]).isalpha())
NAMES = [
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct",
    "n_upper", "n_letters", "n_digits", "n_marks", "n_stops", "n_pipes", "longest_word", "top_word", "n_same_next", "n_capital", "n_symbol_words", "n_letterless",
]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, first occurrence included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, islice(words, 1, None), islice(words, 2, None)))  # noqa: B905  the shortest ends it
    often = Counter(windows)
    if len(often) == len(windows):
        return 0
    at = np.fromiter((often[w] > 1 for w in windows), bool, len(windows))
    inside = np.zeros(len(words), bool)
    inside[:-2] |= at
    inside[1:-1] |= at
    inside[2:] |= at
    return int(inside.sum())


def stats(raw: bytes | None) -> tuple[int, ...]:
    """In the order of NAMES. A null text is empty; all are 0 then (n_lines too)."""
    raw = raw or b""
    if not raw:
        return (0,) * len(NAMES)
    text = raw.decode("utf-8", "replace")
    words = raw.split()
    blank = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    wide = len(text) - len(raw.translate(None, _BEYOND_ASCII))  # characters beyond ASCII
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    often = Counter(words)
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    with_symbol = sum(n for w, n in often.items() if len(w.translate(None, SYMBOLS)) < len(w)) if n_symbols else 0
    return (
        len(text), len(words), len(text) - blank, n_symbols, len(lines), len(lines) - len(set(lines)),
        repeated_words(words), len(often), upper, upper + lower + wide, digits, raw.count(b"!") + raw.count(b"?"), raw.count(b".") + raw.count(b","),
        raw.count(b"|"), max(map(len, words), default=0), max(often.values(), default=0), sum(map(bytes.__eq__, words, islice(words, 1, None))), sum(w[:1].isupper() for w in words),
        with_symbol, sum(n for w, n in often.items() if not w.strip(_NO_LETTER)),
    )
