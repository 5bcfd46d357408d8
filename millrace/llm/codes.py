"""64-bit codes of words and word n-grams, computed over whole texts with numpy."""

from __future__ import annotations

import numpy as np

from millrace.llm.shared import per_process

U = np.uint64
#: Odd, 5 modulo 8: powers repeat as late as they can.
BASE = 0x9E3779B97F4A7C15 & ~7 | 5
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0x7FB5D329728EA185)
    h = (h ^ (h >> U(27))) * U(0x81DADEF4BC2DD44D)
    return h ^ (h >> U(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse modulo 2^64 for i up to n; grown by doubling."""
    kept = per_process(("powers",), dict)
    if kept.get("n", 0) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            made.append(np.cumprod(p))
        kept.update(n=size - 1, made=made)
    return kept["made"]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the runs of other bytes than the six ASCII white spaces."""
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_codes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each word (A-Z lower-cased) of a text, with the byte starts and ends of the words."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), dtype=np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, U), starts, ends
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U)), starts, ends


def gram_codes(words: np.ndarray, width: int) -> np.ndarray:
    """Code of each window of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    h = np.zeros(n, dtype=U)
    for i in range(width):
        h += words[i : i + n] * U((BASE * (2 * i + 3) ** 3) & (1 << 64) - 1 | 1)
    return mix(h)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct codes of the text's word n-grams; of fewer words, that of the whole sequence; of none, nothing."""
    words = word_codes(text)[0]
    if not len(words):
        return words
    return np.unique(gram_codes(words, width)) if len(words) >= width else gram_codes(words, len(words)) ^ U(len(words))
