"""Vectorised splitting of texts into the words of a public BPE tokenizer.

A batch of texts becomes one array of code points.  The tokenizer's split
pattern is evaluated on arrays of character classes (letter, number, white
space, other), every word gets two 64-bit hashes, and only words not met before
leave numpy.  ``PIECE`` stands between texts and
``SPECIAL`` for a special string inside a text; both lie outside Unicode.
"""

from __future__ import annotations

import hashlib
import sys
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Regex, normalizers, pre_tokenizers

PIECE, SPECIAL = 0x110000, 0x110001
OTHER, LETTER, NUMBER, SPACE, MARK = range(5)
#: The white space of the split patterns.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Words of more units than this are hashed one by one.
LONG = 64


@lru_cache(1)
def newer() -> list[str]:
    """Characters that Python's Unicode version lacks and the tokenizer library's may have; no script lies beyond plane 3."""
    return [chr(c) for c in range(0x40000) if unicodedata.category(chr(c)) == "Cn"]


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, for characters newer than Python as the tokenizer library's own pattern engine has it."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out = np.concatenate([out, np.full(2, MARK, np.uint8)])
    out[WHITE_SPACE] = SPACE
    points = np.array([ord(c) for c in newer()])
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for _, (start, end) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str("".join(newer())):
            out[points[start:end]] = value
    return out


@lru_cache(1)
def lowered() -> np.ndarray:
    """Lower case of every code point whose lower case is one code point, each taken alone."""
    out = np.arange(sys.maxunicode + 3, dtype=np.uint32)
    for c in range(0x40000):
        if len(low := chr(c).lower()) == 1:
            out[c] = ord(low)
    for c, low in zip(newer(), normalizers.Lowercase().normalize_str("\n".join(newer())).split("\n")):
        if len(low) == 1:
            out[ord(c)] = ord(low)
    return out


def code_points(texts: list[str], special: tuple[str, ...] = ()) -> np.ndarray:
    """All texts in one array, PIECE after each; special strings are one SPECIAL."""
    parts = []
    for text in texts:
        for s in special:
            if s in text:
                text = text.replace(s, special[0])
        cut = text.split(special[0]) if special and special[0] in text else [text]
        for i, part in enumerate(cut):
            parts.append(part.encode("utf-32-le", "surrogatepass"))
            parts.append((PIECE if i == len(cut) - 1 else SPECIAL).to_bytes(4, "little"))
    return np.frombuffer(b"".join(parts), np.uint32)


def word_bounds(cp: np.ndarray, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words.  With ``keep_space`` a space joins the word after it and white space is kept
    (byte-level pattern); without, numbers are single and white space is dropped (word pattern)."""
    kind = classes()[cp]
    n = len(cp)
    new = np.ones(n + 3, bool)
    new[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == MARK)
    if keep_space:
        after = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != MARK)) + 1
        joined = cp[after - 1] == 0x20
        new[after - 1] = True
        new[after[joined]] = False
    else:
        new[:n] |= kind == NUMBER
    quote = np.flatnonzero((cp == 0x27) & new[:n])
    quote = quote[quote + 2 < n]
    if len(quote):
        a, b = cp[quote + 1], cp[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        new[quote[one | two] + 1] = False
        new[quote[one] + 2] = True
        new[quote[two] + 3] = True
    starts = np.flatnonzero(new[:n])
    ends = np.append(starts[1:], n)
    if not keep_space:
        kept = kind[starts] != SPACE
        starts, ends = starts[kept], ends[kept]
    return starts, ends


def _mix(x: np.ndarray, odd: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def word_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word of an array of bytes or code points.

    Eight bytes are mixed in at a time, without a polynomial that chosen words could make collide; words of more than
    ``LONG`` units get a cryptographic hash."""
    per = 8 // units.itemsize
    padded = np.concatenate([units, np.zeros(per, units.dtype)])
    wide = np.ndarray((len(units),), "<u8", padded.data, strides=(units.itemsize,))
    keep = np.array([(1 << 8 * units.itemsize * k) - 1 for k in range(per + 1)], np.uint64)
    size = ends - starts
    one = _mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15), 0x94D049BB133111EB)
    two = _mix(size.astype(np.uint64) ^ np.uint64(0xC2B2AE3D27D4EB4F), 0xD6E8FEB86659FD93)
    short = size <= LONG
    for k in range(0, LONG, per):
        alive = np.flatnonzero((size > k) & short)
        if not len(alive):
            break
        x = wide[starts[alive] + k] & keep[np.minimum(size[alive] - k, per)]
        one[alive] = _mix(one[alive] ^ x, 0x94D049BB133111EB)
        two[alive] = _mix(two[alive] * np.uint64(0x9E3779B97F4A7C15) + x, 0xD6E8FEB86659FD93)
    for i in np.flatnonzero(~short).tolist():
        digest = hashlib.blake2b(units[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        one[i], two[i] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    return one, two


def distinct_words(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """The first place of each different word, the number of each word's own, and both hashes of the different words."""
    one, two = word_hashes(units, starts, ends)
    _, first, back = np.unique(one, return_index=True, return_inverse=True)
    if (two[first][back] != two).any():
        _, first, back = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
    return first, back, one[first].tolist(), two[first].tolist()


def text_of(cp: np.ndarray, start: int, end: int) -> str:
    return cp[start:end].tobytes().decode("utf-32-le", "surrogatepass")


def windows(cp: np.ndarray, limit: int):
    """Ranges of about ``limit`` code points that end where a run of white space begins or after a mark, where no word goes on."""
    kind, n, start = classes(), len(cp), 0
    while n - start > limit:
        seen = start + limit
        while True:
            k = kind[cp[seen - limit + 1 if seen > start + limit else start + 1 : min(seen, n)]]
            before = kind[cp[seen - limit if seen > start + limit else start : min(seen, n) - 1]]
            cut = np.flatnonzero(((k == SPACE) & (before != SPACE)) | (before == MARK))
            if len(cut) or seen >= n:
                break
            seen += limit
        if not len(cut):
            break
        end = (seen - limit if seen > start + limit else start) + 1 + int(cut[-1])
        yield start, end
        start = end
    if start < n:
        yield start, n
