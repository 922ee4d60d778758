"""64-bit hashes of the words of a text, computed on its bytes at once."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0xD1342543DE82EF95)                      # odd, so powers can be inverted modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLOCK = 1 << 18                                           # bytes hashed at once; longer texts are cut at white space
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PLAIN = SPACE.copy()                                     # also ASCII punctuation and controls: words are letters and digits
PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for b in (BASE, INVERSE):
            p = np.full(BLOCK + 4096, b, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def word_spans(data: bytes, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words: maximal runs of bytes that are not gaps (ASCII white space)."""
    gap = gaps[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(data: bytes, gaps: np.ndarray = SPACE) -> np.ndarray:
    """One hash per word, in order; equal words have equal hashes.  Gaps are ASCII bytes, white space among them."""
    return words_at(data, gaps)[2]


def words_at(data: bytes, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte offsets) and hash of every word."""
    if len(data) <= BLOCK:
        return _block(data, gaps)
    parts, at = [], 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            cut = max(data.rfind(b, at, end) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:      # one word longer than a block: hash it by itself
                tail = [x for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (x := data.find(b, end)) >= 0]
                end = min(tail, default=len(data))
                left = len(data[at:end]) - len(data[at:end].lstrip(b" \t\n\r\x0b\x0c"))
                word = data[at + left:end]                # taken whole, also where it holds other gaps
                h = np.zeros(1, np.uint64)
                for i in range(0, len(word), BLOCK):
                    h = mix(h) + _block_sum(word[i:i + BLOCK])
                parts.append((np.array([at + left]), np.array([end]), mix(h ^ np.uint64(0x5851F42D4C957F2D))))
                at = end
                continue
            end = cut
        start, stop, h = _block(data[at:end], gaps)
        parts.append((start + at, stop + at, h))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))


def _block_sum(word: bytes) -> np.uint64:
    power = _powers()[0]
    return ((np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:len(word)]).sum(dtype=np.uint64)


def _block(data: bytes, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    power, inverse = _powers()
    start, end = word_spans(data, gaps)
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    return start, end, mix((total[end] - total[start]) * inverse[start])


def run_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash per run words[start:end]; equal runs have equal hashes wherever they stand."""
    n = len(words)
    if n < BLOCK:
        power, inverse = (p[:n + 1] for p in _powers())
    else:
        power, inverse = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, b, np.uint64)))) for b in (BASE, INVERSE))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n]
    return mix(acc)
