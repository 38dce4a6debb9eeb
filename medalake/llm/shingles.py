"""Word shingles of texts as sorted 64-bit hashes, computed over whole blocks of bytes."""

from __future__ import annotations

import numpy as np

# Capitals A-Z to small letters, byte by byte; other bytes stay.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

# A word's bytes are numbers of a polynomial over odd constants modulo 2**64, so a stretch of a
# prefix sum, moved to position 0 by the inverse power, is the stretch's own hash.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20
SLICE_WORDS = 1 << 16
_rng = np.random.default_rng(20_111)
BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_FORWARD, _BACK = _powers(BASE, 2 * BLOCK_BYTES), _powers(INVERSE, 2 * BLOCK_BYTES)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes over all their bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(text: bytes) -> list[bytes]:
    """Words between white space (0x20, 0x09-0x0D), A-Z in lower case."""
    return text.translate(LOWER).split()


def _block_hashes(pieces: list[bytes], counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Shingle hashes of each piece: words joined by one space, ``counts`` of them."""
    buffer = np.frombuffer(b" ".join(pieces), np.uint8)
    n = len(buffer)
    forward, back = (
        (_FORWARD, _BACK) if n < len(_FORWARD) else (_powers(BASE, n + 1), _powers(INVERSE, n + 1))
    )
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[buffer] * forward[:n], out=sums[1:])
    gaps = np.flatnonzero(buffer == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [n]])
    last = np.cumsum(counts)
    first = last - counts
    # A piece of w words has w - size + 1 shingles, or one of all its words if it has fewer.
    shingles = np.maximum(counts - size + 1, 1)
    offsets = np.cumsum(shingles) - shingles
    at = np.arange(shingles.sum()) - np.repeat(offsets - first, shingles)
    to = np.minimum(at + size, np.repeat(last, shingles)) - 1
    begin = starts[at]
    hashes = mix((sums[ends[to]] - sums[begin]) * back[begin])
    return np.split(hashes, offsets[1:])


def ngram_hashes(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The hashes of every run of ``size`` words of each text in order, with repeats; of all its
    words, if it has fewer; none for a null text or one without words.

    Long texts are hashed in slices that overlap by ``size - 1`` words, so memory is bounded by
    the block size and the longest text's words.
    """
    found: list[list[np.ndarray]] = [[] for _ in texts]
    pieces: list[bytes] = []
    owners: list[int] = []
    counts: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if pieces:
            for owner, h in zip(owners, _block_hashes(pieces, np.array(counts), size)):
                found[owner].append(h)
        pieces.clear(), owners.clear(), counts.clear()
        held = 0

    for i, text in enumerate(texts):
        all_words = words(text) if text else []
        for at in range(0, max(1, len(all_words) - size + 1), SLICE_WORDS):
            piece = all_words[at : at + SLICE_WORDS + size - 1]
            if not piece:
                continue
            pieces.append(b" ".join(piece))
            owners.append(i)
            counts.append(len(piece))
            held += len(pieces[-1]) + 1
            if held >= BLOCK_BYTES:
                flush()
    flush()
    none = np.empty(0, np.uint64)
    return [(np.concatenate(h) if len(h) > 1 else h[0]) if h else none for h in found]


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return [np.unique(h) for h in ngram_hashes(texts, size)]
