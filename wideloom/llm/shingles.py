"""Word-shingle sets and SuperMinHash signatures of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

from .common import GOLDEN, chain64, mix64

TEXT_BLOCK = 4 << 20  # characters whose shingles are held at once; one longer text is a block alone


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, in order (A-Z lower-cased; words end at ASCII white space)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a shorter text is one
    shingle as a whole, a text without words has none."""
    h = word_hashes(text)
    if len(h) == 0:
        return h
    if len(h) < k:
        return chain64(*(h[i:i + 1] for i in range(len(h))), np.array([len(h)], dtype=np.uint64))
    return np.unique(chain64(*(h[i:len(h) - k + 1 + i] for i in range(k))))


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (one row of ``m`` values per set; every set non-empty).

    Each element visits the ``m`` places in a random order of its own; at its
    j-th visit it offers the value ``j + fraction`` there, and every place keeps
    the least offer.  The visits of one element exclude each other, which is
    what lowers the variance against ``m`` independent minima.  All sets advance
    together, one visit of every element at a time, and a set stops as soon as
    each of its places holds a value of the visits made so far: any later offer
    would be larger.
    """
    out = np.full((len(sets), m), np.iinfo(np.uint64).max, dtype=np.uint64)
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    elements = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    order: np.ndarray | None = None  # the places in visiting order, swapped as it goes
    picks = []
    for j in range(m):
        if not len(elements):
            break
        rnd = mix64(elements + np.uint64((j + 1) * int(GOLDEN) % (1 << 64)))
        pick = (j + (((rnd & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64))
        if j == 0:
            place, picks = pick, [pick]
        else:
            rows = np.arange(len(elements))
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
                order[rows, 0], order[rows, picks[0]] = picks[0], 0
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, j]
            order[rows, j] = place
        offer = (np.uint64(j) << np.uint64(32)) | (rnd >> np.uint64(32))
        np.minimum.at(out.reshape(-1), owner * m + place, offer)
        open_ = (out >> np.uint64(32) > np.uint64(j)).any(axis=1)  # some place still without a value
        stay = open_[owner]
        elements, owner = elements[stay], owner[stay]
        picks = [p[stay] for p in picks]
        order = order[stay] if order is not None else None
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ by the band's number."""
    rows = signatures.shape[1] // bands
    parts = signatures[:, :bands * rows].reshape(-1, bands, rows)
    number = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    return chain64(number, *(parts[:, :, r] for r in range(rows))).view(np.int64)


def blocks(rows: Iterable[tuple], text_at: int) -> Iterator[list[tuple]]:
    """Rows in groups of about ``TEXT_BLOCK`` characters."""
    block: list[tuple] = []
    size = 0
    for row in rows:
        block.append(row)
        size += len(row[text_at] or "")
        if size >= TEXT_BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())
