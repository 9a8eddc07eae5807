"""Content-defined cover of fixed-length windows, shared by the repeat finders.

A window of ``length`` units (bytes or words) is represented by the smallest
``gram``-long hash inside it (leftmost of equals). Equal windows have equal
representatives at equal offsets, so about two in ``length - gram`` positions
stand for all windows. Consecutive windows with one representative form a
span; each span is one record.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from cadenza.llm.hashing import Prefix, U, mix

_PLACE = U((1 << 24) - 1)


@dataclass
class Spans:
    """Runs of windows with one representative: windows start .. start + count - 1 of text ``doc``."""
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    shift: np.ndarray
    gram: np.ndarray
    content: np.ndarray


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys, by doubling."""
    out, done = keys, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def spans(prefix: Prefix, bounds: np.ndarray, length: int, gram: int) -> Spans:
    """Spans of every text; text i holds the units bounds[i]:bounds[i + 1]."""
    total = int(bounds[-1])
    if total < length:
        e = np.zeros(0, dtype=np.int64)
        return Spans(e, e, e, e, e.astype(U), e.astype(U))
    width = length - gram + 1
    chunks = []
    # A chunk is short enough for a place to fit the low bits of a key.
    for lo in range(0, total - length + 1, 1 << 23):
        hi = min(total, lo + (1 << 23) + length - 1)
        at = np.arange(lo, hi - gram + 1)
        keys = (prefix.of(at, at + gram) & ~_PLACE) | np.arange(len(at), dtype=U)
        chunks.append((_smallest(keys, width) & _PLACE).astype(np.int64) + lo)
    anchor = np.concatenate(chunks)
    sizes = np.diff(bounds)
    valid = np.zeros(total + 1, dtype=np.int8)
    fits = sizes >= length
    np.add.at(valid, bounds[:-1][fits], 1)
    np.add.at(valid, bounds[1:][fits] - length + 1, -1)
    places = np.flatnonzero(np.cumsum(valid[:len(anchor)]))
    if not len(places):
        return spans(prefix, np.zeros(2, dtype=np.int64), length, gram)
    doc = np.searchsorted(bounds, places, side="right") - 1
    own = anchor[places]
    new = np.ones(len(places), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1]) | (places[1:] != places[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(places)))
    start, own = places[first], own[first]
    shift = own - start
    with np.errstate(over="ignore"):
        content = mix(prefix.of(start, start + count + length - 1) + shift.astype(U) * U(0xBF58476D1CE4E5B9))
    return Spans(doc[first], start - bounds[doc[first]], count, shift, prefix.of(own, own + gram), content)


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the given ranges; touching ranges join."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:] - 1, len(end) - 1)]
