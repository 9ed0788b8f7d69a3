"""Hashes of the words of many texts at once, by running sums over their bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

from ledgerloom.llm.rows import mixed

BUFFER = 1 << 18  # bytes that are hashed together; a word of so many is hashed by itself
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_"  # do not count around a word

RATIO = 0x9E3779B97F4A7C15 | 1
POWERS = np.cumprod(np.full(BUFFER, RATIO, np.uint64))
INVERSE = np.cumprod(np.full(BUFFER, pow(RATIO, -1, 1 << 64), np.uint64))
BLANK = b"\t\n\x0b\x0c\r "
KINDS = bytes(0 if b in BLANK else 1 if chr(b) in EDGES else 2 for b in range(256))  # white space, edge, other


def split(text: str) -> list[str]:
    """The words of a text: runs of other characters than ASCII white space."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def found_in(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of at most BUFFER bytes starts, and its hash without EDGES around it (with them, if it has nothing else)."""
    text = np.frombuffer(data, np.uint8)
    kind = np.frombuffer((b" " + data + b" ").translate(KINDS), np.uint8)
    inside, core = kind > 0, kind[1:-1] > 1
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    at, upto = np.flatnonzero(core), np.cumsum(core)
    first, last = upto[starts] - core[starts], upto[ends - 1]
    some = last > first
    begin, end = starts.copy(), ends.copy()
    begin[some], end[some] = at[first[some]], at[last[some] - 1] + 1
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * POWERS[: len(text)], out=sums[1:])
    return starts, mixed((sums[end] - sums[begin]) * INVERSE[begin])


def long_text(data: bytes) -> np.ndarray:
    """The hashes of a text of any length, cut at white space."""
    parts, at = [], 0
    while at < len(data):
        blank = np.flatnonzero(np.frombuffer(data[at : at + BUFFER].translate(KINDS), np.uint8) == 0)
        if len(blank) or len(data) - at < BUFFER:
            end = at + int(blank[-1]) + 1 if len(blank) and len(data) - at > BUFFER else min(at + BUFFER, len(data))
            parts.append(found_in(data[at:end])[1])
        else:
            end = at + BUFFER
            while end < len(data) and data[end] not in BLANK:
                end += 1
            word = data[at:end]
            parts.append(np.array([xxhash.xxh64_intdigest(word.strip(EDGES.encode()) or word)], np.uint64))
        at = end
    return np.concatenate([*parts, np.empty(0, np.uint64)])


def hashed_words(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """For each text, in order, one number per word; case and EDGES around a word do not count."""
    held: list[bytes] = []
    size = 0

    def out() -> Iterator[np.ndarray]:
        starts, hashes = found_in(b"\n".join(held))
        yield from np.split(hashes, np.searchsorted(starts, np.cumsum([len(h) + 1 for h in held[:-1]])))

    for text in texts:
        data = text.lower().encode("utf-8", "surrogatepass")
        if held and size + len(data) + 1 > BUFFER:
            yield from out()
            held, size = [], 0
        if len(data) + 1 > BUFFER:
            yield long_text(data)
        else:
            held.append(data)
            size += len(data) + 1
    if held:
        yield from out()
