"""Alignment of read prefixes to barcode templates, for a whole batch of reads at a time."""

from __future__ import annotations

import numpy as np

#: Scores in tenths: exact sums, so that ties are ties. Fixed values.
MATCH, MISMATCH, WILDCARD, GAP, LEFT_GAP = 10, -10, 0, -11, -19
#: A read is aligned as far as this many template lengths.
PREFIX = 1.5
WILD, PAD = ord("N"), 0


def encoded(texts: list[str], width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Letters as a (text, place) matrix padded with 0, and the lengths, both cut at ``width``."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)
    lengths = sizes if width is None else np.minimum(sizes, width)
    most = int(lengths.max(initial=0))
    if len(texts) and (sizes == sizes[0]).all():
        return flat.reshape(len(texts), sizes[0])[:, :most], lengths
    at = np.arange(most)[None]
    there = at < lengths[:, None]
    out = np.zeros((len(texts), most), np.uint8)
    out[there] = flat[((np.cumsum(sizes) - sizes)[:, None] + at)[there]]
    return out, lengths


#: How far from the diagonal reads are aligned at first.
BAND = 5
#: Less than any score.
FAR = -(1 << 20)


def align(templates: np.ndarray, reads: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores in tenths, and for each template letter the read letters used up when it is matched.

    ``templates``: (row, L), ``reads``: (row, M). A template letter without a partner has -1.
    Global alignment; gaps at the left end cost more, read letters after the template's end
    nothing. A read without letters has all letters of its template deleted.
    """
    scores, most = upright(templates, reads, lengths)
    used = np.repeat(np.arange(1, templates.shape[1] + 1)[None], len(lengths), 0)
    rest = np.flatnonzero(scores <= most)
    if len(rest):
        given = templates[rest], reads[rest], lengths[rest]
        scores[rest], used[rest], most = banded(*given)
        own, ways = scores[rest], used[rest]
        widened(*given, own, ways, own <= most)
        scores[rest], used[rest] = own, ways
    return scores, used


#: Up to so many gaps, letters that have a partner at all are counted.
GAPS = 3


def upright(templates: np.ndarray, reads: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the ways without a gap, and the most that ways with gaps may score.

    A way with some gaps pairs no letter with one further off than so many places, so template letters
    without their like there are mismatches or gaps. Where the first number is the greater, :func:`align`
    pairs each letter with the one at its own place. Reads shorter than their template have no way without a gap.
    """
    rows, size = templates.shape
    shifted = np.full((size + 2 * GAPS, rows), PAD, np.uint8)
    width = min(reads.shape[1], size + GAPS)
    shifted[GAPS : GAPS + width] = reads.T[:width]
    letters = templates.T
    fixed = letters != WILD
    at = np.flatnonzero(fixed.any(axis=1))
    letters, fixed = np.ascontiguousarray(letters[at]), fixed[at]
    there = fixed.sum(axis=0)
    wild = shifted == WILD

    def near(k: int) -> np.ndarray:
        return ((letters == shifted[at + GAPS + k]) | wild[at + GAPS + k]) & fixed

    found = near(0)
    open_ = (wild[at + GAPS] & fixed).sum(axis=0)
    hits = found.sum(axis=0)
    scores = MATCH * (hits - open_) + MISMATCH * (there - hits) + WILDCARD * (open_ + size - there)
    most = MATCH * there + (GAPS + 1) * GAP
    for gaps in range(1, GAPS + 1):
        found |= near(gaps)
        found |= near(-gaps)
        hits = found.sum(axis=0)
        most = np.maximum(most, MATCH * hits + MISMATCH * np.maximum(there - hits - gaps, 0) + gaps * GAP)
    return np.where(lengths < size, FAR, scores), most + max(WILDCARD, 0) * size


def banded(templates: np.ndarray, reads: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`align` near the diagonal, and the most that a way further from it can score.

    A way through the matrix that goes further than ``BAND`` from the diagonal has more gaps than
    that, so a read whose best score within the band is over all matches less so many gaps has
    no way as good outside it. Of the others only :func:`widened` tells the score.
    """
    size, width = templates.shape[1], reads.shape[1]
    if min(size, width) <= 2 * BAND:
        return *_aligned(templates, reads, lengths, max(size, width)), np.full(len(lengths), FAR)
    most = MATCH * (templates != WILD).sum(axis=1) + max(WILDCARD, 0) * size + (BAND + 1) * GAP
    return *_aligned(templates, reads, lengths, BAND), most


def widened(templates: np.ndarray, reads: np.ndarray, lengths: np.ndarray, scores: np.ndarray, used: np.ndarray, where: np.ndarray) -> None:
    """Put what the whole matrix gives into ``scores`` and ``used`` of the rows ``where``."""
    rest = np.flatnonzero(where)
    if len(rest):
        scores[rest], used[rest] = _aligned(templates[rest], reads[rest], lengths[rest], max(templates.shape[1], reads.shape[1]))


def _running(rows: np.ndarray) -> None:
    """Each row's greatest values so far: a call for each row is faster here than one for all."""
    for k in range(1, len(rows)):
        np.maximum(rows[k - 1], rows[k], out=rows[k])


def _aligned(templates: np.ndarray, reads: np.ndarray, lengths: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`align` by ways that stay within ``band`` of the diagonal, but for letters after the template's end.

    Of steps that score alike, a read letter without partner is taken first, then a template letter
    without one, then a pair. ``way`` has, for each cell, twice the place in its row where read
    letters without partner end, and one more if a pair is what comes there.
    """
    rows, size = templates.shape
    width = reads.shape[1]
    # the narrowest numbers that hold all scores and places
    kind, far = (np.int16, -16_000) if 40 * (size + width) < 8_000 else (np.int32, FAR)
    way = np.zeros((size + 1, width + 1, rows), np.uint8 if 2 * width + 1 < 256 else np.int32)
    left = (np.arange(width + 1) * LEFT_GAP).astype(kind)
    above = np.repeat(left[:, None], rows, axis=1)
    above[band + 1 :] = far
    turned, letters = np.ascontiguousarray(reads.T), np.ascontiguousarray(templates.T)
    wild, gap = turned == WILD, kind(GAP)
    any_wild = bool(wild.any())
    steps = -np.arange(width + 2, dtype=kind)[:, None]
    places = (2 * np.arange(width + 1)[:, None]).astype(way.dtype)
    for i in range(1, size + 1):
        letter = letters[i - 1][None]
        low, high = max(1, i - band), min(width, i + band)
        here = np.full_like(above, far)
        if i <= band:
            here[0] = i * LEFT_GAP
        if low <= high:
            part = slice(low - 1, high)
            open_ = letter == WILD
            if open_.all():
                pair = above[part] + kind(WILDCARD)
            else:
                score = (letter == turned[part]) * kind(MATCH - MISMATCH) + kind(MISMATCH)
                if any_wild or open_.any():
                    score = np.where(open_ | wild[part], kind(WILDCARD), score)
                pair = above[part] + score
            skip = above[low : high + 1] + gap
            two = skip < pair
            best = np.maximum(skip, pair)
            # the best of all ways along the row, a gap's cost for each place taken off and put back
            after = 0 if i == size else GAP
            count = high - low + 2
            run = np.empty((count, rows), kind)
            run[0], run[1:] = here[low - 1], best
            if after:
                run += steps[:count] * gap
            _running(run)
            if after:
                run -= steps[:count] * gap
            here[low : high + 1] = run[1:]
            found = places[low : high + 1] + two
            found *= run[:-1] + kind(after) < best
            _running(found)
            way[i, low : high + 1] = found
            way[i, high + 1 :] = found[-1]
            if i == size:
                here[high + 1 :] = here[high]  # letters after the template's end cost nothing
        above = here
    every = np.arange(rows)
    scores = above[lengths, every].astype(np.int64)
    if far != FAR:
        scores[scores < far // 2] = FAR
    used = np.full((size, rows), -1, np.int64)
    at = lengths.astype(np.int64)
    for i in range(size, 0, -1):
        # a score from outside the band is of no use, but its way has to end
        found = way[i].reshape(-1).take(at * rows + every)
        at, two = (found >> 1).astype(np.int64), found & 1
        np.copyto(used[i - 1], at, where=two == 1)
        at -= two
    return scores, np.ascontiguousarray(used.T)


def boundaries(used: np.ndarray, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the blocks that end at ``ends`` in the template end in each read, and whether all do.

    A letter inserted at a boundary belongs to the next block. A boundary inside a gap is where
    the pairs before it end. A boundary with no pair before it, or none after it, is undefined.
    """
    rows, size = used.shape
    there = used >= 0
    place = np.where(there, np.arange(1, size + 1), 0)
    upto = np.maximum.accumulate(place, axis=1)
    last = upto[:, -1]
    out, ok = np.zeros((rows, len(ends)), np.int64), last > 0
    every = np.arange(rows)
    for k, end in enumerate(ends[:-1]):
        earlier = upto[:, end - 1]
        before = np.where(earlier > 0, used[every, np.maximum(earlier - 1, 0)], -1)
        starts = there[:, end] & ~there[:, end - 1]
        out[:, k] = np.where(starts, used[:, end] - 1, before)
        ok &= (there[:, end - 1] | (last > end)) & (out[:, k] >= 0)
    out[:, -1] = np.where(last > 0, used[every, np.maximum(last - 1, 0)] + size - last, 0)
    return out, ok
