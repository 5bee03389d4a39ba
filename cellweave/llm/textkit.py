"""A batch of texts as numpy arrays: bytes, words, word windows and lines.

Words are runs of anything but ASCII white space (space, tab, line feed, vertical tab, form
feed, carriage return), so they can be found in UTF-8 bytes. Hashes are 64-bit sums of
byte values times powers of an odd base, taken over whole spans through one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SEPARATORS = b" \t\n\x0b\x0c\r"

_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(2**62, 2**63)) | 1
_INVERSE = pow(_BASE, -1, 2**64)
_WINDOW = (_rng.integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(SEPARATORS)] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())

        def table(base: int) -> np.ndarray:
            steps = np.full(size, base & (2**64 - 1), np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        _powers = (table(_BASE), table(_INVERSE))
    return _powers


def chunks(texts: Sequence[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters each; a longer text is a range of its own."""
    low, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if isinstance(text, str) else 0
        if i > low and size + n > limit:
            yield low, i
            low, size = i, 0
        size += n
    if low < len(texts):
        yield low, len(texts)


class Texts:
    """Arrays over the UTF-8 bytes of a batch; each text is followed by one line feed.

    A null text counts as empty. ``first[d]:last[d]`` are the words of text ``d``.
    """

    def __init__(self, texts: Sequence[str | None], lower: bool = False):
        raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
        joined = b"\n".join(raw) + b"\n"
        self.bytes = np.frombuffer(joined.translate(_LOWER) if lower else joined, np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.separator = _SEPARATOR[self.bytes]
        step = np.diff(self.separator.view(np.int8), prepend=np.int8(1))
        self.word_start = np.flatnonzero(step == -1)
        self.word_end = np.flatnonzero(step == 1)
        self.first = np.searchsorted(self.word_start, self.starts)
        self.last = np.searchsorted(self.word_start, self.ends)
        self.n_words = self.last - self.first
        self.word_text = np.repeat(np.arange(len(raw)), self.n_words)
        self._running: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a byte-wise array for each text."""
        return np.add.reduceat(flags, self.starts, dtype=np.int64) if len(self) else np.zeros(0, np.int64)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes start:end, whatever their place."""
        power, inverse = _power_tables(len(self.bytes) + 1)
        if self._running is None:
            self._running = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[self.bytes] * power[: len(self.bytes)], dtype=np.uint64, out=self._running[1:])
        return mixed((self._running[end] - self._running[start]) * inverse[start])

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.word_start, self.word_end)

    def windows(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``width`` words on end, and the index of the first word of each.

        Windows stay inside one text.
        """
        n = len(words) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total += words[i : i + n] * _WINDOW[i]
        inside = np.flatnonzero(self.word_text[:n] == self.word_text[width - 1 :])
        return mixed(total[inside] + np.uint64(width)), inside

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, text index and word count of each line."""
        end = np.flatnonzero(self.bytes == 10)
        start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        text = np.searchsorted(self.ends, start, "right")
        count = np.searchsorted(self.word_start, end) - np.searchsorted(self.word_start, start)
        return start, end, text, count


def repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (owner, key) entries occur more than once, and which are not the first of theirs."""
    salted = mixed(keys + mixed(owner.astype(np.uint64)))
    order = np.argsort(salted, kind="stable")
    ranked = salted[order]
    same = np.zeros(len(keys), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    later = np.zeros(len(keys), bool)
    later[order] = same
    twice = same.copy()
    twice[:-1] |= same[1:]
    out = np.zeros(len(keys), bool)
    out[order] = twice
    return out, later


def window_words(texts: Texts, words: np.ndarray, width: int) -> np.ndarray:
    """For each text, the number of words inside windows that occur twice or more in it."""
    keys, first = texts.windows(words, width)
    edge = np.zeros(len(words) + 1, np.int64)
    if len(keys):
        twice, _ = repeated(keys, texts.word_text[first])
        np.add.at(edge, first[twice], 1)
        np.add.at(edge, first[twice] + width, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[texts.last] - covered[texts.first]


def duplicate_lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """For each text, its lines that hold a word, and those of them equal to an earlier line."""
    start, end, text, count = texts.lines()
    full = count > 0
    start, end, text = start[full], end[full], text[full]
    _, later = repeated(texts.span_hash(start, end), text)
    n = len(texts)
    return np.bincount(text, minlength=n), np.bincount(text[later], minlength=n)
