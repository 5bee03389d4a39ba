"""BAM records as Arrow columns and back, a batch at a time, and the index of a sorted file.

Records are found by walking from length to length; everything in them is then taken out of
one buffer by numpy: fields by views, texts by ranges, bases and qualities by tables, tags in
step for all records. Tags are texts ``NAME:type:value`` with the format's own type letter, so
that nothing is lost on the way back.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cellweave.sources import bgzf

BASES, STEPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
#: Steps that go on in the reference.
FORWARD = "MDN=X"
NUMBERS = {"c": "<i1", "C": "<u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4", "f": "<f4"}
#: Fixed part of a record. Fixed values.
FIXED = np.dtype([("ref", "<i4"), ("pos", "<i4"), ("n_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_steps", "<u2"), ("flag", "<u2"),
                  ("n", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("span", "<i4")])
SCHEMA = pa.schema([
    ("query_name", pa.string()), ("flag", pa.int32()), ("ref", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()),
    ("mate_ref", pa.string()), ("mate_pos", pa.int64()), ("template_length", pa.int32()), ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.list_(pa.string())),
])
DDL = "query_name string, flag int, ref string, pos long, mapq int, cigar string, mate_ref string, mate_pos long, template_length int, seq string, qual string, tags array<string>"
#: Bytes of records decoded at a time.
CHUNK = 2 << 20

_PAIR = np.array([[ord(BASES[b >> 4]), ord(BASES[b & 15])] for b in range(256)], np.uint8)
_CODE = np.full(256, 15, np.uint8)
for _i, _c in enumerate(BASES):
    _CODE[[ord(_c), ord(_c.lower())]] = _i
_SIZE = np.zeros(256, np.int64)
for _c, _k in [("A", 1), *((c, np.dtype(t).itemsize) for c, t in NUMBERS.items())]:
    _SIZE[ord(_c)] = _k


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... size[0] of them, then those of start[1], and so on."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def _offsets(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)])


def texts(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.StringArray:
    """The bytes start:start+size of ``data`` as texts."""
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(_offsets(size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[ranges(start, size)])))


def _or_star(values: pa.StringArray, given: np.ndarray) -> pa.Array:
    return pc.if_else(pa.array(given), values, "*")


def header(stream) -> tuple[list[tuple[str, int]], int]:
    """Name and length of each reference, and how many bytes the header takes."""
    taken = 0

    def take(n: int) -> bytes:
        nonlocal taken
        taken += n
        return stream.read(n)

    number = lambda: struct.unpack("<i", take(4))[0]
    if take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    take(number())
    refs = []
    for _ in range(number()):
        name = take(number())[:-1].decode()
        refs.append((name, number()))
    return refs, taken


def _numbers(values: np.ndarray, kind: str) -> list[bytes]:
    """Numbers as texts; single floats in as few digits as tell them apart."""
    return [str(v).encode() for v in (values if kind == "f" else values.tolist())]


def _array(data: np.ndarray, at: int) -> bytes:
    sub = chr(data[at])
    n = int(data[at + 1 : at + 5].view("<i4")[0])
    kind = NUMBERS[sub]
    values = data[at + 5 : at + 5 + n * np.dtype(kind).itemsize].view(kind)
    return b",".join([sub.encode(), *_numbers(values, sub)])


def _tags(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.ListArray:
    """All tags of all records: the k-th ones of all records at once."""
    zeros = np.flatnonzero(data == 0)
    who, at, found = np.flatnonzero(start < end), start[start < end], []
    while len(who):
        kind = data[at + 2]
        size = _SIZE[kind]
        text = (kind == ord("Z")) | (kind == ord("H"))
        size[text] = zeros[np.searchsorted(zeros, at[text] + 3)] - (at[text] + 3) + 1
        for i in np.flatnonzero(kind == ord("B")):
            size[i] = 5 + int(data[at[i] + 4 : at[i] + 8].view("<i4")[0]) * _SIZE[data[at[i] + 3]]
        if (size == 0).any():
            raise ValueError(f"a tag of unknown type {chr(kind[size == 0][0])!r}")
        found.append((who, at, kind, size))
        at = at + 3 + size
        going = at < end[who]
        who, at = who[going], at[going]
    if not found:
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(start) + 1, np.int32)), pa.array([], pa.string()))
    who, at, kind, size = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(who, kind="stable")
    who, at, kind, size = who[order], at[order], kind[order], size[order]
    # values are bytes of the buffer, or of texts made here and put after it
    first, length, made, upto = at + 3, size - 1, [data], len(data)
    for k in np.unique(kind):
        own = np.flatnonzero(kind == k)
        if chr(k) == "A":
            length[own] = 1
        elif chr(k) not in "ZH":
            if chr(k) == "B":
                shown, place = [_array(data, i + 3) for i in at[own]], np.arange(len(own))
            else:
                values = data[ranges(at[own] + 3, size[own])].view(NUMBERS[chr(k)])
                distinct, place = np.unique(values.view(f"<u{values.itemsize}"), return_inverse=True)
                shown = _numbers(distinct.view(values.dtype), chr(k))
            sizes = np.array([len(s) for s in shown])
            first[own], length[own] = (upto + np.cumsum(sizes) - sizes)[place], sizes[place]
            made.append(np.frombuffer(b"".join(shown), np.uint8))
            upto += int(sizes.sum())
    source = np.concatenate(made)
    place = _offsets(length + 5)
    out = np.empty(place[-1], np.uint8)
    begin = place[:-1]
    for k, column in enumerate((data[at], data[at + 1], ord(":"), kind, ord(":"))):
        out[begin + k] = column
    out[ranges(begin + 5, length)] = source[ranges(first, length)]
    values = pa.StringArray.from_buffers(len(at), pa.py_buffer(place.astype(np.int32)), pa.py_buffer(out))
    return pa.ListArray.from_arrays(pa.array(_offsets(np.bincount(who, minlength=len(start))), pa.int32()), values)


def decoded(data: bytes, start: np.ndarray, size: np.ndarray, names: pa.Array) -> list[pa.Array]:
    """Columns of ``SCHEMA`` of the records at ``start`` (after their lengths); ``names`` of the references, ``*`` last."""
    b = np.frombuffer(data, np.uint8)
    fixed = b[start[:, None] + np.arange(FIXED.itemsize)].reshape(-1).view(FIXED)
    n = fixed["n"].astype(np.int64)
    name_at = start + FIXED.itemsize
    n_name, n_steps = fixed["n_name"].astype(np.int64), fixed["n_steps"].astype(np.int64)
    steps_at = name_at + n_name
    seq_at = steps_at + 4 * n_steps
    packed = (n + 1) // 2
    qual_at = seq_at + packed
    steps, which = np.unique(b[ranges(steps_at, 4 * n_steps)].view("<u4"), return_inverse=True)
    shown = [f"{s >> 4}{STEPS[s & 15]}".encode() for s in steps.tolist()]
    width = np.array([len(s) for s in shown], np.int64)
    table, at = np.frombuffer(b"".join(shown), np.uint8), np.cumsum(width) - width
    letters = np.bincount(np.repeat(np.arange(len(n)), n_steps), weights=width[which], minlength=len(n)).astype(np.int64)
    cigar = table[ranges(at[which], width[which])]
    bases = _PAIR[b[ranges(seq_at, packed)]].reshape(-1)
    seq = texts(bases, 2 * (np.cumsum(packed) - packed), n)
    rated = n > 0
    rated[rated] = b[qual_at[rated]] != 255
    qual = texts(b + np.uint8(33), qual_at, np.where(rated, n, 0))
    refs = [names.take(pa.array(np.where(fixed[c] < 0, len(names) - 1, fixed[c]))) for c in ("ref", "mate")]
    whole = lambda c, kind: pa.array(fixed[c].astype(kind))
    return [
        texts(b, name_at, n_name - 1), whole("flag", np.int32), refs[0], whole("pos", np.int64), whole("mapq", np.int32), _or_star(texts(cigar, np.cumsum(letters) - letters, letters), n_steps > 0),
        refs[1], whole("mate_pos", np.int64), whole("span", np.int32), _or_star(seq, n > 0), _or_star(qual, rated), _tags(b, qual_at + n, start + size),
    ]


class Records:
    """Records that begin between two virtual offsets, chunk by chunk.

    ``begin`` -1: the first record from the block at ``start`` on is looked for. ``begin`` and,
    once all are read, ``after`` tell where the first record begins, and the first one beyond.
    """

    def __init__(self, raw, start: int, end: int, n_refs: int, inner: int = -1):
        self.window, self.end, self.n_refs, self.at = bgzf.Window(raw, start), end, n_refs, max(inner, 0)
        self.after = bgzf.END
        if inner < 0:
            while self.window.has(self.at + 1) and not self._plausible(self.at, 4):
                self.at += 1
        self.begin = self.window.place(self.at)

    def _plausible(self, at: int, chain: int) -> bool:
        """Whether ``chain`` records may follow one another from here, or fewer and the end."""
        w = self.window
        for k in range(chain):
            if not w.has(at + 36):
                return k > 0 and len(w.data) == at
            n, ref, pos, n_name, _, _, n_steps, _, n_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", w.data, at)
            if not (32 <= n < 1 << 28 and -1 <= ref < self.n_refs and -1 <= mate < self.n_refs and pos >= -1 and mate_pos >= -1 and n_name and n_seq >= 0):
                return False
            if 32 + n_name + 4 * n_steps + (n_seq + 1) // 2 + n_seq > n or not w.has(at + 36 + n_name):
                return False
            name = w.data[at + 36 : at + 36 + n_name]
            if name[-1] or not all(33 <= c < 127 for c in name[:-1]):
                return False
            at += 4 + n
        return True

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
        """(data, start, size, virtual offset) of the records of each chunk."""
        w, done = self.window, False
        while not done:
            while len(w.data) < self.at + CHUNK and not w.reached(self.end) and w.more():
                pass
            starts, at, stop = [], self.at, w.until(self.end) if w.reached(self.end) else 1 << 62
            while at < stop:
                if len(w.data) < at + 4 and not w.has(at + 4):
                    if len(w.data) > at:
                        raise ValueError("the file ends inside a record")
                    done = True
                    break
                n = int.from_bytes(w.data[at : at + 4], "little")
                if len(w.data) < at + 4 + n:
                    if starts and not w.reached(self.end):
                        break
                    if not w.has(at + 4 + n):
                        raise ValueError("the file ends inside a record")
                if stop == 1 << 62 and w.reached(self.end) and at >= (stop := w.until(self.end)):
                    break
                starts.append(at)
                at += 4 + n
            if at >= stop:
                done = True
                self.after = w.place(at)
            if starts:
                begun = np.array(starts)
                size = np.diff(np.append(begun, at)) - 4
                yield bytes(w.data[:at]), begun + 4, size, w.places(begun)
            w.drop(at)
            self.at = 0


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, first places and sizes of texts; null is empty."""
    column = column.fill_null("").cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data, offsets[:-1], np.diff(offsets)


def _steps(cigar: str) -> tuple[np.ndarray, int]:
    """A cigar's packed steps and how far it goes in the reference."""
    out, number, forward = [], 0, 0
    for c in "" if cigar == "*" else cigar:
        if c.isdigit():
            number = 10 * number + int(c)
        else:
            out.append(number << 4 | STEPS.index(c))
            forward += number if c in FORWARD else 0
            number = 0
    return np.array(out, "<u4"), forward


def _tag_bytes(text: str) -> bytes:
    """A tag as the format has it; ``i`` takes the type that holds it, as every other letter is its own type."""
    name, kind, value = text.split(":", 2)
    head = name.encode() + kind.encode()
    if kind in "ZH":
        return head + value.encode() + b"\0"
    if kind == "A":
        return head + value.encode()
    if kind == "B":
        sub, *values = value.split(",")
        return head + sub.encode() + struct.pack("<i", len(values)) + np.array(values, np.float32 if sub == "f" else np.int64).astype(NUMBERS[sub]).tobytes()
    if kind == "i" and int(value) >= 1 << 31:
        head = name.encode() + b"I"
        return head + struct.pack("<I", int(value))
    return head + (np.float32(value) if kind == "f" else np.int64(value)).astype(NUMBERS[kind]).tobytes()


def bins(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest bin of the format's index that holds [begin, end)."""
    out = np.zeros(len(begin), np.int64)
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        inside = begin >> shift == (end - 1) >> shift
        out[inside] = first + (begin[inside] >> shift)
    return out


def encoded(batch: pa.RecordBatch, refs: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records of a batch in ``SCHEMA``'s columns: their bytes, and of each its first byte, reference (-1: none), first and last place."""
    column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    rows = batch.num_rows
    whole = lambda n: column[n].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    known = pa.array(refs, pa.string())

    def number(n: str) -> np.ndarray:
        found = pc.index_in(column[n], known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        strange = (found < 0) & ~pc.is_in(column[n], pa.array(["*", None], pa.string())).to_numpy(zero_copy_only=False)
        if strange.any():
            raise ValueError(f"{column[n][int(np.flatnonzero(strange)[0])].as_py()!r} is none of the references")
        return found

    ref, mate, pos = number("ref"), number("mate_ref"), whole("pos")
    names, name_at, n_name = _flat(column["query_name"])
    cigars = column["cigar"].fill_null("*").dictionary_encode()
    parsed = [_steps(c) for c in cigars.dictionary.to_pylist()]
    which = cigars.indices.to_numpy(zero_copy_only=False)
    every = np.concatenate([np.zeros(0, "<u4"), *(p[0] for p in parsed)])
    n_of, forward = np.array([len(p[0]) for p in parsed], np.int64), np.array([p[1] for p in parsed], np.int64)
    n_steps = n_of[which]
    if n_steps.max(initial=0) > 65_535 or n_name.max(initial=0) > 254:
        raise ValueError("a name or a cigar is longer than the format holds")
    steps = every[ranges((np.cumsum(n_of) - n_of)[which], n_steps)].view(np.uint8)
    letters, seq_at, n = _flat(column["seq"])
    n = np.where(pc.equal(column["seq"], "*").fill_null(False).to_numpy(zero_copy_only=False), 0, n)
    packed = (n + 1) // 2
    codes = np.zeros(2 * int(packed.sum()), np.uint8)
    codes[ranges(2 * (np.cumsum(packed) - packed), n)] = _CODE[letters[ranges(seq_at, n)]]
    rates, rate_at, n_rates = _flat(column["qual"])
    unrated = pc.equal(column["qual"], "*").fill_null(True).to_numpy(zero_copy_only=False)
    if (~unrated & (n_rates != n)).any():
        raise ValueError("letters and qualities differ in number")
    quals = np.full(int(n.sum()), 255, np.uint8)
    own = ~unrated
    quals[ranges((np.cumsum(n) - n)[own], n[own])] = rates[ranges(rate_at[own], n[own])] - np.uint8(33)
    listed = column["tags"]
    flat = listed.flatten().dictionary_encode()
    coded = [_tag_bytes(t) for t in flat.dictionary.to_pylist()]
    tag_of = flat.indices.to_numpy(zero_copy_only=False)
    sizes = np.array([len(c) for c in coded], np.int64)
    tags = np.frombuffer(b"".join(coded), np.uint8)[ranges((np.cumsum(sizes) - sizes)[tag_of], sizes[tag_of])]
    owner = np.repeat(np.arange(rows), pc.list_value_length(listed).fill_null(0).to_numpy(zero_copy_only=False))
    n_tags = np.bincount(owner, weights=sizes[tag_of], minlength=rows).astype(np.int64)

    end = pos + np.maximum(forward[which], 1)
    fixed = np.zeros(rows, FIXED)
    for name, values in (("ref", ref), ("pos", pos), ("n_name", n_name + 1), ("mapq", whole("mapq")), ("bin", bins(np.maximum(pos, -1), np.maximum(end, 0))), ("n_steps", n_steps), ("flag", whole("flag")),
                         ("n", n), ("mate", mate), ("mate_pos", whole("mate_pos")), ("span", whole("template_length"))):
        fixed[name] = values
    fixed["mate_pos"][column["mate_pos"].is_null().to_numpy(zero_copy_only=False)] = -1
    fixed["bin"][pos < 0] = 4680  # what the format gives a record without a place
    size = FIXED.itemsize + n_name + 1 + 4 * n_steps + packed + n + n_tags
    begin = np.cumsum(size + 4) - (size + 4)
    out = np.zeros(int((size + 4).sum()), np.uint8)
    at = begin
    parts = [
        (np.full(rows, 4), size.astype("<i4").view(np.uint8)), (np.full(rows, FIXED.itemsize), fixed.view(np.uint8)), (n_name, names[ranges(name_at, n_name)]), (np.ones(rows, np.int64), np.zeros(rows, np.uint8)),
        (4 * n_steps, steps), (packed, codes[::2] << 4 | codes[1::2]), (n, quals), (n_tags, tags),
    ]
    for length, data in parts:
        out[ranges(at, length)] = data
        at = at + length
    return out.tobytes(), begin, ref, pos, end


class Index:
    """The index of a sorted file while it is written: chunks of each bin, first records of windows of 16,384 places."""

    LONGEST = 1 << 29

    def __init__(self, n_refs: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(n_refs)]
        self.windows: list[dict[int, int]] = [{} for _ in range(n_refs)]
        self.unplaced, self.fits = 0, True

    def add(self, ref: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, after: np.ndarray) -> None:
        """Records in order with the virtual offsets of their begins and ends."""
        placed = ref >= 0
        self.unplaced += int((~placed).sum())
        ref, begin, end, first, after = (x[placed] for x in (ref, begin, end, first, after))
        if not len(ref) or end.max() > self.LONGEST:
            self.fits &= not len(ref)
            return
        own = bins(begin, end)
        cut = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (ref[1:] != ref[:-1])))
        last = np.append(cut[1:], len(own)) - 1
        for r, b, low, high in zip(ref[cut].tolist(), own[cut].tolist(), first[cut].tolist(), after[last].tolist(), strict=True):
            held = self.bins[r].setdefault(b, [])
            if held and held[-1][1] >> 16 >= low >> 16:  # what meets in one block is one chunk
                held[-1][1] = high
            else:
                held.append([low, high])
        many = (end - 1 >> 14) - (begin >> 14) + 1
        window, who = ranges(begin >> 14, many), np.repeat(np.arange(len(ref)), many)
        keys, at = np.unique(np.stack([ref[who], window], 1), axis=0, return_index=True)
        for (r, w), k in zip(keys.tolist(), at.tolist(), strict=True):
            self.windows[r].setdefault(w, int(first[who[k]]))

    def written(self) -> bytes:
        out = [b"BAI\1", struct.pack("<i", len(self.bins))]
        for found, windows in zip(self.bins, self.windows, strict=True):
            out.append(struct.pack("<i", len(found)))
            for b, chunks in sorted(found.items()):
                out += [struct.pack("<Ii", b, len(chunks)), *(struct.pack("<QQ", *c) for c in chunks)]
            n, line, before = max(windows, default=-1) + 1, [], 0
            for w in range(n):
                before = windows.get(w, before)
                line.append(before)
            out += [struct.pack("<i", n), struct.pack(f"<{n}Q", *line)]
        return b"".join([*out, struct.pack("<Q", self.unplaced)])


def chunks_of(index: bytes, ref: int, begin: int, end: int) -> list[tuple[int, int]]:
    """Virtual offsets between which records of [begin, end) of a reference lie, in order, meeting chunks joined."""
    if index[:4] != b"BAI\1":
        raise ValueError("not an index of a BAM file")
    at = 8
    wanted = {0}
    end = min(end, Index.LONGEST)
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        wanted.update(range(first + (begin >> shift), first + (max(end - 1, begin) >> shift) + 1))
    for r in range(struct.unpack_from("<i", index, 4)[0]):
        found = []
        (n_bins,) = struct.unpack_from("<i", index, at)
        at += 4
        for _ in range(n_bins):
            b, n = struct.unpack_from("<Ii", index, at)
            if r == ref and b in wanted:
                found += [struct.unpack_from("<QQ", index, at + 8 + 16 * k) for k in range(n)]
            at += 8 + 16 * n
        (n,) = struct.unpack_from("<i", index, at)
        if r == ref:
            line = struct.unpack_from(f"<{n}Q", index, at + 4)
            least = line[min(begin >> 14, n - 1)] if n else 0
            out: list[tuple[int, int]] = []
            for low, high in sorted((max(low, least), high) for low, high in found if high > least):
                if out and low <= out[-1][1]:
                    out[-1] = (out[-1][0], max(high, out[-1][1]))
                else:
                    out.append((low, high))
            return out
        at += 4 + 8 * n
    return []
