"""Byte-pair encoding by dynamic programming over prefixes.

The encoding of every prefix of a word has one last token. Going through a word, an automaton
over the vocabulary (suffix links included) gives all tokens that end at each place, longest
first; the last token of the prefix is the one that may follow the last token of the prefix
before it. Two tokens may stand side by side if merging their characters gives just the two
again. Following the last tokens back from the end gives the ids of the word.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Sequence
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from cellweave.llm.batches import map_texts

VOCABULARY = "word_bpe_49k.json"
#: Stands for the end of a word inside tokens; no byte is written as this character.
_END = "\ue000"
#: White space of the pattern language of the vocabulary's file: Unicode's, without 1C to 1F.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACES = re.compile(f"[{_SPACE}]+")
#: Entries of each memo before it is emptied; the entries before that are kept for one more turn.
MEMO = 250_000
_NEVER = 1 << 60


class Memo(dict):
    """A bounded memo of two generations."""

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}

    def keep(self, key, value):
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes texts as the vocabulary's own library does; holds only memos as state."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""

        def marked(token: str) -> str:
            return token[: -len(suffix)] + _END if suffix and token.endswith(suffix) else token

        self.text = {i: t for t, i in model["vocab"].items()}
        self.ids = {marked(t): i for t, i in model["vocab"].items()}
        self.token = {i: t for t, i in self.ids.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: Pair of ids -> when it is merged, and into which id.
        self.merge = {(self.ids[a := marked(x)], self.ids[b := marked(y)]): (r, self.ids[a + b]) for r, (x, y) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.text |= {i: t for t, i in self.added.items()}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", _SPACE))
        self.byte = _byte_characters()
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, (i, len(token)))
        self.automaton.make_automaton()
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.pair_memo, self.word_memo, self.chunk_memo = Memo(), Memo(), Memo()

    # -- words

    def edge(self, token: int) -> tuple[list, list] | None:
        """How the token's first and last symbols grow while its characters are merged.

        Two lists of (when, symbol), ending in the token itself; None for a token whose
        characters are merged into anything else.
        """
        if token in self.edges:
            return self.edges[token]
        text = self.token[token]
        parts = [*text[:-2], text[-2:]] if text.endswith(_END) and len(text) > 1 else [*text]
        symbols = [self.ids[x] for x in parts]
        first, last = [(-1, symbols[0])], [(-1, symbols[-1])]
        while len(symbols) > 1:
            when, at = min((self.merge.get(pair, (_NEVER, 0))[0], i) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)))
            if when == _NEVER:
                break
            made = self.merge[symbols[at], symbols[at + 1]][1]
            if at == 0:
                first.append((when, made))
            if at == len(symbols) - 2:
                last.append((when, made))
            symbols[at : at + 2] = [made]
        self.edges[token] = (first, last) if symbols == [token] else None
        return self.edges[token]

    def together(self, left: int, right: int) -> bool:
        """Whether merging the characters of both tokens gives just the two tokens.

        It does unless, at some time, the last symbol inside the left one and the first inside
        the right one would be merged before either grows. Of equal pairs the leftmost is
        merged first, so growth of the left symbol goes before, growth of the right one after.
        """
        grown_left, grown_right = self.edge(left), self.edge(right)
        if grown_left is None or grown_right is None:
            return False
        ends, starts = grown_left[1], grown_right[0]
        i = j = 0
        while True:
            next_left = ends[i + 1][0] if i + 1 < len(ends) else _NEVER
            next_right = starts[j + 1][0] if j + 1 < len(starts) else _NEVER
            when = self.merge.get((ends[i][1], starts[j][1]), (_NEVER, 0))[0]
            if when < _NEVER and when < next_left and when <= next_right:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word in byte characters."""
        n = len(word)
        last, size_of = [-1] * (n + 2), [0] * (n + 2)
        pairs, old = self.pair_memo, self.pair_memo.old
        for at, (token, size) in self.automaton.iter(word + _END):  # longest first at each place
            end = at + 1
            if last[end] >= 0 or end == n:  # the last character and the end mark are one symbol
                continue
            start = end - size
            if start == 0:
                fits = self.edge(token) is not None
            elif last[start] < 0:
                fits = False
            else:
                key = last[start] << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = old.get(key)
                    fits = pairs.keep(key, self.together(last[start], token) if fits is None else fits)
            if fits:
                last[end], size_of[end] = token, size
        out: list[int] = []
        at = n + 1
        while at > 0:
            if last[at] < 0:
                raise ValueError(f"no token of the vocabulary ends at place {at} of {word!r}")
            out.append(last[at])
            at -= size_of[at]
        return tuple(out[::-1])

    # -- texts

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of normalised characters without white space."""
        memo, out = self.word_memo, ()
        for word in self.words.findall(chunk):
            ids = memo.get(word)
            if ids is None:
                ids = memo.old.get(word)
                if ids is None:
                    ids = self.word("".join([self.byte[b] for b in word.encode("utf-8", "surrogatepass")]))
                if len(word) <= 64:
                    memo.keep(word, ids)
            out += ids
        return out

    def plain(self, text: str) -> list[int]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")  # lower case by character: no final sigma
        text = text.lower()
        parts = _SPACES.split(text) if _ODD_SPACE.search(text) else text.split()
        out: list[int] = []
        memo = self.chunk_memo
        for part in parts:
            ids = memo.get(part)
            if ids is None:
                ids = memo.old.get(part)
                if ids is None:
                    ids = self.chunk(part)
                if len(part) <= 64:
                    memo.keep(part, ids)
            out += ids
        return out

    def encode(self, text: str) -> list[int]:
        if self.split_added is None or "<" not in text:
            return self.plain(text)
        out: list[int] = []
        for i, part in enumerate(self.split_added.split(text)):
            out += [self.added[part]] if i % 2 else self.plain(part)
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The vocabulary has no decoder of its own: tokens are set side by side with spaces."""
        return " ".join(map(self.text.__getitem__, ids))


def encode(docs: DataFrame, path: str | Callable[[], str] | None = None, keep: list[str] | None = None, outputs: bool = False) -> DataFrame:
    """Encode every whole text (null: empty) and decode it again.

    Returns ``keep`` columns (all, if None), the count of ids, digests of ids and decoded text,
    and with ``outputs`` the ids and the decoded text themselves. Repeated rows get repeated
    results; very long texts are encoded whole; an empty table gives no rows. A worker's memos
    are emptied at ``MEMO`` entries, whatever the input. The result's columns must not be among
    ``keep``.
    """
    held: list[Encoder] = []

    def run(texts: list[str | None]) -> dict[str, list]:
        if not held:
            place = path() if callable(path) else path
            if place is None:
                import public_tokenizers

                place = public_tokenizers.path(VOCABULARY)
            held.append(Encoder(place))
        coder = held[0]
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
        for text in texts:
            ids = coder.encode(text or "")
            decoded = coder.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(sha256(np.array(ids, "<u4").tobytes()).hexdigest())
            out["decoded_sha256"].append(sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            if outputs:
                out["ids"].append(ids)
                out["decoded"].append(decoded)
        return out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * outputs
    return map_texts(docs, "text", run, schema, keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
