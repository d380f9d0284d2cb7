"""Byte-level BPE of many texts, each distinct piece of text encoded once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from murmur.llm.common import ship, worker_store
from murmur.llm.words import eights, groups, string_hashes, utf8

ship(__name__)

# White space next to white space, or at either end of the text.
ODD_SPACE = re.compile(r"\s\s|^\s|\s$")
# Pieces remembered by a worker (about 40 bytes each) and bytes of them; when either is
# full, it starts anew.
REMEMBERED = 3_000_000
REMEMBERED_BYTES = 64 << 20
# Distinct pieces put into one call of the library, a line each.
LINES = 64
BLANK, LINE_FEED = 32, 10


class Memory:
    """Ids of pieces by 64-bit hash, in sorted arrays, with the bytes of each piece.

    New pieces go to a small array, which is merged into a larger one when it is full. Of
    pieces with one hash the first is held; `same` tells whether it is the one asked for.
    """

    STEPS = (1 << 14, 1 << 18)

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64)
        self.levels = [(none, np.zeros(0, np.int64)) for _ in range(len(self.STEPS) + 1)]
        self.tokens = np.zeros(1 << 16, np.uint32)
        self.used = 0
        # By number of entry: where its ids begin, and after the last where they end.
        self.begins = np.zeros(1 << 16, np.int64)
        self.count = 0
        # The bytes of all entries, eight zeros after them, and where each begins.
        self.body = np.zeros(1 << 16, np.uint8)
        self.body_used = 0
        self.body_begins = np.zeros(1 << 16, np.int64)

    def same(self, entry: np.ndarray, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the strings (`words`: all places of their text by eight bytes) are the entries'."""
        begins = self.body_begins[entry]
        out = self.body_begins[entry + 1] - begins == sizes
        known = np.ndarray((self.body_used + 1,), "<u8", self.body, strides=(1,))
        open_, at = np.flatnonzero(out), 0
        while len(open_):
            left = sizes[open_] - at
            mask = MASKS[np.minimum(left, 8)]
            like = ((words[starts[open_] + at] ^ known[begins[open_] + at]) & mask) == 0
            out[open_[~like]] = False
            open_ = open_[like & (left > 8)]
            at += 8
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the entry of each hash, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int64)
        for known, entry in self.levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                out[hit] = entry[at[hit]]
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, pieces: list[bytes]) -> None:
        body = np.frombuffer(b"".join(pieces), np.uint8)
        self.body = _room(self.body, self.body_used + len(body) + 8)
        self.body[self.body_used : self.body_used + len(body)] = body
        self.body_begins = _room(self.body_begins, self.count + len(sizes) + 1)
        ends = self.body_used + np.cumsum([len(p) for p in pieces])
        self.body_begins[self.count + 1 : self.count + len(sizes) + 1] = ends
        self.body_used += len(body)
        self.tokens = _room(self.tokens, self.used + len(ids))
        self.tokens[self.used : self.used + len(ids)] = ids
        self.begins = _room(self.begins, self.count + len(sizes) + 1)
        ends = self.used + np.cumsum(sizes)
        self.begins[self.count + 1 : self.count + len(sizes) + 1] = ends
        self.used += len(ids)
        fresh = (hashes, np.arange(self.count, self.count + len(hashes)))
        self.count += len(hashes)
        for level, (known, entry) in enumerate(self.levels):
            keys = np.concatenate([known, fresh[0]])
            order = np.argsort(keys, kind="stable")
            fresh = (keys[order], np.concatenate([entry, fresh[1]])[order])
            if level == len(self.STEPS) or len(keys) <= self.STEPS[level]:
                self.levels[level] = fresh
                break
            self.levels[level] = (keys[:0], entry[:0])

    def lookup(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, learn):
        """(ids, number of ids of each string, whether it is the one held by its hash) of the
        strings of `body`. Those not held go to `learn` (hashes, strings), which adds them."""
        words = eights(body)
        hashes = string_hashes(body, starts, ends - starts, words)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        entry = self.find(distinct)
        fresh = np.flatnonzero(entry < 0)
        if len(fresh):
            raw = body.tobytes()
            at = first[fresh]
            learn(distinct[fresh], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            entry[fresh] = self.find(distinct[fresh])
        of_string = entry[back]
        begin = self.begins[of_string]
        size = self.begins[of_string + 1] - begin
        done = np.cumsum(size)
        place = np.repeat(begin - (done - size), size) + np.arange(done[-1])
        return self.tokens[place], size, self.same(of_string, words, starts, ends - starts)


# The first 0 to 8 bytes of a number.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


class ByteBpe:
    """Byte-level BPE by the tokenizers library.

    The pattern that cuts a text before merging lets a blank only start a piece, and a
    line feed between two other characters stand alone. So the ids of a text are those
    of the pieces between such places, one after another, and a piece that has been seen
    is looked up by its hash and compared byte by byte. Texts with other white space, and those that hold an
    added token (as <|endoftext|>), which the library cuts out first, go through it whole.
    """

    @classmethod
    def of(cls, path: str) -> "ByteBpe":
        held = worker_store()
        if ("byte bpe", path) not in held:
            held["byte bpe", path] = cls(path)
        return held["byte bpe", path]

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.line_feed,) = self.library(["\n"])[0].tolist()
        self.memory = Memory()

    def library(self, texts: list[str]) -> list[np.ndarray]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(g.ids, "<u4") for g in got]

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """But for the line feed itself, pieces hold none, so the ids of many lines fall
        apart at its id."""
        feed = np.array([p == b"\n" for p in pieces])
        if feed.any():
            self.memory.add(hashes[feed], np.array([self.line_feed], np.uint32), np.array([1]), [b"\n"])
            hashes, pieces = hashes[~feed], [p for p in pieces if p != b"\n"]
        ids, sizes = [], []
        for first in range(0, len(pieces), LINES):
            lines = b"\n".join(pieces[first : first + LINES]) + b"\n"
            (found,) = self.library([lines.decode()])
            ends = np.flatnonzero(found == self.line_feed)
            sizes.append(np.diff(ends, prepend=-1) - 1)
            ids.append(found[found != self.line_feed])
        if ids:
            self.memory.add(hashes, np.concatenate(ids), np.concatenate(sizes), pieces)

    def plain(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, number of ids of each text, texts in doubt) of texts with single blanks and
        line feeds only. In doubt are those with a piece that is not the one held by its hash."""
        start = (body == BLANK) | (body == LINE_FEED)
        start[1:] |= body[:-1] == LINE_FEED
        start[offsets[:-1]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(body))
        ids, size, same = self.memory.lookup(body, starts, ends, self.learn)
        doubt = np.unique(np.searchsorted(offsets, starts[~same], side="right") - 1)
        done = np.cumsum(size)
        counts = np.diff(np.append(0, done)[np.searchsorted(starts, offsets)])
        return ids, counts, doubt

    def encode(self, texts: list[str], end: int | None = None) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, `end` after them."""
        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        whole = [
            i for i, t in enumerate(texts)
            if not t or ODD_SPACE.search(t) or any(a in t for a in self.added)
        ]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(whole, self.library([texts[i] for i in whole])):
            out[i] = ids.tobytes() + tail
        odd = set(whole)
        rest = [i for i in range(len(texts)) if i not in odd]
        if self.memory.count > REMEMBERED or self.memory.body_used > REMEMBERED_BYTES:
            self.memory.clear()
        body, offsets = utf8(pa.array([texts[i] for i in rest], pa.string()))
        for first, last in groups(offsets):
            part = offsets[first : last + 1]
            ids, counts, doubt = self.plain(body[part[0] : part[-1]], part - part[0])
            data, at = ids.astype("<u4").tobytes(), 0
            for i, n in zip(rest[first:last], (counts * 4).tolist()):
                out[i] = data[at : at + n] + tail
                at += n
            unsure = [rest[first + k] for k in doubt.tolist()]
            for i, found in zip(unsure, self.library([texts[i] for i in unsure])):
                out[i] = found.tobytes() + tail
        return out
