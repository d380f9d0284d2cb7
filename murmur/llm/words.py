"""Words and shingles of whole Arrow batches as hashes, without a Python loop over words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from murmur.llm.common import ship

ship(__name__)

# Odd multipliers.
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
# Longer strings are hashed one by one.
LONG = 1024
SHINGLE = 5
# Texts of a batch are hashed together up to about this many bytes; a longer text alone.
# Some eighty bytes are needed for each, and small arrays stay in the processor's cache.
GROUP_BYTES = 1 << 19

def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of splitmix64, a bijection)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = np.concatenate([(np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)) - np.uint64(1), [~np.uint64(0)]])


def eights(body: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; past the end there are zeros."""
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    return np.ndarray((len(body) + 1,), "<u8", padded, strides=(1,))


def string_hashes(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray, words=None) -> np.ndarray:
    """A 64-bit hash of each of the strings: its length, then eight bytes after eight, each
    mixed with all before. Strings of up to eight bytes never share one with another of
    their length. `words` spares the making of `eights(body)`."""
    words = eights(body) if words is None else words
    out = mixed(sizes.astype(np.uint64))
    short = sizes <= LONG
    open_ = np.flatnonzero(short) if not short.all() else np.arange(len(sizes))
    at = 0
    while len(open_):
        left = sizes[open_] - at
        x = words[starts[open_] + at] & _BYTES[np.minimum(left, 8)]
        out[open_] = mixed((out[open_] ^ x) * BASE + STEP)
        at += 8
        open_ = open_[left > 8]
    for i in np.flatnonzero(~short).tolist():
        whole = body[starts[i] : starts[i] + sizes[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little")
    return out


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and the n + 1 offsets; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if texts.offset or not len(texts):
        texts = pa.concat_arrays([texts, pa.array([], pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, most: int = GROUP_BYTES):
    """Ranges of texts of about `most` bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def slices(batches, rows: int = 1000):
    """The batches in parts, so that what is made of them at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lower(body: np.ndarray) -> np.ndarray:
    return np.where((body >= 65) & (body <= 90), body | np.uint8(32), body)


def is_space(body: np.ndarray) -> np.ndarray:
    return (body == 32) | ((body >= 9) & (body <= 13))


def word_hashes(body: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()):
    """(hash of each word, start byte, end byte, number of words of each text).

    With `prefixes`, also a hash for each of these numbers of first bytes, a fifth item:
    one array per number, of all words; it is the word's own hash where the word is shorter.

    A word is a longest run without ASCII white space inside one text. Equal words hash
    alike wherever they are.
    """
    if not len(body):
        none = np.zeros(0, np.int64)
        parts = (none.astype(np.uint64), none, none, np.zeros(len(offsets) - 1, np.int64))
        return (*parts, [none.astype(np.uint64)] * len(prefixes)) if prefixes else parts
    word = ~is_space(body)
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    words = eights(body)

    def hashed(upto: np.ndarray) -> np.ndarray:
        return string_hashes(body, starts, upto - starts, words)

    parts = hashed(ends), starts, ends, np.diff(np.searchsorted(starts, offsets))
    if not prefixes:
        return parts
    return (*parts, [hashed(np.minimum(starts + k, ends)) for k in prefixes])


def shingle_sets(texts: pa.Array, size: int = SHINGLE):
    """Yields the sorted distinct shingle hashes of each text, in order.

    A-Z count as a-z. A text with fewer than `size` words has its whole sequence as one
    shingle, and none without words.
    """
    whole, where = utf8(texts)
    for first, last in groups(where):
        offsets = where[first : last + 1] - where[first]
        body = lower(whole[where[first] : where[last]])
        hashes, _, _, counts = word_hashes(body, offsets)
        begins = np.concatenate([[0], np.cumsum(counts)])
        rolled = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
        for k in range(size):
            rolled += hashes[k : k + len(rolled)] * np.uint64(2 * k + 3) * BASE
            rolled = mixed(rolled)
        for i in range(last - first):
            n, at = int(counts[i]), int(begins[i])
            if n >= size:
                yield np.unique(rolled[at : at + n - size + 1])
            elif n:
                short = np.full(1, n, np.uint64)
                for h in hashes[at : at + n]:
                    short = mixed((short ^ h) * BASE)
                yield short
            else:
                yield np.zeros(0, np.uint64)
