"""SentencePiece encoding of merge-type models by backtracking, and decoding."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from murmur.llm.common import lean, ship, worker_store
from murmur.llm.units import Memory

ship(__name__)

BLANK = "▁"
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
# Words (about 60 bytes each) and pairs (about 120) remembered by a worker; when full, they are
# emptied and filled anew. Workers outlive the stage, so this adds to what other stages need.
REMEMBERED, REMEMBERED_PAIRS = 400_000, 1 << 17
BATCH_ROWS = 500
# Texts of about so many letters are looked up together.
GROUP_LETTERS = 1 << 16
# Words of more bytes are worked out anew each time, so that what is kept stays small.
KEPT_BYTES = 100


class Pieces:
    """Exact encoder of one model.

    A text is normalised by the library, and cut before each blank that follows another
    character and around characters the vocabulary lacks: no piece crosses such a place
    (checked when the model is loaded). Each distinct word is then encoded by backtracking:
    take the longest piece that starts here (one Aho-Corasick automaton of all pieces); it
    may follow the piece before only if merging the two anew gives just these two; else
    try the next shorter piece, and if there is none, mark this place as failed in a
    bitfield, take back the last piece and go on with a shorter one for it.

    Merging anew is the model's own rule: of all neighbours whose join is a piece, the one
    of the best score, the leftmost of equals, is joined first. A piece that its own text
    does not merge back to is never used, as the rule cannot make it.
    """

    @classmethod
    def of(cls, path: str) -> "Pieces":
        held = worker_store()
        if ("pieces", path) not in held:
            held["pieces", path] = cls(path)
        return held["pieces", path]

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        for i in range(n):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)):
                self.score[piece] = self.library.get_score(i)
                self.ids[piece] = i
        self.unknown = self.library.unk_id()
        self.cuts_before_blank = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids)
        usable = [p for p in self.ids if self.merged(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for p in usable:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.reach = max(map(len, usable), default=1)
        made = set(usable)
        # The next shorter piece that starts in the same place.
        self.shorter = {
            p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in made), None) for p in usable
        }
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memory = Memory()
        known = {p for p in self.ids if len(p) == 1}
        self.lacking = re.compile("([^" + "".join(re.escape(c) for c in sorted(known)) + "])")
        self.line_feed = "\n" not in known

    def merged(self, text: str) -> list[str]:
        """The pieces of `text` by merging neighbours, best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether merging both anew leaves them as they are."""
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            found = self.pairs[pair] = self.merged(left + right) == [left, right]
        return found

    def longest(self, word: str, at: int) -> str:
        """The longest piece that starts at `at`; single characters are all pieces here."""
        return next(self.automaton.iter_long(word[at : at + self.reach]))[1]

    def backtracked(self, word: str) -> list[str]:
        """The one sequence of pieces of `word` whose neighbours all fit."""
        out: list[str] = []
        failed = bytearray((len(word) >> 3) + 1)  # bit i: place i has failed
        at, piece = 0, self.longest(word, 0)
        while piece is not None:
            end = at + len(piece)
            if not failed[end >> 3] >> (end & 7) & 1 and (not out or self.fits(out[-1], piece)):
                out.append(piece)
                at = end
                piece = self.longest(word, at) if at < len(word) else None
                continue
            shorter = self.shorter[piece]
            while shorter is None:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                shorter = self.shorter[piece]
            piece = shorter
        return out

    def word_ids(self, word: str) -> bytes:
        """Ids of a word without blanks inside, as little-endian 32-bit integers."""
        ids: list[int] = []
        for part in self.lacking.split(word):
            if not part:
                continue
            if len(part) == 1 and part not in self.ids:
                spelled = [self.bytes.get(b) for b in part.encode("utf-8")]
                ids += [self.unknown] if None in spelled else spelled
            else:
                ids += [self.ids[p] for p in self.backtracked(part)]
        return np.array(ids, "<u4").tobytes()

    @property
    def words(self) -> list[str]:
        """The words that are remembered."""
        cuts = self.memory.body_begins[: self.memory.count + 1].tolist()
        body = self.memory.body.tobytes()
        return [body[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:])]

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids = [self.word_ids(w.decode()) for w in words]
        sizes = np.array([len(i) // 4 for i in ids], np.int64)
        self.memory.add(hashes, np.frombuffer(b"".join(ids), "<u4"), sizes, words)

    def cut(self, text: str) -> list[bytes]:
        """Words of a text."""
        quick = self.quick(text)
        if quick is not None:
            return quick
        text = self.library.normalize(text)
        if not self.cuts_before_blank:
            return [text.encode()] if text else []
        return [w.encode() for w in re.split(f"(?<=[^{BLANK}])(?={BLANK})", text) if w]

    def ids_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        held = sizes <= KEPT_BYTES
        counts = np.zeros(len(words), np.int64)
        ids = np.zeros(0, np.uint32)
        if held.any():
            short = words if held.all() else [w for w in words if len(w) <= KEPT_BYTES]
            ends = np.cumsum(sizes[held])
            body = np.frombuffer(b"".join(short), np.uint8)
            ids, n, same = self.memory.lookup(body, ends - sizes[held], ends, self.learn)
            ids = ids[np.repeat(same, n)]
            counts[held] = np.where(same, n, 0)
            held[held] = same
        if held.all():
            return ids, counts
        # Long words, and those whose hash is another word's.
        apart = {i: np.frombuffer(self.word_ids(words[i].decode()), "<u4") for i in np.flatnonzero(~held).tolist()}
        counts[list(apart)] = [len(a) for a in apart.values()]
        ends = np.cumsum(counts)
        out = np.zeros(ends[-1], np.uint32)
        out[np.repeat(held, counts)] = ids
        for i, a in apart.items():
            out[ends[i] - len(a) : ends[i]] = a
        return out, counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end id, as little-endian 32-bit integers."""
        begin = np.array([self.library.bos_id()], "<u4").tobytes()
        end = np.array([self.library.eos_id()], "<u4").tobytes()
        out: list[bytes] = []
        while len(out) < len(texts):
            if self.memory.count > REMEMBERED:
                self.memory.clear()
            if len(self.pairs) > REMEMBERED_PAIRS:
                self.pairs.clear()
            words, upto, letters = [], [0], 0
            while letters < GROUP_LETTERS and len(out) + len(upto) <= len(texts):
                text = texts[len(out) + len(upto) - 1]
                letters += len(text)
                words += self.cut(text)
                upto.append(len(words))
            ids, counts = self.ids_of(words)
            cuts = (4 * np.append(0, np.cumsum(counts))[upto]).tolist()
            data = ids.astype("<u4").tobytes()
            out += [begin + data[a:b] + end for a, b in zip(cuts[:-1], cuts[1:])]
        return out

    def quick(self, text: str) -> list[bytes] | None:
        """The words of a plain text, or None where blanks or marks need a closer look.

        Plain: what the library's normaliser does to it is to put a blank in front and
        write blanks as marks. Line feeds, which the vocabulary lacks, stand apart.
        """
        if not self.plain or "  " in text or BLANK in text or text[:1] in ("", " ") or text[-1:] == " ":
            return None
        marked = (" " + text).replace(" ", f"\x00{BLANK}")
        if "\n" in text and self.line_feed:
            marked = marked.replace("\n", "\x00\n\x00")
        if marked.count("\x00") != text.count(" ") + 1 + 2 * text.count("\n") * self.line_feed:
            return None  # the text holds the mark itself
        return [w for w in marked.encode().split(b"\x00") if w]

    @property
    def plain(self) -> bool:
        """Whether the normaliser changes nothing but blanks, tried on a sample of characters."""
        if "_plain" not in self.__dict__:
            odd = "aB1éﬁΩＡ 　\t\n\r​́é中½\U0001f600"
            want = BLANK + odd.replace(" ", BLANK)
            self._plain = self.cuts_before_blank and self.library.normalize(odd) == want
        return self._plain

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([i.tolist() for i in ids], num_threads=1)


def _digest(path: str):
    def run(batches):
        pieces = Pieces.of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                few = batch.slice(at, BATCH_ROWS)
                coded = pieces.encode([t or "" for t in few.column("text").to_pylist()])
                texts = pieces.decode([np.frombuffer(c, "<u4") for c in coded])
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column("doc_id").cast(pa.int64()),
                        pa.array([len(c) // 4 for c in coded], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def _encoder(path: str, name: str):
    def run(batches):
        pieces = Pieces.of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                few = batch.slice(at, BATCH_ROWS)
                coded = pieces.encode([t or "" for t in few.column("text").to_pylist()])
                ids = pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in coded], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*few.columns, ids], [*few.schema.names, name])

    return run


def encode_pieces(documents: DataFrame, model_path: str, name: str = "ids") -> DataFrame:
    """The documents with their piece ids (begin and end ids included) in column `name`.

    Rows stay where they are. Null text counts as empty: the begin and the end id only.
    """
    keep = documents.drop(name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema)
    return keep.mapInArrow(lean(_encoder(model_path, name)), f"{schema}, `{name}` array<int>")


def piece_digest(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: whole texts encoded, then decoded.

    One narrow step. Null text counts as empty, equal rows give equal rows, other columns
    are not read.
    """
    return documents.select("doc_id", "text").mapInArrow(
        lean(_digest(model_path)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
