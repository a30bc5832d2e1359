"""Packing documents into training sequences by the sum-of-squares rule.

Each task packs the documents of its partition as they come. The level array counts the open
windows by fill; a document's end piece goes into the level that makes the sum of the squared
counts least (an empty window is level 0), which keeps windows of all fills at hand. Pieces of
full length go out at once. Where too many windows are open, and at the end, open windows are
joined by cutting pieces; the rest of a partition goes out in sequences whose lengths are powers
of two, which need no padding.
"""

import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import prepare, text_pieces

CAPACITY = 4096
END_ID = 2
#: Open windows of a task, which bounds its memory to 16 MB of ids.
MAX_OPEN = 1024
#: Pieces of words whose ids a worker remembers.
CACHED_PIECES = 800_000
#: Texts are taken in stretches of about so many characters.
STRETCH = 1 << 20
#: Sequences are numbered from this multiple of the partition's number.
PARTITION_STEP = 1 << 33

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_length long, ids binary"

# How the tokenizer file cuts text. Where a file says just this, a text of plain
# letters and signs can be cut here and only its pieces need the tokenizer's merges.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PLAIN = "!-~¡-¬®-ˁ"
_plain_text = re.compile(f"[{_PLAIN} \t\n\x0b\f\r]*").fullmatch
_words = re.compile(r"[^ \t\n\x0b\f\r]+").findall
_SPACE = re.compile(r"[ \t\n\x0b\f\r]")


def _cut_plain():
    """``_CUTS`` for lower-cased plain text; the letters come first, as nothing else begins with one."""
    plain = filter(re.compile(f"[{_PLAIN}]").match, map(chr, range(0x2C2)))
    lower = sorted({c for p in plain for c in p.lower()})
    letters, numbers = ("".join(c for c in lower if unicodedata.category(c)[0] == kind) for kind in "LN")
    return re.compile(rf"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^\s{letters}{numbers}]+").findall


class _Remembered(dict):
    """A dict that makes what is missing and starts anew when it is full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHED_PIECES:
            self.clear()
        self[key] = made = self.make(key)
        return made


class Encoder:
    """Token ids of texts, as little-endian 32-bit numbers, the same as the tokenizer's own.

    The tokenizer merges inside the pieces only into which it cuts a text, so each distinct
    piece is encoded once and remembered. Texts of plain letters and signs are cut here; they
    skip the normaliser, which leaves them as they are but for case. Words with other
    characters, and those that spell a special token, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            facts = json.load(file)
        normalizer, pre = facts.get("normalizer") or {}, facts.get("pre_tokenizer") or {}
        cuts = (pre.get("pretokenizers") or [{}])[0]
        if [n["type"] for n in normalizer.get("normalizers", [])] != _NORMALIZERS or cuts.get("pattern", {}).get("Regex") != _CUTS:
            raise ValueError(f"{path}: this tokenizer does not cut at white space as the packing relies on")
        specials = [t["content"] for t in facts.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)").search
        self.cut = _cut_plain()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = _Remembered(lambda c: level.pre_tokenize_str(c)[0][0])
        self.merge = self.tokenizer.model.tokenize
        self.pieces = _Remembered(self._piece)
        self.words = _Remembered(self._word)

    def _piece(self, piece: str) -> bytes:
        # The printable ASCII characters stand for their own bytes.
        tokens = self.merge(piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece)))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(text.lower())))

    def _word(self, word: str) -> bytes:
        if _plain_text(word) and not self.special(word):
            return self._plain(word)
        ids = self.tokenizer.encode(word.encode("utf-8", "surrogatepass").decode("utf-8", "replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text, taken stretch by stretch; cuts fall on white space only."""
        out, start, text = [], 0, text or ""
        while start < len(text):
            space = _SPACE.search(text, start + STRETCH)
            end = space.start() if space else len(text)
            stretch = text[start:end]
            if _plain_text(stretch) and not self.special(stretch):
                out.append(self._plain(stretch))
            else:
                out.append(b"".join(map(self.words.__getitem__, _words(stretch))))
            start = end
        return b"".join(out)


_encoders = _Remembered(Encoder)


class Packer:
    """Windows of one task. ``add`` and ``finish`` return rows of ``PIECES`` for windows that are done.

    A piece is (document id, start, ids, tokens of the document).
    """

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, max_open: int = MAX_OPEN):
        self.capacity, self.max_open = capacity, max_open
        self.next_sequence = first_sequence
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def add(self, doc_id, ids: bytes) -> list[tuple]:
        total = len(ids) // 4
        rows, start = [], 0
        while total - start >= self.capacity:
            rows += self._close([(doc_id, start, ids[4 * start : 4 * (start + self.capacity)], total)])
            start += self.capacity
        if start < total:
            rows += self._place((doc_id, start, ids[4 * start :], total))
        if self.n_open > self.max_open:
            done, rest = self._join()
            rows += done
            if rest:
                self._put(rest, sum(len(p[2]) for p in rest) // 4)
        return rows

    def level(self, size: int) -> int:
        """The fill to put ``size`` tokens on: least sum of squares, then the fullest."""
        last = self.capacity - size
        here = self.counts[: last + 1]
        change = 2 * self.counts[size : self.capacity + 1] + 1
        change[last] = 0  # a full window is not open any more
        change = change + 1 - 2 * here
        change[here == 0] = np.iinfo(np.int64).max
        change[0] = 2 * self.counts[size] + 1 if last else 0
        return last - int(np.argmin(change[::-1]))

    def _place(self, piece) -> list[tuple]:
        size = len(piece[2]) // 4
        level = self.level(size)
        window = []
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        window.append(piece)
        if level + size == self.capacity:
            return self._close(window)
        self._put(window, level + size)
        return []

    def _put(self, window, level):
        self.open.setdefault(level, []).append(window)
        self.counts[level] += 1
        self.n_open += 1

    def _close(self, window) -> list[tuple]:
        rows, offset, length = [], 0, sum(len(p[2]) for p in window) // 4
        for doc_id, start, ids, total in window:
            size = len(ids) // 4
            rows.append((doc_id, start, size, total, self.next_sequence, offset, length, ids))
            offset += size
        self.next_sequence += 1
        return rows

    def _join(self) -> tuple[list[tuple], list]:
        """All open windows end to end, cut into full ones; and what is left over."""
        stream = [p for level in sorted(self.open, reverse=True) for window in self.open[level] for p in window]
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        rows, window, room = [], [], self.capacity
        for piece in stream:
            while piece:
                part, piece = _cut(piece, room)
                window.append(part)
                room -= len(part[2]) // 4
                if not room:
                    rows += self._close(window)
                    window, room = [], self.capacity
        return rows, window

    def finish(self) -> list[tuple]:
        rows, rest = self._join()
        while rest:
            left = sum(len(p[2]) for p in rest) // 4
            room, window = 1 << (left.bit_length() - 1), []
            while room:
                part, after = _cut(rest[0], room)
                window.append(part)
                room -= len(part[2]) // 4
                rest = ([after] if after else []) + rest[1:]
            rows += self._close(window)
        return rows


def _cut(piece, room):
    doc_id, start, ids, total = piece
    if len(ids) <= 4 * room:
        return piece, None
    return (doc_id, start, ids[: 4 * room], total), (doc_id, start + room, ids[4 * room :], total)


def pack(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, sequence_length, ids``.

    A document is its token ids and then ``end_id``; each id lies in exactly one piece.
    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers, ``start`` its place
    in the document, ``offset`` its place in the sequence, gapless from 0. Sequences have at
    most ``capacity`` tokens; a sequence shorter than that has a power of two, and needs no
    padding. ``tokenizer`` is the path of a tokenizer file that every executor has.

    A null or empty text is ``end_id`` alone. Repeated rows and null ids are documents like
    any other. Other columns are not read. No rows: no sequences. A task packs the rows of
    its partition, so nothing is shuffled; give it a stored table, so that a task that runs
    again sees the same rows in the same order.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [f.split()[0] for f in PIECES.split(", ")]

    def table(found):
        kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders[tokenizer]
        packer = Packer(TaskContext.get().partitionId() * PARTITION_STEP, capacity)
        for batch, texts in text_pieces(batches, "text"):
            found = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                found += packer.add(doc_id, encoder.encode(text) + end)
            if found:
                yield table(found)
        if found := packer.finish():
            yield table(found)

    return rows.mapInArrow(run, PIECES)
