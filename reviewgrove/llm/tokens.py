"""Token ids of whole texts with a public tokenizer file, fast through a table of word pieces.

Both tokenizers cut a text into pieces before they merge characters, and no piece crosses the places named below.
So the ids of a text are the ids of its pieces in order. A worker remembers the ids of the chunks between spaces that it has seen,
under a 64-bit hash of their bytes and in a bounded number of bytes, so a different chunk is encoded by the library once
per worker. Texts where such places are not certain are given to the library whole, and long chunks are never remembered.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewgrove.llm.batches import mixed, process_store, slices, utf8, words

# Bytes of chunks and pieces that a worker remembers; when they are full, what was not used lately goes. Results do not
# depend on it.
TABLE_BYTES = 48 << 20
PIECES_BYTES = 16 << 20
# Chunks beyond so many bytes are encoded each time.
LONGEST_KNOWN = 256
SLICE_BYTES = 1 << 22
# Characters that the library encodes in one call.
WHOLE_AT_ONCE = 1 << 16
_SPACE = r" \t\n\r\f\v"
# White space beyond ASCII, characters that some libraries count as such, and the start of special tokens.
_UNSURE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]|<\|"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
# ASCII signs but for the apostrophe, which starts pieces such as 's.
_SIGNS = r"!-&(-/:-@\[-`{-~"


_SOLID = np.array([byte != 0x20 for byte in range(256)])
_AS_IS = np.arange(256, dtype=np.uint8)
_AT_START = np.uint64(0x5851F42D4C957F2D)
# Room of a piece beside its bytes and ids.
_PER_PIECE = 200


class Known:
    """Ids by 64-bit key: sorted keys, and for each where its ids lie in one array."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.used = np.zeros(0, bool)
        # The ids, and behind the first ``filled`` of them room for more.
        self.ids = np.zeros(0, np.uint32)
        self.filled = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of ``keys``; -1 for those that are not there."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        self.used[at[there]] = True
        return np.where(there, at, -1)

    def add(self, keys: np.ndarray, found: Sequence[bytes]) -> None:
        """Add sorted ``keys`` that are not there. What has not been used since the last cut makes room."""
        ids = np.frombuffer(b"".join(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        if self.nbytes() + 25 * len(keys) + ids.nbytes > self.limit:
            self._cut()
        at = np.searchsorted(self.keys, keys)
        self.starts = np.insert(self.starts, at, self.filled + np.cumsum(sizes) - sizes)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.used = np.insert(self.used, at, True)
        self.keys = np.insert(self.keys, at, keys)
        filled = self.filled + len(ids)
        if filled > len(self.ids):  # made longer in place
            self.ids.resize(filled + filled // 8, refcheck=False)
        self.ids[self.filled : filled] = ids
        self.filled = filled

    def nbytes(self) -> int:
        return 25 * len(self.keys) + 4 * self.filled

    def _cut(self) -> None:
        kept = np.flatnonzero(self.used)
        if 2 * len(kept) > len(self.keys):
            kept = kept[:0]
        self.ids = gathered(self.ids, self.starts[kept], self.sizes[kept])
        self.keys, self.sizes = self.keys[kept], self.sizes[kept]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.used = np.zeros(len(kept), bool)
        self.filled = len(self.ids)


def gathered(
    values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, more: np.ndarray | None = None, filled: int = 0
) -> np.ndarray:
    """The runs ``values[start : start + size]`` behind one another. ``more`` stands behind the first ``filled`` values."""
    before = np.cumsum(sizes) - sizes
    places = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
    if more is None or not len(more):
        return values[places]
    beyond = np.flatnonzero(places >= filled)
    found = more[places[beyond] - filled]
    if len(beyond) == len(places):
        return found
    places[beyond] = 0
    out = values[places]
    out[beyond] = found
    return out


def byte_level() -> dict[int, str]:
    """Bytes as the characters that byte-level models see: printable ones as they are, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(256 + n) for n, byte in enumerate(others)}


BYTE_LEVEL = byte_level()


class Encoder:
    """Encodes string arrays to token ids. ``spaced``: a space belongs to the piece behind it."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        kind = self.library.pre_tokenizer.__class__.__name__
        self.spaced = kind == "ByteLevel"
        self.folded = not self.spaced
        two_spaces = rf"[{_SPACE}] | [{_SPACE}]"
        self.unsure = f"{two_spaces}|{_UNSURE}" if self.spaced else _UNSURE
        self.pieces_of = re.compile(
            rf" ?[{_LETTERS}]+| ?[{_SIGNS}]+|\n(?=[{_LETTERS}{_SIGNS}])" if self.spaced else rf"[{_LETTERS}]+|[{_SIGNS}]+|\n"
        ).findall
        self.merge = self.library.model.tokenize
        self.pieces: dict[str, bytes] = {}
        self.pieces_bytes = 0
        self.known = Known(TABLE_BYTES)

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text straight from the library, a bounded number of characters at a time: its results take far more room than ids."""
        out, first, room = [], 0, 0
        for last, text in enumerate(texts, 1):
            room += len(text)
            if room >= WHOLE_AT_ONCE or last == len(texts):
                encoded = self.library.encode_batch_fast(list(texts[first:last]), add_special_tokens=False)
                out += [array("I", encoding.ids).tobytes() for encoding in encoded]
                first, room = last, 0
        return out

    def _merged(self, piece: str) -> bytes:
        """Ids of one certain piece from the library's merge model, which works on bytes written as characters."""
        if self.folded and piece == "\n":
            return b""
        if piece.isascii():  # behind the first character only printable ones, which stand for themselves
            written = BYTE_LEVEL.get(ord(piece[0]), piece[0]) + piece[1:]
        else:
            written = piece.encode().decode("latin-1").translate(BYTE_LEVEL)
        return array("I", [token.id for token in self.merge(written)]).tobytes()

    def _of_piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self._merged(piece)
            if len(piece) <= LONGEST_KNOWN:
                self.pieces_bytes += len(piece) + len(ids) + _PER_PIECE
                if self.pieces_bytes > PIECES_BYTES:
                    self.pieces.clear()
                    self.pieces_bytes = 0
                self.pieces[piece] = ids
        return ids

    def _of_chunks(self, chunks: Sequence[str]) -> list[bytes]:
        """Ids of different chunks of texts, cut further where that is certain."""
        out, whole = [b""] * len(chunks), []
        for i, chunk in enumerate(chunks):
            pieces = self.pieces_of(chunk)
            if sum(map(len, pieces)) != len(chunk):
                whole.append(i)
            else:
                out[i] = b"".join([self._of_piece(piece.lower() if self.folded else piece) for piece in pieces])
        for i, ids in zip(whole, self.whole([chunks[i] for i in whole])):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and how many each text has. Null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        unsure = pc.match_substring_regex(texts, self.unsure)
        if self.spaced:  # a space at the end is a piece of its own
            unsure = pc.or_(unsure, pc.ends_with(texts, " "))
        unsure = np.flatnonzero(unsure.to_numpy(zero_copy_only=False))
        apart = self.whole(texts.take(pa.array(unsure)).to_pylist()) if len(unsure) else []
        if len(unsure):
            mask = np.ones(len(texts), bool)
            mask[unsure] = False
            texts = pc.if_else(pa.array(mask), texts, pa.scalar("", pa.large_string()))
        found = words(texts, _SOLID, _AS_IS)
        keys = found.hashes
        if self.spaced:
            # The first chunk of a text has no space in front.
            at_start = found.starts == utf8(texts)[1][found.text]
            keys = np.where(at_start, mixed(keys ^ _AT_START), keys)
        keys, at, place = np.unique(keys, return_index=True, return_inverse=True)
        known = self.known.find(keys)
        new = np.flatnonzero(known < 0)
        chunks = []
        for i in at[new].tolist():
            chunk = found.data[found.starts[i] : found.ends[i]].tobytes().decode()
            chunks.append(f" {chunk}" if self.spaced and not at_start[i] else chunk)
        ids = self._of_chunks(chunks)
        # New ids count on behind the known ones, but the table is not copied for them.
        starts, sizes = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        old = np.flatnonzero(known >= 0)
        starts[old], sizes[old] = self.known.starts[known[old]], self.known.sizes[known[old]]
        sizes[new] = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts[new] = self.known.filled + np.cumsum(sizes[new]) - sizes[new]
        values = gathered(self.known.ids, starts[place], sizes[place], np.frombuffer(b"".join(ids), np.uint32), self.known.filled)
        short = [k for k, i in enumerate(at[new].tolist()) if found.ends[i] - found.starts[i] <= LONGEST_KNOWN]
        if short:
            self.known.add(keys[new[short]], [ids[k] for k in short])
        sums = np.concatenate(([0], np.cumsum(sizes[place])))
        counts = np.diff(sums[found.first])
        if len(unsure):
            counts = counts.copy()
            before = sums[found.first[unsure]]
            lengths = [len(a) // 4 for a in apart]
            values = np.insert(values, np.repeat(before, lengths), np.frombuffer(b"".join(apart), "<u4"))
            counts[unsure] = lengths
        return values, counts


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file; one per worker process."""
    store = process_store()
    key = ("encoder", path)
    if key not in store:
        store[key] = Encoder(path)
    return store[key]


def encoded(
    texts: pa.Array, path: str, end_id: int, slice_bytes: int | None = None
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of ``texts`` as (first row, last row, ids, counts), the end id behind every text."""
    coder = encoder(path)
    for first, last in slices(texts, slice_bytes or SLICE_BYTES):
        ids, counts = coder.encode(texts.slice(first, last - first))
        ends = np.cumsum(counts)
        yield first, last, np.insert(ids, ends, end_id).astype("<u4"), counts + 1
