"""Encoding texts into SentencePiece ids, and back, exactly as the sentencepiece library does.

The encoder is the backtracking form of byte-pair merging. An Aho-Corasick automaton finds the
longest piece at every position. From left to right the longest piece is taken that is compatible
with the piece before it; if none is, the piece before is taken back and made shorter. Two adjacent
pieces are compatible when merging the characters of both again gives just these two. A sequence
whose neighbours are all compatible is the sequence that merging the whole text gives. Positions
from which there is no way on are marked in a bitfield, so no position fails twice.

Null and empty texts have no ids. A character no piece holds becomes the pieces of its bytes.
"""

from __future__ import annotations

import codecs
import re
from array import array
from functools import lru_cache
from sys import getsizeof

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickloom.llm.frames import with_column_of, with_columns_of

SPACE = "▁"
# Kinds of pieces in a model file, the text of an unknown piece, the only kind of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
# Words seen before are not encoded again. These bound the memory of a worker: two generations of
# words are held, and the older one goes when the newer one takes so many bytes.
MAX_HELD, MAX_WORD_LENGTH, MAX_PAIRS = 24_000_000, 64, 300_000
ENTRY = 56  # bytes of a word's place in a dict, beside word and ids

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceDecoder:
    """Texts of ids, for a byte-pair model with byte fallback and a dummy prefix."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        norm = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if (
            proto.trainer_spec.model_type != BPE
            or not proto.trainer_spec.byte_fallback
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or proto.trainer_spec.treat_whitespace_as_suffix
            or kinds & {USER_DEFINED, UNUSED}
        ):
            raise ValueError("only merge models with byte fallback and no normalisation are read")
        self.rank: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.kind = [p.type for p in proto.pieces]
        self.surface: list[str] = []
        for i, p in enumerate(proto.pieces):
            self.surface.append(p.piece.replace(SPACE, " "))
            if p.type == NORMAL:
                self.rank[p.piece] = -p.score
                self.id_of[p.piece] = i
            elif p.type == BYTE:
                byte = int(p.piece[3:5], 16)
                self.byte_ids[byte] = i
                # The byte of an ASCII character is that character whatever is next to it.
                self.surface[i] = chr(byte) if byte < 128 else ""
            elif p.type == CONTROL:
                self.surface[i] = ""
            else:
                self.surface[i] = proto.trainer_spec.unk_surface
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.is_high_byte = np.zeros(len(proto.pieces), bool)
        self.is_high_byte[self.byte_ids[128:]] = True

    def decode(self, found: np.ndarray) -> str:
        """Text of ids. One space at the very beginning is the dummy prefix and goes."""
        surface, byte_of = self.surface, self.byte_of
        ids = found.tolist()
        if not self.is_high_byte[found].any():
            text = "".join(map(surface.__getitem__, ids))
            first = next((i for i in ids if self.kind[i] != CONTROL), None)
        else:
            parts: list[str] = []
            pending = bytearray()
            first = None
            for i in ids:
                b = byte_of.get(i)
                if b is not None:
                    pending.append(b)
                else:
                    if pending:
                        parts.append(pending.decode("utf-8", "each_byte"))
                        pending.clear()
                    parts.append(surface[i])
                if first is None and self.kind[i] != CONTROL:
                    first = i
            if pending:
                parts.append(pending.decode("utf-8", "each_byte"))
            text = "".join(parts)
        if first is not None and self.kind[first] == NORMAL and text.startswith(" "):
            return text[1:]
        return text


class PieceModel(PieceDecoder):
    """The encoder of such a model."""

    def __init__(self, model: bytes) -> None:
        super().__init__(model)
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.held = 0
        known = {c for piece in self.rank for c in piece}
        # Pieces that merging never makes of their own characters can't occur at all.
        units = known | {p for p in self.rank if self.merge(p) == [p]}
        self.unit = sorted(units)
        self.length = [len(p) for p in self.unit]
        number = {p: i for i, p in enumerate(self.unit)}
        self.automaton = ahocorasick.Automaton()
        for piece, i in number.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        # The next shorter unit that a unit begins with, or -1.
        self.shorter = [
            next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in units), -1)
            for p in self.unit
        ]
        # The ids of a unit, as bytes: one, or those of its bytes if it is no piece itself.
        self.packed = [self._pack(p) for p in self.unit]
        # No piece goes on from another character to a space, nor holds a character outside `known`.
        letters = "".join(map(re.escape, sorted(known - {SPACE})))
        spaces_lead = not any(SPACE in p.lstrip(SPACE) for p in self.rank)
        word = f" *[{letters}]+| +" if spaces_lead else f"[{letters} ]+"
        self.split = re.compile(f"(?s){word}|.")
        self.known = known

    def merge(self, text: str) -> list[str]:
        """Plain merging: the best-ranked adjacent pair first, of equals the leftmost."""
        parts, rank = list(text), self.rank
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _pack(self, piece: str) -> bytes:
        i = self.id_of.get(piece)
        ids = [self.byte_ids[b] for b in piece.encode()] if i is None else [i]
        return array("i", ids).tobytes()

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            two = [self.unit[left], self.unit[right]]
            known = self.pairs[pair] = self.merge("".join(two)) == two
        return known

    def backtrack(self, text: str) -> list[int]:
        """The units of a text of known characters."""
        matches, shorter, length = self.automaton.iter_long, self.shorter, self.length
        pairs = self.pairs.get
        greedy = [unit for _, unit in matches(text)]
        if all([pairs(a << 32 | b) for a, b in zip(greedy, greedy[1:])]):
            return greedy  # known to be compatible all along
        size = len(text)
        failed = bytearray(size // 8 + 1)
        out: list[int] = []
        at, last, candidate = 0, -1, greedy[0]
        while True:
            end = at + length[candidate]
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = last < 0 or pairs(last << 32 | candidate)
                if fits is None:
                    fits = self.compatible(last, candidate)
                if fits:
                    out.append(candidate)
                    if end == size:
                        return out
                    at, last = end, candidate
                    candidate = next(matches(text, at))[1]
                    continue
            candidate = shorter[candidate]
            while candidate < 0:
                failed[at >> 3] |= 1 << (at & 7)
                candidate = out.pop()
                at -= length[candidate]
                last = out[-1] if out else -1
                candidate = shorter[candidate]

    def _word(self, word: str) -> bytes:
        found = self.old_words.get(word)
        if found is None:
            spaced = word.replace(" ", SPACE)
            if spaced[0] in self.known:
                found = b"".join([self.packed[unit] for unit in self.backtrack(spaced)])
            else:
                found = self._pack(spaced)
        if len(word) <= MAX_WORD_LENGTH:
            if self.held >= MAX_HELD:
                self.old_words, self.words, self.held = self.words, {}, 0
            self.words[word] = found
            self.held += getsizeof(word) + getsizeof(found) + ENTRY
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without begin and end, as int32."""
        if not text:
            return np.zeros(0, np.int32)
        seen, fresh = self.words.get, self._word
        # A space symbol in the text is the same as a space.
        words = self.split.findall(" " + text.replace(SPACE, " "))
        return np.frombuffer(b"".join([seen(w) or fresh(w) for w in words]), np.int32)


@lru_cache(maxsize=2)
def _encoder(model: bytes) -> PieceModel:
    """One encoder, with its words, for each Python worker."""
    return PieceModel(model)


@lru_cache(maxsize=2)
def _decoder(model: bytes) -> PieceDecoder:
    return PieceDecoder(model)


def read_model(path: str) -> bytes:
    """The model file's bytes; under a megabyte, they go to the tasks with the code."""
    with open(path, "rb") as f:
        return f.read()


IDS = T.ArrayType(T.IntegerType())


def _encoded(texts: pa.Array, model: bytes) -> pa.ListArray:
    encode = _encoder(model).encode
    each = [encode(t or "") for t in texts.to_pylist()]
    ends = np.cumsum([0, *map(len, each)], dtype=np.int32)
    flat = np.concatenate(each) if each else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _decoded(arrays: pa.Array, decoder: PieceDecoder) -> pa.Array:
    flat = arrays.flatten().to_numpy()
    sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy()
    texts = [decoder.decode(flat[end - size : end]) for end, size in zip(np.cumsum(sizes), sizes)]
    return pa.array(texts, pa.string())


def encode_pieces(
    df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Adds the ids of `text`, an array of int; null and empty texts get an empty array.

    With `decoded` the text that the ids decode to is added as well, in the same pass. Existing
    columns of these names are replaced; all other columns stay.
    """
    if decoded is None:
        return with_column_of(df, text, ids, IDS, lambda texts: _encoded(texts, model))

    def both(texts: pa.Array) -> list[pa.Array]:
        found = _encoded(texts, model)
        return [found, _decoded(found, _encoder(model))]

    return with_columns_of(df, text, {ids: IDS, decoded: T.StringType()}, both)


def decode_pieces(df: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the text of `ids`; null gives an empty text. An existing column `text` is replaced."""
    return with_column_of(
        df, ids, text, T.StringType(), lambda arrays: _decoded(arrays, _decoder(model))
    )
