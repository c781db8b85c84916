"""Token ids of many texts at once, by the distinct segments in them.

A vocabulary's first step never joins what lies on the two sides of certain places in a
text: white space where the vocabulary drops it, or, where a word takes one space before
it, the place before such a space; and the border of a letter and an ASCII mark. Texts
are cut there on their bytes, all of a batch together; each distinct segment is encoded
once by the tokenizer itself and remembered, and the ids of the texts are gathered from
those of the segments. A place that might not be a border (next to bytes that could be
white space or marks beyond ASCII) is not cut, which only makes a segment longer.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa

MAX_KNOWN = 250_000
# Longer segments are encoded again each time, so that the table stays small.
MAX_LETTERS = 64


def _bytes(chosen: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chosen)] = True
    return table


SPACE = _bytes(b" \t\n\r")
LETTER = _bytes(bytes(range(65, 91)) + bytes(range(97, 123)))
# An apostrophe may belong to the letters behind it.
MARK = _bytes(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
# First byte of a letter from U+00C0 to U+024F (two of these are signs, see below).
LATIN = _bytes(bytes(range(0xC3, 0xCA)))
SIGNS = _bytes(bytes([0x97, 0xB7]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Remembered:
    """Ids of segments, in two generations of a bounded table: what is asked for again survives."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = MAX_KNOWN):
        self.encode, self.most, self.new, self.old = encode, most, {}, {}

    def of(self, segments: list[str]) -> list[bytes]:
        found = list(map(self.new.get, segments))
        lacking = [place for place, ids in enumerate(found) if ids is None]
        old = list(map(self.old.get, [segments[place] for place in lacking]))
        missing = [place for place, ids in zip(lacking, old, strict=True) if ids is None]
        coded = iter(self.encode([segments[place] for place in missing]) if missing else ())
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        for place, ids in zip(lacking, old, strict=True):
            found[place] = ids = next(coded) if ids is None else ids
            if len(segments[place]) <= MAX_LETTERS:
                self.new[segments[place]] = ids
        return found


def _marks_apart(data: np.ndarray, cut: np.ndarray) -> None:
    """Cut between a letter and an ASCII mark, in either order."""
    letter, mark = LETTER[data], MARK[data]
    latin = LATIN[data[:-2]] & ~((data[:-2] == 0xC3) & SIGNS[data[1:-1]])
    cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & (letter | LATIN[data])[1:])
    cut[2:] |= latin & mark[2:]
    # A mark before U+00D7 or U+00F7 may be one run with it.
    cut[1:-1] &= ~(mark[:-2] & (data[1:-1] == 0xC3) & SIGNS[data[2:]])


def segments_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each segment begins among the bytes kept (and their end), where each text
    begins among them, and the bytes: without ASCII white space, A-Z in lower case."""
    blank = SPACE[data]
    first = np.zeros(len(data), bool)
    first[1:] = blank[:-1]
    if len(data) > 2:
        _marks_apart(data, first)
    starts = offsets[:-1]
    first[starts[starts < len(data)]] = True
    solid = np.flatnonzero(~blank)
    kept = LOWER[data[solid]]
    left = np.searchsorted(solid, offsets)
    return np.append(np.flatnonzero(first[solid]), len(kept)).astype(np.int64), left, kept


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes
    for themselves, the others from 256 on in their order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + place) for place, byte in enumerate(others)}


class BatchEncoder:
    """Encodes for a byte-level vocabulary that drops white space and case."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        model, letters = tokenizer.model, byte_letters()

        def encode(segments: list[str]) -> list[bytes]:
            coded = []
            for segment in segments:
                lower = segment.lower()
                if lower.isalpha() and max(lower) < "\u0250":
                    # Latin letters are one part as they are, so the model is asked directly.
                    part = lower.encode().decode("latin-1").translate(letters)
                    ids = [token.id for token in model.tokenize(part)]
                else:
                    ids = tokenizer.encode(segment, add_special_tokens=False).ids
                coded.append(array("I", ids).tobytes())
            return coded

        self.known = Remembered(encode)

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with ``end_id`` behind it, and where
        each text begins among them (one place more than texts). Null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, held = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(held or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        begins, left, kept = segments_of(data, offsets)
        words = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(kept)).dictionary_encode()
        coded = self.known.of(words.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(coded) + np.uint32(end_id).tobytes(), "<u4")
        sizes = np.append(np.fromiter(map(len, coded), np.int32, len(coded)) // 4, 1).astype(np.int32)
        places = (np.cumsum(sizes) - sizes).astype(np.int32)
        # The segments of each text, and the end behind them as one more.
        of_text = np.searchsorted(begins[:-1], left)
        order = np.insert(words.indices.to_numpy(zero_copy_only=False), of_text[1:], len(coded))
        lengths = sizes[order]
        ends = np.cumsum(lengths, dtype=np.int64)
        shift = places[order] - (ends - lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(shift, lengths) + np.arange(total)]
        text_ends = ends[of_text[1:] + np.arange(len(texts))] if len(texts) else ends
        return flat, np.concatenate([[0], text_ends])
