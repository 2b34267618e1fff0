"""Chunk-wise encoding with public tokenizer files.

Both vocabularies split every text at white space before they merge anything, so a text's
ids are the concatenation of the ids of its chunks. Chunks repeat far more often than texts:
each distinct chunk is encoded once and kept in a bounded table per Python worker.
"""

from __future__ import annotations

import os
import string
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct chunks one worker remembers before it starts anew: a memory bound, not a limit on texts.
REMEMBERED = 400_000
#: Texts of more bytes are cut at spaces before they are encoded.
LONG_TEXT = 1 << 20

_ENCODERS: dict[str, "ChunkEncoder"] = {}


def resolve(vocabulary: str) -> str:
    """A path as it is, else a file of the installed public tokenizers."""
    if os.path.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def encoder(vocabulary: str) -> "ChunkEncoder":
    """The worker's encoder for a vocabulary file; .json: tokenizers, .model: sentencepiece."""
    if vocabulary not in _ENCODERS:
        path = resolve(vocabulary)
        _ENCODERS[vocabulary] = PieceEncoder(path) if path.endswith(".model") else WordEncoder(path)
    return _ENCODERS[vocabulary]


def safe_pieces(text: str, most: int = LONG_TEXT) -> list[str]:
    """Cut a long text after spaces; no cut falls inside a run of white space, so nothing merges across."""
    if len(text) <= most:
        return [text]
    pieces, start = [], 0
    while len(text) - start > most:
        cut = text.rfind(" ", start, start + most)
        while cut > start and text[cut - 1].isspace():
            cut -= 1
        if cut <= start:
            cut = text.find(" ", start + most)
            if cut < 0:
                break
            while cut > start and text[cut - 1].isspace():
                cut -= 1
            if cut <= start:
                break
        pieces.append(text[start:cut])
        start = cut
    pieces.append(text[start:])
    return pieces


class ChunkEncoder:
    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def _encode(self, chunks: list[str]) -> list[tuple[int, ...]]:
        raise NotImplementedError

    def ids_of(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """Ids of each of these distinct chunks."""
        known = self.known
        new = [c for c in chunks if c not in known]
        if len(known) + len(new) > REMEMBERED:
            self.known = known = {}
            new = chunks
        known.update(zip(new, self._encode(new)))
        found = list(map(known.__getitem__, chunks))
        if len(known) > REMEMBERED:
            self.known = {}
        return found

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All texts' chunks in a row, dictionary-encoded, and where each text's chunks begin and end."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = lists.offsets.to_numpy()
        return lists.flatten().dictionary_encode(), offsets - offsets[0]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        chunks, offsets = self.split(texts)
        names = chunks.dictionary.to_pylist()
        each = np.fromiter(map(len, self.ids_of(names)), np.int64, len(names))
        running = np.concatenate(([0], np.cumsum(each[chunks.indices.to_numpy()])))
        return running[offsets[1:]] - running[offsets[:-1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and each text's bounds in it."""
        chunks, offsets = self.split(texts)
        of_chunk = self.ids_of(chunks.dictionary.to_pylist())
        each = np.fromiter(map(len, of_chunk), np.int64, len(of_chunk))
        flat = np.fromiter(chain.from_iterable(of_chunk), np.uint32, int(each.sum()))
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))), pa.int32()), pa.array(flat))
        indices = chunks.indices
        running = np.concatenate(([0], np.cumsum(each[indices.to_numpy()])))
        return ids.take(indices).flatten().to_numpy(), running[offsets]


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(0x100 + i) for i, b in enumerate(rest)}}


class WordEncoder(ChunkEncoder):
    """A tokenizers file whose pre-tokenizer drops white space, so chunks between spaces are independent.

    A chunk of plain Latin letters, of ASCII marks, or of letters and then marks, is one or two pre-tokens:
    its lower-case bytes go straight to the model. Everything else takes the whole tokenizer.
    """

    MARKS = string.punctuation

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.bodies: dict[str, tuple[int, ...]] = {}

    def _word(self, lower: str) -> tuple[int, ...]:
        mapped = lower.encode().decode("latin-1").translate(self.letters)
        ids = self.bodies[lower] = tuple([t.id for t in self.model.tokenize(mapped)])
        return ids

    def _encode(self, chunks: list[str]) -> list[tuple[int, ...]]:
        bodies, out, slow, marks_of, word = self.bodies, [], [], self.MARKS, self._word
        if len(bodies) > REMEMBERED:
            bodies.clear()
        for i, chunk in enumerate(chunks):
            body = chunk.rstrip(marks_of)
            if body.isalpha() and (body.isascii() or max(body) < "ɐ" and "İ" not in body):
                lower = body.lower()
                ids = bodies.get(lower) or word(lower)
                if len(body) < len(chunk):
                    marks = chunk[len(body):]
                    ids += bodies.get(marks) or word(marks)
                out.append(ids)
            elif not body:
                out.append((bodies.get(chunk) or word(chunk)) if chunk else ())
            else:
                slow.append(i)
                out.append(())
        for at in range(0, len(slow), 2000):
            part = slow[at:at + 2000]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([chunks[i] for i in part], add_special_tokens=False)):
                out[i] = tuple(e.ids)
        return out


class PieceEncoder(ChunkEncoder):
    """A sentencepiece BPE file; see pieces.py, which also keeps byte spans."""

    def __init__(self, path: str) -> None:
        super().__init__()
        from kithlink.llm.pieces import PieceModel

        self.pieces = PieceModel(path)

    def lengths(self, texts: pa.Array) -> np.ndarray:
        return np.array([len(self.pieces.encode_ids(t)) for t in texts.to_pylist()], dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        each = [np.array(self.pieces.encode_ids(t), dtype=np.uint32) for t in texts.to_pylist()]
        return np.concatenate(each or [np.empty(0, np.uint32)]), np.cumsum([0, *map(len, each)])
