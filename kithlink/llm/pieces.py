"""SentencePiece encoding that keeps each piece's byte span in the original text.

A text is normalised by longest-prefix search through the model's compiled character map (a
double-array trie over UTF-8 bytes followed by its zero-ended replacements), and the source byte of
every normalised character is kept. The normalised text falls into chunks that begin with a space
mark; no piece of the vocabulary has a space mark after another character, so merges never cross
chunks and each distinct chunk is segmented once. Segmentation is the library's, on a copy of the
model whose normaliser does nothing, because the text is normalised already.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithlink.llm.common import byte_batches, frugal, utf8_lengths

SPACE = "▁"
#: Distinct chunks one worker remembers before it starts anew (memory bound).
REMEMBERED = 40_000
#: Bytes of text that a worker holds as ids at once.
BATCH_BYTES = 1 << 19


class CharacterMap:
    """Longest-prefix rewriting by a precompiled map: 4 bytes of trie size, trie units, replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.replacements = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that data has at a position, and its replacement."""
        units, node, best = self.units, 0, None
        if not units:
            return None
        jump = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node ^= jump(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[i]:
                break
            node ^= jump(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        start = best[1]
        return best[0], self.replacements[start:self.replacements.index(b"\0", start)]


class PieceModel:
    """A .model file: encoding with spans, and the library's decoding."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        proto = schema.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        self._setup(proto, sentencepiece)

    @classmethod
    def of_proto(cls, proto) -> "PieceModel":
        import sentencepiece

        self = cls.__new__(cls)
        self._setup(proto, sentencepiece)
        return self

    def _setup(self, proto, library) -> None:
        spec = proto.normalizer_spec
        self.library = library.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.mark = SPACE if self.escape else " "
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.unk, self.byte_fallback = proto.trainer_spec.unk_id, proto.trainer_spec.byte_fallback
        bare = type(proto)()
        bare.CopyFrom(proto)
        bare.normalizer_spec.Clear()
        bare.normalizer_spec.name = "identity"
        bare.normalizer_spec.add_dummy_prefix = bare.normalizer_spec.remove_extra_whitespaces = False
        bare.normalizer_spec.escape_whitespaces = True
        self.bare = library.SentencePieceProcessor(model_proto=bare.SerializeToString())
        self.user_defined = sorted((p.piece for p in proto.pieces if p.type == 4), key=len, reverse=True)
        separable = self.escape and not self.suffix and not any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces) and not self.user_defined
        self.chunks = re.compile(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+").findall if separable else lambda text: [text] if text else []
        self.plain = not self.map.units and not self.squeeze and self.escape and not self.suffix and not self.user_defined
        self.known: dict[str, tuple] = {}
        self.pieces_of = [p.piece for p in proto.pieces]
        #: Characters of a piece; 0 for the unknown piece; -1 - value for the piece of a byte.
        self.sizes = [0 if p.type == 2 else -1 - int(p.piece[3:5], 16) if p.type == 6 else len(p.piece) for p in proto.pieces]

    # -- normalisation -------------------------------------------------------------------------

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, the source byte where it comes from."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.plain:
            data = np.frombuffer(text.encode(), np.uint8)
            starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            marked = text.replace(" ", SPACE)
            return (SPACE + marked, np.concatenate(([0], starts))) if self.dummy else (marked, starts)
        data, at, out, source = text.encode(), 0, [], []
        end = len(data)
        users = [u.encode() for u in self.user_defined]

        def step(at: int) -> tuple[int, str]:
            for user in users:
                if data.startswith(user, at):
                    return len(user), user.decode()
            if found := self.map.longest(data, at):
                return found[0], found[1].decode("utf-8", "replace")
            n = _utf8_width(data[at])
            return n, data[at:at + n].decode()

        if self.squeeze:
            while at < end:
                n, new = step(at)
                if new != " ":
                    break
                at += n
            if at == end:
                return "", np.zeros(1, np.int64)
        if self.dummy and not self.suffix:
            out.append(self.mark)
            source.append(at)
        blank = self.squeeze
        while at < end:
            n, new = step(at)
            if blank and self.squeeze:
                new = new.lstrip(" ")
            for c in new:
                out.append(self.mark if c == " " else c)
                source.append(at)
            if new:
                blank = self.squeeze and new.endswith(" ")
            at += n
        source.append(at)
        if self.squeeze:
            while out and out[-1] == self.mark:
                out.pop()
                source.pop()
        if self.dummy and self.suffix:
            out.append(self.mark)
            source.append(source[-1])
        return "".join(out), np.array(source, np.int64)

    def marked(self, text: str) -> str:
        """The normalised text alone."""
        if self.plain and text:
            marked = text.replace(" ", SPACE)
            return SPACE + marked if self.dummy else marked
        return self.normalize(text)[0]

    # -- segmentation --------------------------------------------------------------------------

    def _entries(self, chunks: list[str]) -> list[tuple]:
        """For each chunk: ids; their decimal text; how many characters of the chunk each piece has."""
        known = self.known
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                self.known = known = {}
                new = list(dict.fromkeys(chunks))
            for chunk, ids in zip(new, self.bare.encode(new, num_threads=1)):
                known[chunk] = (tuple(ids), ",".join(map(str, ids)), self._lengths(chunk, ids))
        return [known[c] for c in chunks]

    def _lengths(self, chunk: str, ids: list[int]) -> tuple[int, ...]:
        """Characters of the chunk that each id stands for; of a character's byte pieces the last one holds it."""
        size = self.sizes
        lengths = [size[i] for i in ids]
        if min(lengths) > 0:
            return tuple(lengths)
        at = i = 0
        while i < len(ids):
            n = size[ids[i]]
            if n < 0:  # a byte: its value tells how many bytes its character has
                bytes_ = _utf8_width(-1 - n)
                lengths[i:i + bytes_] = [0] * (bytes_ - 1) + [1]
                at, i = at + 1, i + bytes_
                continue
            if n == 0:  # unknown characters, up to where the next piece begins
                follow = self.pieces_of[ids[i + 1]] if i + 1 < len(ids) else None
                lengths[i] = n = len(chunk) - at if follow is None else max(1, chunk.index(follow, at + 1) - at)
            at, i = at + n, i + 1
        return tuple(lengths)

    def encode_ids(self, text: str) -> list[int]:
        return list(chain.from_iterable(e[0] for e in self._entries(self.chunks(self.marked(text)))))

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids, and the byte spans [begin, end) of their sources."""
        return self._spans(*self._segment(text))

    def _segment(self, text: str) -> tuple[list[tuple], np.ndarray]:
        normal, source = self.normalize(text)
        return self._entries(self.chunks(normal)), source

    def _spans(self, entries: list[tuple], source: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        ids = list(chain.from_iterable([e[0] for e in entries]))
        lengths = np.fromiter(chain.from_iterable([e[2] for e in entries]), np.int64, len(ids))
        ends = np.cumsum(lengths)
        begins, stops = source[ends - lengths], source[ends]
        held = np.flatnonzero(lengths == 0)  # the leading byte pieces of a character stand empty at its begin
        stops[held] = begins[held]
        return ids, begins, stops

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)

    def digest(self, text: str) -> tuple[int, str, str, int, list[int]]:
        """Number of ids, sha256 of the ids and of the decoded text, the source bytes that the spans cover, and the ids."""
        entries, source = self._segment(text)
        ids, begins, ends = self._spans(entries, source)
        listed = ",".join([e[1] for e in entries])
        covered = int(np.maximum(0, ends - np.maximum(begins, np.concatenate(([0], np.maximum.accumulate(ends)[:-1])))).sum()) if ids else 0
        return len(ids), _sha(listed), _sha(self.decode(ids)), covered, ids


    def digests(self, texts: pa.Array) -> list[tuple]:
        """digest() of each text. Where the map is empty and no spaces meet, whole batches go column by column."""
        rows: list = [None] * len(texts)
        even = np.zeros(len(texts), bool)
        if self.plain and self.dummy and len(self.chunks(SPACE + "a" + SPACE + "b")) == 2:
            even = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
            for odd in (pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE), pc.starts_with(texts, " "), pc.ends_with(texts, " ")):
                even &= ~odd.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(~even).tolist():
            rows[i] = self.digest(texts[i].as_py())
        if even.any():
            part = texts.filter(pa.array(even))
            for i, row in zip(np.flatnonzero(even).tolist(), self._digest_columns(part)):
                rows[i] = row
        return rows

    def _digest_columns(self, texts: pa.Array) -> list[tuple]:
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        flat = lists.flatten().dictionary_encode()
        entries, at = self._entries([SPACE + c for c in flat.dictionary.to_pylist()]), flat.indices
        count = np.fromiter((len(e[0]) for e in entries), np.int64, len(entries))
        starts = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32())
        total = int(count.sum())
        each = lambda k: pa.ListArray.from_arrays(starts, pa.array(np.fromiter(chain.from_iterable([e[k] for e in entries]), np.int32, total))).take(at).flatten().to_numpy()
        ids, lengths = each(0), each(2).astype(np.int64)
        running = np.concatenate(([0], np.cumsum(count[at.to_numpy()])))[bounds]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array([e[1] for e in entries]).take(at)), ",").to_pylist()
        # spans: the source of normalised character k of a text is its character k - 1, the mark in front has no bytes
        data = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
        first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        sizes = np.array(utf8_lengths(texts))
        doc_byte = np.concatenate(([0], np.cumsum(sizes)))
        doc_char = np.searchsorted(first, doc_byte)
        of = np.repeat(np.arange(len(texts)), np.diff(running))
        ends = np.cumsum(lengths)
        base = np.concatenate(([0], ends))[running[:-1]]
        ends = ends - base[of]
        begin_at = np.maximum(ends - lengths - 1, 0)
        span = first[doc_char[of] + np.maximum(ends - 1, 0)] - first[doc_char[of] + begin_at]
        span[lengths == 0] = 0
        covered = np.add.reduceat(span, running[:-1])
        decode, bounds = self.library.decode, running.tolist()
        return [(b - a, _sha(listed), _sha(decode(own := ids[a:b].tolist())), int(c), own) for a, b, listed, c in zip(bounds, bounds[1:], joined, covered)]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _utf8_width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


_MODELS: dict[str, PieceModel] = {}


def model(vocabulary: str) -> PieceModel:
    from kithlink.llm.subwords import resolve

    if vocabulary not in _MODELS:
        _MODELS[vocabulary] = PieceModel(resolve(vocabulary))
    return _MODELS[vocabulary]


def encode_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ids array<int>, begins and ends array<long> (byte spans in the text).

    Null and empty texts give empty arrays. Repeated rows and ids each give a row; other columns are not read.
    Narrow: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [pieces.encode(t or "") for t in part.column(1).to_pylist()]
                kinds = (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], ["id", "ids", "begins", "ends"])

    return _over(docs, run, "ids array<int>, begins array<long>, ends array<long>", id_col, text_col)


def decode_pieces(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of encoded: id, text as the library's decode(ids) gives it; null ids decode to ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(vocabulary)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pieces.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(frugal(run), f"id {kind}, text string").withColumnRenamed("id", id_col)


def piece_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text; return only digests: n_tokens, ids_sha256, decoded_sha256, covered_bytes.

    The ids and spans stay in the worker, so nothing but a short row a document leaves it.
    Null and empty texts: 0 tokens, digests of empty strings. Very long texts count whole; an empty table gives an empty result. Repeated rows each give a row; other columns are not read.
    """
    columns = [("n_tokens", pa.int64(), 0), ("ids_sha256", pa.string(), 1), ("decoded_sha256", pa.string(), 2), ("covered_bytes", pa.int64(), 3)]
    return _digested(docs, vocabulary, columns, "n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long", id_col, text_col)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens, ids array<int>, decoded_sha256, covered_bytes; cases as in piece_digests."""
    columns = [("n_tokens", pa.int64(), 0), ("ids", pa.list_(pa.int32()), 4), ("decoded_sha256", pa.string(), 2), ("covered_bytes", pa.int64(), 3)]
    return _digested(docs, vocabulary, columns, "n_tokens long, ids array<int>, decoded_sha256 string, covered_bytes long", id_col, text_col)


def _digested(docs: DataFrame, vocabulary: str, columns: list[tuple], schema: str, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(vocabulary)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in byte_batches(utf8_lengths(texts), BATCH_BYTES):
                rows = pieces.digests(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array([r[k] for r in rows], kind) for _, kind, k in columns)], ["id", *(n for n, _, _ in columns)])
        pieces.known = {}

    return _over(docs, run, schema, id_col, text_col)


def _over(docs: DataFrame, run, columns: str, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(frugal(run), f"id {kind}, {columns}").withColumnRenamed("id", id_col)
