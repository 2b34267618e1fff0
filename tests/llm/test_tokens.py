"""Token counts, shards and SentencePiece spans against the libraries themselves."""

import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from kithlink.llm.pieces import PieceModel, decode_pieces, encode_documents, encode_pieces, model, piece_digests  # noqa: E402
from kithlink.llm.queries import PIECE_VOCABULARY, WORD_VOCABULARY  # noqa: E402
from kithlink.llm.sstable import ShardReader, ShardWriter, lookup, read_shards, write_shards  # noqa: E402
from kithlink.llm.subwords import encoder, safe_pieces  # noqa: E402
from kithlink.llm.token_counts import count_texts, token_counts  # noqa: E402

ODD = [
    "", " ", "  a  b\n\n", "<|endoftext|> x <|startoftext|>", "<|ENDOFTEXT|>", "İstanbul ǅ ŉ", "don't can'T we'Re", "x\U0001f9ffy \x00  <s> </s>", "a b c\td", "ª º µ ß ſ", "abc..., !!! ?a,b.",
    "１２ 12,5", "é a ͅx", "▁a ▁▁ b▁", "日本語 テキスト", "� ﻿", "word<|endoftext|>word", "der&&& CO!! |x| '' 's", "▁ x",
]


def _texts():
    pick = random.Random(7)
    return ODD + [chr(c) + "a." for c in range(0x20, 0x250)] + ["".join(pick.choice("aB é\n.,'!1 <|▁İßΣς😀\t") for _ in range(pick.randint(1, 40))) for _ in range(300)]


def _word_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path(WORD_VOCABULARY))


def _piece_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.path(PIECE_VOCABULARY))


def test_word_ids_are_the_librarys():
    texts = _texts()
    want = [e.ids for e in _word_library().encode_batch(texts, add_special_tokens=False)]
    ids, bounds = encoder(WORD_VOCABULARY).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_long_texts_are_cut_at_safe_places():
    text = " ".join(f"word{i} (x)\n\n  y," for i in range(5000))
    assert "".join(safe_pieces(text, 1000)) == text and max(map(len, safe_pieces(text, 1000))) <= 1000
    assert safe_pieces("x" * 5000, 1000) == ["x" * 5000]
    text *= 15
    assert count_texts(pa.array([text, None, "a"]), WORD_VOCABULARY, 1 << 16).tolist() == [len(_word_library().encode(text, add_special_tokens=False).ids), 0, 1]


def test_token_counts(spark):
    texts = _texts() + [None, "same", "same"]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(None, "x y", 1)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r for r in token_counts(docs, WORD_VOCABULARY, 5).collect()}
    for i, t in enumerate(texts):
        n = len(_word_library().encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 5)
    assert got[None]["n_tokens"] == 2
    assert token_counts(docs.limit(0), WORD_VOCABULARY, 5).count() == 0
    assert token_counts(docs.filter("doc_id = 0"), PIECE_VOCABULARY, 5).first()["n_tokens"] == 0


def test_piece_ids_spans_and_decoding_are_the_librarys():
    library, pieces = _piece_library(), model(PIECE_VOCABULARY)
    texts = _texts()
    rows = pieces.digests(pa.array(texts))
    for text, row in zip(texts, rows):
        want = library.encode(text)
        ids, begins, ends = pieces.encode(text)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert (ids, list(zip(begins.tolist(), ends.tolist()))) == (want, spans), repr(text)
        assert row[:3] == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(library.decode(want).encode()).hexdigest())
        assert row[3] == len(text.encode())


@pytest.mark.parametrize("dummy, squeeze", [(True, True), (False, True), (True, False)])
def test_longest_prefix_normalisation_with_a_real_map(dummy, squeeze):
    """The library's compiled nmt_nfkc map, put into the public model, against the library's own normaliser and spans."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as schema

    proto = schema.ModelProto()
    proto.ParseFromString(open(P.path(PIECE_VOCABULARY), "rb").read())
    proto.normalizer_spec.precompiled_charsmap = _compiled_map(sentencepiece)
    proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = dummy, squeeze
    library, own = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), PieceModel.of_proto(proto)
    for text in ["ﬁne  １２ Ａb", " ㍿ x ", "é ｶﾞ ½", "", "  ", "a 　b", "​z ①", *_texts()[:40]]:
        pieces = library.encode(text, return_type="proto").pieces
        ids, begins, ends = own.encode(text)
        assert ids == [p.id for p in pieces], repr(text)
        assert list(zip(begins.tolist(), ends.tolist())) == [(p.begin, p.end) for p in pieces], repr(text)


def _compiled_map(library):
    from sentencepiece import sentencepiece_model_pb2 as schema

    proto = schema.ModelProto()
    proto.ParseFromString(library.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    return proto.normalizer_spec.precompiled_charsmap


def test_pieces_over_tables(spark):
    docs = spark.createDataFrame([(1, "Hello  wörld 😀", "x"), (1, "Hello  wörld 😀", "x"), (2, None, "y"), (None, "", "z")], "doc_id long, text string, ids string")
    rows = encode_pieces(docs, PIECE_VOCABULARY).collect()
    library = _piece_library()
    assert len(rows) == 4 and rows[0]["ids"] == rows[1]["ids"] == library.encode("Hello  wörld 😀") and rows[2]["ids"] == []
    back = decode_pieces(encode_pieces(docs, PIECE_VOCABULARY), PIECE_VOCABULARY).collect()
    assert [r["text"] for r in back] == ["Hello  wörld 😀"] * 2 + [""] * 2
    digests = piece_digests(docs, PIECE_VOCABULARY).collect()
    assert digests[0]["covered_bytes"] == len("Hello  wörld 😀".encode()) and digests[2]["n_tokens"] == 0
    assert [r["n_tokens"] for r in encode_documents(docs, PIECE_VOCABULARY).collect()] == [r["n_tokens"] for r in digests]
    assert piece_digests(docs.limit(0), PIECE_VOCABULARY).count() == 0


def test_shard_round_trip_and_lookup():
    sink, pick = io.BytesIO(), random.Random(3)
    keys = sorted([pick.randint(-(1 << 40), 1 << 40) for _ in range(500)] + [5, 5, 5])
    docs = [(None, np.array([9], np.uint32))] + [(k, np.array([pick.randint(0, 60000) for _ in range(pick.choice([0, 1, 3, 400]))], np.uint32)) for k in keys]
    writer = ShardWriter(sink, 2, block_bytes=512)
    for k, ids in docs:
        writer.add(k, ids)
    assert writer.finish() == len(sink.getvalue())
    reader = ShardReader(sink)
    assert [(k, ids.tolist()) for k, ids in reader] == [(k, ids.tolist()) for k, ids in docs]
    assert len(reader.index) > 10 and reader.docs == len(docs)
    for k in {*keys, None}:
        assert [x.tolist() for x in reader.get(k)] == [x.tolist() for kk, x in docs if kk == k]
    absent = [k for k in range(2000) if k not in keys]
    assert all(reader.get(k) == [] for k in absent) and sum(map(reader.may_hold, absent)) < 100
    with pytest.raises(ValueError):
        writer = ShardWriter(io.BytesIO(), 4)
        writer.add(2, np.array([1]))
        writer.add(1, np.array([1]))


def test_token_shards(spark, tmp_path):
    texts = _texts()[:200]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, "again", "y"), (3, "again", "y"), (None, "none", "z"), (7, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string").repartition(3)
    manifest = write_shards(docs, f"file://{tmp_path}/shards", WORD_VOCABULARY, end_id=1)
    got = sorted(read_shards(manifest).collect(), key=lambda r: r["start"])
    library = _word_library()
    ids = {(i, t): library.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _ in rows}
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    want = sorted((i if i is not None else -1, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, t, _) in rows for x in [ids[i, t]])
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_crc32"]) for r in got) == want
    found = lookup(manifest, spark.createDataFrame([(3,), (5,), (10**9,)], "doc_id long")).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == sorted([(3, ids[3, texts[3]]), (3, ids[3, "again"]), (3, ids[3, "again"]), (5, ids[5, texts[5]])])
    empty = write_shards(docs.limit(0), f"file://{tmp_path}/none", WORD_VOCABULARY, end_id=1)
    assert empty.count() == 0 and read_shards(empty).count() == 0


def test_ids_that_do_not_fit_raise():
    import io

    import numpy as np

    from kithlink.llm.sstable import ShardWriter

    ShardWriter(io.BytesIO(), 2).add(1, np.array([0xFFFF], np.uint32))
    with pytest.raises(OverflowError):
        ShardWriter(io.BytesIO(), 2).add(1, np.array([70_000], np.uint32))
