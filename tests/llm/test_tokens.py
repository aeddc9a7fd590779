"""Record files, chunked encoding and the rebuilt piece model."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Tokenizer

from innlake.llm import piece_codec, record_files, token_files
from innlake.llm.chunk_codes import ChunkCodes, by_lists, gap_starts
from innlake.llm.units import SPACE
from tests.llm import cases

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def joined(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def test_records_round_trip_and_find_damage(tmp_path):
    payloads = [b"", b"abc", bytes(range(256)) * 50]
    assert record_files.write_records(str(tmp_path), "part", 1, payloads)[0] == 3
    assert list(record_files.read_all(str(tmp_path), "part")) == payloads
    assert list(record_files.read_some(str(tmp_path), "part", [2, 0, 1])) == [payloads[2], payloads[0], payloads[1]]
    data = bytearray((tmp_path / "part.records").read_bytes())
    assert struct.unpack_from("<Q", data)[0] == 0
    data[-10] ^= 1
    (tmp_path / "part.records").write_bytes(bytes(data))
    with pytest.raises(ValueError, match="damaged record"):
        list(record_files.read_all(str(tmp_path), "part"))
    (tmp_path / "part.records").write_bytes(bytes(data[:16]))
    with pytest.raises(ValueError, match="index"):
        list(record_files.read_all(str(tmp_path), "part"))


def test_token_files_equal_whole_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 20_000)
    folder = cases.saved(cases.documents(spark), tmp_path, "documents")
    found = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.query(spark, folder).collect())
    tokenizer, at, wanted = Tokenizer.from_file(WORD), 0, []
    for row in sorted(cases.rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 1]
        wanted.append((at, row[0], len(ids), crc(ids)))
        at += len(ids)
    assert found == wanted


def test_token_files_of_no_documents(spark, tmp_path):
    folder = cases.saved(cases.documents(spark, []), tmp_path, "documents")
    assert token_files.query(spark, folder).collect() == []


def test_remembering_few_chunks_changes_nothing():
    tokenizer = Tokenizer.from_file(WORD)
    codes = ChunkCodes(by_lists(lambda c: [e.ids for e in tokenizer.encode_batch(c, add_special_tokens=False)]), np.uint16, 5)
    texts = [t or "" for _, t, *_ in cases.rows()]
    for some in (texts, texts[::-1], ["a\x1eb \x1e c"], [""], []):
        data, offsets = joined(some)
        ids, ends = codes.encode(data, offsets, gap_starts(SPACE[data]))
        assert [ids[a:z].tolist() for a, z in zip(ends[:-1], ends[1:])] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in some]


TEXTS = ["", " ", "  a", "a  ", " a   b ", "▁x", "a▁ b", "\t\nx  y", "<s> hi </s><0x41><unk>", "日本語 テスト 🎉", " " * 300,
         "a" * 500, "x\x00y", *(t or "" for _, t, *_ in cases.rows())]


def assert_like_library(codec, path, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = codec.normal(texts)
    ids, ends = codec.encode(*joined(normal))
    data, places = codec.decode(ids, ends)
    for i, text in enumerate(texts):
        wanted = library.encode(text)
        assert ids[ends[i]: ends[i + 1]].tolist() == wanted, text[:50]
        assert data[places[i]: places[i + 1]].tobytes().decode("utf-8", "replace") == library.decode(wanted), text[:50]


def test_pieces_equal_the_library():
    codec = piece_codec.Codec(PIECE)
    assert_like_library(codec, PIECE, TEXTS)
    assert codec.differing == 0


def test_unigram_model_equals_the_library(tmp_path):
    model = proto.ModelProto()
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *((f"<0x{b:02X}>", 0, 6) for b in range(256)),
              ("▁", -3.5, 1), ("▁the", -1.25, 1), ("th", -2.5, 1), ("er", -2.25, 1), ("▁er", -2.75, 1), ("ing", -2.0, 1)]
    pieces += [(c, -6.0 - i / 16, 1) for i, c in enumerate("abcdefghinorst")]
    for piece, score, kind in pieces:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = True
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    codec = piece_codec.Codec(str(path))
    assert codec.model.kind == piece_codec.UNIGRAM and codec.model.trim
    assert_like_library(codec, str(path), ["the other thing", " the  there ", "", "zebra é", "er er er", "stringing"])


def test_piece_query(spark, tmp_path):
    folder = cases.saved(cases.documents(spark), tmp_path, "documents")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found = piece_codec.query(spark, folder).collect()
    wanted = sorted((str(k), len(i := library.encode(t or "")), crc(i)) for k, t, *_ in cases.rows())
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == wanted
    assert all(r["round_trip"] and r["verified"] for r in found)
    folder = cases.saved(cases.documents(spark, []), tmp_path, "documents")
    assert piece_codec.query(spark, folder).collect() == []


def test_every_text_is_verified(monkeypatch):
    monkeypatch.setattr(piece_codec, "SPAN", 20)
    codec = piece_codec.Codec(PIECE)
    wrong = codec._tokenizer.encode("▁wrong", add_special_tokens=False).ids
    inner = codec._codes._encode

    def encode(chunks):
        flat, sizes = inner(chunks)
        ends = np.cumsum(sizes)
        for chunk, end, size in zip(chunks, ends, sizes):
            if chunk.strip() == "wrong":
                flat[end - size: end] = wrong[0] + 1
        return flat, sizes

    codec._codes._encode = encode
    texts = [*TEXTS, *(f"some words and  more number{i} are here, ▁ and   there" for i in range(40)), "a wrong one", "wrong again and wrong"]
    for _ in range(2):  # chunks are remembered the second time
        ids, ends = codec.encode(*joined(codec.normal(texts)))
        verdicts = [codec.verified(t, n, ids[ends[i]: ends[i + 1]]) for i, (t, n) in enumerate(zip(texts, codec.normal(texts)))]
        assert verdicts == ["wrong" not in t for t in texts]
    assert piece_codec.Codec(PIECE, False).verified("x", "x", ids[:0]) is None
