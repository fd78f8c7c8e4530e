import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import documents, odd_rows
from tokenizers import Tokenizer

from threadlens.llm import tokens
from threadlens.llm.blobs import read_blobs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def whole(plain, text):
    return np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes()


def test_encoder_equals_the_library(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 30)
    encoder = tokens.Encoder(open(PATH, encoding="utf-8").read(), 2, public_tokenizers.PATTERN)
    assert encoder.by_piece
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "the", "'s", "'t", "é", "ß", "１", "23", "!", "?!", "<|endoftext|>", "\x1c", "\x85", "日本", "\U0001f600", "..."]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert encoder.encode(text) == whole(plain, text), text


def test_other_tokenizers_are_used_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokens.Encoder(open(path, encoding="utf-8").read(), 7, None)
    ids = Tokenizer.from_file(path).encode("Some  Words here", add_special_tokens=False).ids
    assert not encoder.by_piece
    assert encoder.encode("Some  Words here") == np.array([*ids, 7], dtype="<u4").tobytes()


def test_files_round_trip_in_order(spark, plain, monkeypatch):
    rows = odd_rows()
    folder = tokens.write_tokens(documents(spark, rows), PATH, 2, public_tokenizers.PATTERN)
    found = tokens.token_digests(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i))
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(whole(plain, t))
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in {(len(x) // 4, zlib.crc32(x)) for x in texts[r.doc_id]}
    some = tokens.read_tokens(spark, folder, [3, 26]).collect()
    assert {r.doc_id: bytes(r.ids) for r in some} == {3: texts[3][0], 26: texts[26][0]}


def test_small_files_keep_their_order(spark):
    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            for i in batch["doc_id"].to_pylist():
                yield pa.RecordBatch.from_pydict({"file": [tokens.pack_file([i], [bytes(4 * i)])]})

    rows = spark.range(1, 30, numPartitions=3).withColumnRenamed("id", "doc_id").mapInArrow(pack, "file binary")
    folder = tokens.write_blobs(rows, "file", tokens.MAGIC, "tokens")
    assert read_blobs(spark, folder).count() == 29
    found = tokens.read_tokens(spark, folder).orderBy("doc_id").collect()
    assert [r.start for r in found] == [sum(range(1, r.doc_id)) for r in found]


def test_damage_is_noticed():
    packed = bytearray(tokens.pack_file([1, None], [b"abcd" * 50, b"efgh"]) + tokens.MAGIC)
    table = tokens.seek_table(bytes(packed))
    starts = tokens.frame_starts(table)
    assert tokens.document_names(bytes(packed), starts, table) == [1, None]
    assert tokens.frame(bytes(packed), starts, table, 2) == b"efgh"
    at = len(packed) - 10
    packed[at] ^= 1  # the checksum of the last frame
    with pytest.raises(ValueError):
        tokens.frame(bytes(packed), starts, tokens.seek_table(bytes(packed)), 2)
    with pytest.raises(ValueError):
        tokens.seek_table(bytes(packed[:-1]))


def test_any_zstandard_reader_can_read_the_files():
    import zstandard

    packed = tokens.pack_file([1], [b"abcd"]) + tokens.MAGIC
    with zstandard.ZstdDecompressor().stream_reader(packed, read_across_frames=True) as reader:
        assert reader.read().endswith(b"abcd")


def test_empty_table(spark):
    folder = tokens.write_tokens(documents(spark, []), PATH, 2, public_tokenizers.PATTERN)
    assert tokens.token_digests(spark, folder).count() == 0
