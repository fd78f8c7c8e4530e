"""Token ids in seekable files: one zstandard frame per document and a seek table at the end.

A file follows the public seekable format: frames, then a skippable frame that lists each
frame's packed and unpacked size and checksum, its count and a magic number. The first
frame holds the document ids, each further one the ids of one document as little-endian
32-bit numbers, so a reader unpacks only the documents it wants.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.llm.blobs import read_blobs, write_blobs
from threadlens.sources.tables import stage

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
MAGIC = b"\xb1\xea\x92\x8f"
CHECKSUMS = 0x80

FILE_BYTES = 4 << 20
LEVEL = 3
CACHE = 600_000

_encoders: dict[tuple[str, int, str | None], Encoder] = {}


class Encoder:
    """Ids of texts as bytes.

    Byte-level vocabularies cut a text at every space that a visible character follows, so
    such pieces are encoded once each and kept (about ``CACHE`` pieces, then afresh).
    Other tokenizers, and texts with special strings, are encoded whole.
    """

    def __init__(self, definition: str, end_id: int, pattern: str | None):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.end = struct.pack("<I", end_id)
        spec = json.loads(definition)
        cutter = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            pattern is not None
            and spec["model"]["type"] == "BPE"
            and not spec.get("normalizer")
            and cutter.get("type") == "ByteLevel"
            and not cutter.get("add_prefix_space")
            and cutter.get("use_regex", True)
        )
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.cut = regex.compile(pattern or "").findall
        self.at_spaces = regex.compile(r" (?=\S)").split
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = dict(zip(shown, map(chr, shown))) | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        # A space and a word is a word that follows a space: kept once, with those.
        is_word = len(piece) > 1 and piece[0] == " " and not piece[1].isspace()
        kept, key = (self.words, piece[1:]) if is_word else (self.pieces, piece)
        found = kept.get(key)
        if found is None:
            letters = piece.encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.tokenizer.model.tokenize(letters)]
            found = kept[key] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _learn(self, words: set[str]) -> None:
        """Keep the ids of words that follow a space."""
        for word in words.difference(self.words):
            self.words[word] = b"".join([self._piece(p) for p in self.cut(" " + word)])

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if not self.by_piece or any(s in text for s in self.special):
            return self._whole(text) + self.end
        if len(self.words) > CACHE:
            self.words.clear()
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        first, *words = text.split(" ")
        try:
            body = b"".join(map(self.words.__getitem__, words))
        except KeyError:
            new = set(words).difference(self.words)
            # Blanks side by side leave words that are empty or begin with one; none is ever kept.
            if any(not word or word[0].isspace() for word in new):
                first, *words = self.at_spaces(text)
                new = set(words)
            self._learn(new)
            body = b"".join(map(self.words.__getitem__, words))
        return b"".join([self._piece(p) for p in self.cut(first)]) + body + self.end


def encoder_for(definition: str, end_id: int, pattern: str | None) -> Encoder:
    """One encoder per worker, so that later tasks find the pieces of earlier ones."""
    key = (definition, end_id, pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def forget_encoders() -> None:
    _encoders.clear()


def pack_file(ids: Sequence[int | None], documents: Sequence[bytes]) -> bytes:
    """One file without its last four bytes (``MAGIC``)."""
    import xxhash
    import zstandard

    packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    known = np.array([i is not None for i in ids], dtype="u1").tobytes()
    names = known + np.array([i or 0 for i in ids], dtype="<i8").tobytes()
    frames, table = [], []
    for raw in (names, *documents):
        frame = packer.compress(raw)
        frames.append(frame)
        table.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
    rows = b"".join(table)
    head = struct.pack("<II", SKIPPABLE, len(rows) + 9)
    return b"".join(frames) + head + rows + struct.pack("<IB", len(table), CHECKSUMS)


def seek_table(content: bytes) -> np.ndarray:
    """Rows of packed size, unpacked size and checksum, one per frame."""
    if content[-4:] != MAGIC:
        raise ValueError("no seek table at the end of the file")
    count, flags = struct.unpack("<IB", content[-9:-4])
    if flags != CHECKSUMS:
        raise ValueError("the seek table has no checksums")
    return np.frombuffer(content, dtype="<u4", count=3 * count, offset=len(content) - 9 - 12 * count).reshape(-1, 3)


def frame(content: bytes, starts: np.ndarray, table: np.ndarray, k: int) -> bytes:
    import xxhash
    import zstandard

    packed = content[starts[k] : starts[k] + int(table[k, 0])]
    raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, int(table[k, 1])))
    if len(raw) != table[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != table[k, 2]:
        raise ValueError(f"frame {k} does not match its checksum")
    return raw


def frame_starts(table: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(table[:, 0].astype(np.int64))[:-1]])


def document_names(content: bytes, starts: np.ndarray, table: np.ndarray) -> list[int | None]:
    raw = frame(content, starts, table, 0)
    n = len(table) - 1
    ids = np.frombuffer(raw, dtype="<i8", offset=n).tolist()
    return [i if known else None for known, i in zip(raw[:n], ids)]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, pattern: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order; gives the folder.

    Nulls: a null text is empty (its ids are the end id alone), a null doc_id sorts first.
    Repeated ids stay separate documents side by side. An empty table gives no files.
    Columns other than doc_id and text are not looked at. ``tokenizer`` is the path of a
    tokenizer's JSON file on the driver, ``pattern`` the cut of its byte-level vocabulary.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(definition.value, end_id, pattern)
        ids: list[int | None] = []
        documents: list[bytes] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                raw = encoder.encode(text.as_py())
                ids.append(doc_id)
                documents.append(raw)
                size += len(raw)
                if size >= FILE_BYTES:
                    yield pa.RecordBatch.from_pydict({"file": pa.array([pack_file(ids, documents)], pa.binary())})
                    ids, documents, size = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pydict({"file": pa.array([pack_file(ids, documents)], pa.binary())})

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
    )
    return write_blobs(ordered.mapInArrow(packed, "file binary"), "file", MAGIC, "tokens")


def file_totals(spark: SparkSession, folder: str) -> DataFrame:
    """(part, chunk, base): how many ids all earlier files hold, as their seek tables say.

    Files are added up per writing task first, so one row per task meets in one place and
    one row per file in that of its task.
    """

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [int(seek_table(c.as_py())[1:, 1].astype(np.int64).sum()) // 4 for c in batch["content"]]
            yield pa.RecordBatch.from_arrays([batch["part"], batch["chunk"], pa.array(ids, pa.int64())], ["part", "chunk", "n"])

    files = read_blobs(spark, folder).select("content", "part", "chunk")
    sizes = stage(files.mapInArrow(totals, "part bigint, chunk bigint, n bigint"), "file-sizes")

    def earlier(of: Window, column: str) -> Column:
        return F.coalesce(F.sum(column).over(of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    parts = sizes.groupBy("part").agg(F.sum("n").alias("_sum"))
    parts = parts.select("part", earlier(Window.orderBy("part"), "_sum").alias("_base"))
    inside = sizes.select("part", "chunk", earlier(Window.partitionBy("part").orderBy("chunk"), "n").alias("_inside"))
    return inside.join(parts, "part").select("part", "chunk", (F.col("_base") + F.col("_inside")).alias("base"))


def _read(spark: SparkSession, folder: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """(part, chunk, doc_id, before, n_tokens, ids): documents of each file and the ids before them in it."""
    asked = None if wanted is None else frozenset(wanted)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()  # a worker that reads has written; its pieces only take room
        for batch in batches:
            for part, chunk, content in zip(batch["part"], batch["chunk"], batch["content"]):
                raw = content.as_py()
                table = seek_table(raw)
                starts = frame_starts(table)
                names = document_names(raw, starts, table)
                sizes = table[1:, 1].astype(np.int64) // 4
                before = np.cumsum(sizes) - sizes
                rows = [k for k, name in enumerate(names) if asked is None or name in asked]
                for at in range(0, len(rows), 1000):
                    some = rows[at : at + 1000]
                    columns = {
                        "part": pa.array([part.as_py()] * len(some), pa.int64()),
                        "chunk": pa.array([chunk.as_py()] * len(some), pa.int64()),
                        "doc_id": pa.array([names[k] for k in some], pa.int64()),
                        "before": pa.array(before[some], pa.int64()),
                        "n_tokens": pa.array(sizes[some], pa.int64()),
                        "ids": pa.array([frame(raw, starts, table, k + 1) for k in some], pa.binary()),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    files = read_blobs(spark, folder).select("content", "part", "chunk")
    return files.mapInArrow(
        documents, "part bigint, chunk bigint, doc_id bigint, before bigint, n_tokens bigint, ids binary"
    )


def _placed(spark: SparkSession, folder: str, found: DataFrame, last: str) -> DataFrame:
    return found.join(file_totals(spark, folder), ["part", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", last
    )


def read_tokens(spark: SparkSession, folder: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files, ids as little-endian 32-bit numbers.

    ``start`` counts the ids of all documents before. With ``wanted``, only the frames of
    those documents are unpacked. Checksums are verified.
    """
    return _placed(spark, folder, _read(spark, folder, wanted), "ids")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    digests = _read(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return _placed(spark, folder, digests, "ids_crc32")
