"""Token ids in directly addressable files.

A file holds the ids of many documents in ascending doc_id order. Each id is
split into chunks of eight bits, the lowest first. Level 0 has the lowest chunk
of every id, level 1 the next chunk of those ids that go on, and so forth. A
bitmap of each level says which ids go on, and its rank directory, the ones
before every 512th bit, tells where an id's next chunk is. So any token, or any
run of tokens, is read from a few bytes of each level, with no block to decode.

All numbers are little-endian::

    magic "DACTOK1\\n" | documents u64 | tokens u64 | levels u64
    for each level: length u64
    for each level: chunks u8[length] | bitmap u8[ceil(length / 8)] | directory u64[ceil(length / 512)]
    doc_id i64[documents] | doc_id is NULL u8[documents] | first token u64[documents + 1]
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from servicelens.llm.common import ensure_checkpoint_dir, materialise

MAGIC = b"DACTOK1\n"
RANK_EVERY = 512
#: A file is closed once it has so many tokens; a reader takes so many at a time.
FILE_TOKENS, READ_TOKENS = 1 << 22, 1 << 20
#: Ids of so many chunks, and of so many words, are kept by a worker; it encodes texts of so many bytes together.
CACHED, GROUP_BYTES = 1_000_000, 1 << 22
#: Rules under which a chunk of visible ASCII is cut as below (fixed values of the tokenizer's definition).
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
VISIBLE = re.compile(r"[!-~]+").fullmatch
WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9]+").findall
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"


# ------------------------------------------------------------------ format
def split_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(chunks, goes on) of each level; no id, no level."""
    out, rest = [], np.asarray(ids, np.uint32)
    while len(rest):
        high = rest >> np.uint32(8)
        more = high > 0
        out.append((rest.astype(np.uint8), more))
        rest = high[more]
    return out


def file_bytes(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file of documents with the given numbers of ids."""
    levels = split_levels(ids)
    parts = [MAGIC, np.array([len(doc_ids), len(ids), len(levels), *(len(c) for c, _ in levels)], "<u8").tobytes()]
    for chunks, more in levels:
        ones = np.append(0, np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_EVERY), dtype=np.int64)))[:-1]
        parts += [chunks.tobytes(), np.packbits(more, bitorder="little").tobytes(), ones.astype("<u8").tobytes()]
    parts.append(np.array([x or 0 for x in doc_ids], "<i8").tobytes())
    parts.append(np.array([x is None for x in doc_ids], np.uint8).tobytes())
    parts.append(np.append(0, np.cumsum(sizes)).astype("<u8").tobytes())
    return b"".join(parts)


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if re.match(r"file:/|/", path):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:", "", path).lstrip("/")
    return fs.FileSystem.from_uri(path)


class TokenFile:
    """Random access to one file; only what is asked for is read."""

    def __init__(self, path: str):
        system, name = storage(path)
        self.file = system.open_input_file(name)
        head = self._read(0, 32)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.n_docs, self.n_tokens, n_levels = np.frombuffer(head[8:], "<u8").tolist()
        lengths = np.frombuffer(self._read(32, 8 * n_levels), "<u8").tolist()
        at, self.levels = 32 + 8 * n_levels, []
        for n in lengths:
            bitmap = at + n
            directory = bitmap + -(-n // 8)
            self.levels.append((at, bitmap, directory))
            at = directory + 8 * -(-n // RANK_EVERY)
        self.docs_at = at

    def _read(self, at: int, size: int) -> bytes:
        return self.file.read_at(size, at)

    def _bits(self, bitmap: int, a: int, b: int) -> np.ndarray:
        raw = np.frombuffer(self._read(bitmap + a // 8, -(-b // 8) - a // 8), np.uint8)
        return np.unpackbits(raw, bitorder="little")[a % 8 :][: b - a].astype(bool)

    def tokens(self, a: int, b: int) -> np.ndarray:
        """The ids at positions a to b (excluded)."""
        out, at, shift = np.zeros(b - a, np.uint32), np.arange(b - a), 0
        for chunks, bitmap, directory in self.levels:
            if not len(at):
                break
            out[at] |= np.frombuffer(self._read(chunks + a, b - a), np.uint8).astype(np.uint32) << np.uint32(shift)
            start = a // RANK_EVERY * RANK_EVERY
            bits = self._bits(bitmap, start, b)
            before = int(np.frombuffer(self._read(directory + a // RANK_EVERY * 8, 8), "<u8")[0]) + int(bits[: a - start].sum())
            more = bits[a - start :]
            at, a, b, shift = at[more], before, before + int(more.sum()), shift + 8
        return out

    def token(self, i: int) -> int:
        return int(self.tokens(i, i + 1)[0])

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """doc_ids, and the first token of each document, followed by the number of tokens."""
        n = self.n_docs
        ids, null = np.frombuffer(self._read(self.docs_at, 8 * n), "<i8"), np.frombuffer(self._read(self.docs_at + 8 * n, n), np.uint8)
        return [None if z else x for x, z in zip(ids.tolist(), null)], np.frombuffer(self._read(self.docs_at + 9 * n, 8 * (n + 1)), "<u8").astype(np.int64)

    def close(self) -> None:
        self.file.close()


# ------------------------------------------------------------------ encoding
class Encoder:
    """The library's ids of whole texts, by their chunks between ASCII white space.

    The tokenizers that this is for drop white space, and neither their
    normalisation nor their words reach over it, so a text's ids are those of
    its chunks one after the other. A worker keeps the ids of many chunks. A
    chunk of visible ASCII needs no normalisation but lower case, and its words
    are plain: it is cut here, and the library's model alone encodes each
    distinct word. ``plain`` says whether the tokenizer is one for which that
    holds; all other chunks go through the whole library.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = Tokenizer(self.tokenizer.model)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        rules = json.loads(definition)
        self.plain = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER
        self.special = [x["content"] for x in rules["added_tokens"]]

    def _ids(self, tokenizer, parts: list[str], into: dict[str, bytes]) -> None:
        for i in range(0, len(parts), 8192):
            part = parts[i : i + 8192]
            got = tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, "<u4").tobytes()
            ends = (4 * np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(part) + 1))).tolist()
            into.update(zip(part, map(ids.__getitem__, map(slice, ends, ends[1:]))))

    def _learn(self, new: list[str]) -> None:
        letters, mixed, rest = [], [], []
        for c in new:
            if not (self.plain and VISIBLE(c)) or "<" in c and any(x in c for x in self.special):
                rest.append(c)
            elif c.isalpha():
                letters.append(c)
            else:
                mixed.append(c)
        lower, cut = list(map(str.lower, letters)), [WORDS(c.lower()) for c in mixed]
        if len(self.words) > CACHED:
            self.words.clear()
        self._ids(self.model, list(set(lower).union(*cut).difference(self.words)), self.words)
        word = self.words.__getitem__
        self.chunks.update(zip(letters, map(word, lower)))
        self.chunks.update(zip(mixed, [b"".join(map(word, own)) for own in cut]))
        self._ids(self.tokenizer, rest, self.chunks)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each text's ids start, and where the last one's end)."""
        texts = texts.fill_null("")
        if self.plain:  # texts of ASCII alone are lower-cased as the library does it, and so have fewer distinct chunks
            whole = pc.string_is_ascii(texts)
            for x in self.special:
                whole = pc.and_(whole, pc.invert(pc.match_substring(texts, x)))
            texts = pc.if_else(whole, pc.ascii_lower(texts), texts)
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        chunks, code = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        if len(self.chunks) + len(chunks) > CACHED:
            self.chunks.clear()
        self._learn([c for c in chunks if c not in self.chunks])
        own = list(map(self.chunks.__getitem__, chunks))
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        start, long = (np.cumsum(size) - size)[code], size[code]
        ends = np.append(0, np.cumsum(long))
        ids = np.frombuffer(b"".join(own), "<u4")[np.repeat(start - ends[:-1], long) + np.arange(ends[-1])]
        return ids, ends[cut.offsets.to_numpy()]


@lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


def encoded(batches: Iterator[pa.RecordBatch], encode, end_id: int, group_bytes: int) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, ids, numbers of ids) of some rows at a time, in order; each row's ids end with ``end_id``."""
    for b in batches:
        at = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)) // group_bytes
        cuts = [*np.flatnonzero(np.diff(at, prepend=-1)).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            ids, ends = encode(b.column("text").slice(i, j - i))
            yield b.column("doc_id").slice(i, j - i).to_pylist(), np.insert(ids, ends[1:], end_id), np.diff(ends) + 1


# ------------------------------------------------------------------ jobs
def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode and write all documents; returns the manifest (part, seq, path, n_docs, n_tokens), a row a file.

    ``tokenizer`` is the path of a definition of the tokenizers library; it
    goes to the tasks with the job (its size is the vocabulary's). Files are
    in ascending doc_id order by (part, seq), NULL ids last; texts of one id
    are in the order of their hash. Equal keys spread over parts as any other,
    so no id is a hot group. A task that runs again writes the same files
    again, each under its own name first.
    """
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encode = encoder(definition.value).encode
        doc_ids, sizes, held, tokens = [], [], [], 0

        def close() -> pa.RecordBatch:
            system, top = storage(folder)
            system.create_dir(top, recursive=True)
            name, own = f"part-{part:06d}-{seq:04d}.tok", f"{top}/_{uuid.uuid4().hex}"
            with system.open_output_stream(own) as f:
                f.write(file_bytes(doc_ids, np.concatenate(sizes), np.concatenate(held)))
            system.move(own, f"{top}/{name}")
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [f"{folder}/{name}"],
                "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64())})

        for ids_of, ids, size in encoded(batches, encode, end_id, min(GROUP_BYTES, 4 * file_tokens)):
            doc_ids += ids_of
            held.append(ids)
            sizes.append(size)
            tokens += len(ids)
            if tokens >= file_tokens:
                yield close()
                doc_ids, sizes, held, tokens, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield close()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_last("doc_id"), F.asc("h"), F.asc("row")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(ranged.select("doc_id", "text").mapInArrow(write, MANIFEST))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before; the sums over the files
    are taken over the manifest, which has one row for millions of tokens.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                f = TokenFile(path)
                doc_ids, first = f.documents()
                crcs = np.zeros(len(doc_ids), np.int64)
                i = 0
                while i < len(doc_ids):  # documents of READ_TOKENS together; a longer one by pieces
                    j = max(i + 1, int(np.searchsorted(first, first[i] + READ_TOKENS, "right")) - 1)
                    if j == i + 1:
                        for a in range(int(first[i]), int(first[j]), READ_TOKENS):
                            crcs[i] = zlib.crc32(f.tokens(a, min(a + READ_TOKENS, int(first[j]))).astype("<u4").tobytes(), int(crcs[i]))
                    else:
                        got = f.tokens(int(first[i]), int(first[j])).astype("<u4")
                        for k in range(i, j):
                            crcs[k] = zlib.crc32(got[first[k] - first[i] : first[k + 1] - first[i]].tobytes())
                    i = j
                f.close()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(first[:-1] + base),
                    "n_tokens": pa.array(np.diff(first)), "ids_crc32": pa.array(crcs)})

    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return files.repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_codes(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the documents' ids to files and read them back: (doc_id, start, n_tokens, ids_crc32).

    Each document's ids are followed by ``end_id``, which counts in n_tokens
    and in the crc32 of the ids as little-endian unsigned 32-bit integers. A
    NULL or empty text has the end id only. Every row is a document of its
    own, repeated rows and NULL ids too (these come last). An empty table
    writes no file and gives no rows. Other columns are not read.
    """
    return read_token_files(write_token_files(docs, tokenizer, end_id))
