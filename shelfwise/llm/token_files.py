"""Token ids of documents in compressed segments that decode in parallel.

A segment holds whole documents in order. Layout, little-endian: the header (magic, lanes, documents, tokens, symbols,
blocks, tokens of a block, crc32 of the rest), then doc ids (int64), which of them are null (uint8), tokens of each document (uint64), the
frequency table that the segment's blocks share (symbols, frequencies: uint32), the checkpoints (for each block its first
token and byte offset: uint64; tokens and crc32 of its ids: uint32), and the blocks. All but the blocks is deflated.
Segments are rows of a Parquet table (file_no, seg_no, n_docs, n_tokens, first_token, data), so Spark's committer keeps
them whole when a task is repeated.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.rans import Table
from shelfwise.llm.words import kept
from shelfwise.llm.workspace import new_path, small_batches

MAGIC, HEADER = b"SWTK0001", struct.Struct("<8sIQQIIII")
CHECKPOINT = np.dtype([("first", "<u8"), ("offset", "<u8"), ("n", "<u4"), ("crc", "<u4")])
#: A space before white or the end, which a split at spaces gets wrong: such texts are encoded whole.
ODD = re.compile(r" (?=\s|\Z)")
#: A space between characters that aren't white starts a new piece; a part of an odd text has at least PART characters.
SINGLE, PART = re.compile(r"(?<=\S) (?=\S)"), 1 << 16
PUNCTUATION = ".,;:!?%$*#&|()\""
SEGMENTS = "file_no int, seg_no int, n_docs long, n_tokens long, first_token long, data binary"


def gathered(pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of an array one after another."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Tokens:
    """Texts to ids by the tokenizers library, each distinct word once while it is remembered.

    The tokenizer's pattern starts a new piece at every space before a character that isn't white, and pieces are encoded
    apart, so a text's ids are those of its parts at such spaces. Special tokens hold no space. New words are joined again
    and encoded together; the ids are parted by the lengths in bytes of their tokens. Words are held in Arrow and their ids in
    one array, so that no step but the tokenizer's goes word by word; beyond about `most` bytes of them only those of the
    latest texts stay.
    """

    def __init__(self, path: str, most: int = 40 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype(np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32)
        special = {i: len(t.content.encode()) for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # in a byte-level vocabulary a character stands for a byte
            self._bytes[i] = special.get(i, len(token))
        self._most = most
        # words as they stand after a space, and their ids: those of word i end at ends[i]
        self._known, self._pool, self._ends = pa.array([""], pa.large_string()), np.empty(0, self.dtype), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _after_space(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each word as it stands after a space, one after another, and how many each has."""
        ids, sizes = [], []
        for low in range(0, len(words), 5_000):
            part = words[low : low + 5_000]
            (got,) = self._ids([" " + " ".join(part.to_pylist())])
            ends, reached = np.cumsum(pc.binary_length(part).to_numpy() + 1), np.cumsum(self._bytes[got])
            at = np.searchsorted(reached, ends) + 1
            if at[-1] != len(got) or (reached[at - 1] != ends).any():
                raise ValueError("the tokenizer isn't byte-level, or doesn't part words at spaces")
            ids.append(got)
            sizes.append(np.diff(at, prepend=0))
        return np.concatenate(ids or [self._pool[:0]]), np.concatenate(sizes or [self._ends[:0]])

    def _learn(self, words: pa.Array) -> np.ndarray:
        """The place of each of some distinct words among those that are known; new ones are known from here on."""
        if self._known.nbytes + self._pool.nbytes + self._ends.nbytes > self._most:
            kept = pc.unique(pc.index_in(words, self._known).drop_null()).to_numpy()
            kept = np.concatenate(([0], kept[kept > 0]))  # the empty word stays first
            sizes = np.diff(self._ends, prepend=0)
            self._pool, self._known = gathered(self._pool, self._ends[kept] - sizes[kept], sizes[kept]), self._known.take(pa.array(kept))
            self._ends = np.cumsum(sizes[kept])
        found = pc.index_in(words, self._known)
        new = words.filter(found.is_null())
        if len(new):
            ids, sizes = self._after_space(new)
            self._ends = np.concatenate((self._ends, len(self._pool) + np.cumsum(sizes)))
            self._pool, places = np.concatenate((self._pool, ids)), found.fill_null(-1).to_numpy().astype(np.int64)
            places[places < 0] = len(self._known) + np.arange(len(new))
            self._known = pa.concat_arrays([self._known, new])
            return places
        return found.to_numpy().astype(np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words as they stand after a space, one after another, and how many each has.

        Punctuation after a letter or digit is a piece of its own: a word's ids are those of its core and of its tail.
        """
        cores = pc.utf8_rtrim(words, PUNCTUATION)
        last = pc.utf8_slice_codeunits(cores, -1).dictionary_encode()
        plain = np.array([c.isalnum() for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
        cores = pc.if_else(pa.array(plain), cores, words).dictionary_encode()
        places = self._learn(cores.dictionary)[cores.indices.to_numpy()]
        cut = pc.binary_length(words).to_numpy() - pc.binary_length(cores.dictionary).to_numpy()[cores.indices.to_numpy()]
        tailed = np.flatnonzero(cut)
        texts = [w[-n:] for w, n in zip(words.take(pa.array(tailed)).to_pylist(), cut[tailed].tolist(), strict=True)]
        tails = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        encoded = self._ids(list(tails))
        tail_sizes = np.array([len(x) for x in encoded], np.int64)
        tail_begins = len(self._pool) + np.cumsum(tail_sizes) - tail_sizes
        # two stretches of the pool a word: its core's and its tail's
        begins, sizes = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        known = np.diff(self._ends, prepend=0)
        sizes[:, 0] = known[places]
        begins[:, 0] = self._ends[places] - sizes[:, 0]
        kind = np.array([tails[t] for t in texts], np.int64)
        begins[tailed, 1], sizes[tailed, 1] = tail_begins[kind], tail_sizes[kind]
        return gathered(np.concatenate((self._pool, *encoded)), begins.ravel(), sizes.ravel()), sizes.sum(axis=1)

    def _whole(self, text: str) -> np.ndarray:
        """The ids of a text with white space that a split at spaces gets wrong; long ones in parts, cut before single spaces."""
        cuts, low = [0], 0
        while low + PART < len(text):
            m = SINGLE.search(text, low + PART)
            if not m:
                break
            low = m.start()
            cuts.append(low)
        parts = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
        return np.concatenate([ids for p in parts for ids in self._ids([p])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        odd = {i: t for i, t in enumerate(texts) if ODD.search(t)}
        lists = pc.split_pattern(pa.array([t if i not in odd else "" for i, t in enumerate(texts)], pa.large_string()), " ")
        starts, flat = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        words, at = flat.dictionary, flat.indices.to_numpy()
        # the ids of all words one after another, then of each place its word's, none for the first of a text
        ids, size = self._words(words)
        n = size[at]
        n[starts[:-1]] = 0
        ids, ends = gathered(ids, (np.cumsum(size) - size)[at], n), np.cumsum(n)
        first = words.take(pa.array(at[starts[:-1]])).to_pylist()
        heads = self._ids(["" if i in odd else w for i, w in enumerate(first)])
        for i, t in odd.items():
            heads[i] = self._whole(t)
        cuts = ends[starts[1:] - 1]
        return [np.concatenate((h, x)) for h, x in zip(heads, np.split(ids, cuts[:-1]), strict=True)]


def pack(doc_ids: list[int | None], ids: list[np.ndarray], lanes: int = 1024, block: int = 1 << 18) -> bytes:
    """One segment of whole documents."""
    flat = np.concatenate(ids).astype(np.uint32) if ids else np.empty(0, np.uint32)
    lanes = max(1, min(lanes, len(flat) // 64))
    table, blocks, points, offset = Table.of(flat), [], [], 0
    for low in range(0, len(flat), block):
        part = flat[low : low + block]
        blocks.append(table.encode(part, lanes))
        points.append((low, offset, len(part), zlib.crc32(part.tobytes())))
        offset += len(blocks[-1])
    head = zlib.compress(
        np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is None for x in doc_ids], np.uint8).tobytes()
        + np.array([len(x) for x in ids], "<u8").tobytes() + table.symbols.tobytes() + table.freqs.tobytes()
        + np.array(points, CHECKPOINT).tobytes(), 6,
    )
    rest = struct.pack("<Q", len(head)) + head + b"".join(blocks)
    return HEADER.pack(MAGIC, lanes, len(ids), len(flat), len(table.symbols), len(blocks), block, zlib.crc32(rest)) + rest


def unpack(data: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """The documents of a segment; raises ValueError if any checksum fails."""
    magic, lanes, n_docs, n_tokens, n_symbols, n_blocks, _, crc = HEADER.unpack_from(data)
    if magic != MAGIC or zlib.crc32(memoryview(data)[HEADER.size :]) != crc:
        raise ValueError("damaged segment")
    (size,) = struct.unpack_from("<Q", data, HEADER.size)
    begin = HEADER.size + 8
    head, at = zlib.decompress(memoryview(data)[begin : begin + size]), 0

    def take(dtype: str | np.dtype, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(head, dtype, n, at)
        at += got.nbytes
        return got

    doc_ids, null, lengths = take("<i8", n_docs), take(np.uint8, n_docs), take("<u8", n_docs)
    table, points = Table(take("<u4", n_symbols), take("<u4", n_symbols)), take(CHECKPOINT, n_blocks)
    body = memoryview(data)[begin + size :]
    ends = [*points["offset"][1:].tolist(), len(body)][: len(points)]
    out = []
    for point, end in zip(points, ends, strict=True):
        ids = table.decode(bytes(body[int(point["offset"]) : end]), int(point["n"]), lanes)
        if zlib.crc32(ids.tobytes()) != point["crc"]:
            raise ValueError("damaged block")
        out.append(ids)
    flat = np.concatenate(out) if out else np.empty(0, np.uint32)
    if len(flat) != n_tokens:
        raise ValueError("damaged segment")
    cuts = np.cumsum(lengths.astype(np.int64))
    return [None if n else int(i) for i, n in zip(doc_ids, null, strict=True)], np.split(flat, cuts[:-1]) if n_docs else []


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    segment_tokens: int = 1 << 20,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> str:
    """Encodes every whole text, adds end_id to each document, writes segments in ascending order of id; returns the path.

    Rows are dealt by ranges of id, and within an id by a hash of the text, so that an id on many rows is spread; rows
    alike in both, whose order can't be told, are spread by their place in the input. Null texts are empty (their document is end_id alone), null
    ids come first, rows that are repeated are documents of their own. An empty table writes no segment. A segment is
    closed once it has segment_tokens tokens, so only a longer document makes a larger one.
    """
    path = path or new_path(docs.sparkSession, "tokens")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, file_no = kept(f"tokens {tokenizer}", lambda: Tokens(tokenizer)), TaskContext.get().partitionId()
        seg_no = first = held = 0
        names: list[int | None] = []
        ids: list[np.ndarray] = []

        def segment() -> pd.DataFrame:
            nonlocal seg_no, first, held
            row = (file_no, seg_no, len(names), held, first, pack(names, ids))
            seg_no, first, held = seg_no + 1, first + held, 0
            names.clear()
            ids.clear()
            return pd.DataFrame([row], columns=["file_no", "seg_no", "n_docs", "n_tokens", "first_token", "data"])

        end = np.array([end_id], tokens.dtype)
        for batch in batches:
            most = max(1, (1 << 22) * len(batch) // max(1, int(batch["text"].str.len().sum())))
            for low in range(0, len(batch), most):
                part = batch.iloc[low : low + most]
                texts = list(part["text"])
                for name, got in zip(part["id"], tokens.encode(texts), strict=True):
                    names.append(None if pd.isna(name) else int(name))
                    ids.append(np.concatenate((got, end)))
                    held += len(ids[-1])
                    if held >= segment_tokens:
                        yield segment()
        if names:
            yield segment()

    # ids go as text: pandas would turn longs with nulls into doubles
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("n"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["n", F.xxhash64("text"), "place"]
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(F.col("n").cast("string").alias("id"), "text")
    rows.mapInPandas(encode, SEGMENTS).write.option("compression", "none").parquet(path)
    return path


def read_token_files(spark, path: str) -> DataFrame:
    """doc_id, file_no, first (its first token's place in the file), n_tokens, ids_crc32 (of its ids as uint32) of what was written."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_no, first_token, data in zip(batch["file_no"], batch["first_token"], batch["data"], strict=True):
                names, ids = unpack(data)
                n = np.array([len(x) for x in ids], np.int64)
                yield pd.DataFrame({
                    "doc_id": pd.array(names, "Int64"), "file_no": file_no, "first": first_token + np.cumsum(n) - n,
                    "n_tokens": n, "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids],
                })

    small_batches(spark)
    segments = spark.read.schema(SEGMENTS).parquet(path).select("file_no", "first_token", "data")
    return segments.mapInPandas(decode, "doc_id long, file_no int, first long, n_tokens long, ids_crc32 long")


def token_index(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of what was written.

    The offsets of files come from their token counts: one row for each file.
    """
    files = spark.read.schema(SEGMENTS).parquet(path).groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file_no", F.coalesce(before, F.lit(0)).alias("before"))
    docs = read_token_files(spark, path).join(files, "file_no")
    return docs.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
