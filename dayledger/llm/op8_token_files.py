"""Token files: ids of all documents in ascending doc_id order, in patched
frame-of-reference blocks.

Format. A row of the Parquet files is one chunk: whole documents, in order,
together at least ``chunk_ids`` ids where there are so many (a long document is
a chunk of its own). ``part`` and ``chunk`` order the chunks, ``first`` is the
chunk's first id position in its part, ``doc_ids`` and ``doc_lens`` list its
documents. ``block_starts`` indexes the blocks in ``payload``: the byte where
each block of 128 ids starts (the last may be shorter). A block holds, little
endian: its minimum (uint32), the bit width b (uint8) and the number of
exceptions (uint8); the ids less the minimum, low b bits each, packed without
gaps; the exceptions' positions (uint8 each) and their bits beyond b (uint32
each). b is the width that ``percentile`` of the block's values fit in.

A part is one range of doc_ids, so positions over all documents are the
position in the part plus the ids of the parts before it: a sum over one row a
part. Files are written and read by Spark's Parquet committer and reader, so a
task that is run again writes its part again and never twice.

Defined cases: a null text is empty, so it has the end id alone; null doc_ids
come first; rows of one doc_id come in the order of their texts; an empty table
writes no chunks; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
import string
from collections.abc import Iterator
from itertools import pairwise
from struct import pack as pack_ids

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, new_path, slices, table, worker_cache
from dayledger.llm.pretokens import LETTERS, PLAIN, WORD_PATTERN, Bounded, byte_alphabet, chunks, numbered, specials, sums
from dayledger.llm.textops import ragged, utf8

BLOCK = 128
SLICE = 8 << 20
#: Pre-tokens in one call of the library.
TOGETHER = 20_000
MARKS = string.punctuation
CHUNK = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())),
    ("block_starts", pa.list_(pa.int64())), ("payload", pa.binary())])
CHUNK_DDL = ("part int, chunk int, first long, n_ids long, doc_ids array<long>, doc_lens array<long>, "
             "block_starts array<long>, payload binary")


def little(ids: list[int]) -> bytes:
    """Ids as little-endian uint32."""
    return pack_ids(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of texts as the tokenizers library gives them, with a bounded memory
    of pre-tokens."""

    def __init__(self, path: str, entries: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.byte_char = str.maketrans(dict(enumerate(byte_alphabet())))
        # the same model over pre-tokens that are already cut, one a line
        self.lines = Tokenizer(self.library.model)
        self.lines.pre_tokenizer = WhitespaceSplit()
        self.line_char = self.byte_char | {10: "\n"}
        suffix, vocabulary = self.library.model.end_of_word_suffix, self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        added = [t for t, _ in specials(path)]
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        # a piece of letters alone is one pre-token, unless a special string is letters alone;
        # marks that follow the letters are another, unless one is letters and such marks
        self.plain_words = not any(t.isalpha() for t in added)
        self.plain_ends = not any(re.fullmatch(f"[{LETTERS}]*[{re.escape(MARKS)}]*", t) for t in added)
        self.cache = Bounded(entries)
        self.known = Bounded(entries // 2)

    def pretoken(self, p: str) -> bytes:
        """Little-endian uint32 ids of one lower-case pre-token."""
        if (ids := self.cache.get(p)) is None:
            mapped = p.encode("utf-8").decode("latin-1").translate(self.byte_char)
            ids = self.cache.put(p, little([t.id for t in self.library.model.tokenize(mapped)]))
        return ids

    def piece(self, text: str) -> bytes:
        """Little-endian uint32 ids of a piece that is not yet known."""
        if self.plain_words and text.isascii() and text.isalpha():
            ids = self.pretoken(text.lower())
        elif PLAIN(text) and not self.special(text):
            get = self.cache.get
            ids = b"".join([get(p) or self.pretoken(p) for p in WORD_PATTERN.findall(text.lower())])
        else:
            ids = little(self.library.encode(text, add_special_tokens=False).ids)
        return self.known.put(text, ids)

    def together(self, words: list[str]) -> list[bytes]:
        """``pretoken`` of each of the distinct words; the library is asked once for all new ones."""
        coded = list(map(self.cache.get, words))
        at = [i for i, ids in enumerate(coded) if ids is None]
        for part in chunks(at, TOGETHER):
            new = [words[i] for i in part]
            mapped = "\n".join(new).encode("utf-8").decode("latin-1").translate(self.line_char)
            ids = np.array(self.lines.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(new):
                raw = ids.tobytes()
                for i, (a, b) in zip(part, pairwise([0, *(4 * ends).tolist()]), strict=True):
                    coded[i] = self.cache.put(words[i], raw[a:b])
            else:  # a vocabulary that doesn't mark where a word ends
                for i in part:
                    coded[i] = self.pretoken(words[i])
        return coded

    def distinct(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct pieces one after the other, and the ids of each
        piece. Pieces of plain letters and marks that may follow them share
        their words: each word is looked up once, in whatever case and before
        whatever marks it stands."""
        word = pc.ascii_rtrim(found, MARKS)
        simple = np.asarray(pc.match_substring_regex(word, f"^[{LETTERS}]+$")) & self.plain_ends
        lone = np.flatnonzero(~simple)
        known, piece = self.known.get, self.piece
        coded = [known(p) or piece(p) for p in found.take(pa.array(lone)).to_pylist()]
        units = np.zeros((len(found), 2), np.int64)  # numbers of a piece's one or two units; 0: none
        units[lone, 0] = 1 + np.arange(len(lone))
        raw, offs = utf8(found)
        size, marks = np.diff(offs), np.asarray(pc.binary_length(found)) - np.asarray(pc.binary_length(word))
        tail = np.flatnonzero(simple & (marks > 0))
        ends = np.concatenate([[0], np.cumsum(marks[tail])])
        cut = pa.LargeStringArray.from_buffers(len(tail), pa.py_buffer(ends.astype(np.int64)),
                                               pa.py_buffer(ragged(raw, (offs[:-1] + size - marks)[tail], marks[tail]).tobytes()))
        for column, at, strings in ((0, np.flatnonzero(simple), pc.utf8_lower(word.filter(pa.array(simple)))), (1, tail, cut)):
            number = strings.dictionary_encode()
            units[at, column] = 1 + len(coded) + np.asarray(number.indices)
            coded += self.together(number.dictionary.to_numpy(zero_copy_only=False).tolist())
        lens = np.fromiter(map(len, [b"", *coded]), np.int64, 1 + len(coded)) // 4
        starts = np.cumsum(lens) - lens
        each = lens[units]
        return ragged(np.frombuffer(b"".join(coded), "<u4"), starts[units].ravel(), each.ravel()), each.sum(1)

    def texts(self, col: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the ids of each text."""
        found, index, offs = numbered(col, single_space=False)
        flat, lens = self.distinct(found)
        if end is not None:  # one more piece at each text's end
            flat, lens = np.append(flat, np.array([end], "<u4")), np.append(lens, 1)
            index = np.insert(index, offs[1:], len(found))
            offs = offs + np.arange(len(offs))
        starts = np.cumsum(lens) - lens
        return ragged(flat, starts[index], lens[index]), sums(lens[index], offs)


def pack(ids: np.ndarray, percentile: float = 0.95) -> tuple[np.ndarray, bytes]:
    """Block starts and payload of the ids (format: see the module text)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64), b""
    short = -n % BLOCK
    rows = np.concatenate([ids, np.full(short, ids[-1], ids.dtype)]).astype("<u4").reshape(-1, BLOCK)
    least = rows.min(1)
    rows = rows - least[:, None]
    bits = np.frexp(rows.astype(np.float64))[1].astype(np.uint8)  # the bits that each value needs
    place = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.partition(bits, place, axis=1)[:, place]
    blocks: list[bytes] = [b""] * len(rows)
    for b in np.unique(width).tolist():
        at = np.flatnonzero(width == b)
        part = rows[at]
        each = np.unpackbits(part.view(np.uint8).reshape(len(at), BLOCK, 4), axis=2, count=b, bitorder="little")
        low = np.packbits(each.reshape(len(at), -1), axis=1, bitorder="little")
        over = (part.astype(np.uint64) >> np.uint64(b)).astype("<u4")
        odd, where = np.nonzero(over)
        ends = np.searchsorted(odd, np.arange(len(at) + 1))
        for i, block in enumerate(at.tolist()):
            out = where[ends[i]:ends[i + 1]]
            count = BLOCK
            if short and block == len(rows) - 1:
                count -= short
                out = out[out < count]
            blocks[block] = (int(least[block]).to_bytes(4, "little") + bytes([b, len(out)])
                             + low[i, :(count * b + 7) // 8].tobytes()
                             + out.astype(np.uint8).tobytes() + over[i, out].astype("<u4").tobytes())
    starts = np.cumsum([0, *map(len, blocks[:-1])])
    return starts.astype(np.int64), b"".join(blocks)


def unpack(payload: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The n ids of a payload."""
    raw = np.frombuffer(payload, np.uint8)
    starts = np.asarray(starts, dtype=np.int64)
    out = np.zeros(len(starts) * BLOCK, np.int64)
    rows = out.reshape(-1, BLOCK)
    if not n:
        return out[:0].astype("<u4")
    count = np.full(len(starts), BLOCK)
    count[-1] = n - BLOCK * (len(starts) - 1)
    least = raw[starts[:, None] + np.arange(4)].astype(np.int64) @ (1 << (8 * np.arange(4)))
    width, odd = raw[starts + 4].astype(np.int64), raw[starts + 5].astype(np.int64)
    size = (count * width + 7) // 8
    for b in np.unique(width[width > 0]).tolist():
        for full in (True, False):
            at = np.flatnonzero((width == b) & ((count == BLOCK) == full))
            if not len(at):
                continue
            m = int(count[at[0]])
            packed = raw[(starts[at] + 6)[:, None] + np.arange(int(size[at[0]]))]
            each = np.zeros((len(at), m, 32), np.uint8)
            each[:, :, :b] = np.unpackbits(packed, axis=1, bitorder="little", count=m * b).reshape(len(at), m, b)
            rows[at, :m] = np.packbits(each, axis=2, bitorder="little").view("<u4")[:, :, 0]
    where = starts + 6 + size
    pos = ragged(raw, where, odd).astype(np.int64)
    block = np.repeat(np.arange(len(starts)), odd)
    high = ragged(raw, where + odd, 4 * odd).reshape(-1, 4).astype(np.int64) @ (1 << (8 * np.arange(4)))
    rows[block, pos] += high << width[block]
    rows += least[:, None]
    return out[:n].astype("<u4")


def _write(path: str, cache: int, end: int | None, chunk_ids: int, percentile: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"encoder:{path}:{cache}", lambda: Encoder(path, cache))
        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            nonlocal chunk, first
            ids = np.concatenate([x[2] for x in held])
            starts, payload = pack(ids, percentile)
            row = batch_of(CHUNK, part=[part], chunk=[chunk], first=[first], n_ids=[len(ids)],
                           doc_ids=[[d for x in held for d in x[0]]], doc_lens=[np.concatenate([x[1] for x in held]).tolist()],
                           block_starts=[starts.tolist()], payload=[payload])
            chunk, first = chunk + 1, first + len(ids)
            held.clear()
            return row

        for rows, col in slices(batches, "text", SLICE):
            ids, lens = encoder.texts(col, end)
            docs, ends = rows.column("doc_id").to_pylist(), np.cumsum(lens)
            at = 0
            while at < len(docs):
                before = ends[at] - lens[at]
                want = before + chunk_ids - sum(len(x[2]) for x in held)
                to = min(len(docs), int(np.searchsorted(ends, want, side="left")) + 1)
                held.append((docs[at:to], lens[at:to], ids[before:ends[to - 1]]))
                if sum(len(x[2]) for x in held) >= chunk_ids:
                    yield out()
                at = to
        if held:
            yield out()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int | None = 1, chunk_ids: int = 1 << 16,
                      percentile: float = 0.95, cache_entries: int = 400_000) -> None:
    """Encode ``docs`` (doc_id, text) and write the chunks under ``path``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    (rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_write(tokenizer, cache_entries, end, chunk_ids, percentile), CHUNK_DDL)
     .write.option("compression", "zstd").parquet(path))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            n = row["n_ids"].as_py()
            ids = unpack(row["payload"].as_py(), np.asarray(row["block_starts"].values), n)
            lens = np.asarray(row["doc_lens"].values, dtype=np.int64)
            ends = np.cumsum(lens)
            yield batch_of(schema, part=[row["part"].as_py()] * len(lens), doc_id=row["doc_ids"].values,
                           at=row["first"].as_py() + ends - lens, n_tokens=lens,
                           ids_crc32=[zlib.crc32(ids[b - k:b]) for b, k in zip(ends.tolist(), lens.tolist(), strict=True)])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    each document, decoded from the files."""
    chunks = spark.read.schema(CHUNK_DDL).parquet(path)
    sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    docs = chunks.mapInArrow(_read, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document (each with id 1 at its end), read them back."""
    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)
