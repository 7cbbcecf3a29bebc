"""BPE encoding and decoding by a pair occurrence index.

The pre-tokens of a partition that are not yet known are laid out as one symbol
sequence with links to the left and right neighbour inside a pre-token. The
index maps each mergeable pair (by its rank) to all its positions. The active
ranks are applied in ascending order: a rank's positions are merged from left to
right, and each merge enters the pairs that it makes with its neighbours in
their lists, which may activate further ranks. A position whose pair has gone
meanwhile is passed over, so the lists need no deletion.

Ranks in ascending order give each pre-token what the usual loop (lowest rank
first, leftmost first) gives, provided a pair that holds a merged symbol ranks
after the merge that makes the symbol. That holds for vocabularies whose merges
were learnt in order; it is checked when the file is loaded.

Decoding looks each id's token up and joins the tokens by single spaces, which
is what a tokenizer file without a decoder asks for.

Rules read from the file's public format: normalisation to NFC, white space to
one space, lower case; the special strings first; pre-tokens by the pattern;
bytes as characters; ``</w>`` at the end of a pre-token.

Defined cases: a null text is empty (no ids, empty decoded text); repeated rows
and null ids give a row each; an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, slices, table, worker_cache
from dayledger.llm.pretokens import CONTRACTIONS, PLAIN, WORD_PATTERN, Bounded, byte_alphabet, chunks, pieces, specials

SLICE = 8 << 20
#: Unicode's White_Space characters (the \s of the pattern).
SPACES = "\t-\r \x85\xa0  -     　"
ANY_PATTERN = regex.compile(rf"{CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+")
ANY_SPACE = regex.compile(f"[{SPACES}]+")


class Vocabulary:
    """Token ids, merge ranks and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = specials(path)
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special}
        self.byte_id = [ids[c] for c in byte_alphabet()]
        self.last_id = [ids[c + self.suffix] for c in byte_alphabet()]
        self.rank: dict[tuple[int, int], int] = {}
        self.pairs: list[tuple[int, int]] = []
        self.made: list[int] = []
        born: dict[int, int] = {}
        for n, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = ids[a], ids[b], ids[a + b]
            if max(born.get(x, -1), born.get(y, -1)) >= n:
                raise ValueError(f"merge {n} is older than a symbol that it holds")
            self.rank.setdefault((x, y), n)
            self.pairs.append((x, y))
            self.made.append(z)
            if born.setdefault(z, n) != n:
                raise ValueError(f"merges {born[z]} and {n} make the same symbol")

    def encode_units(self, units: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token (its UTF-8 bytes, not empty), over one index."""
        symbol: list[int] = []
        right: list[int] = []
        left: list[int] = []
        first: list[int] = []
        where: dict[int, list[int]] = {}
        rank, made, pairs = self.rank, self.made, self.pairs
        for unit in units:
            at = len(symbol)
            first.append(at)
            symbol += [self.byte_id[b] for b in unit[:-1]]
            symbol.append(self.last_id[unit[-1]])
            end = len(symbol)
            left += [-1, *range(at, end - 1)]
            right += [*range(at + 1, end), -1]
            for i in range(at, end - 1):
                r = rank.get((symbol[i], symbol[i + 1]))
                if r is not None:
                    where.setdefault(r, []).append(i)
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            spots = where.pop(r)
            spots.sort()
            new, (a, b) = made[r], pairs[r]
            for i in spots:
                j = right[i]
                if symbol[i] != a or j < 0 or symbol[j] != b:
                    continue
                symbol[i], symbol[j] = new, -1
                k = right[i] = right[j]
                h = left[i]
                if k >= 0:
                    left[k] = i
                    x = rank.get((new, symbol[k]))
                    if x is not None:
                        if x not in where:
                            where[x] = []
                            heapq.heappush(active, x)
                        where[x].append(i)
                if h >= 0:
                    x = rank.get((symbol[h], new))
                    if x is not None:
                        if x not in where:
                            where[x] = []
                            heapq.heappush(active, x)
                        where[x].append(h)
        out = []
        for i in first:
            unit_ids = []
            while i >= 0:
                unit_ids.append(symbol[i])
                i = right[i]
            out.append(unit_ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.token.__getitem__, ids))


class Codec:
    """Vocabulary with a bounded memory of pre-tokens: (ids, decoded text)."""

    def __init__(self, path: str, entries: int):
        self.vocabulary = Vocabulary(path)
        self.cache = Bounded(entries)
        self.special = dict(self.vocabulary.special)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens of a piece; special strings stand for themselves, marked by
        a leading white space character (which no pre-token has)."""
        out: list[str] = []
        plain = PLAIN(text) is not None
        for part in self.cut.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(" " + part)
            elif plain:
                out += WORD_PATTERN.findall(part.lower())
            else:
                part = ANY_SPACE.sub(" ", unicodedata.normalize("NFC", part))
                out += ANY_PATTERN.findall("".join([c.lower() for c in part]))
        return out

    def learn(self, units: set[str], unit_chunk: int = 20_000) -> dict[str, tuple[bytes, bytes]]:
        """Ids and decoded text of each unit."""
        v, known = self.vocabulary, {}
        for p in (u for u in units if u[0] == " "):
            i = self.special[p[1:]]
            known[p] = (np.array([i], "<u4").tobytes(), v.token[i].encode("utf-8"))
        for part in chunks(sorted(u for u in units if u[0] != " "), unit_chunk):
            for p, ids in zip(part, v.encode_units([p.encode("utf-8") for p in part]), strict=True):
                known[p] = (np.array(ids, "<u4").tobytes(), v.decode(ids).encode("utf-8"))
        return known

    def pieces(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids and decoded text of each piece."""
        cut = list(map(self.pretokens, texts))
        cache = self.cache
        fresh = self.learn({p for units in cut for p in units if p not in cache})
        out = []
        for units in cut:
            got = [cache.get(p) or fresh[p] for p in units]
            out.append(got[0] if len(got) == 1 else (b"".join([g[0] for g in got]), b" ".join([g[1] for g in got])))
        for p, value in fresh.items():
            cache.put(p, value)
        return out


def _codec(path: str, entries: int) -> Codec:
    return worker_cache(f"codec:{path}:{entries}", lambda: Codec(path, entries))


def _texts(codec: Codec, col: pa.Array) -> Iterator[tuple[bytes, bytes]]:
    """Ids (little-endian uint32) and decoded text (UTF-8) of each text."""
    distinct, index, offs = pieces(col, single_space=False)
    coded = codec.pieces(distinct)
    ids, texts = [c[0] for c in coded], [c[1] for c in coded]
    some = np.fromiter(map(bool, ids), bool, len(ids))
    index, bounds, keep = index.tolist(), offs.tolist(), bool(some.all())
    for a, b in zip(bounds, bounds[1:], strict=False):
        at = index[a:b] if keep else [i for i in index[a:b] if ids[i]]
        yield b"".join([ids[i] for i in at]), b" ".join([texts[i] for i in at])


def _digests(path: str, entries: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, entries)
        for rows, col in slices(batches, "text", SLICE):
            found = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(t).hexdigest()) for i, t in _texts(codec, col)]
            n, a, b = zip(*found, strict=True)
            yield batch_of(schema, doc_id=rows.column("doc_id"), n_tokens=n, ids_sha256=a, decoded_sha256=b)

    return run


def _full(path: str, entries: int, text: bool):
    last = ("decoded", pa.string()) if text else ("decoded_sha256", pa.string())
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, entries)
        for rows, col in slices(batches, "text", SLICE // 4):
            ids, texts = zip(*_texts(codec, col), strict=True)
            yield batch_of(schema, doc_id=rows.column("doc_id"), n_tokens=[len(i) // 4 for i in ids],
                           ids=[np.frombuffer(i, "<i4") for i in ids],
                           **{last[0]: [t.decode("utf-8") if text else hashlib.sha256(t).hexdigest() for t in texts]})

    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer: str, text: bool = True, cache_entries: int = 150_000) -> DataFrame:
    """doc_id, n_tokens, ids of each document, and what the ids give back: the
    decoded text, or its SHA-256 (``text`` False)."""
    return _rows(docs).mapInArrow(_full(tokenizer, cache_entries, text), "doc_id long, n_tokens long, ids array<int>, "
                                  + ("decoded string" if text else "decoded_sha256 string"))


def token_digests(docs: DataFrame, tokenizer: str, cache_entries: int = 150_000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    return _rows(docs).mapInArrow(_digests(tokenizer, cache_entries),
                                  "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the word vocabulary, and decoded again."""
    return token_digests(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
