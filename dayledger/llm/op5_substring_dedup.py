"""Repeated passages: words covered by a window of words that also starts in an
earlier document, found by compressed full-text indexes.

A window is ``window`` consecutive words. Each window's anchor is the smallest
hash among its short grams, so equal windows have equal anchors wherever they
occur; consecutive windows of one anchor form a segment. Shards are made by
anchor, so every place of a window's words is in one shard. Places of one content
in one document that follow each other within a window (a phrase said over and
over) are one place, from the first to the last: what is cut of them touches.

1. Each map task sends its segments' anchors, places and content hashes to the
   shards (packed arrays, no words). A shard keeps anchors of several documents
   and tells their contents apart by 64 bits of anchor and 64 of content; the
   smallest document of a content stands for its copies.
2. Those documents' words travel to the shards, one copy of each content. A
   shard builds an FM-index over them (wavelet matrix of the Burrows-Wheeler
   transform) and searches every window backward; windows whose matching
   statistic reaches ``window`` get the smallest document over their interval.
3. The answers go back to the places of the content in its first document (later
   copies are gone whole); spans of words are joined
   per document and cut from its text.

Skew: anchors of ``HOT`` segments or more are counted in bounded memory first;
their windows are dealt by their own hashes, so equal windows still meet and no
shard holds all contents of a common phrase.

Text moves only for documents that stand for a content, and for documents that
lose words; their ids are broadcast if at most ``small``, else joined. Copies of
a passage are one content in the index however many documents share it.

Defined cases: windows are judged on the input; a null or empty text has no
words; rows of one doc_id and text give equal rows; a document is earlier only
by a smaller doc_id, so rows of one id leave each other alone; a null doc_id
loses nothing and is no earlier document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.common import batch_of, most_frequent, slices, small_batches, table, written
from dayledger.llm.fmindex import FMIndex
from dayledger.llm.textops import FACTOR, gram_hashes, mix, ragged, row_of, utf8, word_hashes, words

SLICE = 4 << 20
GRAM = 3
#: Segments of one anchor from which its windows are dealt by their own hashes.
HOT = 20_000
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))


def content_hashes(h: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit hashes of the word runs h[start:start+n]."""
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), FACTOR, np.uint64)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h), INVERSE, np.uint64)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:-1])])
    return mix((total[start + n] - total[start]) * back[start] + n.astype(np.uint64))


def segments(col: pa.Array, window: int, hot: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Runs of consecutive windows with one anchor: row, first word in the row,
    windows, anchor, content hash and reach (see ``_chained``). Under the ``hot``
    anchors (ascending) each window is a segment of its own and its hash the anchor."""
    data, offs = utf8(col)
    starts, ends, counts = words(data, offs)
    h = word_hashes(data, starts, ends, lower=False)
    gram = min(GRAM, window)
    grams = gram_hashes(h, gram)
    width = window - gram + 1
    none = np.zeros(0, np.int64)
    if len(grams) < width:
        return dict(row=none, start=none, windows=none, anchor=none.view(np.uint64), content=none.view(np.uint64), reach=none)
    at = np.empty(len(grams) - width + 1, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    for lo in range(0, len(at), 1 << 18):
        at[lo:lo + (1 << 18)] = view[lo:lo + (1 << 18)].argmin(1)
    at += np.arange(len(at))
    row = row_of(counts)[:len(at)]
    whole = np.flatnonzero(np.arange(len(at)) + window <= counts[1:][row])
    at, row = at[whole], row[whole]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    split = np.zeros(len(at), bool)
    if hot is not None and len(hot):
        value = grams[at]
        split = hot[np.minimum(np.searchsorted(hot, value), len(hot) - 1)] == value
    first = np.flatnonzero(new | split)
    n = np.diff(np.append(first, len(at)))
    start = whole[first]
    anchor, content = grams[at[first]], content_hashes(h, start, n + window - 1)
    own = split[first]
    anchor[own] = mix(anchor[own] * FACTOR + content[own])
    return _chained(dict(row=row[first], start=start - counts[row[first]], windows=n, anchor=anchor, content=content), window)


def _chained(s: dict[str, np.ndarray], window: int) -> dict[str, np.ndarray]:
    """Segments (by row and start) with those of one row and content that start at
    most ``window`` words after each other as one: the first, and the words from
    its start to the last one's (``reach``)."""
    key = mix(s["anchor"] * FACTOR + s["content"]) * FACTOR + s["row"].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    link = np.zeros(len(key), bool)
    twice = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    one, two = order[twice], order[twice + 1]
    link[twice + 1] = (s["start"][two] - s["start"][one] <= window) & np.logical_and.reduce(
        [s[p][one] == s[p][two] for p in ("row", "anchor", "content", "windows")])
    head = np.flatnonzero(~link)
    first, last = order[head], order[np.append(head[1:], len(key))[:len(head)] - 1]
    back = np.argsort(first)
    first, last = first[back], last[back]
    return {p: v[first] for p, v in s.items()} | {"reach": s["start"][last] - s["start"][first]}


def _anchor_counts(window: int, per_task: int):
    """The most frequent anchors of each task's segments, in bounded memory."""
    schema = pa.schema([("s", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, col in slices(batches, "text", SLICE):
            values, n = np.unique(segments(col, window)["anchor"], return_counts=True)
            more = n > 1
            held, where = np.unique(np.concatenate([held, values[more]]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, n[more]]), minlength=len(held)).astype(np.int64)
            if len(held) > 8 * per_task:
                top = np.sort(np.argpartition(-times, 4 * per_task)[:4 * per_task])
                held, times = held[top], times[top]
        top = np.argsort(-times, kind="stable")[:per_task]
        yield batch_of(schema, s=held[top].view(np.int64), n=times[top])

    return run


def hot_anchors(docs: DataFrame, window: int, least: int, entries: int = 100_000) -> np.ndarray:
    """Anchors of ``least`` segments or more (the ``entries`` most frequent at
    most), ascending. They set how windows are dealt, no result."""
    counts = written(docs.select("text").mapInArrow(_anchor_counts(window, entries // 10), "s long, n long")
                     .groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "anchor-counts")
    return np.sort(np.asarray(most_frequent(counts, "n", entries).toArrow()["s"]).view(np.uint64))


RUN_PARTS = (("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("start", "<i4"), ("windows", "<i4"), ("reach", "<i4"))


def _runs(window: int, shards: int, hot):
    schema = pa.schema([("shard", pa.int32()), ("n", pa.int32()), *[(p, pa.binary()) for p, _ in RUN_PARTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for rows, col in slices(batches, "text", SLICE):
            s = segments(col, window, hot.value)
            doc = rows.column("doc_id")
            real = ~np.asarray(doc.is_null())[s["row"]]
            s["doc"] = np.asarray(doc.fill_null(0))[s["row"]]
            s["tag"] = np.asarray(rows.column("tag"))[s["row"]]
            shard = (mix(s["anchor"]) % np.uint64(shards)).astype(np.int32)
            order = np.flatnonzero(real)
            order = order[np.argsort(shard[order], kind="stable")]
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[k]:cuts[k + 1]]
                parts = {p: s[p][at].astype(kind) for p, kind in RUN_PARTS}
                parts["doc"] = np.diff(parts["doc"], prepend=0).astype("<i8")
                yield batch_of(schema, shard=[k], n=[len(at)], anchor=[parts["anchor"].tobytes()], content=[parts["content"].tobytes()],
                               **{p: [press.compress(parts[p].tobytes())] for p in ("doc", "tag", "start", "windows", "reach")})

    return run


PLACE_DDL = "shard int, anchor long, content long, doc_id long, tag long, start int, windows int, reach int, stands boolean, later boolean"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's segments of anchors that several documents hold."""
    schema = pa.schema([("shard", pa.int32()), ("anchor", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()),
                        ("start", pa.int32()), ("windows", pa.int32()), ("reach", pa.int32()), ("stands", pa.bool_()), ("later", pa.bool_())])
    open_ = zstandard.ZstdDecompressor()

    def close(shard: int, held: list[dict]) -> Iterator[pa.RecordBatch]:
        x = {p: np.concatenate([r[p] for r in held]) for p, _ in RUN_PARTS}
        held.clear()
        order = np.lexsort((x["start"], x["doc"], x["content"], x["anchor"]))
        x = {p: v[order] for p, v in x.items()}
        new = np.ones(len(order), bool)
        new[1:] = x["anchor"][1:] != x["anchor"][:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        several = (np.minimum.reduceat(x["doc"], first) < np.maximum.reduceat(x["doc"], first))[group]
        lead = new.copy()
        lead[1:] |= x["content"][1:] != x["content"][:-1]
        later = x["doc"] > x["doc"][np.flatnonzero(lead)][np.cumsum(lead) - 1]
        at = np.flatnonzero(several)
        for lo in range(0, len(at), 50_000):
            i = at[lo:lo + 50_000]
            yield batch_of(schema, shard=np.full(len(i), shard), anchor=x["anchor"][i].view(np.int64), content=x["content"][i].view(np.int64),
                           doc_id=x["doc"][i], tag=x["tag"][i], start=x["start"][i], windows=x["windows"][i], reach=x["reach"][i], stands=lead[i], later=later[i])

    held: list[dict] = []
    now = None
    for batch in batches:
        for i in range(batch.num_rows):
            shard = batch.column("shard")[i].as_py()
            if shard != now and held:
                yield from close(now, held)
            now = shard
            row = {}
            for p, kind in RUN_PARTS:
                raw = batch.column(p)[i].as_py()
                row[p] = np.frombuffer(raw if p in ("anchor", "content") else open_.decompress(raw), kind)
            row["doc"] = np.cumsum(row["doc"])
            held.append(row)
    if held:
        yield from close(now, held)


CONTENT_DDL = "shard int, anchor long, content long, doc_id long, windows int, words binary"


def _contents(window: int):
    """Documents with the segments they stand for: each segment's word hashes."""
    schema = pa.schema([("shard", pa.int32()), ("anchor", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()),
                        ("windows", pa.int32()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, col in slices(batches, "text", SLICE):
            data, offs = utf8(col)
            starts, ends, counts = words(data, offs)
            h = word_hashes(data, starts, ends, lower=False)
            lists = rows.column("segs")
            seg = lists.flatten()
            n_of = np.diff(np.asarray(lists.offsets))
            row = np.repeat(np.arange(rows.num_rows), n_of)
            anchor, content, shard, start, n = (np.asarray(seg.field(c)).astype(np.int64) for c in ("anchor", "content", "shard", "start", "windows"))
            at = start + counts[row]
            doc = np.asarray(rows.column("doc_id"))
            flat = h.astype("<u8")  # whole hashes: windows of one anchor often differ in a single word
            for lo in range(0, len(at), 20_000):
                p = slice(lo, lo + 20_000)
                yield batch_of(schema, shard=shard[p], anchor=anchor[p], content=content[p], doc_id=doc[row[p]], windows=n[p],
                               words=[flat[a:b].tobytes() for a, b in zip(at[p].tolist(), (at[p] + n[p] + window - 1).tolist(), strict=True)])

    return run


ANSWER_DDL = "anchor long, content long, times array<int>, least array<long>"


def _search(window: int):
    """One index a shard: for each content, the smallest document of each of its
    windows, as runs of equal values."""
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("times", pa.list_(pa.int32())), ("least", pa.list_(pa.int64()))])

    def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = list({x[:2]: x for x in held}.values())  # a content may come from equal rows
        held.clear()
        anchors, contents, docs, counts, raw = zip(*rows, strict=True)
        counts, docs = np.array(counts), np.array(docs)
        lens = counts + window - 1
        kinds, symbol = np.unique(np.frombuffer(b"".join(raw), "<u8"), return_inverse=True)
        # every segment is followed by the separator 0
        begin = np.cumsum(lens + 1) - (lens + 1)
        text = np.zeros(int((lens + 1).sum()), np.int64)
        text[np.arange(len(symbol)) + np.repeat(np.arange(len(lens)), lens)] = symbol.ravel() + 1
        doc = np.repeat(docs, lens + 1)
        index = FMIndex(text, len(kinds) + 1, window)
        which = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[which]
        matched, lo, hi = index.matches(text, at + window, window)
        least = docs[which].copy()
        more = np.flatnonzero(matched >= window)
        if len(more):
            by_place = np.append(doc[index.order], np.int64(2**63 - 1))
            spans, inverse = np.unique(np.stack([lo[more], hi[more]]), axis=1, return_inverse=True)
            low = np.minimum.reduceat(by_place, spans.T.ravel())[::2]  # intervals are disjoint, in order
            least[more] = low[inverse.ravel()]
        some = np.zeros(len(counts), bool)  # only contents that lose words are answered
        some[which[least < docs[which]]] = True
        least, which = least[some[which]], (np.cumsum(some) - 1)[which[some[which]]]
        anchors, contents = np.array(anchors)[some], np.array(contents)[some]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (which[1:] != which[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(least)))
        ends = np.searchsorted(which[first], np.arange(len(anchors) + 1))
        yield pa.RecordBatch.from_arrays([
            pa.array(anchors, pa.int64()), pa.array(contents, pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(times, pa.int32())),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(least[first], pa.int64()))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("shard", "anchor", "content", "doc_id", "windows", "words")]
            for shard, *row in zip(*cols, strict=True):
                if shard != now and held:
                    yield from close(held)
                now = shard
                held.append(tuple(row))
        if held:
            yield from close(held)

    return run


def _spans(window: int):
    """Places with their content's answer: the spans of words to remove. Each is a
    window long at least, so that of a place with reach is one to its last."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("least")
            n = np.diff(np.asarray(lists.offsets))
            row = np.repeat(np.arange(batch.num_rows), n)
            least, times = np.asarray(lists.flatten()), np.asarray(batch.column("times").flatten()).astype(np.int64)
            before = np.cumsum(times) - times
            head = np.cumsum(n) - n
            begin = before - before[np.minimum(head, max(0, len(before) - 1))][row] if len(before) else before
            doc = np.asarray(batch.column("doc_id"))[row]
            gone = least < doc
            a = np.asarray(batch.column("start")).astype(np.int64)[row][gone] + begin[gone]
            tag, reach = np.asarray(batch.column("tag"))[row], np.asarray(batch.column("reach")).astype(np.int64)[row]
            yield batch_of(schema, doc_id=doc[gone], tag=tag[gone], a=a, b=a + reach[gone] + times[gone] + window - 1)

    return run


def _texts_of(docs: DataFrame, per_doc: DataFrame, small: int) -> DataFrame:
    """``docs`` joined with a row per document, text moving only for those."""
    ids = written(per_doc, "per-document")
    few = ids.count() <= small
    wanted = docs.join(F.broadcast(ids.select("doc_id", "tag")), ["doc_id", "tag"], "left_semi") if few else docs
    return wanted.join(ids.hint("merge"), ["doc_id", "tag"])


def _tagged(docs: DataFrame, small: int) -> DataFrame:
    """``docs`` with a tag that tells apart the texts of one doc_id: their hash
    where an id has several texts, else 0."""
    mark = F.xxhash64("text")
    several = written(docs.where("doc_id is not null").select("doc_id", mark.alias("mark")).groupBy("doc_id")
                      .agg(F.min("mark").alias("x"), F.max("mark").alias("y")).where("x <> y").select("doc_id"), "repeated-ids")
    n = several.count()
    if not n:
        return docs.withColumn("tag", F.lit(0).cast("long"))
    several = several.select("doc_id", F.lit(True).alias("several"))
    return (docs.join(F.broadcast(several) if n <= small else several, "doc_id", "left")
            .select("doc_id", "text", F.when(F.col("several"), mark).otherwise(0).alias("tag")))


def repeated_spans(docs: DataFrame, window: int, small: int = 1_000_000, hot: int = HOT) -> DataFrame:
    """(doc_id, text, spans): documents that lose words, with the word spans
    [a, b) to remove. ``docs``: doc_id long, text string."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = _tagged(docs, small)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = ", ".join(f"{p} binary" for p, _ in RUN_PARTS)
    anchors = spark.sparkContext.broadcast(hot_anchors(docs, window, hot))
    runs = (docs.mapInArrow(_runs(window, shards, anchors), f"shard int, n int, {parts}")
            .repartition(shards, "shard").sortWithinPartitions("shard"))
    places = written(runs.mapInArrow(_shared, PLACE_DDL), "places")
    stands = places.where("stands").groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("anchor", "content", "shard", "start", "windows")).alias("segs"))
    contents = (_texts_of(docs, stands, small).select("doc_id", "text", "segs").mapInArrow(_contents(window), CONTENT_DDL)
                .repartition(shards, "shard").sortWithinPartitions("shard"))
    answers = contents.mapInArrow(_search(window), ANSWER_DDL)
    # a copy in a later document than its content's first is gone whatever the answer
    whole = places.where("later").select("doc_id", "tag", F.col("start").alias("a"),
                                         (F.col("start") + F.col("reach") + F.col("windows") + F.lit(window - 1)).cast("int").alias("b"))
    found = (places.where("not later").select("anchor", "content", "doc_id", "tag", "start", "reach").join(answers, ["anchor", "content"])
             .mapInArrow(_spans(window), "doc_id long, tag long, a int, b int"))
    spans = (whole.union(found)
             .groupBy("doc_id", "tag").agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    return _texts_of(docs, spans, small).select("doc_id", "text", "spans")


def keep_mask(spans: pa.StructArray, n: int) -> np.ndarray:
    """Which of n words are outside all spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(np.asarray(spans.field("a")), n), 1)
    np.add.at(edge, np.minimum(np.asarray(spans.field("b")), n), -1)
    return np.cumsum(edge[:-1]) == 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without their spans: words gone, kept words joined by spaces,
    and the text with the removed words and the white space after them cut."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])
    for rows, col in slices(batches, "text", SLICE):
        data, offs = utf8(col)
        starts, ends, counts = words(data, offs)
        raw = data.tobytes()
        out = []
        for i in range(rows.num_rows):
            lo, hi = int(counts[i]), int(counts[i + 1])
            keep = keep_mask(rows.column("spans")[i].values, hi - lo)
            s, e = starts[lo:hi][keep].tolist(), ends[lo:hi][keep].tolist()
            joined = b" ".join([raw[a:b] for a, b in zip(s, e, strict=True)])
            follow = np.append(starts[lo + 1:hi], offs[i + 1])
            text = b"".join([raw[a:b] for a, b in zip(s, follow[keep].tolist(), strict=True)]) if hi > lo else b""
            out.append((hi - lo - len(s), hashlib.sha256(joined).hexdigest(), text.decode("utf-8")))
        n, sha, text = zip(*out, strict=True)
        yield batch_of(schema, doc_id=rows.column("doc_id"), mark=rows.column("mark"), n_removed=n, kept_sha256=sha, kept_text=text)


CUT_DDL = "doc_id long, mark long, n_removed long, kept_sha256 string, kept_text string"


def cut_documents(docs: DataFrame, window: int, small: int = 1_000_000) -> DataFrame:
    """The documents that lose words: doc_id, mark (xxhash64 of the text),
    n_removed, kept_sha256, kept_text."""
    found = repeated_spans(docs, window, small).withColumn("mark", F.xxhash64("text"))
    return found.dropDuplicates(["doc_id", "mark"]).mapInArrow(_cut, CUT_DDL).where("n_removed > 0")


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("all_sha256", pa.string())])
    for rows, col in slices(batches, "text", SLICE):
        data, offs = utf8(col)
        starts, ends, counts = words(data, offs)
        raw, n = data.tobytes(), np.diff(counts)
        s, e, cuts = starts.tolist(), ends.tolist(), counts.tolist()
        sha = [hashlib.sha256(b" ".join([raw[a:b] for a, b in zip(s[x:y], e[x:y], strict=True)])).hexdigest()
               for x, y in zip(cuts, cuts[1:], strict=False)]
        yield batch_of(schema, doc_id=rows.column("doc_id"), mark=rows.column("mark"), n_words=n, all_sha256=sha)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def substring_digests(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    rows = _rows(docs)
    plain = rows.withColumn("mark", F.xxhash64("text")).mapInArrow(_plain, "doc_id long, mark long, n_words long, all_sha256 string")
    cut = cut_documents(rows, window).drop("kept_text")
    return plain.join(cut, ["doc_id", "mark"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that an earlier one holds."""
    return substring_digests(table(spark, sf_dir, "documents", "doc_id", "text"), window=13)
