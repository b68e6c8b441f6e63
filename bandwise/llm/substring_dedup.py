"""Substring dedup by fixed-block anchors: drop passages that documents with a smaller id have as well.

A window of ``width`` words holds a whole block of ``(width + 1) // 2`` words
wherever the blocks of its document lie. So every document is an index of its
non-overlapping blocks, and every rolling window of a block's length probes it:

1. The rows are dealt into chunks of about ``chunk_bytes`` of text, written as a
   table bucketed by chunk: the later passes read it without moving a text.
2. A chunk sends its distinct rolling keys, sorted, cut by hash into parts, with
   two marks: the key is a fixed block here; it is in several documents here. A
   part holds a key's marks from all chunks. A key that is a fixed block
   somewhere and occurs in two documents is an anchor; the answer to a chunk is
   one bit per key it sent.
3. Around its anchors a chunk extends the hits to all windows that hold one, and
   sends the distinct windows (96 bits of hash) with the smallest id that has them
   here. The answer is one bit per window: a smaller id has it elsewhere.
4. Windows that a smaller id has, here or elsewhere, join to maximal repeats;
   their words go.

Anchors are a filter that errs on the side of more windows; windows decide. A
passage shared by many documents costs each chunk one entry a window, however
many documents share it, and no pair of documents is ever made.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from bandwise.llm.common import free_name, give_back, stored, text_of
from bandwise.llm.words import PLAIN, run_hashes, spans, utf8, word_hashes
from bandwise.session import checkpoint_dir

#: Text of a chunk, and text whose keys one part holds; both are a task's memory (about 15 bytes a byte of text).
CHUNK_BYTES, PART_BYTES = 8 << 20, 12 << 20
#: Chunks in a bucket, which is what one task reads.
BUCKET_CHUNKS = 3
#: Bits of a rolling key beside its part's number.
KEY_BITS = 32
NO_ID = np.iinfo(np.int64).max
SPANS = "array<struct<first:int,last:int>>"


def _packed(*columns: np.ndarray) -> bytes:
    """Columns byte by byte in planes, compressed: high bytes of small numbers cost next to nothing."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() if c.dtype != bool
              else np.packbits(c).tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(payload: bytes, n: int, *types) -> list[np.ndarray]:
    sizes = [-(-n // 8) if t is bool else n * np.dtype(t).itemsize for t in types]
    raw, out, at = np.frombuffer(pa.decompress(payload, sum(sizes), codec="zstd"), np.uint8), [], 0
    for t, size in zip(types, sizes, strict=True):
        part = raw[at:at + size]
        out.append(np.unpackbits(part, count=n).astype(bool) if t is bool
                   else np.ascontiguousarray(part.reshape(-1, n).T).view(t).ravel())
        at += size
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers; their running sum gives the numbers back."""
    return np.diff(values, prepend=values.dtype.type(0))


def _runs(*same: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in sorted columns."""
    if not len(same[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(same[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in same])
    return np.flatnonzero(new)


def _parts(sorted_parts: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    edges = np.searchsorted(sorted_parts, np.arange(parts + 1, dtype=sorted_parts.dtype))
    return ((p, slice(edges[p], edges[p + 1])) for p in range(parts) if edges[p] < edges[p + 1])


class Chunk:
    """Words, rolling keys and candidate windows of a chunk; every pass computes the same from the same rows."""

    def __init__(self, texts: pa.Array, ids: np.ndarray, width: int, bits: int):
        self.width, self.block, self.bits, self.ids = width, (width + 1) // 2, bits, ids
        self.data, self.offsets = utf8(texts)
        self.starts, self.ends, self.doc = spans(self.data, self.offsets, PLAIN)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        n = max(0, len(self.doc) - self.block + 1)
        self.at = np.flatnonzero(self.doc[:n] == self.doc[len(self.doc) - n:])
        keys = run_hashes(self.hashes[0], self.block)[self.at] >> np.uint64(64 - KEY_BITS - bits)
        self.order = np.argsort(keys, kind="stable")
        keys = keys[self.order]
        self.first = _runs(keys)
        self.keys = keys[self.first]

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Per distinct key: it is a fixed block of a document; it occurs in several documents."""
        if not len(self.keys):
            return np.empty(0, bool), np.empty(0, bool)
        place = np.arange(len(self.doc)) - np.searchsorted(self.doc, self.doc)
        fixed = (place[self.at] % self.block == 0)[self.order]
        doc = self.doc[self.at][self.order]
        last = np.append(self.first[1:], len(doc)) - 1
        return np.logical_or.reduceat(fixed, self.first), doc[self.first] != doc[last]

    def windows(self, anchors: np.ndarray) -> None:
        """Places, ids and sorted distinct hashes of the windows that hold an anchor."""
        hit = np.zeros(len(self.doc) + 1, np.int64)
        hit[self.at[self.order]] = np.repeat(anchors, np.diff(np.append(self.first, len(self.order))))
        before = np.concatenate(([0], np.cumsum(hit)))
        n = max(0, len(self.doc) - self.width + 1)
        inside = self.doc[:n] == self.doc[len(self.doc) - n:]
        self.places = np.flatnonzero(inside & (before[self.width - self.block + 1:][:n] > before[:n]))
        high = run_hashes(self.hashes[0], self.width, self.places)
        low = (run_hashes(self.hashes[1], self.width, self.places) >> np.uint64(32)).astype(np.uint32)
        ids = self.ids[self.doc[self.places]]
        self.window_order = np.lexsort((ids, low, high))
        self.high, self.low, self.window_ids = (c[self.window_order] for c in (high, low, ids))
        self.window_first = _runs(self.high, self.low)

    def removed(self, elsewhere: np.ndarray) -> np.ndarray:
        """Per word: a window that a smaller id has covers it. ``elsewhere``: per distinct window."""
        lengths = np.diff(np.append(self.window_first, len(self.high)))
        least = self.window_ids[self.window_first]
        gone = np.repeat(elsewhere, lengths) | (self.window_ids > np.repeat(least, lengths))
        cover = np.zeros(len(self.doc) + 1, np.int64)
        places = self.places[self.window_order[gone]]
        cover[places] += 1
        cover[places + self.width] -= 1
        return np.cumsum(cover)[:-1] > 0


def _chunk_numbers(text: str, chunk: str, seq: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, size, n = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = size + np.cumsum(lengths)
            number = base + (ends - lengths) // most
            yield batch.append_column(chunk, pa.array(number)).append_column(seq, pa.array(np.arange(n, n + len(lengths))))
            size, n = int(ends[-1]) if len(ends) else size, n + len(lengths)
    return run


def _in_order(table: pa.Table, seq: str) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column(seq).to_numpy(), kind="stable")))


def _chunk(table: pa.Table, id_col: str, text_col: str, width: int, bits: int) -> Chunk:
    ids = table.column(id_col).combine_chunks().cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    return Chunk(table.column(text_col), ids, width, bits)


ENTRIES = "chunk long, part int, n int, payload binary"
ANSWERS = "kind int, chunk long, part int, bits binary"


def _entries(chunk: int, rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, n, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array([chunk] * len(rows), pa.int64()), pa.array(part, pa.int32()), pa.array(n, pa.int32()),
                     pa.array(payload, pa.binary())], ["chunk", "part", "n", "payload"])


def _send_keys(name: str, seq: str, id_col: str, text_col: str, width: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        number = table.column(name)[0].as_py()
        c = _chunk(_in_order(table, seq), id_col, text_col, width, bits)
        fixed, several = c.marks()
        part, low = c.keys >> np.uint64(KEY_BITS), (c.keys & np.uint64(2 ** KEY_BITS - 1)).astype(np.uint32)
        rows = [(p, int(s.stop - s.start), _packed(_steps(low[s]), fixed[s], several[s])) for p, s in _parts(part, 1 << bits)]
        give_back()
        return _entries(number, rows)
    return run


def _answers(kind: int, table: pa.Table, said: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """One row for each entry with anything to say: its bits."""
    edges = np.concatenate(([0], np.cumsum(sizes)))
    rows = [i for i in range(len(sizes)) if said[edges[i]:edges[i + 1]].any()]
    bits = [_packed(said[edges[i]:edges[i + 1]]) for i in rows]
    some = table.take(pa.array(rows, pa.int64()))
    return pa.table([pa.array([kind] * len(rows), pa.int32()), some.column("chunk"), some.column("part"),
                     pa.array(bits, pa.binary())], ["kind", "chunk", "part", "bits"])


def _gathered(table: pa.Table, *types) -> tuple[np.ndarray, list[np.ndarray]]:
    sizes = table.column("n").to_numpy()
    rows = [_unpacked(p.as_buffer(), int(n), *types) for p, n in zip(table.column("payload"), sizes, strict=True)]
    rows = [[np.cumsum(r[0], dtype=r[0].dtype), *r[1:]] for r in rows]
    return sizes, [np.concatenate(c) for c in zip(*rows, strict=True)]


def _find_anchors(table: pa.Table) -> pa.Table:
    sizes, (key, fixed, several) = _gathered(table, np.uint32, bool, bool)
    order = np.argsort(key, kind="stable")
    first = _runs(key[order])
    lengths = np.diff(np.append(first, len(key)))
    anchor = np.logical_or.reduceat(fixed[order], first) & ((lengths > 1) | np.logical_or.reduceat(several[order], first))
    said = np.empty(len(key), bool)
    said[order] = np.repeat(anchor, lengths)
    out = _answers(0, table, said, sizes)
    give_back()
    return out


def _find_smaller(table: pa.Table) -> pa.Table:
    sizes, (high, low, least) = _gathered(table, np.uint64, np.uint32, np.int64)
    order = np.lexsort((low, high))
    first = _runs(high[order], low[order])
    said = np.empty(len(high), bool)
    said[order] = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.append(first, len(high)))) < least[order]
    out = _answers(1, table, said, sizes)
    give_back()
    return out


def _bits(answers: pa.Table, kind: int, sorted_parts: np.ndarray, parts: int) -> np.ndarray:
    out = np.zeros(len(sorted_parts), bool)
    at = dict(_parts(sorted_parts, parts))
    for k, p, bits in zip(*(answers.column(c).to_pylist() for c in ("kind", "part", "bits")), strict=True):
        if k == kind:
            out[at[p]] = _unpacked(bits, at[p].stop - at[p].start, bool)[0]
    return out


def _with_windows(rows: pa.Table, answers: pa.Table, id_col: str, text_col: str, width: int, bits: int) -> tuple[Chunk, np.ndarray]:
    """The chunk with its windows, and the part of each distinct window."""
    c = _chunk(rows, id_col, text_col, width, bits)
    c.windows(_bits(answers, 0, c.keys >> np.uint64(KEY_BITS), 1 << bits))
    return c, (c.high[c.window_first] >> np.uint64(1) >> np.uint64(63 - bits))


def _send_windows(name: str, seq: str, id_col: str, text_col: str, width: int, bits: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(answers):
            return _entries(0, [])
        number = table.column(name)[0].as_py()
        c, part = _with_windows(_in_order(table, seq), answers, id_col, text_col, width, bits)
        high, low, least = (x[c.window_first] for x in (c.high, c.low, c.window_ids))
        rows = [(p, int(s.stop - s.start), _packed(_steps(high[s]), low[s], least[s])) for p, s in _parts(part, 1 << bits)]
        give_back()
        return _entries(number, rows)
    return run


def kept_texts(c: Chunk, gone: np.ndarray) -> pa.Array:
    """The words that stay, joined by one space."""
    n = len(c.offsets) - 1
    stay = ~gone
    inside = np.zeros(len(c.data) + 1, np.int8)
    inside[c.starts[stay]] += 1
    inside[c.ends[stay]] -= 1
    mask = np.cumsum(inside, dtype=np.int8)[:-1].astype(bool)
    data = c.data.copy()
    # A word that another one follows in its text has white space behind it, where the joining space goes.
    doc, ends = c.doc[stay], c.ends[stay]
    joints = ends[:-1][doc[1:] == doc[:-1]]
    data[joints], mask[joints] = 0x20, True
    offsets = np.concatenate(([0], np.cumsum(mask)))[c.offsets].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data[mask])])


def repeat_spans(c: Chunk, gone: np.ndarray) -> pa.Array:
    """Maximal repeats per text: first and last word, from 0."""
    n = len(c.offsets) - 1
    first_word = np.searchsorted(c.doc, np.arange(n + 1))
    edge = np.zeros(len(c.doc) + 1, bool)
    edge[first_word] = True
    begin = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1]))))
    end = np.flatnonzero(gone & (edge[1:] | ~np.concatenate((gone[1:], [False]))))
    own = first_word[c.doc[begin]]
    cells = pa.StructArray.from_arrays([pa.array((begin - own).astype(np.int32)), pa.array((end - own).astype(np.int32))],
                                       ["first", "last"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begin, first_word).astype(np.int32)), cells)


def _finish(seq: str, id_col: str, text_col: str, width: int, bits: int, columns: list[str]):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _in_order(table, seq)
        c, part = _with_windows(rows, answers, id_col, text_col, width, bits)
        gone = c.removed(_bits(answers, 1, part, 1 << bits))
        n = len(rows)
        new = {text_col: kept_texts(c, gone), "n_words": pa.array(np.bincount(c.doc, minlength=n)[:n].astype(np.int64)),
               "n_removed": pa.array(np.bincount(c.doc[gone], minlength=n)[:n].astype(np.int64)),
               "repeats": repeat_spans(c, gone)}
        out = pa.table([new[x] if x in new else rows.column(x) for x in columns], columns)
        give_back()
        return out
    return run


def drop_repeated_passages(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text",
                           chunk_bytes: int = CHUNK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """All rows and columns of ``docs``, without the passages that a smaller id has.

    Words are runs without ASCII white space; a window is ``width`` consecutive
    words of one text. Each word goes that lies in a window whose words also
    stand in a text under a smaller id; all windows are judged on the input. The
    new text is the words that stay, joined by one space. Adds ``n_words``,
    ``n_removed`` (long) and ``repeats`` (first and last word of every maximal
    passage removed, from 0); columns of these names are replaced.

    Ids are integers. A null id is larger than all others, and rows with equal
    ids (null ones included) never lose words to one another: repeated rows are
    all returned and all treated alike. Null and empty texts have no words and
    come back empty; a text shorter than a window loses nothing. An empty table
    gives an empty table. A text is held in one task as a whole; tasks hold one
    chunk, or the keys of one part.
    """
    if width < 1:
        raise ValueError("a window has at least one word")
    spark = docs.sparkSession
    chunk, seq = free_name(docs, "_chunk"), free_name(docs, "_seq")
    rows = docs.withColumns({id_col: F.col(id_col).cast("long"), text_col: text_of(text_col)})
    total = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = max(0, int(total // part_bytes).bit_length())
    buckets = max(1, -(-total // (chunk_bytes * BUCKET_CHUNKS)))
    schema = StructType([*rows.schema.fields, StructField(chunk, LongType()), StructField(seq, LongType())])
    name = f"bandwise_{uuid.uuid4().hex}"
    (rows.mapInArrow(_chunk_numbers(text_col, chunk, seq, chunk_bytes), schema).write.bucketBy(int(buckets), chunk)
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").format("parquet").saveAsTable(name))
    grouped = spark.table(name).groupBy(chunk)
    to = (id_col, text_col, width, bits)

    def by_part(sent: DataFrame, judge) -> DataFrame:
        return sent.groupBy("part").applyInArrow(judge, ANSWERS)

    anchors = stored(by_part(grouped.applyInArrow(_send_keys(chunk, seq, *to), ENTRIES), _find_anchors))
    smaller = stored(by_part(grouped.cogroup(anchors.groupBy("chunk")).applyInArrow(
        _send_windows(chunk, seq, *to), ENTRIES), _find_smaller))
    columns = [*docs.columns, *(c for c in ("n_words", "n_removed", "repeats") if c not in docs.columns)]
    types = {c: f.dataType.simpleString() for c, f in zip(rows.columns, rows.schema, strict=True)}
    types |= {"n_words": "bigint", "n_removed": "bigint", "repeats": SPANS}
    return grouped.cogroup(anchors.union(smaller).groupBy("chunk")).applyInArrow(
        _finish(seq, *to, columns), ", ".join(f"`{c}` {types[c]}" for c in columns))
