"""Byte-level BPE encoding in overlapping chunks, and decoding.

A text longer than a chunk is cut into chunks that overlap. Each chunk is
pre-tokenised on its own, as a task of its own, and its pieces are encoded. A
piece boundary of a chunk is sure if it follows from a sure one and lies so far
from the chunk's end that what comes after cannot change it. Where a sure
boundary of the left chunk is also a boundary of the right one, the two have
resynchronised: from there on the right chunk's pieces are the text's pieces,
because the pattern never looks back. If no boundary is shared in the overlap
(a run of one class longer than it), the seam is pre-tokenised again from the
last sure boundary until it meets one of a later chunk, which is exact for any
run length. The end of a run of letters or of numbers is a boundary wherever
pre-tokenising began before it, so both chunks of a seam see from the shared
characters alone whether that can happen, and only then hand on their text and
all their boundaries. Texts of one chunk need no shuffle; of longer ones the
chunks are shuffled once as text and once as ids.

Pieces are encoded by the given merge ranks; decoding concatenates the bytes
of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_of, text_slices

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
#: Characters after a boundary that may decide about it: the longest fixed alternative has three.
GUARD = 4
#: Pieces a worker remembers before it forgets them all.
CACHE_PIECES = 100_000
#: The end of a run of letters or numbers, before another character.
RUN_END = regex.compile(r"\p{L}(?=\P{L})|\p{N}(?=\P{N})")


@lru_cache(maxsize=4)
def rank_table(path: str) -> dict[bytes, int]:
    """Bytes -> rank of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Pieces(dict):
    """Piece -> ids, encoded when first met."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.find = regex.compile(pattern).findall
        #: As ids are shuffled: two bytes where they fit.
        self.id_type = "<u2" if max(rank_table(path).values()) < 1 << 16 else "<u4"
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=rank_table(path), special_tokens={})

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= CACHE_PIECES:
            self.clear()
        ids = self.bpe.encode_ordinary(piece)
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.__getitem__, pieces)), "<u4")


@lru_cache(maxsize=4)
def pieces_of(path: str, pattern: str) -> Pieces:
    return Pieces(path, pattern)


def cut(text: str, size: int, overlap: int) -> list[str]:
    """Chunks that start every ``size`` characters and reach ``overlap`` into the next."""
    return [text[at:at + size + overlap] for at in range(0, max(1, len(text)), size)]


def chunk_pieces(table: Pieces, chunk: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece boundaries (0 to the length), the number of ids before each, and the ids."""
    pieces = table.find(chunk)
    ids = [table[p] for p in pieces]
    bounds = np.fromiter(accumulate(map(len, pieces), initial=0), np.int32, len(pieces) + 1)
    before = np.fromiter(accumulate(map(len, ids), initial=0), np.int32, len(ids) + 1)
    return bounds, before, np.fromiter(chain.from_iterable(ids), "<u4")


def resynchronises(shared: str) -> bool:
    """Whether pre-tokenising from anywhere before these characters surely shares a boundary in them."""
    return RUN_END.search(shared, 0, max(0, len(shared) - GUARD)) is not None


def stitch(table: Pieces, size: int, chunks: list[str | None], lengths: list[int], bounds: list[np.ndarray], before: list[np.ndarray],
           ids: list[np.ndarray]) -> np.ndarray:
    """The ids of the whole text from its chunks' pieces (``chunks``: their text where a seam may need it)."""
    n = len(chunks)
    at = [np.asarray(b, np.int64) + i * size for i, b in enumerate(bounds)]
    sure = [a if i == n - 1 else a[a <= i * size + lengths[i] - GUARD] for i, a in enumerate(at)]
    out, here, position, end_of_text = [np.empty(0, "<u4")], 0, 0, int(at[-1][-1])
    while position < end_of_text:
        mine = sure[here][sure[here] >= position]
        shared, right = mine[-1:], None
        if here + 1 < n:
            common = np.intersect1d(mine, at[here + 1], assume_unique=True)
            if len(common):
                shared, right = common[:1], here + 1
        end = int(shared[0]) if len(shared) else position
        first, last = np.searchsorted(at[here], (position, end))
        out.append(ids[here][before[here][first]:before[here][last]])
        if here == n - 1:
            break
        if right is None:
            end, right, seam = _bridge(table, size, chunks, at, here, end)
            out.append(table.encode(seam))
        here, position = right, end
    return np.concatenate(out)


def _bridge(table: Pieces, size: int, chunks: list[str], at: list[np.ndarray], here: int, start: int):
    """Pieces from the sure boundary ``start`` to one that a chunk after ``here`` shares."""
    last = here
    while True:
        last = min(last + 1, len(chunks) - 1)
        text = "".join(c[:size] if i < last - here else c for i, c in enumerate(chunks[here:last + 1]))
        text = text[start - here * size:]
        whole, position, seam = last == len(chunks) - 1, start, []
        for piece in table.find(text):
            if not whole and position - start + len(piece) > len(text) - GUARD:
                break
            seam.append(piece)
            position += len(piece)
            for right in range(here + 1, last + 1):
                k = np.searchsorted(at[right], position)
                if k < len(at[right]) and at[right][k] == position:
                    return position, right, seam


def _short(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces_of(path, pattern)
        for batch in text_slices(batches):
            ids = [table.encode(table.find(t)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return run


def _chunks(size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            for i, text in enumerate(batch.column("text").to_pylist()):
                parts = cut(text, size, overlap)
                for at in range(0, len(parts), 256):
                    some = parts[at:at + 256]
                    same = [batch.column(c).take(pa.array([i] * len(some))) for c in ("doc_id", "key")]
                    yield pa.RecordBatch.from_arrays(
                        [*same, pa.array(range(at, at + len(some)), pa.int32()),
                         pa.array([at + k == len(parts) - 1 for k in range(len(some))]), pa.array(some, pa.string())],
                        ["doc_id", "key", "no", "last", "chunk"])
    return run


def encoded_chunk(table: Pieces, size: int, overlap: int, no: int, last: bool, chunk: str):
    """text (only if a seam may need it), length, boundaries, ids before each, ids.

    Without the text, only the boundaries that a seam may share and the first
    and last one are handed on.
    """
    bounds, before, ids = chunk_pieces(table, chunk)
    safe = (no == 0 or resynchronises(chunk[:overlap])) and (last or resynchronises(chunk[size:]))
    if safe:
        use = (bounds <= overlap) | (bounds >= size)
        use[[0, -1]] = True
        bounds, before = bounds[use], before[use]
    return None if safe else chunk, len(chunk), bounds, before, ids


def _encoded_chunks(path: str, pattern: str, size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces_of(path, pattern)
        for batch in text_slices(batches, "chunk"):
            columns = (batch.column(c).to_pylist() for c in ("no", "last", "chunk"))
            done = [encoded_chunk(table, size, overlap, *row) for row in zip(*columns, strict=True)]
            binary = [pa.array([d[i].tobytes() for d in done], pa.binary()) for i in (2, 3)]
            narrow = pa.array([d[4].astype(table.id_type).tobytes() for d in done], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "key", "no", "copies")), pa.array([d[0] for d in done], pa.string()),
                 pa.array([d[1] for d in done], pa.int32()), *binary, narrow],
                ["doc_id", "key", "no", "copies", "chunk", "chars", "bounds", "before", "ids"])
    return run


def _stitched(path: str, pattern: str, size: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, table = rows.sort_values("no"), pieces_of(path, pattern)
        arrays = [[np.frombuffer(x, kind) for x in rows[c]]
                  for c, kind in (("bounds", np.int32), ("before", np.int32), ("ids", table.id_type))]
        ids = stitch(table, size, rows["chunk"].tolist(), rows["chars"].tolist(), *arrays)
        return rows[["doc_id", "copies"]].iloc[:1].assign(ids=[ids.astype("<u4").tobytes()])
    return run


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit).

    ``ranks`` is the path of a rank file on every machine, ``pattern`` the
    pre-token pattern; no special tokens. A null or empty text has no ids.
    Repeated rows are all returned; an empty table gives an empty table.
    """
    if not 0 <= overlap_chars <= chunk_chars:
        raise ValueError("the overlap must not be longer than a chunk")
    docs = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    is_long = F.char_length("text") > chunk_chars
    short = docs.filter(~is_long).mapInArrow(_short(ranks, pattern), f"doc_id {id_type}, ids binary")
    # Rows repeated under one id and text are encoded once and counted.
    chunks = (docs.filter(is_long).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
              .mapInArrow(_chunks(chunk_chars, overlap_chars),
                          f"doc_id {id_type}, key string, no int, last boolean, chunk string")
              .groupBy("doc_id", "key", "no").agg(F.any_value("last").alias("last"), F.any_value("chunk").alias("chunk"),
                                                  F.count(F.lit(1)).alias("copies")))
    long = (chunks.mapInArrow(_encoded_chunks(ranks, pattern, chunk_chars, overlap_chars),
                              f"doc_id {id_type}, key string, no int, copies long, chunk string, chars int, "
                              "bounds binary, before binary, ids binary")
            .groupBy("doc_id", "key").applyInPandas(_stitched(ranks, pattern, chunk_chars),
                                                    f"doc_id {id_type}, copies long, ids binary")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "ids"))
    return short.unionByName(long).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def _decoded(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: data for data, rank in rank_table(path).items()}
        for batch in text_slices(batches, "ids"):
            texts = [b"".join(map(token.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*names, "decoded"])
    return run


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the concatenated bytes of ``ids``; null ids give no bytes."""
    encoded = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decoded(ranks, encoded.columns), f"{schema}, decoded binary")
