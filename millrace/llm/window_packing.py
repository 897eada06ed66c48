"""Packing of documents into sequences by dynamic programming, in the order of their ids.

Each partition is a stream of tokens: its documents in order, each followed by the end id. Windows are cut from it so that
padding plus the penalties of the cuts is smallest: a cut at the end of a document is free, one at the end of a sentence
costs ``SENTENCE_CUT``, any other ``HARD_CUT``. With f the least cost up to a cut, f(j) = cut(j) + size - c(j) + min(f(i) + c(i))
over the cuts i at most one window before j; a monotone queue gives that minimum in constant time on average. A
window whose length is a power of two is not padded, so it may also end without that cost.

Texts are not shuffled. The stream is planned a stretch at a time; the last windows of a stretch are planned again with
the next one. A sequence's number is its partition and its place there. A text is tokenised piece by piece with the
pieces' ids kept, which gives the ids of the whole text since the tokenizer encodes every piece by itself.

Edge cases: a null text is empty, and an empty document is its end id alone. Rows with equal or null ids are
documents of their own, ordered by the digest of their text. A text longer than a window spans several. An empty
table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.piece_tokens import PieceTokenizer, piece_tokenizer
from millrace.llm.scratch import bounded_batches, tidy

SIZE = 2048
END_ID = 1
SENTENCE_CUT = 8
HARD_CUT = 48
# Without a sentence end for so many tokens, cuts in between are allowed.
LONGEST_SENTENCE = 256
# Shorter windows than this are padded even at a power of two.
SHORTEST = 64
STRETCH = 1 << 18
BYTES_AT_ONCE = 1 << 20


def cut_candidates(
    ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, last: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, the first and the last included, and what a cut there costs.

    In the last two windows of a stream any place will do, so its end need not be padded.
    """
    n = len(ids)
    kind = np.full(n + 1, -1, np.int32)
    if last:
        kind[max(0, n - 2 * SIZE) :] = HARD_CUT
    kind[np.flatnonzero(ends_sentence[ids]) + 1] = SENTENCE_CUT
    kind[doc_ends] = 0
    kind[0] = kind[n] = 0
    at = np.flatnonzero(kind >= 0)
    for i in np.flatnonzero(np.diff(at) > LONGEST_SENTENCE):
        kind[np.arange(at[i] + LONGEST_SENTENCE // 2, at[i + 1], LONGEST_SENTENCE // 2)] = HARD_CUT
    at = np.flatnonzero(kind >= 0)
    return at, kind[at]


def plan_windows(at: np.ndarray, cost: np.ndarray, size: int = SIZE, shortest: int = SHORTEST) -> tuple[list[int], int]:
    """The cuts of least total cost, as places from first to last, and that cost."""
    m = len(at)
    # Candidates that lie a power of two before each candidate.
    exact: list[list[int]] = [[] for _ in range(m)]
    power = shortest
    while power < size:
        before = np.searchsorted(at, at - power)
        for j in np.flatnonzero((at >= power) & (at[np.minimum(before, m - 1)] == at - power)).tolist():
            exact[j].append(int(before[j]))
        power *= 2
    place, charge = at.tolist(), cost.tolist()
    best, back = [0] * m, [0] * m
    queue, worth, head = [0], [place[0]], 0  # indices with rising worth f(i) + c(i); those before head have been left behind
    for j in range(1, m):
        here = place[j]
        low = here - size
        while place[queue[head]] < low:
            head += 1
        i = queue[head]
        least = worth[head] + size - here
        for k in exact[j]:
            if best[k] < least:
                least, i = best[k], k
        least += charge[j]
        best[j], back[j] = least, i
        w = least + here
        while len(queue) > head and worth[-1] >= w:
            queue.pop()
            worth.pop()
        queue.append(j)
        worth.append(w)
    cuts, j = [place[-1]], m - 1
    while j:
        j = back[j]
        cuts.append(place[j])
    return cuts[::-1], best[-1]


SCHEMA = "doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Stream:
    """Documents whose tokens have not all been packed, and the sequences so far."""

    def __init__(self, partition: int, tokenizer: PieceTokenizer):
        self.tokenizer, self.number = tokenizer, partition << 32
        self.docs: list[tuple[object, int, int]] = []  # id, tokens of the document, those already packed
        self.held: list[bytes] = []
        self.size = 0

    def add(self, identities: list, bodies: list[bytes]) -> None:
        for identity, ids in zip(identities, self.tokenizer.ids(bodies), strict=True):
            self.docs.append((identity, len(ids) + 1, 0))
            self.held += [ids.tobytes(), END_ID.to_bytes(4, "little")]
            self.size += len(ids) + 1

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of all windows but those that more documents could still change."""
        stream = b"".join(self.held)
        left = np.array([total - done for _, total, done in self.docs])
        ends = left.cumsum()
        at, cost = cut_candidates(np.frombuffer(stream, "<u4"), ends, self.tokenizer.ends_sentence, last)
        cuts, _ = plan_windows(at, cost)
        if not last:
            cuts = [c for c in cuts if c <= self.size - 2 * SIZE]
        pieces, doc = [], 0
        begins = ends - left
        for a, b in zip(cuts, cuts[1:], strict=False):
            place = a
            while place < b:
                while ends[doc] <= place:
                    doc += 1
                stop = min(b, int(ends[doc]))
                identity, total, done = self.docs[doc]
                pieces.append((identity, done + place - int(begins[doc]), stop - place, zlib.crc32(stream[4 * place : 4 * stop]), total, self.number, place - a))
                place = stop
            self.number += 1
        packed = cuts[-1] if cuts else 0
        keep = int(np.searchsorted(ends, packed, side="right"))
        rest = self.docs[keep:]
        if rest:
            identity, total, done = rest[0]
            rest[0] = (identity, total, done + packed - int(begins[keep]))
        self.docs, self.held, self.size = rest, [stream[4 * packed :]], self.size - packed
        return pieces


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document; ``tokenizer_path`` must be there on every executor."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    ordered = source.sortWithinPartitions("doc_id", F.xxhash64("body"))
    schema = SCHEMA.format(id_type=id_type)

    def batch(pieces: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*pieces, strict=True))
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = piece_tokenizer(tokenizer_path)
        stream = _Stream(TaskContext.get().partitionId(), tokenizer)
        kind, identities, bodies, size = None, [], [], 0
        for rows in batches:
            kind = rows.column(0).type
            for identity, body in zip(rows.column(0), rows.column(1), strict=True):
                identities.append(identity.as_py())
                bodies.append(body.as_py())
                size += len(bodies[-1])
                if size >= BYTES_AT_ONCE:
                    stream.add(identities, bodies)
                    identities, bodies, size = [], [], 0
                    if stream.size >= STRETCH and (pieces := stream.pack(last=False)):
                        yield batch(pieces, kind)
        stream.add(identities, bodies)
        if stream.docs:
            yield batch(stream.pack(last=True), kind)
        tokenizer.forget()

    return ordered.mapInArrow(tidy(run), schema)
