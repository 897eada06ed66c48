"""Alignment of two tokenizers by inverted pair bitmaps.

A text is encoded by a byte-level BPE (A, after a space) and by a piece model (B, which adds the space itself). Where tokens
of both end at the same byte, a group ends; tokens whose bytes overlap are linked. For every pair of linked ids there is
an inverted list of documents. Documents are numbered by container and position (at most 65536 in a container); what a container holds for a
pair is a compressed bitmap: the sorted 16-bit positions, or 8192 bytes of bits from 4096 positions on. Batches of documents are OR-merged
into their container. Plane 0 says which documents have the pair, plane k holds bit k - 1 of (links in the document - 1), so counts
over the corpus are popcounts: of plane 0 for documents, and of all planes by weight for links. Only popcounts are
shuffled by pair. Scores return through the postings: each container meets the scores of its pairs and adds them
up by position.

Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros and an empty ''
for the groups. Repeated rows and rows with a null id are documents of their own. Ties for a B id's highest count all
count as best. Other columns are ignored, whatever their names. An empty table gives no rows. A text is encoded as a whole: a task
needs some hundred bytes per byte of its longest text, besides 100 MB for a container.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.scratch import Scratch, bounded_batches, skew_aware, tidy
from millrace.llm.word_hashes import by_size

# Documents and (document, pair) entries after which a container is closed, and the entries from which a bitmap is smaller.
CONTAINER_DOCS = 1 << 16
CONTAINER_ENTRIES = 1 << 22
DENSE = 4096
BITMAP_BYTES = CONTAINER_DOCS // 8
# The faster encoder merges a piece in time that grows with the square of its length, so texts with longer runs go to the other.
LONG_RUN = 1000
# Below this code point both encoders know the same letters, digits and spaces.
LATIN = 0x250
# The split of a text into pieces, fixed by the byte-level tokenizer's file ("use_regex").
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

FIELDS = {
    "container": pa.int64(),
    "position": pa.int32(),
    "id": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups": pa.string(),
    "pair": pa.int64(),
    "plane": pa.int32(),
    "bits": pa.binary(),
}
SCHEMA = "container long, position int, id long, n_a long, n_b long, n_groups long, n_links long, groups string, pair long, plane int, bits binary"


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones as themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoders:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        symbols = byte_of_symbol()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.fast = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths = [np.array([len(t) for t in tokens]) for tokens in (self.bytes_a, self.bytes_b)]
        # Ids as text, each followed by the mark that can come after it.
        self.texts = [str(i).encode() + mark for mark in (b",", b"|", b";") for i in range(self.stride)]

    @property
    def stride(self) -> int:
        return max(len(self.bytes_a), len(self.bytes_b))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def ids_a(self, body: bytes) -> list[int]:
        """The ids of space + text."""
        text = " " + body.decode("utf-8", "replace")
        gap = np.frombuffer(body, np.uint8) <= 0x20
        edges = np.concatenate([[0], np.flatnonzero(gap[1:] != gap[:-1]) + 1, [len(gap)]])
        if np.diff(edges).max() <= LONG_RUN and max(text) < chr(LATIN):
            return self.fast.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, bodies: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of A and B of every text; empty where one of them does not give back the text."""
        all_b = self.b.encode([x.decode("utf-8", "replace") for x in bodies], num_threads=1)
        out = []
        for body, b in zip(bodies, all_b, strict=True):
            a = self.ids_a(body) if body else []
            whole = b" " + body
            if not body or b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
                a = b = []
            out.append((np.array(a, np.int64), np.array(b, np.int64)))
        return out


@functools.cache
def encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


class Aligned:
    """Groups and links of a batch of encoded texts, laid end to end."""

    def __init__(self, found: Encoders, encoded: list[tuple[np.ndarray, np.ndarray]]):
        none = np.zeros(0, np.int64)
        self.n_a, self.n_b = (np.array([len(e[k]) for e in encoded], np.int64) for k in range(2))
        a, b = (np.concatenate([none, *(e[k] for e in encoded)]) for k in range(2))
        ends_a, ends_b = found.lengths[0][a].cumsum(), found.lengths[1][b].cumsum()
        # Between two neighbouring ends lies one link.
        ends = np.unique(np.concatenate([ends_a, ends_b]))
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.doc = np.repeat(np.arange(len(encoded)), self.n_a)[at_a]
        self.pair = a[at_a] * len(found.bytes_b) + b[at_b]
        self.n_links = np.bincount(self.doc, minlength=len(encoded))
        self.n_groups = self.n_a + self.n_b - self.n_links
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        group_a, group_b = last_a.cumsum() - last_a, last_b.cumsum() - last_b
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        codes = np.concatenate([a + found.stride * last_a, b + 2 * found.stride * last_b])[order].tolist()
        stops = (self.n_a + self.n_b).cumsum().tolist()
        self.digests = []
        start = 0
        for stop in stops:
            text = b"".join([found.texts[c] for c in codes[start:stop]])
            self.digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
            start = stop


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[c], kind) if c in columns else pa.nulls(n, kind) for c, kind in FIELDS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(FIELDS))


class Container:
    """Postings of the documents numbered so far; keys are pair and position."""

    def __init__(self, number: int):
        self.number, self.docs, self.size = number, 0, 0
        self.keys: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def full(self, docs: int) -> bool:
        return self.docs + docs > CONTAINER_DOCS or self.size >= CONTAINER_ENTRIES

    def add(self, aligned: Aligned) -> None:
        keys, links = np.unique(aligned.pair << 16 | (aligned.doc + self.docs), return_counts=True)
        self.keys.append(keys)
        self.links.append(links.astype(np.int32))
        self.docs += len(aligned.n_a)
        self.size += len(keys)

    def postings(self) -> Iterator[pa.RecordBatch]:
        """All planes of all pairs; merges the batches' entries."""
        if not self.size:
            return
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys, extra = keys[order], np.concatenate(self.links)[order] - 1
        for plane in range(int(extra.max()).bit_length() + 1):
            of_plane = keys if plane == 0 else keys[(extra >> (plane - 1)) & 1 == 1]
            if len(of_plane):
                yield from self._plane(of_plane, plane)

    def _plane(self, keys: np.ndarray, plane: int) -> Iterator[pa.RecordBatch]:
        pair, position = keys >> 16, (keys & 0xFFFF).astype("<u2")
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(pair)]]))
        dense = counts >= DENSE
        sparse = np.repeat(~dense, counts)
        offsets = np.concatenate([[0], 2 * counts[~dense].cumsum()]).astype("<i4")
        bits = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(position[sparse].tobytes())])
        n = len(bits)
        yield _batch(container=np.full(n, self.number), pair=pair[starts[~dense]], plane=np.full(n, plane, np.int32), bits=bits)
        for s, c in zip(starts[dense].tolist(), counts[dense].tolist(), strict=True):
            bitmap = np.zeros(CONTAINER_DOCS, np.uint8)
            bitmap[position[s : s + c]] = 1
            yield _batch(container=[self.number], pair=[int(pair[s])], plane=[plane], bits=[np.packbits(bitmap, bitorder="little").tobytes()])


def inverted(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document (pair null) with its alignment, and rows of postings (container, pair, plane, bits)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = encoders(path_a, path_b)
        first = TaskContext.get().partitionId() << 32
        held = Container(first)
        for batch in batches:
            for ids, bodies in by_size(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))):
                if held.full(len(bodies)):
                    yield from held.postings()
                    held = Container(held.number + 1)
                aligned = Aligned(found, found.encode(bodies))
                position = np.arange(held.docs, held.docs + len(ids), dtype=np.int32)
                yield _batch(
                    container=np.full(len(ids), held.number),
                    position=position,
                    id=ids,
                    n_a=aligned.n_a,
                    n_b=aligned.n_b,
                    n_groups=aligned.n_groups,
                    n_links=aligned.n_links,
                    groups=aligned.digests,
                )
                held.add(aligned)
        yield from held.postings()

    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body")).mapInArrow(tidy(read), SCHEMA)


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, n_docs and n_links over all containers."""
    ones = F.when(F.length("bits") == BITMAP_BYTES, F.bitmap_count("bits")).otherwise((F.length("bits") / 2).cast("long"))
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("plane") - 1))
    counted = postings.select("pair", "plane", ones.alias("ones"), weight.alias("weight"))
    documents = F.sum(F.when(F.col("plane") == 0, F.col("ones")))
    return counted.groupBy("pair").agg(documents.alias("n_docs"), F.sum(F.col("ones") * F.col("weight")).alias("n_links"))


def pair_scores(counts: DataFrame, size_b: int) -> DataFrame:
    """pair, n_links and whether that is the highest of its B id."""
    own = counts.withColumn("b", F.col("pair") % size_b)
    best = own.groupBy("b").agg(F.max("n_links").alias("highest"))
    return own.join(best, "b").select("pair", "n_links", (F.col("n_links") == F.col("highest")).alias("best"))


def _positions(bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row and the position of every bit that is set."""
    sizes = pc.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64)
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sparse = np.flatnonzero(sizes < BITMAP_BYTES)
    if len(sparse):
        joined = b"".join(x.as_py() for x in bits.take(pa.array(sparse)))
        rows.append(np.repeat(sparse, sizes[sparse] // 2))
        found.append(np.frombuffer(joined, "<u2").astype(np.int64))
    for k in np.flatnonzero(sizes == BITMAP_BYTES).tolist():
        at = np.flatnonzero(np.unpackbits(np.frombuffer(bits[k].as_py(), np.uint8), bitorder="little"))
        rows.append(np.full(len(at), k))
        found.append(at)
    return np.concatenate(rows), np.concatenate(found)


def _returned(postings: pa.Table, scores: pa.Table) -> pa.Table:
    """container, position, n_best and count_sum of the documents of one container."""
    names = ["container", "position", "n_best", "count_sum"]
    if not postings.num_rows:
        return pa.table([pa.array([], pa.int64())] * 4, names=names)
    order = np.argsort(scores["pair"].to_numpy())
    pairs = scores["pair"].to_numpy()[order]
    at = order[np.searchsorted(pairs, postings["pair"].to_numpy())]
    plane = postings["plane"].to_numpy().astype(np.int64)
    weight = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
    count = scores["n_links"].to_numpy()[at] * weight
    best = scores["best"].to_numpy(zero_copy_only=False)[at].astype(np.int64) * weight
    row, position = _positions(postings["bits"].combine_chunks())
    total, tops = np.zeros(CONTAINER_DOCS, np.int64), np.zeros(CONTAINER_DOCS, np.int64)
    np.add.at(total, position, count[row])
    np.add.at(tops, position, best[row])
    found = np.flatnonzero(total)
    container = np.full(len(found), postings["container"][0].as_py())
    return pa.table([pa.array(x, pa.int64()) for x in (container, found, tops[found], total[found])], names=names)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum and the digest of its groups."""
    spark = docs.sparkSession
    skew_aware(spark)
    bounded_batches(spark)
    scratch = Scratch(spark, "pair-bitmaps")
    found = scratch.keep(inverted(docs, path_a, path_b, id_col, text_col), "inverted")
    postings = found.where("pair IS NOT NULL").select("container", "pair", "plane", "bits")
    size_b = len(encoders(path_a, path_b).bytes_b)
    scores = scratch.keep(pair_scores(scratch.keep(pair_counts(postings), "counts"), size_b), "scores")
    held = postings.where("plane = 0").select(F.col("container").alias("container"), F.col("pair").alias("pair"))
    wanted = held.join(scores, "pair")
    returned = (
        postings.groupBy("container")
        .cogroup(wanted.groupBy("container"))
        .applyInArrow(_returned, "container long, position long, n_best long, count_sum long")
    )
    zero = F.lit(0).cast("long")
    return (
        found.where("pair IS NULL")
        .withColumn("position", F.col("position").cast("long"))
        .join(returned, ["container", "position"], "left")
        .select(
            F.col("id").alias(id_col),
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"),
            F.col("groups").alias("groups_sha256"),
        )
    )
