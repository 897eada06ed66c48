"""Near duplicates by order MinHash, with candidates verified by banded alignment.

A text's words are its runs of letters and digits in lower case; its k-mers are runs of five words, labelled with how often
each has come before. A sketch takes the ``TUPLE`` k-mers that are least under one of ``SKETCHES`` hash orders and keeps
them in the order of the text, so it is sensitive to that order as edit distance is. Texts that share a sketch are candidates. A
candidate pair is a link if the words align with at most (1 - ``similarity``) times the longer text's number of words
inserted, deleted or replaced, searched on the diagonals within that band only. Blocks that changed places count as edits.

Texts with the same words are merged first, so copies never form pairs. In a bucket of texts with one sketch every member is
first compared to one pivot; in large buckets then to another, drawn anew per bucket. Members that end up in different components
are candidates still, but most of them share only a passage. An edit changes one word, so two texts that align have all words but
those of the limit in common; three bounds follow. In buckets of up to ``DENSE`` texts all members are held against each other
by bitmaps: a bit says whether an odd number of the text's labelled words fall on it, so two bitmaps differ in at most as many bits as
there are words in one text only. A pair that passes is verified once, whatever number of sketches it shares. Larger buckets are split by rare words: two
texts that align share one of the words that each lists, its rarest, one more than it may lose. Among texts with a sketch and
such a word, up to ``SMALL`` are compared with each other; more are first compared with up to ``STARS`` pivots in
turn, as long as that finds links, then with each other. No candidate pair between different components is left out: only pairs that
cannot align, by their lengths, their bitmaps or their rare words, are not compared.

Edge cases: a null or wordless text is in a class of its own. Texts of fewer than five words have all their words as
one k-mer, so they are linked only to texts with the same words. Repeated rows share a class. Of a class the row with the least id stays; a null id comes last. An empty
table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.block_naming import keep_rows
from millrace.llm.components import components
from millrace.llm.scratch import Scratch, bounded_batches, skew_aware, tidy
from millrace.llm.word_hashes import BASES, by_size, mix, range_digests, word_digests

KMER = 5
TUPLE = 2
SKETCHES = 24
SIMILARITY = 0.8
# An alignment within the limit leaves so many words and runs of GRAM words in common; fewer need no alignment.
GRAM = 3
SMALL = 32
STARS = 2
# Up to so many texts of a bucket are one task's matter, held against each other by bitmaps of BITS.
DENSE = 2048
BITS = 4096
BLOCK = 256
# Words are counted by slots, 2 MB in all.
SLOTS = 1 << 18
# Sketches are compared in turns, so that what the first ones have joined is not compared again.
TURNS = (0, 2, SKETCHES)
# Up to so many edits the diagonals are walked one by one, beyond that the band is aligned column by column.
FEW_EDITS = 8
SEEDS = mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64) * np.uint64(BASES[0]))
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
# Lower-cased bytes: ASCII letters and digits and all bytes of other characters make up words.
WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def normalised(body: bytes) -> bytes:
    return body.decode("utf-8", "replace").lower().encode().translate(WORD_BYTES)


def labelled_kmers(first: np.ndarray, words: np.ndarray, k: int = KMER) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's k-mers begin in the sequence of all, and the k-mers with their occurrence labels as digests."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], count.cumsum()])
    text = np.repeat(np.arange(len(n)), count)
    at = np.repeat(first[:-1] - starts[:-1], count) + np.arange(len(text))
    grams = range_digests(words, at, np.minimum(at + k, first[text + 1]), BASES[0])
    order = np.lexsort((grams, text))
    g, t = grams[order], text[order]
    fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (t[1:] != t[:-1])]) if len(g) else np.zeros(0, bool)
    run = np.maximum.accumulate(np.where(fresh, np.arange(len(g)), 0))
    label = np.empty(len(g), np.uint64)
    label[order] = (np.arange(len(g)) - run).astype(np.uint64)
    return starts, mix(grams + label * np.uint64(BASES[1]))


def order_sketches(starts: np.ndarray, kmers: np.ndarray, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """texts x sketches digests; every text must have a k-mer."""
    count = np.diff(starts)
    text = np.repeat(np.arange(len(count)), count)
    out = np.empty((len(count), sketches), np.uint64)
    for s in range(sketches):
        h = (kmers ^ SEEDS[2 * s]) * (SEEDS[2 * s + 1] | np.uint64(1))
        h ^= h >> np.uint64(31)
        picks = np.full((len(count), size), -1, np.int64)
        for j in range(size):
            least = np.minimum.reduceat(h, starts[:-1])
            at = np.flatnonzero(h == np.repeat(least, count))
            picks[text[at], j] = at
            picks[count <= j, j] = -1
            h[at] = LAST
        picks.sort(axis=1)  # the order of the text
        value = np.full(len(count), SEEDS[s], np.uint64)
        for j in range(size):
            there = picks[:, j] >= 0
            value = np.where(there, mix(value * np.uint64(BASES[1]) + kmers[np.maximum(picks[:, j], 0)]), value)
        out[:, s] = value
    return out


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Insertions, deletions and replacements that turn one sequence into the other; None if over ``most``.

    Only diagonals within the band are visited: after d edits, the farthest place on each of the 2d + 1 diagonals; after
    ``FEW_EDITS`` all of the band at once.
    """
    if abs(len(a) - len(b)) > most:
        return None
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    head = int(differ.argmax()) if differ.any() else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = a[len(a) - n :][::-1] != b[len(b) - n :][::-1]
    tail = int(differ.argmax()) if differ.any() else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        d = max(len(a), len(b))
        return d if d <= most else None
    goal = len(b) - len(a)
    reach = np.full(2 * most + 3, -2, np.int64)  # by diagonal: the farthest place in a; -2 if not reached
    middle = most + 1
    for d in range(min(most, FEW_EDITS) + 1):
        low, high = max(-d, -len(a)), min(d, len(b))
        k = np.arange(low, high + 1)
        if d == 0:
            x = np.zeros(1, np.int64)
        else:
            i = k + middle
            x = np.maximum(np.maximum(reach[i] + 1, reach[i + 1] + 1), reach[i - 1])
            x[x < 0] = 0
        x = np.minimum(np.minimum(x, len(a)), len(b) - k)
        x = np.maximum(x, np.maximum(0, -k))
        x = _slide_each(a, b, x, k)
        reach[low + middle : high + middle + 1] = x
        if low <= goal <= high and x[goal - low] >= len(a):
            return d
    return _band_by_columns(a.tolist(), b.tolist(), most) if most > FEW_EDITS else None


def _slide_each(a, b, x, k):
    for i, (p, s) in enumerate(zip(x.tolist(), k.tolist(), strict=True)):
        step = 16
        while p < len(a) and p + s < len(b):
            n = min(step, len(a) - p, len(b) - p - s)
            differ = a[p : p + n] != b[p + s : p + s + n]
            if differ.any():
                p += int(differ.argmax())
                break
            p, step = p + n, step * 4
        x[i] = p
    return x


def _band_by_columns(a: list[int], b: list[int], most: int) -> int | None:
    """The same by bit vectors: a column of the alignment matrix holds one bit per row within the band.

    The differences between neighbouring cells are 1, 0 or -1, so two vectors hold a column (Myers; with a moving band, Hyyro). An
    alignment that leaves its band of ``aside`` diagonals on either side of those between both ends takes more than ``most`` edits.
    """
    if len(a) < len(b):
        a, b = b, a
    gap = len(a) - len(b)
    aside = (most - gap) // 2
    band = (1 << (gap + 2 * aside + 1)) - 1
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << (i + aside)
    up, down = band >> aside << aside, 0  # one more, one less than the cell above
    goal, edits = gap + aside, gap  # the edits on the diagonal of the last cell only grow
    for j, y in enumerate(b):
        same = places.get(y, 0) >> j & band
        level = ((((same & up) + up) ^ up) | same | down) & band  # as many edits as the cell before on the diagonal
        if not level >> goal & 1:
            edits += 1
            if edits > most:
                return None
        more, less = (down | ~(level | up)) & band, level & up  # than the cell to the left
        level >>= 1
        up, down = (less | ~(level | more)) & band, level & more
    return edits


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """The labelled runs of k words of one text, sorted; none if it is shorter."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    return np.sort(labelled_kmers(np.array([0, len(words)]), words, k)[1])


def is_link(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY, sorted_a: np.ndarray | None = None) -> bool:
    """Whether two texts, as word digests, are near duplicates. ``sorted_a`` are the labelled words of the first."""
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    # Every edit changes at most k of the longer text's runs of k words, so fewer in common mean too many edits.
    for k in (1, GRAM):
        in_a = sorted_a if k == 1 and sorted_a is not None else runs(a, k)
        if len(np.intersect1d(in_a, runs(b, k), assume_unique=True)) < longer - k + 1 - k * most:
            return False
    return edits_within(a, b, most) is not None


class _Verifier:
    def __init__(self, scratch: Scratch, texts: DataFrame, similarity: float):
        self.scratch, self.texts, self.similarity = scratch, texts, similarity
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None
        self.round = 0

    def check(self, pairs: DataFrame) -> int:
        """Verifies the pairs (a, b), brings the labels of linked nodes up to date and returns the number of links found."""
        self.round += 1
        asked = self.scratch.keep(pairs.select("a", "b").distinct(), f"pairs{self.round}")
        if asked.isEmpty():
            return 0
        similarity = self.similarity

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last: tuple[int, tuple] | None = None

            def read(z: bytes) -> np.ndarray:
                return word_digests([zlib.decompress(z)], families=1)[1][0]

            for batch in batches:
                found = []
                for a, b, za, zb in zip(*batch.columns, strict=True):
                    if last is None or last[0] != a.as_py():
                        words = read(za.as_py())
                        last = a.as_py(), (words, runs(words, 1))
                    if is_link(last[1][0], read(zb.as_py()), similarity, last[1][1]):
                        found.append((a.as_py(), b.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], names=["a", "b"])

        za = self.texts.select(F.col("node").alias("a"), F.col("z").alias("za"))
        zb = self.texts.select(F.col("node").alias("b"), F.col("z").alias("zb"))
        checked = asked.join(zb, "b").join(za, "a").select("a", "b", "za", "zb").mapInArrow(tidy(verify), "a long, b long")
        found = self.scratch.keep(checked, f"links{self.round}")
        count = found.count()
        if count:
            self.links = found if self.links is None else self.links.unionByName(found)
            # A label stands for all links that it came from.
            known = found if self.labels is None else found.union(self.labels.where("node <> label").select("node", "label"))
            self.labels = components(known, self.scratch, f"components{self.round}")
        return count

    def labelled(self, rows: DataFrame, node: str = "node", label: str = "label") -> DataFrame:
        """``rows`` with the label of a node; one without links is its own."""
        if self.labels is None:
            return rows.withColumn(label, F.col(node))
        named = self.labels.select(F.col("node").alias(node), F.col("label").alias(label))
        return rows.join(named, node, "left").withColumn(label, F.coalesce(label, node))


def _open(buckets: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The rows (key, node, n, room, pick, label) of buckets with more than one label, with the bucket's pivot (most of ``pick``) and size."""
    several = scratch.keep(
        buckets.groupBy("key")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max(F.struct("pick", "node", "n", "room", "label")).alias("pivot"), F.count(F.lit(1)).alias("size"))
        .where("least < most")
        .select("key", "pivot", "size"),
        f"{name}-several",
    )
    return scratch.keep(buckets.join(several, "key"), name)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: id, class_id (least id of the class), class_size, links, kept, text_sha256.

    ``links`` counts the verified links of the row's text to different texts; more may hold within a class.
    """
    spark = docs.sparkSession
    skew_aware(spark)
    bounded_batches(spark)
    scratch = Scratch(spark, "order-minhash")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(body).alias("th"),
        F.sha2(body, 256).alias("sha"),
        body.alias("body"),
    )
    id_type = source.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, bodies in by_size(range(batch.num_rows), (normalised(x.as_py()) for x in batch.column(4))):
                first, words = word_digests(bodies)
                starts, kmers = labelled_kmers(first, words[0])
                whole = [range_digests(w, first[:-1], first[1:], BASES[0]).view(np.int64) for w in words]
                with_words = np.flatnonzero(np.diff(starts) > 0)
                values: list[list[int] | None] = [None] * len(rows)
                if len(with_words):
                    found = order_sketches(np.append(starts[with_words], starts[-1]), kmers).view(np.int64).tolist()
                    for i, v in zip(with_words.tolist(), found, strict=True):
                        values[i] = v
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:4], pa.array(np.diff(first), pa.int64()), *(pa.array(w) for w in whole), pa.array(values, pa.list_(pa.int64()))],
                    names=["row", "id", "th", "sha", "n", "w1", "w2", "sketches"],
                )

    rows = scratch.keep(
        source.mapInArrow(tidy(sketch), f"row long, id {id_type}, th long, sha string, n long, w1 long, w2 long, sketches array<long>"), "rows"
    )
    nodes = scratch.keep(
        rows.where("n > 0")
        .groupBy("w1", "w2")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th", "n", "sketches")).alias("of"))
        .select(F.monotonically_increasing_id().alias("node"), "w1", "w2", "of.id", "of.th", "of.n", "of.sketches"),
        "nodes",
    )
    singles = nodes.select("node", "n", F.col("n").alias("room"), (-F.col("node")).alias("pick"), F.posexplode("sketches").alias("sketch", "key")).withColumn("label", F.col("node"))
    buckets = _open(singles, scratch, "buckets")
    labels = None
    if not buckets.isEmpty():
        labels = _link(source, nodes, buckets, similarity, scratch)
    return _classes(rows, nodes, labels, scratch, id_col)


def _link(source, nodes, buckets, similarity, scratch) -> tuple[DataFrame, DataFrame] | None:
    """Labels of the linked nodes and the number of links of each; None without links."""
    wanted = nodes.join(buckets.select("node").distinct(), "node").select("node", F.col("id").alias("node_id"), F.col("th").alias("node_th"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = pa.array([zlib.compress(normalised(x.as_py()), 1) for x in b.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed], names=["id", "th", "z"])

    id_type = source.schema["id"].dataType.simpleString()
    packed = source.select("id", "th", "body").mapInArrow(tidy(squeeze), f"id {id_type}, th long, z binary")
    texts = scratch.keep(
        packed.join(wanted, packed["id"].eqNullSafe(wanted["node_id"]) & (packed["th"] == wanted["node_th"])).select("node", "z"), "texts"
    )
    verifier = _Verifier(scratch, texts, similarity)
    longer = F.greatest("n", "other_n")
    close = F.abs(F.col("n") - F.col("other_n")) <= F.floor((1 - similarity) * longer + 1e-9)
    alike = close & (F.least("room", "other_room") >= F.ceil(similarity * longer - 1e-9))
    for first, last in zip(TURNS, TURNS[1:], strict=False):
        stars = _with_pivot(buckets.where((F.col("sketch") >= first) & (F.col("sketch") < last)), alike)
        apart = verifier.labelled(verifier.labelled(stars, "a", "label_a"), "b", "label_b").where("label_a <> label_b")
        verifier.check(apart)
    columns = ["key", "node", "n", "room"]
    anew = buckets.select(*columns, F.xxhash64("key", "node").alias("pick"))
    buckets = _open(verifier.labelled(anew), scratch, "rest")
    large = buckets.where((F.col("size") > SMALL) & (F.col("label") != F.col("pivot.label")))
    if verifier.check(_with_pivot(large, alike)):
        buckets = _open(verifier.labelled(buckets.select(*columns, "pick")), scratch, "rest-anew")
    dense = buckets.where(F.col("size") <= DENSE)
    if not dense.isEmpty():
        verifier.check(_by_bitmaps(texts, dense, similarity, scratch))
    buckets = _open(verifier.labelled(buckets.where(F.col("size") > DENSE).select(*columns, "pick")), scratch, "large")
    if not buckets.isEmpty():
        rare = _rare_words(texts, buckets.select("key", "node", "n"), similarity, scratch)
        buckets = _open(verifier.labelled(rare), scratch, "rare")
    turn, found = 0, 1
    while not buckets.isEmpty():
        large = buckets.where((F.col("size") > SMALL) if turn < STARS and found else F.lit(False))
        small = buckets.where((F.col("size") <= SMALL) if turn < STARS and found else F.lit(True))
        last = turn == STARS or not found
        found = verifier.check(_with_pivot(large.where("label <> pivot.label"), alike).union(_with_each_other(small, alike)))
        if last:
            break
        # Small buckets are done with, and so are the pivots of the large ones.
        left = large.where("node <> pivot.node").select(*columns, "pick")
        buckets = _open(verifier.labelled(left), scratch, f"left{turn}")
        turn += 1
    if verifier.links is None:
        return None
    pairs = verifier.links.distinct()
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    return verifier.labels, scratch.keep(ends.groupBy("node").agg(F.count(F.lit(1)).alias("links")), "degrees")


def _with_pivot(buckets: DataFrame, alike) -> DataFrame:
    """A pair of the pivot of its bucket and the member, for every other member."""
    others = buckets.where("node <> pivot.node").withColumns({"other_n": F.col("pivot.n"), "other_room": F.col("pivot.room")}).where(alike)
    return others.select(F.col("pivot.node").alias("a"), F.col("node").alias("b"))


def _with_each_other(buckets: DataFrame, alike) -> DataFrame:
    """The pairs of members that are in different components."""
    other = buckets.select(
        "key", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("label").alias("other_label"), F.col("room").alias("other_room")
    )
    pairs = buckets.join(other, "key").where((F.col("node") < F.col("other")) & (F.col("label") != F.col("other_label"))).where(alike)
    return pairs.select(F.col("node").alias("a"), F.col("other").alias("b"))


def bitmaps(first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """texts x BITS / 8 bytes: by bit, whether an odd number of the text's labelled words fall on it."""
    starts, labelled = labelled_kmers(first, words, 1)
    out = np.zeros((len(first) - 1, BITS // 8), np.uint8)
    bit = (labelled % np.uint64(BITS)).astype(np.int64)
    text = np.repeat(np.arange(len(out)), np.diff(starts))
    np.bitwise_xor.at(out.reshape(-1), text * (BITS // 8) + (bit >> 3), np.left_shift(1, bit & 7).astype(np.uint8))
    return out


def bitmap_pairs(key: int, n: np.ndarray, label: np.ndarray, maps: np.ndarray, keys: list[list[int]], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places (i < j) of a bucket's members with different labels that may align, by blocks.

    ``maps`` are their bitmaps, ``keys`` the buckets that each is in. A pair comes up in the least of its common buckets only.
    """
    bits = np.unpackbits(maps, axis=1).astype(np.float32)
    ones = bits.sum(1)
    lesser = [{k for k in own if k < key} for own in keys]
    for low in range(0, len(n), BLOCK):
        here = slice(low, low + BLOCK)
        # One text's words that the other lacks, at least; exact, as whole numbers below 2^24.
        apart = (ones[here, None] + ones - 2 * (bits[here] @ bits.T)).astype(np.int64)
        longer = np.maximum(n[here, None], n)
        most = np.floor((1 - similarity) * longer + 1e-9).astype(np.int64)
        may = (np.abs(n[here, None] - n) <= most) & (n[here, None] + n - apart >= 2 * (longer - most))
        may &= (label[here, None] != label) & (np.arange(len(n))[here, None] < np.arange(len(n)))
        i, j = np.nonzero(may)
        i += low
        first = np.array([lesser[a].isdisjoint(lesser[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)], bool)
        yield i[first], j[first]


def _by_bitmaps(texts: DataFrame, buckets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """The pairs of members of buckets (key, node, n, label) of at most ``DENSE`` texts that may align."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, bodies in by_size(range(batch.num_rows), (zlib.decompress(x.as_py()) for x in batch.column(1))):
                first, words = word_digests(bodies, families=1)
                maps = pa.array([m.tobytes() for m in bitmaps(first, words[0])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), maps], names=["node", "bitmap"])

    def pairs(bucket: pa.Table) -> pa.Table:
        key = bucket.column("key")[0].as_py()
        node, n, label = (bucket.column(c).to_numpy() for c in ("node", "n", "label"))
        maps = np.frombuffer(b"".join(bucket.column("bitmap").to_pylist()), np.uint8).reshape(len(node), -1)
        found = [(node[i], node[j]) for i, j in bitmap_pairs(key, n, label, maps, bucket.column("keys").to_pylist(), similarity)]
        a, b = (np.concatenate([f[side] for f in found]) for side in range(2))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    asked = buckets.groupBy("node").agg(F.collect_list("key").alias("keys"))  # at most SKETCHES
    drawn = texts.join(asked.select("node"), "node").select("node", "z").mapInArrow(tidy(draw), "node long, bitmap binary")
    members = scratch.keep(drawn.join(asked, "node"), "bitmaps")
    return buckets.select("key", "node", "n", "label").join(members, "node").groupBy("key").applyInArrow(pairs, "a long, b long")


def rare_words(first: np.ndarray, words: np.ndarray, seen: np.ndarray, similarity: float) -> tuple[np.ndarray, ...]:
    """By text, the rarest of its words that others may have too, one more than it may lose: place of the text, word, room and words in all.

    ``seen`` counts labelled words by slot, so a slot seen once holds a word of one text only. A text with more such words than it
    may lose cannot align with any and lists none.
    """
    starts, labelled = labelled_kmers(first, words, 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(starts))
    times = seen[slots(labelled)]
    others = times > 1
    text, labelled, times = text[others], labelled[others], times[others]
    shared = np.bincount(text, minlength=len(first) - 1)
    needed = np.ceil(np.diff(first) * similarity - 1e-9).astype(np.int64)
    order = np.lexsort((labelled, times, text))
    text, labelled = text[order], labelled[order]
    rank = np.arange(len(text)) - (shared.cumsum() - shared)[text]
    listed = rank <= (shared - needed)[text]
    text = text[listed]
    return text, labelled[listed], shared[text] - rank[listed], shared[text]


def slots(labelled: np.ndarray) -> np.ndarray:
    return (labelled % np.uint64(SLOTS)).astype(np.int64)


def _rare_words(texts: DataFrame, buckets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """The buckets (key, node, n) split by the rarest words of every node, so many that two nodes that align must share one.

    Words are rare by their slots' counts: any one order of the words gives whole results, so ``SLOTS`` numbers, which the driver
    gathers, do for a vocabulary of any size. ``room`` is the number of words from this one on that others may have too. For the
    first word that two nodes share it bounds how many they share, so a pair is only made where both have room enough.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, bodies in by_size(range(batch.num_rows), (zlib.decompress(x.as_py()) for x in batch.column("z"))):
                first, words = word_digests(bodies, families=1)
                seen += np.bincount(slots(labelled_kmers(first, words[0], 1)[1]), minlength=SLOTS)
        slot = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(seen[slot])], names=["slot", "times"])

    # A text is in at most SKETCHES buckets.
    asked = buckets.groupBy("node").agg(F.collect_list("key").alias("keys"), F.first("n").alias("n"))
    large = scratch.keep(texts.join(asked, "node"), "large-texts")
    counted = large.select("z").mapInArrow(tidy(count), "slot long, times long").groupBy("slot").agg(F.sum("times").alias("times"))
    gathered = counted.toArrow()  # at most SLOTS rows
    seen = np.zeros(SLOTS, np.int64)
    seen[gathered.column("slot").to_numpy()] = gathered.column("times").to_numpy()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, bodies in by_size(range(batch.num_rows), (zlib.decompress(x.as_py()) for x in batch.column("z"))):
                first, words = word_digests(bodies, families=1)
                text, word, room, shared = rare_words(first, words[0], seen, similarity)
                own = batch.select(["node", "n", "keys"]).take(pa.array(np.array(rows, np.int64)[text]))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(word.view(np.int64)), pa.array(room), pa.array(shared)], names=["node", "n", "keys", "word", "room", "pick"]
                )

    rarest = large.select("node", "n", "keys", "z").mapInArrow(tidy(cut), "node long, n long, keys array<long>, word long, room long, pick long")
    return scratch.keep(
        rarest.withColumn("key", F.explode("keys")).select(F.xxhash64("key", "word").alias("key"), "node", "n", "room", "pick"), "split"
    )


def _classes(rows, nodes, found, scratch, id_col) -> DataFrame:
    if found is None:
        named = nodes.select("w1", "w2", F.col("node").alias("class"), F.lit(0).cast("long").alias("links"))
    else:
        labels, degrees = found
        named = (
            nodes.select("w1", "w2", "node")
            .join(labels, "node", "left")
            .join(degrees, "node", "left")
            .select("w1", "w2", F.coalesce("label", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
        )
    named = scratch.keep(named, "named")
    narrow = rows.select("row", "id", "sha", "n", "w1", "w2")
    worded = scratch.keep(narrow.where("n > 0").join(named, ["w1", "w2"]).select("row", "id", "sha", "class", "links"), "worded")
    heads = scratch.keep(
        worded.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("head"), F.count(F.lit(1)).alias("class_size")), "heads"
    )
    grouped = worded.join(heads, "class").select(
        F.col("id").alias(id_col),
        F.col("head.id").alias("class_id"),
        "class_size",
        "links",
        (F.col("row") == F.col("head.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    alone = narrow.where("n = 0").select(
        F.col("id").alias(id_col),
        F.col("id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
        F.lit(0).cast("long").alias("links"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return grouped.unionByName(alone)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with their columns.

    Of wordless texts every row stays; of rows that repeat id and text one.
    """
    groups = Scratch(docs.sparkSession, "near-dedup").keep(near_groups(docs, id_col, text_col, similarity), "groups")
    return keep_rows(docs, groups, id_col, text_col)
