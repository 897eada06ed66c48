"""Tokenizer alignment, divergence audit and SimHash against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from millrace.llm import level_products, pair_bitmaps, queries, trie_simhash
from millrace.llm.scratch import Scratch

PATHS = queries.ALIGNED
ODD_TEXTS = [
    "<|endoftext|> and <s>", "a  b   c \n\n d", "▁piece▁marks", "\x00nul\x00", "Привет мир", "漢字 かな", "emoji 🙂🙂 x", " leading", "trailing ", "\t",
    "it's we'll THEY'RE", "don't12345 4.5e6", "z" * 3000, " " * 2500 + "x", "naïve café ÀÉ ß ŉ ǆ", " \u0085   ​",
]


@pytest.fixture(scope="module")
def odd(spark, texts):
    rows = [(r.doc_id, r.text) for r in texts.collect()] + list(enumerate(ODD_TEXTS, 200)) + [(200, ODD_TEXTS[0]), (None, None)]
    return spark.createDataFrame([(i, t, 5, "p", 3) for i, t in rows], "doc_id long, text string, id int, pair string, container int")


def decoded():
    """Bytes of every token of A, by the tokenizer's own table of symbols, and of B."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    symbols = pair_bitmaps.byte_of_symbol()

    def of_a(i):
        return bytes(symbols[c] for c in a.id_to_token(i))

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()

    return a, b, of_a, of_b


def aligned_by_hand(rows):
    a, b, of_a, of_b = decoded()
    docs, counts = [], Counter()
    for i, text in rows:
        text = text or ""
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        whole = (" " + text).encode()
        if b"".join(map(of_a, x)) != whole or b"".join(map(of_b, y)) != whole:
            x = y = []
        spans = []
        for ids, size in ((x, of_a), (y, of_b)):
            at, own = 0, []
            for k in ids:
                own.append((at, at + len(size(k)), k))
                at = own[-1][1]
            spans.append(own)
        links = [(p[2], q[2]) for p in spans[0] for q in spans[1] if p[0] < q[1] and q[0] < p[1]] if len(x) < 5000 else merged(*spans)
        cuts = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(s[2]) for s in own if start < s[1] <= cut) for own in spans) if len(x) < 5000 else None)
            start = cut
        counts.update(links)
        docs.append((i, len(x), len(y), links, groups))
    top = defaultdict(int)
    for (_, q), n in counts.items():
        top[q] = max(top[q], n)
    out = Counter()
    for i, n_a, n_b, links, groups in docs:
        text = ";".join(groups) if None not in groups else None
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest() if text else ""
        out[(i, n_a, n_b, len(groups), len(links), sum(counts[k] == top[k[1]] for k in links), sum(counts[k] for k in links), digest)] += 1
    return out


def merged(x, y):
    """Links of two long sequences by walking both."""
    i = j = 0
    out = []
    while i < len(x) and j < len(y):
        out.append((x[i][2], y[j][2]))
        end = min(x[i][1], y[j][1])
        i, j = i + (x[i][1] == end), j + (y[j][1] == end)
    return out


def test_alignment_equals_brute_force(odd):
    want = aligned_by_hand([(r.doc_id, r.text) for r in odd.collect()])
    long = {k[:4] for k in want if k[-1] is None}
    got = Counter()
    for r in pair_bitmaps.align(odd, *PATHS).collect():
        key = (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
        got[key[:-1] + (None,) if key[:4] in long else key] += 1
    assert got == want


def test_both_encoders_of_a_agree():
    found = pair_bitmaps.Encoders(*PATHS)
    rng = random.Random(4)
    alphabet = [chr(c) for c in [*range(1, 0x250)]] + list(" \n\t'abcsdmtlve019.,") * 12
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120)))
        assert found.ids_a(text.encode()) == found.a.encode(" " + text, add_special_tokens=False).ids


def test_containers_merge_batches_and_planes(monkeypatch):
    """Sparse and dense bitmaps and all planes come back as the entries that went in."""
    rng = np.random.default_rng(2)
    links = Counter()

    class Batch:
        def __init__(self, n, first):
            self.n_a = np.zeros(n)
            self.doc = np.sort(rng.integers(0, n, 6 * n))
            self.pair = rng.choice([3, 9, 2**31 - 5, 77], 6 * n, p=[0.6, 0.3, 0.05, 0.05])
            for d, p in zip(self.doc.tolist(), self.pair.tolist(), strict=True):
                links[p, d + first] += 1

    held = pair_bitmaps.Container(7)
    for n in (3000, 1, 9000):
        held.add(Batch(n, held.docs))
    got = Counter()
    for batch in held.postings():
        row, position = pair_bitmaps._positions(batch.column("bits"))
        pair, plane = (batch.column(c).to_numpy() for c in ("pair", "plane"))
        for r, p in zip(row.tolist(), position.tolist(), strict=True):
            got[int(pair[r]), p] += 1 if plane[r] == 0 else 1 << int(plane[r] - 1)
    assert got == links
    assert not list(pair_bitmaps.Container(1).postings())


def test_pair_counts_are_popcounts(spark):
    bitmap = np.zeros(pair_bitmaps.CONTAINER_DOCS, np.uint8)
    bitmap[5:6000] = 1
    rows = [(1, 8, 0, np.packbits(bitmap, bitorder="little").tobytes()), (1, 8, 1, b"\x05\x00\x06\x00"), (1, 8, 3, b"\x07\x00"), (2, 8, 0, b"\x01\x00"), (2, 9, 0, b"\x01\x00")]
    postings = spark.createDataFrame([(c, p, k, bytearray(b)) for c, p, k, b in rows], "container long, pair long, plane int, bits binary")
    got = {r.pair: (r.n_docs, r.n_links) for r in pair_bitmaps.pair_counts(postings).collect()}
    assert got == {8: (5996, 5996 + 2 + 4), 9: (1, 1)}
    scores = pair_bitmaps._returned(
        pa.table({"container": [1, 1], "pair": [8, 8], "plane": pa.array([0, 1], pa.int32()), "bits": [b"\x05\x00\x09\x00", b"\x05\x00"]}),
        pa.table({"container": [1], "pair": [8], "n_links": [10], "best": [True]}),
    )
    assert scores.to_pylist() == [{"container": 1, "position": 5, "n_best": 2, "count_sum": 20}, {"container": 1, "position": 9, "n_best": 1, "count_sum": 10}]


def audited_by_hand(rows, min_docs, top):
    words = [(lang or "", source or "", [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    docs, uses = Counter(), Counter()
    for lang, source, w in words:
        docs.update((lang, t) for t in set(w))
        uses.update((lang, source, t) for t in w)
    groups = sorted({(lang, source) for lang, source, _ in words})
    out, joint = [], Counter()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (k, t), n in docs.items() if k == lang and n >= min_docs)
        sources = [s for k, s in groups if k == lang]
        count = {s: {t: uses[lang, s, t] for t in kept} for s in sources}
        count[None] = {t: sum(count[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 5) // (sum(own.values()) + 5 * len(kept)) for t, c in own.items()} for s, own in count.items()}
        for i, s in enumerate(sources):
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - p[None][t], t) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
            for j in range(i, len(sources)):
                joint.update((lang, i, count[s][t], j, count[sources[j]][t]) for t in kept)
    return sorted(out), joint


@pytest.mark.parametrize("columns,block_terms", [(2, 7), (32, 4096), (1, 1)])
def test_audit_equals_brute_force(spark, columns, block_terms):
    rng = random.Random(columns)
    vocabulary = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(100)] + ["Éa", "éa", "ÀB", "naïve", "漢字", "X", "x"]
    rows = []
    for k in range(220):
        n = rng.choice([0, 3, 40, 60])
        text = None if k % 17 == 0 else " ".join(rng.choice(vocabulary[: rng.choice([5, 107])]) + rng.choice(["", ".", "1", "_Up"]) for _ in range(n))
        rows.append((text, rng.choice(["en", "en", "de", None, "thin"] if k > 3 else ["thin"]), rng.choice(["s0", "s0", "s1", "s2", None, "S"])))
    rows += [("only once", "rare", "s0"), (None, "rare", "s1"), (rows[7][0], *rows[7][1:])]
    docs = spark.createDataFrame([(t, a, b, 1, "x") for t, a, b in rows], "text string, lang string, source string, n int, term string")
    found = level_products.Audit(docs, min_docs=12, block_terms=block_terms)
    want, joint = audited_by_hand(rows, 12, 4)
    pairs = {(r.lang, r.a, r.b): r.value for r in found.pair_values(columns).collect()}
    assert pairs == {(r.lang, r.a, r.b): r.value for r in found.pair_values().collect()}
    got = found.pairs().unionByName(found.terms(4)).collect()
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got) == want
    tables = Counter({(r.lang, r.a, r.level_a, r.b, r.level_b): r.terms for r in found.joint_tables(columns).collect()})
    assert tables == joint


def printed(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(prints):
    """The component of every fingerprint, by comparing all of them."""
    every = sorted(set(prints))
    whole = np.array(every, np.uint64)
    label = np.arange(len(every))
    pairs = [(i, j) for i in range(len(every)) for j in np.flatnonzero(np.bitwise_count(whole ^ whole[i]) <= 3).tolist() if i < j]
    for _ in every:
        before = label.copy()
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
        if (before == label).all():
            break
    return dict(zip(every, label.tolist(), strict=True))


def test_simhash_equals_brute_force(spark, odd):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for k in range(12):
        base = [rng.choice(words) for _ in range(300)]
        for copy in range(rng.choice([1, 2, 9])):
            changed = [w if rng.random() > 0.01 * copy else rng.choice(words) for w in base]
            rows.append((1000 + 20 * k + copy, "  ".join(changed).replace("w1", "W1" if copy % 2 else "w1")))
    rows += [(3000, "two words"), (3001, "TWO\twords"), (3002, "\x0b \n"), (3003, "a b a b a b")]
    docs = spark.createDataFrame([(i, t, 0, "") for i, t in rows], "doc_id long, text string, print int, least string")
    prints = [printed(t) for _, t in rows]
    label = reached(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[label[p]] = min(least.get(label[p], i), i)
    want = Counter((i, f"{p:016x}", least.get(label[p])) for (i, _), p in zip(rows, prints, strict=True))
    for limit in (1 << 20, 2):
        got = trie_simhash.near_components(docs, limit=limit).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("frontier", [1 << 18, 5])
def test_trie_walk(frontier):
    """Dense groups, chains of links and strangers; the walk finds the components of an exhaustive comparison."""
    rng = random.Random(frontier)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(48)
        for _ in range(rng.choice([1, 30, 150])):
            x = centre
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(48)
            prints.add(x)
    prints = np.array(sorted(prints | {rng.getrandbits(48) for _ in range(200)}), np.uint64)
    roots = np.array([[0], [len(prints)], [0], [len(prints)], [16]])
    label = trie_simhash.walk(prints, roots, frontier=frontier)
    want = reached(prints.tolist())
    assert label.tolist() == [want[p] for p in prints.tolist()]


def test_nodes_are_walked_in_spark(spark):
    """A node that holds more than the limit is split by its next bits, with every link kept."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = sorted({centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 4))}) for _ in range(300)} | {rng.getrandbits(64) for _ in range(100)})
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    nodes = trie_simhash.node_pairs(frame, Scratch(spark, "nodes"), limit=40)
    sizes = nodes.groupBy(*trie_simhash.NODES).count().collect()
    assert max(r["depth"] for r in sizes) > trie_simhash.PART
    assert max(r["count"] for r in sizes if r["depth"] < 56) <= 40
    order = [*trie_simhash.NODES, "turned"]
    links = nodes.select(*order).repartition(*trie_simhash.NODES).sortWithinPartitions(*order).mapInArrow(trie_simhash._linked, "a long, b long").collect()
    label = {p: p for p in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in links:
        x, y = root(r.a), root(r.b)
        label[max(x, y)] = min(x, y)
    want = reached(prints)
    classes = defaultdict(set)
    for p, s in zip(prints, signed, strict=True):
        classes[want[p]].add(root(s))
    assert all(len(c) == 1 for c in classes.values()) and len({min(c) for c in classes.values()}) == len(classes)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert pair_bitmaps.align(docs, *PATHS).count() == 0
    assert level_products.audit(docs).count() == 0
    assert trie_simhash.near_components(docs).count() == 0
