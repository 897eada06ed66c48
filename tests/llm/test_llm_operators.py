"""Edge cases of every operator against brute force; the given tables against SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    block_naming,
    byte_cnn,
    chat_parts,
    components,
    label_propagation,
    order_minhash,
    piece_tokens,
    pivot_search,
    queries,
    raking,
    relative_lz,
    warc_revisits,
    window_packing,
)
from millrace.llm.scratch import Scratch
from millrace.llm.word_hashes import word_digests


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == duck_rows(connect(sf_dir), queries.ORACLE_SQL[name])


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("digest", [F.xxhash64, lambda b: F.length(b).cast("long") % 3])
@pytest.mark.parametrize("block", [7, 2048])
def test_exact_groups(texts, digest, block):
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    got = block_naming.exact_groups(texts, block_chars=block, digest=digest).collect()
    want = Counter()
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        want[(i, max((j for j in same if j is not None), default=None), len(same), sha(t))] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len({t or "" for _, t in rows})


def test_exact_dedup_keeps_one_of_repeated_rows(texts):
    kept = block_naming.exact_dedup(texts)
    assert kept.columns == texts.columns
    assert sorted(r.doc_id for r in kept.where("doc_id < 10").collect()) == [2, 3, 5, 6, 7, 8, 9]


def removed(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            if i is not None:
                first[g] = min(first.get(g, i), i)
    out = Counter()
    for i, w in split:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        out[(i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())] += 1
    return out


@pytest.mark.parametrize("window,gram", [(50, 20), (6, 3), (4, 4)])
def test_relative_lz(spark, texts, window, gram):
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    rng = random.Random(window)
    rows += [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = relative_lz.duplicate_spans(docs, window=window, gram=gram).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == removed(rows, window)
    assert all(f.length >= window for r in got for f in r.factors)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("few", [0, 24])
def test_banded_alignment(monkeypatch, few):
    monkeypatch.setattr(order_minhash, "FEW_EDITS", few)
    rng = random.Random(3)
    for _ in range(300):
        a = np.array([rng.randint(0, 3) for _ in range(rng.randint(0, 25))], dtype=np.uint64)
        b = np.array([x for x in a for _ in range(rng.choice([0, 1, 1, 1, 2]))], dtype=np.uint64)
        d = edits(a.tolist(), b.tolist())
        for most in (0, 3, 8, 40):
            assert order_minhash.edits_within(a, b, most) == (d if d <= most else None)


def near_classes(rows, similarity=0.8):
    """Classes by plain edit distance between all pairs of word sequences."""
    number = {}
    words = {i: [number.setdefault(w, len(number)) for w in order_minhash.normalised((t or "").encode()).split()] for i, t in rows}
    parent = {i: i for i in words}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in words if words[i]]
    for a in ids:
        for b in ids:
            longer = max(len(words[a]), len(words[b]))
            # Words that are not in common must be edited.
            lost = longer - sum((Counter(words[a]) & Counter(words[b])).values())
            if a < b and find(a) != find(b) and lost <= longer - similarity * longer + 1e-9 and edits(words[a], words[b]) <= longer - similarity * longer + 1e-9:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in words}


def edited(rng, text, share, words):
    """``text`` with this share of its words replaced, deleted or followed by a new one, in turn."""
    out = []
    chosen = set(rng.sample(range(len(text)), round(share * len(text))))
    for at, word in enumerate(text):
        if at not in chosen:
            out.append(word)
            continue
        kind = rng.randrange(3)
        out += [[rng.choice(words)], [], [word, rng.choice(words)]][kind]
    return out


@pytest.mark.parametrize("share,least", [(0.02, 0.98), (0.05, 0.95), (0.1, 0.9)])
def test_edited_copies_are_found(spark, share, least):
    """Pairs of a text and its edited copy, all within the limit of a fifth by plain edit distance."""
    rng = random.Random(int(share * 100))
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        copy = edited(rng, text, share, words)
        assert edits(text, copy) <= 0.2 * max(len(text), len(copy))
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
    got = {r.doc_id: r.class_id for r in order_minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * i] == 2 * i for i in range(40))
    assert sum(got[2 * i + 1] == 2 * i for i in range(40)) >= least * 40


def test_too_many_edits_and_moved_blocks_stay_apart(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    text = [rng.choice(words) for _ in range(200)]
    half = text[100:] + text[:100]
    far = ["x"] * 50 + text[50:]
    near = ["x"] * 40 + text[40:]
    rows = [(1, " ".join(text)), (2, " ".join(half)), (3, " ".join(far)), (4, " ".join(near))]
    got = {r.doc_id: r.class_id for r in order_minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_classes(rows) and got == {1: 1, 2: 2, 3: 1, 4: 1}


def test_bitmaps_pass_every_pair_that_aligns_once():
    """Pairs within the limit come up in exactly one of their common buckets; few of those beyond it do."""
    rng = random.Random(10)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    texts = [edited(rng, base, rng.uniform(0, 0.3), vocabulary) for _ in range(70)] + [["a"] * 5, ["a"] * 6, ["a", "b"]]
    first, words = word_digests([" ".join(t).encode() for t in texts], families=1)
    maps, n = order_minhash.bitmaps(first, words[0]), np.diff(first)
    keys = [sorted(rng.sample(range(8), rng.randint(1, 6))) for _ in texts]
    label = np.array([i // 2 for i in range(len(texts))])
    found = Counter()
    for key in range(8):
        inside = np.array([i for i, own in enumerate(keys) if key in own])
        for i, j in order_minhash.bitmap_pairs(key, n[inside], label[inside], maps[inside], [keys[i] for i in inside], 0.8):
            found.update(zip(inside[i].tolist(), inside[j].tolist(), strict=True))
    assert max(found.values()) == 1
    candidates = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if set(keys[i]) & set(keys[j]) and label[i] != label[j]]
    digests = [words[0][a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    near = {(i, j) for i, j in candidates if order_minhash.edits_within(digests[i], digests[j], int(0.2 * max(n[i], n[j]) + 1e-9)) is not None}
    assert near and near <= found.keys() and len(found) < 0.8 * len(candidates)


@pytest.mark.parametrize("slots", [7, 1 << 18])
def test_rare_words_are_shared_by_texts_that_align(monkeypatch, slots):
    """Texts that align share a listed word, and at the first one both have room for the words they must share."""
    monkeypatch.setattr(order_minhash, "SLOTS", slots)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = [edited(rng, base, rng.uniform(0, 0.2), vocabulary) for _ in range(50)] + [[rng.choice(vocabulary) for _ in range(120)] for _ in range(10)]
    texts += [[f"own{i}" for i in range(40)], ["a"], ["a", "a"]]
    first, words = word_digests([" ".join(t).encode() for t in texts], families=1)
    n = np.diff(first)
    seen = np.bincount(order_minhash.slots(order_minhash.labelled_kmers(first, words[0], 1)[1]), minlength=slots)
    listed = defaultdict(dict)
    for text, word, room, _ in zip(*(x.tolist() for x in order_minhash.rare_words(first, words[0], seen, 0.8)), strict=True):
        listed[text][word] = room
    digests = [words[0][a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    aligned = 0
    for i in range(len(texts)):
        for j in range(i):
            longer = max(n[i], n[j])
            if order_minhash.edits_within(digests[i], digests[j], int(0.2 * longer + 1e-9)) is not None:
                aligned += 1
                assert any(min(listed[i][w], listed[j][w]) >= 0.8 * longer - 1e-9 for w in listed[i].keys() & listed[j].keys())
    assert aligned > 100
    if slots > 7:
        assert 60 not in listed and len(listed[0]) <= 0.2 * n[0] + 1


@pytest.mark.parametrize("small,dense", [(1, 1), (32, 1), (32, 20), (32, 2048)])
def test_near_groups(spark, monkeypatch, small, dense):
    """Copies, near copies in chains, variants too far apart, and a passage in many texts."""
    monkeypatch.setattr(order_minhash, "SMALL", small)
    monkeypatch.setattr(order_minhash, "DENSE", dense)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(900)]
    rows, base = [], [rng.choice(words) for _ in range(200)]
    passage = [rng.choice(words) for _ in range(60)]
    chain = base
    for i in range(60):
        text = list(chain if i < 12 else base)
        for _ in range(2 if i < 30 else 5):
            text[rng.randrange(200)] = rng.choice(words)
        chain = text
        rows.append((i, " ".join(text).upper() + "."))
    rows += [(100 + i, " ".join(passage + [rng.choice(words) for _ in range(rng.randint(3, 40))])) for i in range(60)]
    rows += [(200, rows[0][1]), (201, "one two"), (202, "One, two!"), (203, ""), (204, None)]
    got = order_minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == near_classes(rows)
    assert sum(r.kept for r in got) == len({r.class_id for r in got})


def test_near_groups_edge_rows(texts):
    got = order_minhash.near_groups(texts).collect()
    assert len(got) == texts.count()
    named = defaultdict(set)
    for r in got:
        named[r.class_id].add(r.doc_id)
    assert named[1] == {1, 2, 3} and named[4] == {4} and named[5] == {5} and named[11] == {11}
    assert sorted(r.kept for r in got if r.doc_id == 9) == [False, True]


@pytest.mark.parametrize("finish", [0, 3, components.FINISH])
def test_components(spark, finish):
    links = [(1, 2), (2, 3), (9, 8), (7, 8), *((i, i + 1) for i in range(20, 60))]
    found = components.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"), "c", finish)
    got = {r.node: r.label for r in found.collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, **{i: 20 for i in range(20, 61)}}


def test_chats_round_trip(spark):
    nasty = ["<end>\n", "<turn a>", "\\l\\b<", "\\", "", None, "<part image 1/>", "\\### Assistant: </turn> ok", "é😀\n\n"]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate((r, x) for x in nasty for r in ("user", "assistant", None, "a>b<c\\g"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    typed = turns.withColumn("parts", chat_parts.text_parts(F.col("text")))
    read = chat_parts.read_chats(chat_parts.format_chats(typed)).collect()
    want = Counter((c, t, r or "", x or "", r == "assistant") for c, t, r, x in rows)
    assert Counter((r.conv_id, r.place, r.role, r.text, r.in_loss) for r in read) == want


def test_chat_attachments(spark):
    parts = [("text", "see <this>", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", None), ("odd", "plain", None, None), ("document", "", None, 3)]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [])], f"conv_id long, turn long, role string, parts array<{chat_parts.PART_TYPE}>")
    row = chat_parts.format_chats(turns).first()
    assert row.formatted == "<turn user>see \\lthis><part image 512/><part audio 25/>plain<part document 1536/><end>\n<turn assistant><end>\n"
    assert [(a.turn, a.place, a.kind, a.ref, a.tokens) for a in row.attachments] == [(1, 0, "image", "a.png", 512), (1, 1, "audio", "b.wav", 25), (1, 2, "document", None, 1536)]
    assert row.media_tokens == 2073


def test_pivot_search(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(150)]
    rows += [(200 + i, [0.5] * 5) for i in range(8)] + [(50, rows[50][1]), (300, None), (350, [1.0, None]), (400, [float("nan")] * 5), (450, []), (None, [0.0] * 5)]
    rows += [(500, [3e38] * 5), (501, [1e30, -1e30, 0.0, 0.0, 1.0]), (550, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    valid = []
    for r in frame.collect():
        if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            valid.append((r.vec_id, [int(np.floor(x * 256.0)) for x in r.embedding]))
    want = set()
    for q, v in valid:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in valid if c != q and len(w) == len(v))[:5]
            want |= {(q, k, c, max(min(-s, (1 << 63) - 1), -(1 << 63))) for k, (s, c) in enumerate(scores, 1)}
    assert {tuple(r) for r in pivot_search.top_k(frame, lambda i: i % 50 == 0).collect()} == want


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op6_byte_cnn(spark, sf).join(queries.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert len(held) > 100 and sum(held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(texts):
    model = byte_cnn.fit(texts)
    got = {r.doc_id: (r.lang_pred, r.score) for r in byte_cnn.identify(texts, model).collect()}
    assert got[4] == got[5] == got[11] == ("und", 0.0) and got[8][0] == "en"
    assert byte_cnn.fit(texts.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.doc_id for r in byte_cnn.known_language(texts).collect()} >= {1, 2, 3, 6, 7, 8, 13}


def test_language_sample_of_copied_texts(spark, monkeypatch):
    """Every language teaches, whatever its copies, and every different text at most once."""
    hot = {lang: f"{lang} {word} " * 20 for lang, word in (("aa", "bala"), ("bb", "wyzo"), ("cc", "tekiru"), ("dd", "qopux"))}
    rows = [(f"{lang}", text) for lang, text in hot.items() for _ in range(400)]
    rows += [("dd", f"qopux {i} " * 60) for i in range(90)] + [("cc", hot["aa"])]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    taught = []
    monkeypatch.setattr(byte_cnn, "train", lambda windows, labels, langs, seed: taught.append((windows, labels, langs)))
    byte_cnn.fit(docs, docs_per_lang=10)
    windows, labels, langs = taught[0]
    assert langs == ("aa", "bb", "cc", "dd")
    got = {lang: Counter(bytes(w).rstrip(b"\0") for w, k in zip(windows, labels, strict=True) if langs[k] == lang) for lang in langs}
    assert got["aa"] == Counter([hot["aa"].encode()]) and got["bb"] == Counter([hot["bb"].encode()])
    assert got["cc"] == Counter([hot["cc"].encode(), hot["aa"].encode()])
    heads = [w for w in got["dd"] if w.startswith((b"qopux", b"dd"))]
    assert len({w.split()[1] for w in heads}) == 10 and sum(got["dd"].values()) <= 20


def test_windows_cover_every_byte_run():
    for n in (0, 1, 255, 256, 257, 508, 509, 510, 5000):
        spans = byte_cnn.windows_of(bytes(n))
        covered = {p for s, k in spans for p in range(s, s + k - 3)}
        assert covered >= set(range(n - 3)) and all(k <= 256 for _, k in spans)


def test_balanced_shards(spark, texts):
    rows = [(i, f"t{i}") for i in range(50)] + [(100 + i, "hot") for i in range(60)] + [(200 + i, f"pair{i // 2}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = label_propagation.balanced_shards(docs, slice_rows=7).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == 150 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    text = dict(rows)
    pairs = defaultdict(set)
    for r in got:
        if text[r.doc_id].startswith("pair"):
            pairs[text[r.doc_id]].add(r.shard)
    # By chance an eighth of the pairs would be whole; the hot group fills most shards.
    assert sum(len(s) == 1 for s in pairs.values()) >= 12
    edge = label_propagation.balanced_shards(texts).collect()
    assert len(edge) == texts.count()
    assert {r.text_crc32 for r in edge if r.doc_id in (4, 5)} == {zlib.crc32(b"")}


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "It's I'LL don't ''s .'s a'b they're 's", "a_b-c@d.e (f) 12ab34", "x\x0by\x0cz\r\n\tq", "<|endoftext|> a<|b", "Ünï çödé ÿß µ º 3²", "é a\x1cb\x85c 　d", "İ ΑΣ. 가각 한"]


def test_token_ids():
    t = piece_tokens.PieceTokenizer(TOKENIZER)
    for text, ids in zip(ODD, t.ids([x.encode() for x in ODD]), strict=True):
        assert ids.tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids


def least_cost(at, cost, size, shortest):
    best = {0: 0}
    for j in range(1, len(at)):
        options = []
        for i in range(j):
            n = at[j] - at[i]
            if n <= size and i in best:
                options.append(best[i] + (0 if n & (n - 1) == 0 and n >= shortest else size - n))
        best[j] = min(options) + cost[j]
    return best[len(at) - 1]


def test_plan_is_the_cheapest():
    rng = random.Random(4)
    for _ in range(200):
        at = np.unique([0, *np.cumsum([rng.randint(1, 16) for _ in range(rng.randint(1, 30))])])
        cost = np.array([0, *[rng.choice([0, 2, 9]) for _ in at[1:]]])
        cuts, found = window_packing.plan_windows(at, cost, 16, 4)
        assert found == least_cost(at.tolist(), cost.tolist(), 16, 4)
        assert cuts[0] == 0 and cuts[-1] == at[-1] and max(np.diff(cuts)) <= 16


def test_packing(spark, texts):
    rows = sorted(((r.doc_id, r.text) for r in texts.collect()), key=str)
    t = piece_tokens.PieceTokenizer(TOKENIZER)
    got = [r.asDict() for r in window_packing.pack(texts.repartition(2), TOKENIZER).collect()]
    whole = Counter()
    for i, text in rows:
        whole[(i, len(t.tokenizer.encode(text or "", add_special_tokens=False).ids) + 1)] += 1
    per_doc = defaultdict(list)
    for g in got:
        per_doc[(g["doc_id"], g["doc_tokens"])].append((g["start"], g["length"], g["ids_crc32"]))
    for (i, n), copies in whole.items():
        ids = next(t.tokenizer.encode(x or "", add_special_tokens=False).ids for j, x in rows if j == i) + [1]
        starts = sorted(per_doc[(i, n)])
        assert sum(x[1] for x in starts) == n * copies
        for s, length, crc in starts:
            assert zlib.crc32(np.array(ids[s : s + length], "<u4").tobytes()) == crc
    sequences = defaultdict(list)
    for g in got:
        sequences[g["sequence_id"]].append((g["offset"], g["length"]))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 2048


def test_raking_meets_targets():
    rng = np.random.default_rng(2)
    tokens = rng.integers(50, 100, (3, 4, 2)).astype(float)
    shares = [np.array([0.3, 0.3, 0.4]), np.array([0.25, 0.25, 0.2, 0.3]), np.array([0.5, 0.5])]
    wanted = raking.rake(tokens, shares, 0.4)
    assert (wanted <= tokens).all()
    for axis, share in enumerate(shares):
        sums = wanted.sum(axis=tuple(a for a in range(3) if a != axis))
        assert np.allclose(sums, 0.4 * tokens.sum() * share, rtol=1e-6)


def test_mix_edge_rows(texts):
    docs, margins, tokens = queries.mixture(texts)
    got = raking.mix(docs, margins, 0.5, tokens).collect()
    assert len(got) == texts.count() and all(0 <= r.mix_probability <= 1 for r in got)
    assert {r.mix_tokens for r in got if r.doc_id in (4, 5)} == {0}


def test_mix_keeps_unlabelled_and_further_languages(spark):
    langs = ["en", "en", "de", "fr", "es", None, "it", "nl"]
    initial, source = "b" * 3 + "h" * 7 + "r" * 10, [0] * 4 + [1] + [2] * 15
    rows = [(i, f"{initial[i // 160]}{i} " * 20, langs[i % 8], f"src{source[i // 8 % 20]}") for i in range(3200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    counted, margins, tokens = queries.mixture(docs)
    got = raking.mix(counted, margins, queries.BUDGET_SHARE, tokens).collect()
    rest = [r for r in got if r.mix_lang == 4]
    assert {r.lang for r in rest} == {None, "it", "nl"} and all(r.mix_probability > 0 for r in rest)
    wanted = Counter()
    for r in got:
        wanted[r.mix_lang] += r.mix_tokens * r.mix_probability
    total = sum(r.mix_tokens for r in got)
    assert wanted[4] == pytest.approx(queries.BUDGET_SHARE * total * 3 / 8)
    for k, share in enumerate((0.5, 0.2, 0.2, 0.1)):
        assert wanted[k] == pytest.approx(queries.BUDGET_SHARE * total * 5 / 8 * share)
    kept = {r.lang for r in corpus_pipeline.mixture(spark, docs, "").collect()}
    assert kept == set(langs)
    other = docs.where("lang IS NULL OR lang IN ('it', 'nl')")
    assert {r.lang for r in corpus_pipeline.mixture(spark, other, "").collect()} == {None, "it", "nl"}


def test_warc_revisits(spark, tmp_path):
    long = "WARC/1.1\r\n\r\npayload é " * 60
    rows = [(1, "http://a/\r\nX: y", long), (2, None, long), (3, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "x" * 1000), (7, "u", "x" * 1000), (None, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc_revisits.write_archives(pages, path, queries.WARC_DATE)
    got = warc_revisits.read_archives(spark, path).collect()
    body = {i: (h or "").encode() for i, _, h in rows}
    assert Counter((r.id, r.payload_bytes, r.payload_digest) for r in got) == Counter((i, len(body[i]), hashlib.sha1(body[i]).hexdigest()) for i, *_ in rows)
    assert all(r.digest_matches for r in got)
    found = Counter((r.id, r.record_type, r.refers_to) for r in got)
    assert found == Counter([(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (None, "revisit", 3), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None), (7, "revisit", 7)])


def empties(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    yield block_naming.exact_groups(docs)
    yield relative_lz.duplicate_spans(docs)
    yield order_minhash.near_groups(docs)
    yield byte_cnn.identify(docs, byte_cnn.fit(docs))
    yield byte_cnn.known_language(docs)
    yield label_propagation.balanced_shards(docs)
    yield window_packing.pack(docs, TOKENIZER)
    counted, margins, tokens = queries.mixture(docs)
    yield raking.mix(counted, margins, 0.5, tokens)
    yield chat_parts.format_chats(spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat_parts.PART_TYPE}>"))
    yield pivot_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i % 50 == 0)
    yield warc_revisits.resolve_revisits(spark.createDataFrame([], "page_id long, url string, html string"))


def test_empty_tables(spark):
    for frame in empties(spark):
        assert frame.count() == 0


def test_pipeline_stages(spark, texts):
    """Every stage keeps the columns, and its decisions are those of its operator."""
    docs = Scratch(spark, "stages").keep(texts, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = Counter(r.text for r in docs.collect())
        docs = Scratch(spark, "stages").keep(stage(spark, docs, ""), name)
        after = Counter(r.text for r in docs.collect())
        assert docs.columns == texts.columns and after <= before
        if name == "exact_duplicates":
            assert set(after) == set(before) and max(after.values()) == 1
        if name == "near_duplicates":
            assert len([t for t in after if t.startswith(("b", "c", "d", "f", "g", "h", "k", "l", "m"))]) >= 4
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_mixture_decides_texts_with_one_id_apart(spark):
    """Null or repeated ids do not tie different texts together, and columns of the mixture's own names stay as they are."""
    rows = [(None if i % 2 else 7, f"text {i}", "en", "src0", f"kept{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_drawn string")
    got = corpus_pipeline.mixture(spark, docs, "").collect()
    assert 100 < len(got) < 300 and {r.mix_drawn for r in got} <= {f"kept{i}" for i in range(400)}
    counted, margins, tokens = queries.mixture(docs)
    with pytest.raises(ValueError, match="mix_drawn"):
        raking.mix(counted, margins, 0.5, tokens)


def test_mixture_equals_brute_force(spark, texts):
    """Drawn rows follow from the raked cells and the digest; texts without a word in a field keep their share."""
    others = [(50 + i, t, 0, 1, 2, lang, "s") for i, (t, lang) in enumerate([("Привет мир", "ru"), ("漢字 かな", None), ("123 456", "en"), ("élan école", "fr")] * 4)]
    docs = texts.unionByName(spark.createDataFrame(others, texts.schema))
    cells, rows = Counter(), []
    for r in docs.collect():
        found = [w for w in (r.text or "").encode().split()]
        counts = [sum(chr(w[0]).lower() in letters for w in found if w[0] < 128) for letters in ("abcd", "efghijklmn", "opqrstuvwxyz")]
        at = 2, ["en", "de", "fr", "es"].index(r.lang) if r.lang in ("en", "de", "fr", "es") else 4, counts.index(max(counts)) if any(counts) else 3
        cells[at] += len(found)
        rows.append((r.doc_id, r.text, at, len(found)))
    table = np.zeros((3, 5, 4))
    for at, n in cells.items():
        table[at] = n
    shares = [np.array([0.2, 0.05, 0.75]), np.array([0.5, 0.2, 0.2, 0.1, np.nan]), np.array([0.15, 0.35, 0.5, np.nan])]
    wanted = raking.rake(table, shares, queries.BUDGET_SHARE)
    want = Counter()
    for i, t, at, n in rows:
        key = f"{queries.MIX_SEED}:{'' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}"
        if int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52 < (wanted[at] / table[at] if n else queries.BUDGET_SHARE):
            want[i, t] += 1
    assert Counter((r.doc_id, r.text) for r in corpus_pipeline.mixture(spark, docs, "").collect()) == want


def test_mixture_sql_has_further_languages(spark, tmp_path):
    """The SQL twin on a table with null and further languages and texts of no topic."""
    import duckdb

    langs = ["en", "en", "de", None, "it"]
    rows = [(i, ["bar", "hat", "pip", "мир", ""][i // 5 % 5] * (i % 3 + 1) + " x" * (i % 2), langs[i % 5], f"src{i % 4}") for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert spark_rows(queries.op9_raking(spark, str(tmp_path))) == duck_rows(con, queries.ORACLE_SQL["op9_raking"])


def test_archives_keep_every_uri(spark, tmp_path):
    rows = [(7, "u1", "X" * 1500), (7, "u2", "X" * 1500), (7, "u2", "X" * 1500), (None, "a", None), (None, "b", None), (8, "u1", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc_revisits.write_archives(pages, str(tmp_path / "w"), queries.WARC_DATE)
    got = warc_revisits.read_archives(spark, str(tmp_path / "w")).collect()
    assert Counter((r.id, r.uri, r.payload_bytes) for r in got) == Counter((i, u, len(h or "")) for i, u, h in rows)
    assert [r.record_type for r in got if r.id == 7].count("response") == 1


def test_repeated_rows_spread_over_slices(spark):
    docs = spark.createDataFrame([(1, "same")] * 2000, "doc_id long, text string")
    got = label_propagation.balanced_shards(docs, 8, slice_rows=100)
    assert sorted((r.shard, r.n, r.low, r.high) for r in got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()) == [(s, 250, 0, 249) for s in range(8)]


def test_kept_rows_keep_columns_of_inner_names(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (2, "a", "y")], "doc_id long, text string, __text string")
    assert [tuple(r) for r in block_naming.exact_dedup(docs).collect()] == [(2, "a", "y")]
