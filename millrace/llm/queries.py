"""The checked queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import (
    block_naming,
    byte_cnn,
    chat_parts,
    label_propagation,
    level_products,
    order_minhash,
    pair_bitmaps,
    pivot_search,
    raking,
    relative_lz,
    trie_simhash,
    warc_revisits,
    window_packing,
)
from millrace.llm.scratch import Scratch
from millrace.session import fresh_path

WARC_DATE = "2024-06-01T00:00:00Z"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ALIGNED = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
HELD_OUT_PART = 2
EXTRA_CONVERSATION = -7
EXTRA_TEXT = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_groups(table(spark, sf_dir, "documents"))


def op2_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz.duplicate_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_groups(table(spark, sf_dir, "documents"))


def op4_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(EXTRA_CONVERSATION, 0, "user", EXTRA_TEXT), (EXTRA_CONVERSATION, 1, "assistant", EXTRA_TEXT)], turns.schema
    )
    typed = turns.unionByName(extra).select("conv_id", "turn", "role", chat_parts.text_parts(F.col("text")).alias("parts"))
    formatted = Scratch(spark, "chats").keep(chat_parts.format_chats(typed), "formatted")
    read = chat_parts.read_chats(formatted)
    gathered = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text", "in_loss"))).alias("turns"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["in_loss"]), lambda t: t["text"]), "")
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    digests = gathered.select(
        F.col("conv_id").alias("read_conv"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every.cast("binary"), 256).alias("turns_sha256"),
        loss.alias("loss"),
    )
    return formatted.join(digests, formatted["conv_id"].eqNullSafe(digests["read_conv"])).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


QUERY_STEP = 50
TOP = 5
SCALE = 256


def op5_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % QUERY_STEP == 0, TOP, float(SCALE))


SHARDS = 8


def op7_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_propagation.balanced_shards(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(label_propagation.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "links",
    )


def held_out(doc_id: Column) -> Column:
    """Documents that teach nothing; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_PART, F.lit(True))


def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = byte_cnn.fit(docs.where("NOT held_out"))
    return byte_cnn.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op8_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


# The lexical field of a text: the range of initial letters that most of its words have.
FIELDS = ("a-d", "e-n", "o-z")
BUDGET_SHARE = 0.6
MIX_SEED = 11
SOURCE_TARGETS = {"src0": 0.2, "src1": 0.05, raking.REST: 0.75}
# No target for REST: null and further languages keep their own share.
LANG_TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
# Nor for topics: texts without a word in any field keep their own share too.
TOPIC_TARGETS = {"a-d": 0.15, "e-n": 0.35, "o-z": 0.5}


def topic(counts: Column) -> Column:
    """The field with most words, the first of those with as many; null without any."""
    each = [counts[f"n{i}"] for i in range(len(FIELDS))]
    out = F.lit(None).cast("string")
    for name, count in reversed(list(zip(FIELDS, each, strict=True))):
        out = F.when((count == F.greatest(*each)) & (count > 0), F.lit(name)).otherwise(out)
    return out


def mixture(docs: DataFrame) -> tuple[DataFrame, list[raking.Margin], Column]:
    """``docs`` with a column of word counts as its last, and the margins and token weights that are based on it."""
    name = "__words"
    while name in docs.columns:
        name = f"_{name}"
    counted = docs.withColumn(name, raking.initials(F.col("text"), FIELDS))
    found = [
        raking.Margin("source", F.col("source"), SOURCE_TARGETS),
        raking.Margin("lang", F.col("lang"), LANG_TARGETS),
        raking.Margin("topic", topic(F.col(name)), TOPIC_TARGETS),
    ]
    return counted, found, F.col(name)["n"]


def op9_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, margins, tokens = mixture(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    return raking.mix(docs, margins, BUDGET_SHARE, tokens, seed=MIX_SEED, drop=("text", "__words")).select(
        "doc_id",
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_source").alias("source_class"),
        F.col("mix_lang").alias("lang_class"),
        F.col("mix_topic").alias("topic_class"),
        F.round("mix_probability", 6).alias("probability"),
        F.col("mix_drawn").alias("drawn"),
    )


def _class_sql(value: str, targets: dict) -> str:
    named = [v for v in targets if v is not raking.REST]
    return "CASE " + " ".join(f"WHEN {value} = '{v}' THEN {i}" for i, v in enumerate(named)) + f" ELSE {len(named)} END"


def _share_sql(margin: str, targets: dict) -> str:
    """The target of every class; REST has null if it keeps its own share."""
    shares = [w for v, w in targets.items() if v is not raking.REST] + [targets.get(raking.REST, "NULL")]
    return " UNION ALL ".join(f"SELECT '{margin}' AS margin, {i} AS class, {w}::DOUBLE AS share" for i, w in enumerate(shares))


def _mix_sql(documents: str = "documents") -> str:
    """The raking as SQL: one step of the recursion scales one margin."""
    start = r"(^|[\x20\x09-\x0D])"
    fields = ", ".join(
        f"len(regexp_extract_all(coalesce(text, ''), '{start}[{r}{r.upper()}]')) AS n{i}" for i, r in enumerate(FIELDS)
    )
    names = FIELDS
    first = " ".join(f"WHEN n{i} = greatest(n0, n1, n2) AND n{i} > 0 THEN '{n}'" for i, n in enumerate(names))
    axes = (("source", "s"), ("lang", "l"), ("topic", "t"))
    step = "CASE " + " ".join(
        f"WHEN r.step % 3 = {k} THEN coalesce(g{a}.goal / nullif(sum(r.wanted) OVER (PARTITION BY r.{a}), 0), 0)" for k, (_, a) in enumerate(axes)
    ) + " END"
    goals = ", ".join(
        f"""held_{a} AS (
            SELECT {a} AS class, sum(tokens) AS held, any_value(share) AS share, any_value(share) IS NULL AS keeps
            FROM cells JOIN shares ON margin = '{m}' AND class = {a} GROUP BY {a} HAVING sum(tokens) > 0
        ), goal_{a} AS (
            SELECT class, CASE WHEN keeps THEN {BUDGET_SHARE} * held
                   ELSE {BUDGET_SHARE} * sum(CASE WHEN keeps THEN 0 ELSE held END) OVER () * share / nullif(sum(share) OVER (), 0) END AS goal
            FROM held_{a}
        )"""
        for m, a in axes
    )
    joins = " ".join(f"LEFT JOIN goal_{a} g{a} ON g{a}.class = r.{a}" for _, a in axes)
    return f"""
        WITH RECURSIVE counted AS (
            SELECT *, len(regexp_extract_all(coalesce(text, ''), '{raking.WORD}')) AS tokens, {fields} FROM {documents}
        ), classed AS (
            SELECT *, {_class_sql("source", SOURCE_TARGETS)} AS s, {_class_sql("lang", LANG_TARGETS)} AS l,
                   {_class_sql(f"(CASE {first} END)", TOPIC_TARGETS)} AS t
            FROM counted
        ), shares AS ({_share_sql("source", SOURCE_TARGETS)} UNION ALL {_share_sql("lang", LANG_TARGETS)}
            UNION ALL {_share_sql("topic", TOPIC_TARGETS)}
        ), cells AS (SELECT s, l, t, sum(tokens)::DOUBLE AS tokens FROM classed GROUP BY s, l, t
        ), {goals}, raked AS (
            SELECT 0 AS step, s, l, t, tokens, tokens * {BUDGET_SHARE} AS wanted FROM cells
            UNION ALL
            SELECT r.step + 1, r.s, r.l, r.t, r.tokens, least(r.tokens, r.wanted * {step})
            FROM raked r {joins} WHERE r.step < {3 * raking.ROUNDS}
        ), mixed AS (
            SELECT c.*, CASE WHEN c.tokens > 0 THEN r.wanted / r.tokens ELSE {BUDGET_SHARE} END AS p,
                   ('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT / {float(1 << 52)} AS u
            FROM classed c JOIN raked r ON r.step = {3 * raking.ROUNDS} AND r.s = c.s AND r.l = c.l AND r.t = c.t
        )
    """


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    warc_revisits.write_archives(table(spark, sf_dir, "pages"), path, WARC_DATE)
    return warc_revisits.read_archives(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_matches"
    )


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bitmaps.align(table(spark, sf_dir, "documents"), *ALIGNED)


def op12_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_products.audit(table(spark, sf_dir, "documents"))


def op13_trie_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_simhash.near_components(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_block_naming": op1_block_naming,
    "op2_relative_lz": op2_relative_lz,
    "op3_order_minhash": op3_order_minhash,
    "op4_chat_parts": op4_chat_parts,
    "op5_pivot_search": op5_pivot_search,
    "op6_byte_cnn": op6_byte_cnn,
    "op7_label_propagation": op7_label_propagation,
    "op8_window_packing": op8_window_packing,
    "op9_raking": op9_raking,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_pair_bitmaps": op11_pair_bitmaps,
    "op12_level_products": op12_level_products,
    "op13_trie_simhash": op13_trie_simhash,
}

ORACLE_SQL = {
    "op1_block_naming": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256,
               greatest(1, (length(coalesce(text, '')) + {block_naming.BLOCK_CHARS - 1}) // {block_naming.BLOCK_CHARS}) AS n_blocks
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op2_relative_lz": f"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{raking.WORD}') AS words FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(1, len(words) - {relative_lz.WINDOW - 2})) AS start, words FROM split
        ), keyed AS (
            SELECT doc_id, start, md5(array_to_string(words[start : start + {relative_lz.WINDOW - 1}], ' ')) AS gram FROM windows
        ), firsts AS (SELECT gram, min(doc_id) AS least FROM keyed GROUP BY gram
        ), covered AS (
            SELECT DISTINCT doc_id, unnest(range(start, start + {relative_lz.WINDOW})) AS place
            FROM keyed JOIN firsts USING (gram) WHERE least < doc_id
        ), gone AS (SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
                   CASE WHEN places IS NULL THEN words ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END AS kept
            FROM split LEFT JOIN gone USING (doc_id)
        )
        SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM kept
    """,
    "op4_chat_parts": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT {EXTRA_CONVERSATION}, 0, 'user', '{EXTRA_TEXT}'
            UNION ALL SELECT {EXTRA_CONVERSATION}, 1, 'assistant', '{EXTRA_TEXT}'
        ), sized AS (
            SELECT *, length('<turn >' || role || text || '<end>.') + 0
                + (length(text) - length(replace(text, '<', ''))) + (length(text) - length(replace(text, chr(92), '')))
                + (length(role) - length(replace(role, '<', ''))) + (length(role) - length(replace(role, chr(92), '')))
                + (length(role) - length(replace(role, '>', ''))) AS chars
            FROM turns
        ), whole AS (
            SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss
            FROM sized GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(every) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               formatted_chars
        FROM whole
    """,
    "op5_pivot_search": f"""
        WITH scaled AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM scaled q JOIN scaled c ON c.vec_id <> q.vec_id WHERE q.vec_id % {QUERY_STEP} = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
        )
        SELECT * FROM ranked WHERE rank <= {TOP}
    """,
    "op9_raking": f"""{_mix_sql()}
        SELECT doc_id, tokens, s AS source_class, l AS lang_class, t AS topic_class, round(p, 6) AS probability, u < p AS drawn
        FROM mixed
    """,
    "op10_warc_revisits": f"""
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS bytes FROM pages
        ), first AS (
            SELECT *, max(page_id) OVER (PARTITION BY body) AS original FROM sized
        )
        SELECT page_id, bytes AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN bytes >= {warc_revisits.MIN_BYTES} AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN bytes >= {warc_revisits.MIN_BYTES} AND page_id <> original THEN original END AS refers_to,
               true AS digest_matches
        FROM first
    """,
    "op12_level_products": f"""
        WITH words AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   unnest(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS word
            FROM documents
        ), uses AS (
            SELECT doc, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM words
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT doc) >= {level_products.MIN_DOCS}
        ), langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
        ), groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
        ), cells AS (
            SELECT g.lang, g.source, k.term, count(u.term) AS n, any_value(k.n) AS lang_n
            FROM groups g JOIN kept k USING (lang) LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
            GROUP BY g.lang, g.source, k.term
        ), totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source
        ), priced AS (
            SELECT lang, c.source, term, n,
                   1 + ({level_products.SCALE}::HUGEINT * (c.n + 5)) // (t.total + 5 * l.v) AS p,
                   1 + ({level_products.SCALE}::HUGEINT * (c.lang_n + 5)) // (l.total + 5 * l.v) AS q
            FROM cells c JOIN totals t USING (lang, source) JOIN langs l USING (lang)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN priced y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY a.lang, a.source, b.source
        ), parts AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, p - q FROM priced WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked
        WHERE part = 'pair' OR rank <= {level_products.TOP_TERMS}
    """,
}
