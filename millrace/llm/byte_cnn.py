"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over them, every filter keeps its largest response in the window,
and a softmax layer reads these. The network is trained in numpy on windows from a bounded sample of labelled
texts: at most ``docs_per_lang`` different texts of each of the ``max_langs`` languages that have most of them, ``windows_per_doc``
windows each. Copies of a text count once. For application the embedding is folded into lookup tables (the response of a
filter to a pair of bytes), and every window of the whole text is scored; the text's scores are the mean log-probabilities of
its windows, weighted by their bytes. Windows overlap by the widest filter less one, so no run of bytes falls between two.

Edge cases: a null or letterless text is ``und`` with score 0, as is every text if there was nothing to learn from. Rows
with a null label or text teach nothing. Repeated rows and ties are predicted alike; of equal probabilities the
language first in the alphabet is taken. An empty table gives an empty result. The columns of the table pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.scratch import Scratch, bounded_batches, release_memory, unit

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
STRIDE = WINDOW - max(WIDTHS) + 1
DOCS_PER_LANG = 2000
WINDOWS_PER_DOC = 2
MAX_LANGS = 256
EPOCHS = 8
BATCH = 64
WINDOWS_AT_ONCE = 256
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    embedding: np.ndarray  # 256 x EMBEDDING, byte 0 (padding) at zero
    kernels: tuple[np.ndarray, ...]  # per width: width x EMBEDDING x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray


def windows_of(body: bytes, stride: int = STRIDE) -> list[tuple[int, int]]:
    """Start and length of every window of a text."""
    last = max(0, len(body) - (WINDOW - stride) - 1)
    return [(s, min(WINDOW, len(body) - s)) for s in range(0, last + 1, stride)]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, labels: np.ndarray, langs: tuple[str, ...], seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Fits the network by Adam; ``windows`` is n x WINDOW bytes, zero-padded, ``labels`` an index into ``langs``."""
    rng = np.random.default_rng(seed)
    n_pooled = FILTERS * len(WIDTHS)
    p = [rng.normal(0, 0.5, (256, EMBEDDING))]
    p += [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    p += [np.zeros(n_pooled), rng.normal(0, 1 / np.sqrt(n_pooled), (n_pooled, len(langs))), np.zeros(len(langs))]
    p = [x.astype(np.float32) for x in p]
    p[0][0] = 0
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    # Each language weighs the same, however many windows it has.
    counts = np.bincount(labels, minlength=len(langs))
    weights = (len(labels) / np.maximum(counts, 1) / len(langs)).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for batch in (order[i : i + BATCH] for i in range(0, len(order), BATCH)):
            step += 1
            for k, g in enumerate(_gradients(p, windows[batch], labels[batch], weights[labels[batch]])):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                rate = 0.005 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
            p[0][0] = 0
    return Model(langs, p[0], tuple(p[1 : 1 + len(WIDTHS)]), *p[1 + len(WIDTHS) :])


def _gradients(p: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    embedding, kernels, (bias, dense, offset) = p[0], p[1 : 1 + len(WIDTHS)], p[1 + len(WIDTHS) :]
    n = len(x)
    e = embedding[x]
    best, at = [], []
    for w, k in zip(WIDTHS, kernels, strict=True):
        response = sum(e[:, j : WINDOW - w + 1 + j] @ k[j] for j in range(w))
        at.append(response.argmax(axis=1))
        best.append(np.take_along_axis(response, at[-1][:, None], axis=1)[:, 0])
    best = np.concatenate(best, axis=1)
    pooled = np.maximum(best, 0) + bias
    hidden = np.maximum(pooled, 0)
    probability = np.exp(_log_softmax(hidden @ dense + offset))
    probability[np.arange(n), y] -= 1
    d = probability * (weight / n)[:, None]
    d_hidden = (d @ dense.T) * (pooled > 0)
    d_best = d_hidden * (best > 0)
    d_embedding = np.zeros_like(embedding)
    d_kernels = []
    rows = np.arange(n)[:, None]
    for i, (w, k) in enumerate(zip(WIDTHS, kernels, strict=True)):
        g = d_best[:, i * FILTERS : (i + 1) * FILTERS]
        d_k = np.empty_like(k)
        for j in range(w):
            where = at[i] + j
            d_k[j] = np.einsum("nfe,nf->ef", e[rows, where], g)
            np.add.at(d_embedding, x[rows, where], g[:, :, None] * k[j].T[None])
        d_kernels.append(d_k)
    return [d_embedding, *d_kernels, d_hidden.sum(axis=0), hidden.T @ d, d.sum(axis=0)]


class Scorer:
    """A model with its embedding folded into tables over pairs of bytes and single bytes."""

    def __init__(self, model: Model):
        self.model = model
        pairs, singles = [], []
        for w, k in zip(WIDTHS, model.kernels, strict=True):
            tables = [model.embedding @ k[j] for j in range(w)]
            for j in range(0, w - 1, 2):
                pairs.append((tables[j][:, None] + tables[j + 1][None]).reshape(65536, FILTERS))
            if w % 2:
                singles.append(tables[w - 1])
        self.pairs = np.ascontiguousarray(np.concatenate(pairs, axis=1), dtype=np.float32)
        self.singles = np.ascontiguousarray(np.concatenate(singles, axis=1), dtype=np.float32) if singles else None

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """For n x WINDOW zero-padded bytes."""
        m = self.model
        code = (windows[:, :-1].astype(np.uint16) << 8) | windows[:, 1:]
        pair = self.pairs.take(code, axis=0)
        single = self.singles.take(windows, axis=0) if self.singles is not None else None
        best, p, s = [], 0, 0
        for w in WIDTHS:
            length = WINDOW - w + 1
            response = None
            for j in range(0, w - 1, 2):
                part = pair[:, j : j + length, p : p + FILTERS]
                response = part if response is None else response + part
                p += FILTERS
            if w % 2:
                response = response + single[:, w - 1 : w - 1 + length, s : s + FILTERS]
                s += FILTERS
            best.append(response.max(axis=1))
        pooled = np.maximum(np.concatenate(best, axis=1), 0) + m.bias
        return _log_softmax(np.maximum(pooled, 0) @ m.dense + m.offset)

    def predict(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Language index and probability of each text, from all its windows."""
        total = np.zeros((len(bodies), len(self.model.langs)))
        size = np.zeros(len(bodies))
        for owners, lengths, block in self._blocks(bodies):
            np.add.at(total, owners, self.log_probabilities(block) * lengths[:, None])
            np.add.at(size, owners, lengths)
        scores = np.exp(_log_softmax(total / np.maximum(size, 1)[:, None]))
        return scores.argmax(axis=1), scores.max(axis=1)

    def _blocks(self, bodies: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        block = np.zeros((WINDOWS_AT_ONCE, WINDOW), np.uint8)
        owners, lengths, filled = np.zeros(WINDOWS_AT_ONCE, np.int64), np.zeros(WINDOWS_AT_ONCE), 0
        for k, body in enumerate(bodies):
            view = np.frombuffer(body, np.uint8)
            for start, length in windows_of(body):
                block[filled, :length] = view[start : start + length]
                block[filled, length:] = 0
                owners[filled], lengths[filled] = k, length
                filled += 1
                if filled == WINDOWS_AT_ONCE:
                    yield owners, lengths, block
                    filled = 0
        if filled:
            yield owners[:filled], lengths[:filled], block[:filled]


def _per_language(values: dict[str, float], other: float) -> Column:
    out = F.lit(other)
    for lang, value in values.items():
        out = F.when(F.col("lang") == lang, F.lit(value)).otherwise(out)
    return out


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_lang: int = DOCS_PER_LANG,
    windows_per_doc: int = WINDOWS_PER_DOC,
    max_langs: int = MAX_LANGS,
    seed: int = 7,
) -> Model | None:
    """Trains on a bounded sample of the different labelled texts of ``docs``; None if there are none."""
    spark = docs.sparkSession
    labelled = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("digest")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    different = Scratch(spark, "labelled").keep(labelled.select("lang", "digest").distinct(), "different")
    counts = different.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    if not counts:
        return None
    # Half as many again as are wanted, on average; then the place of the last one wanted in the order of the draw.
    draw = unit(F.col("digest"), F.lit(seed))
    rate = _per_language({r["lang"]: min(1.0, (1.5 * docs_per_lang + 20) / r["count"]) for r in counts}, 0.0)
    drawn = different.withColumn("draw", draw).where(F.col("draw") < rate).groupBy("lang")
    lasts = drawn.agg(F.slice(F.sort_array(F.collect_list("draw")), 1, docs_per_lang).alias("draws")).select("lang", F.element_at("draws", -1).alias("last"))
    last = _per_language({r["lang"]: r["last"] for r in lasts.collect()}, -1.0)
    sample = labelled.withColumn("draw", draw).where(F.col("draw") <= last).select("lang", "text", "draw")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            rows = []
            for lang, text, place in zip(batch["lang"], batch["text"], batch["draw"], strict=True):
                if (lang, place) in seen:
                    continue
                seen.add((lang, place))
                body = text.encode()
                spans = windows_of(body)
                for i in range(min(windows_per_doc, len(spans))):
                    start, length = spans[(i * len(spans)) // min(windows_per_doc, len(spans))]
                    rows.append((lang, place, i, body[start : start + length]))
            yield pd.DataFrame(rows, columns=["lang", "draw", "place", "body"])

    # Copies in several tasks meet here; what is left is bounded by the sample.
    rows = sample.mapInPandas(cut, "lang string, draw double, place int, body binary").distinct().collect()
    langs = tuple(sorted(r["lang"] for r in counts))
    bodies: list[bytes] = []
    labels: list[int] = []
    for k, lang in enumerate(langs):
        own = sorted((r["draw"], r["place"], bytes(r["body"])) for r in rows if r["lang"] == lang)
        bodies += [b for *_, b in own]
        labels += [k] * len(own)
    windows = np.zeros((len(bodies), WINDOW), np.uint8)
    for i, b in enumerate(bodies):
        windows[i, : len(b)] = np.frombuffer(b, np.uint8)
    return train(windows, np.array(labels), langs, seed)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability."""
    if model is None:
        return docs.withColumns({lang_out: F.lit(UNKNOWN), score_out: F.lit(0.0)})
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            bodies = [b"" if t is None else t.encode() for t in texts]
            best, score = scorer.predict(bodies)
            yield pd.DataFrame({"lang": [model.langs[i] for i in best], "score": score})
        del scorer
        release_memory()

    known = has_letter(F.col(text_col))
    guess = "__guess_of_language"
    return (
        docs.withColumn(guess, predict(F.when(known, F.col(text_col))))
        .withColumns({
            lang_out: F.when(known, F.col(f"{guess}.lang")).otherwise(UNKNOWN),
            score_out: F.when(known, F.col(f"{guess}.score")).otherwise(0.0),
        })
        .drop(guess)
    )


def known_language(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_score: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose text has a language: those without letters or below ``min_score`` go.

    The model learns from the labelled rows of ``docs`` itself; without any, only letterless texts go.
    """
    model = fit(docs, text_col, lang_col)
    if model is None:
        return docs.where(has_letter(F.col(text_col)))
    columns = docs.columns
    scored = identify(docs, model, text_col, "__lang_pred", "__lang_score")
    return scored.where((F.col("__lang_pred") != UNKNOWN) & (F.col("__lang_score") >= min_score)).select(*columns)
