"""Toxicity by a convolutional text classifier, trained in numpy.

Words (longest runs of letters, digits and non-ASCII bytes, A-Z folded) are
hashed to rows of an embedding table; a row belongs to one hash of 64 bits, that
of the commonest training word in its place, and all other words share the row
of unknown words. Filters of one, two and three words run over the whole text,
each filter's greatest response is kept, and a logistic layer reads those.

The network learns from a bounded sample of labelled rows (SAMPLE of each
label, those with the least hash of doc_id), four fifths of it. A text's language is
told from its own words (log likelihoods of known words, learnt from the sample),
and each language has the threshold that best separates its labelled rows: all that
are neither held out nor taught the weights, scored in one pass and counted in a
histogram by language and label. Scores are shifted so that this threshold is 0.7 in
every language.

Scoring is one pass over all texts without a shuffle. Embeddings are multiplied
with the filters beforehand, so that a response is a sum of table rows.

Defined results: a null or empty text gets the score of no words; repeated rows
are scored each; null labels and labels of unknown documents teach nothing; with
fewer than two kinds of labels every score is the share of toxic labels (0 if
there are none), kept below 0.7 unless all are toxic; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookflow.llm import common

#: Labelled rows of each label that the network learns from, at most.
SAMPLE = 1500
TABLE_BITS, DIMS, FILTERS, WIDTHS, EPOCHS, BATCH = 17, 12, 8, (1, 2, 3), 4, 32
#: A language needs as many calibration rows of each label for a threshold of its own.
LEAST_ROWS = 12
#: Thresholds are told apart by histograms of BINS bins to a unit of the logit, up to MOST_LOGIT either way.
BINS, MOST_LOGIT = 128, 40
RATE, EMBEDDING_RATE = 0.02, 0.005
#: Coefficients of chance size, so many standard errors, are taken as none.
NOISE = 3.5
CUT = 0.7
UNKNOWN, PAD = 0, 1


@dataclass
class Model:
    """rows: table row of a hash's place; owners: the hash it belongs to; tables[w][k]: responses of filters of width w to the word at place k."""

    rows: np.ndarray
    owners: np.ndarray
    tables: dict[int, list[np.ndarray]]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    languages: np.ndarray  # log likelihoods, one column per language
    thresholds: np.ndarray  # one per language
    constant: float | None = None

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
        return np.where(self.owners[place] == hashes, self.rows[place], UNKNOWN)

    def logits(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language) of each text."""
        rows, begin = padded(self.lookup(hashes), first)
        pooled = []
        for w in WIDTHS:
            n = len(rows) - w + 1
            response = self.tables[w][0][rows[:n]]
            for k in range(1, w):
                response += self.tables[w][k][rows[k : k + n]]
            ends = np.append(begin[1:], len(rows))
            for k in range(1, w):  # places from which the filter would reach into the next text
                over = ends - k
                response[over[over < n]] = -np.inf
            pooled.append(np.maximum(np.maximum.reduceat(response, begin, axis=0) + self.bias[w], 0))
        language = np.add.reduceat(self.languages[rows], begin, axis=0).argmax(axis=1)
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias, language

    def scores(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        logit, language = self.logits(hashes, first)
        return sigmoid(logit - self.thresholds[language] + np.log(CUT / (1 - CUT)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -40, 40)))


def padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's rows followed by padding of the widest filter; and where each text begins."""
    gap = max(WIDTHS)
    counts = np.diff(first)
    out = np.full(len(rows) + gap * len(counts), PAD, np.int64)
    out[np.arange(len(rows)) + gap * np.repeat(np.arange(len(counts)), counts)] = rows
    return out, first[:-1] + gap * np.arange(len(counts))


def _best_threshold(logit: np.ndarray, label: np.ndarray, count: np.ndarray, weight: tuple[float, float]) -> float:
    """The middle of the gap at which F1 is best, each of count rows of label k counting weight[k] times; of several the widest gap."""
    order = np.argsort(logit)
    x, y, n = logit[order], label[order], count[order]
    toxic, clean = (np.cumsum(((y == k) * n * weight[k])[::-1])[::-1] for k in (1, 0))  # at or above each
    f1 = 2 * toxic / (toxic + clean + toxic[0])
    below = np.concatenate([[x[0] - 2], x[:-1]])
    best = max(range(len(x)), key=lambda i: (round(float(f1[i]), 9), x[i] - below[i]) if x[i] > below[i] else (-1, 0))
    return float((x[best] + below[best]) / 2)


def train(texts: list[str | None], labels: np.ndarray, langs: list[str | None], seed: int = 7) -> tuple[Model, np.ndarray]:
    """A model of the texts' labels (0 or 1), its thresholds not yet set, and which texts taught it; langs (null: unknown) only serve to tell languages apart."""
    labels = np.asarray(labels, np.int64)
    blank = Model(np.zeros(0, np.int64), np.zeros(0, np.uint64), {}, {}, np.zeros(0), 0.0, np.zeros((0, 0)), np.zeros(0))
    if not 0 < labels.sum() < len(labels):
        blank.constant = 1.0 if len(labels) and labels.all() else 0.0
        return blank, np.zeros(0, np.int64)
    rng = np.random.default_rng(seed)
    words = [np.concatenate([common.word_hashes(d, s, e, common.PUNCT)[0] for _, _, d, s, e in common.text_blocks(pa.array([t], pa.string()))]) for t in texts]
    # table rows for words of at least two texts, the commonest first
    seen, in_texts = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True)
    keep = in_texts > 1
    seen, in_texts = seen[keep], in_texts[keep]
    seen = seen[np.lexsort((seen, -in_texts))]
    place = (seen & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
    _, first_at = np.unique(place, return_index=True)
    taken = np.sort(first_at)
    rows, owners = np.zeros(1 << TABLE_BITS, np.int64), np.zeros(1 << TABLE_BITS, np.uint64)
    rows[place[taken]], owners[place[taken]] = np.arange(len(taken)) + 2, seen[taken]
    n_rows = len(taken) + 2
    model = Model(rows, owners, {}, {}, np.zeros(0), 0.0, np.zeros((n_rows, 1), np.float32), np.zeros(1))
    ids = [model.lookup(w) for w in words]

    names = sorted({x for x in langs if x is not None}) or [""]
    counts = np.full((n_rows, len(names)), 0.1)
    for x, lang in zip(ids, langs, strict=True):
        if lang is not None:
            np.add.at(counts[:, names.index(lang)], x, 1)
    model.languages = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    model.languages -= model.languages.mean(axis=1, keepdims=True)
    model.languages[[UNKNOWN, PAD]] = 0

    # Embeddings start small, but for the first place: there stands how a word's presence goes with the label (phi
    # coefficient over the taught texts), and one filter of each width starts by reading it.
    order = rng.permutation(len(ids))
    taught = order[len(order) // 5 :]
    present = np.zeros((2, n_rows))
    for i in taught:
        present[labels[i], np.unique(ids[i])] += 1
    totals = np.bincount(labels[taught], minlength=2).astype(float)[:, None]
    in_all, n_all = present.sum(axis=0), totals.sum()
    phi = (present[1] * (totals[0] - present[0]) - present[0] * (totals[1] - present[1])) / np.sqrt(np.maximum(in_all * (n_all - in_all) * totals[0] * totals[1], 1))
    table = rng.normal(0, 0.02, (n_rows, DIMS)).astype(np.float32)
    table[:, 0] = 10 * np.sign(phi) * np.maximum(np.abs(phi) - NOISE / np.sqrt(n_all), 0)
    table[[UNKNOWN, PAD]] = 0
    filters = {w: rng.normal(0, 0.1, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0, 0] = 1
    bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
    out, out_bias = np.full(FILTERS * len(WIDTHS), 0.1, np.float32), np.zeros(1, np.float32)
    speed = {id(p): np.full_like(p, 1e-2) for p in (table, out, out_bias, *filters.values(), *bias.values())}

    def step(p: np.ndarray, g: np.ndarray, rate: float = RATE) -> None:
        speed[id(p)] += g * g
        p -= rate * g / np.sqrt(speed[id(p)])

    for _ in range(EPOCHS):
        for at in range(0, len(taught), BATCH):
            batch = taught[at : at + BATCH]
            sizes = [len(ids[i]) for i in batch]
            x, begin = padded(np.concatenate([ids[i] for i in batch]), np.concatenate([[0], np.cumsum(sizes)]))
            ends = np.append(begin[1:], len(x))
            vectors = table[x]
            pooled, tops = [], {}
            for w in WIDTHS:
                at_most = len(x) - w + 1
                response = sum(vectors[k : k + at_most] @ filters[w][k] for k in range(w))
                tops[w] = np.stack([b + response[b : e - w + 1].argmax(axis=0) for b, e in zip(begin, ends, strict=True)])
                pooled.append(np.take_along_axis(response, tops[w], axis=0) + bias[w])
            raw = np.concatenate(pooled, axis=1)
            hidden = np.maximum(raw, 0)
            error = ((sigmoid(hidden @ out + out_bias) - labels[batch]) / len(batch)).astype(np.float32)
            back = error[:, None] * out * (raw > 0)
            step(out, hidden.T @ error)
            step(out_bias, error.sum(keepdims=True))
            grad, touched = np.zeros((len(x), DIMS), np.float32), []
            for j, w in enumerate(WIDTHS):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]
                step(bias[w], g.sum(axis=0))
                change = np.empty_like(filters[w])
                for k in range(w):
                    at_k = tops[w] + k
                    change[k] = np.einsum("bfd,bf->df", vectors[at_k], g)
                    np.add.at(grad, at_k.reshape(-1), (g[:, :, None] * filters[w][k].T[None]).reshape(-1, DIMS))
                    touched.append(at_k.reshape(-1))
                step(filters[w], change)
            used = np.unique(np.concatenate(touched))
            used_rows, inverse = np.unique(x[used], return_inverse=True)
            g = np.zeros((len(used_rows), DIMS), np.float32)
            np.add.at(g, inverse, grad[used])
            g[used_rows == PAD] = 0
            speed[id(table)][used_rows] += g * g
            table[used_rows] -= EMBEDDING_RATE * g / np.sqrt(speed[id(table)][used_rows])
        rng.shuffle(taught)

    model.tables = {w: [(table @ filters[w][k]).astype(np.float32) for k in range(w)] for w in WIDTHS}
    model.bias, model.out, model.out_bias = bias, out, float(out_bias[0])
    model.thresholds = np.zeros(len(names))
    return model, taught


def thresholds_of(language: np.ndarray, label: np.ndarray, logit: np.ndarray, count: np.ndarray, totals: tuple[int, int], languages: int) -> np.ndarray:
    """A threshold per language from a histogram: `count` rows of each (language, label, logit); totals: all rows of label 0 and 1, whose proportions count."""
    weight = tuple(max(1.0, totals[k] / max(1, count[label == k].sum())) for k in (0, 1))
    both = len(set(label)) == 2
    out = np.full(languages, _best_threshold(logit, label, count, weight) if both else 0.0)
    for j in range(languages):
        mine = language == j
        if min(count[mine & (label == k)].sum() for k in (0, 1)) >= LEAST_ROWS:
            out[j] = _best_threshold(logit[mine], label[mine], count[mine], weight)
    return out


def _histogram(texts: DataFrame, known: DataFrame, model: Model) -> list:
    """(language, label, bin, count) over the rows of texts (doc_id, text) in known (doc_id, label); a doc_id counts once.

    Texts are scored in place; only ids, languages and bins are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, starts, ends in common.text_blocks(batch.column(1)):
                logit, language = model.logits(*common.word_hashes(data, starts, ends, common.PUNCT))
                bins = np.rint(np.clip(logit.astype(np.float64), -MOST_LOGIT, MOST_LOGIT) * BINS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(language.astype(np.int32)), pa.array(bins)], ["doc_id", "language", "bin"])

    made = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, language int, bin int")
    once = made.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("language", "bin")).alias("x"))
    return once.groupBy("x.language", "label", "x.bin").count().collect()


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> Model:
    """Train on labelled rows that aren't held out, `sample` of each label at most, and set thresholds by the others: what is broadcast and collected is bounded."""
    known = labels.where(~common.held_out("doc_id") & F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.max(F.col(label_col)).alias("label"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.where("label = 1").orderBy(*order).limit(sample).union(known.where("label = 0").orderBy(*order).limit(sample))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    model, taught = train([r["text"] for r in rows], np.array([r["label"] for r in rows], np.int64), [r["lang"] for r in rows])
    if model.constant is None:
        others = ~F.col("doc_id").isin([rows[i]["doc_id"] for i in taught])
        counted = _histogram(texts.where(~common.held_out("doc_id") & others), known, model)
        language, label, bins, count = np.array([tuple(r) for r in counted], np.int64).reshape(-1, 4).T
        model.thresholds = thresholds_of(language, label, bins / BINS, count, (totals.get(0, 0), totals.get(1, 0)), len(model.thresholds))
    return model


def scored(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a double `score_col`; every whole text is read once, in place."""
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.zeros(0)]
            for _, _, data, starts, ends in common.text_blocks(batch.column(at)):
                made.append(model.scores(*common.word_hashes(data, starts, ends, common.PUNCT)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(made), pa.float64())], [*columns, score_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of docs."""
    model = fit(docs, labels)
    out = _ids_scored(docs, model)
    return out.select("doc_id", common.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def _ids_scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): like scored(), but the texts don't come back from Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.zeros(0)]
            for _, _, data, starts, ends in common.text_blocks(batch.column(1)):
                made.append(model.scores(*common.word_hashes(data, starts, ends, common.PUNCT)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(made), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those whose score is at least 0.7."""
    return scored(docs, fit(docs, labels), score_col="__score").where(F.col("__score") < CUT).drop("__score")
