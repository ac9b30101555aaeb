"""Toxicity by a convolutional text classifier in numpy.

Words are lower-cased runs of letters and digits; a word and its beginnings are hashed to BUCKETS embeddings and summed. Filters of widths 1, 2 and 3 slide over
a text's words, the greatest value of each filter over the whole text goes through a logistic layer. Only the words that
win a maximum carry gradient, so a training step costs little more than the forward pass. Buckets that training
hardly saw have a zero embedding: a word that nothing is known about says nothing.

An embedding begins with the evidence that its bucket's texts give, less what chance gives among so many buckets, so a few
hundred labelled texts are enough to begin with the right words.

The fit is on a bounded sample of labelled rows (TRAIN_ROWS, of texts up to MOST_CHARS, SAMPLE_CHARS in all), of which every
fifth is kept to calibrate a threshold for each language, drawn to the common one the more the fewer rows the language has.
Scoring is one scan.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import caches, give_back, in_arrow, slices

BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 20, 8, 8, (1, 2, 3)
TRAIN_ROWS, MOST_CHARS = 8000, 100_000
STEPS, BATCH, RATE = 1200, 32, 0.01
#: Texts of the sample that a bucket must be in to have an embedding: rarer words would be learnt by heart.
LEAST_TEXTS = 3
#: A language's threshold of its own counts like so many rows of each label against the common one.
PRIOR_ROWS = 20
#: Most characters of all the sample's texts.
SAMPLE_CHARS = 48_000_000
WORD = re.compile(r"[^\W_]+")
MOST_CACHED = 100_000
#: Zero rows after each text.
PADDING = max(WIDTHS)
#: A word's embedding is the sum of those of the word and of its beginnings of so many letters.
BEGINNINGS = (4, 5)
_places: dict[str, int] = {}
_features = np.zeros((MOST_CACHED + 1, 1 + len(BEGINNINGS)), np.int32)
caches.append(_places.clear)


def _place(word: str) -> int:
    if (at := _places.get(word)) is None:
        at = _places[word] = len(_places)
        _features[at] = [zlib.crc32(x.encode()) % BUCKETS for x in (word, *(f"^{word[:n]}" for n in BEGINNINGS))]
    return at


def word_features(text: str | None) -> np.ndarray:
    """A row of buckets for each word."""
    words = WORD.findall((text or "").lower())
    try:
        at = list(map(_places.__getitem__, words))
    except KeyError:
        at = []
        for a in range(0, len(words), MOST_CACHED // 2):
            part = words[a : a + MOST_CACHED // 2]
            if len(_places) > MOST_CACHED - len(part):
                _places.clear()
            at.append(_features[list(map(_place, part))])
        return np.concatenate(at)
    return _features[at] if at else _features[:0]


class Classifier:
    """e: embeddings; w[width]: (width * SIZE, FILTERS); b[width]; out and bias: the logistic layer."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.known = np.zeros(0, np.int64)  # buckets seen in training, in order
        self.e = np.zeros((0, SIZE), np.float32)
        self.w = {k: rng.normal(0, (k * SIZE) ** -0.5, (k * SIZE, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.b = {k: np.zeros(FILTERS, np.float32) for k in WIDTHS}
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.float32(-1.0)
        self.thresholds: dict[str, float] = {}
        self.threshold = 0.5
        self.row_of: np.ndarray | None = None  # made by the first scores()

    def rows_of(self) -> np.ndarray:
        """For each bucket its row of e; the row after the last, for unknown buckets and padding, is zero."""
        out = np.full(BUCKETS, len(self.known), np.int32)
        out[self.known] = np.arange(len(self.known))
        return out

    def maxima(self, e: np.ndarray, x: np.ndarray, begins: np.ndarray, where: bool = False):
        """Of texts that begin at `begins` in x and end with PADDING rows of padding: each filter's greatest value over the
        windows that begin in the text or right after it, and where. Later ones would reach into the next text."""
        made, places = [], []
        ends = np.append(begins[1:], len(x))
        v = e[x[:, 0]]
        for j in range(1, x.shape[1]):
            v += e[x[:, j]]
        for k in WIDTHS:
            z = v @ self.w[k][:SIZE]
            for j in range(1, k):
                z[:-j] += v[j:] @ self.w[k][j * SIZE : (j + 1) * SIZE]
            for j in range(1, PADDING):
                z[ends - j] = -np.inf
            top = np.maximum.reduceat(z, begins, axis=0)
            made.append(np.maximum(top + self.b[k], 0))
            if where:
                places.append(np.stack([a + z[a:b].argmax(0) for a, b in zip(begins, ends, strict=True)]))
        return np.concatenate(made, 1), places

    @staticmethod
    def joined(rows: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter((len(r) + PADDING for r in rows), np.int64, len(rows))
        begins = np.cumsum(sizes) - sizes
        x = np.full((int(sizes.sum()), 1 + len(BEGINNINGS)), pad, np.int64)
        for a, r in zip(begins, rows, strict=True):
            x[a : a + len(r)] = r
        return x, begins

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> None:
        """Adam for the filters, Adagrad for the embeddings; the rows' words are dropped now and then."""
        rng = np.random.default_rng(seed)
        in_texts = [np.unique(r) for r in rows]
        ids, at, texts = np.unique(np.concatenate(in_texts or [self.known]), return_inverse=True, return_counts=True)
        toxic = np.bincount(at, np.repeat(labels, [len(x) for x in in_texts]), len(ids)) if len(rows) else texts
        often = texts >= LEAST_TEXTS
        self.known = ids[often]
        pad = len(self.known)
        e = np.concatenate([rng.normal(0, 0.1, (pad, SIZE)), np.zeros((1, SIZE))]).astype(np.float32)
        # the first value begins with the evidence of the bucket's texts, and each filter with a share of it
        e[:pad, 0] += evidence(texts[often], toxic[often], float(labels.mean()) if len(rows) else 0.0)
        for k in WIDTHS:
            self.w[k][::SIZE] += 0.3
        row_of = self.rows_of()
        xs = [row_of[r] for r in rows]
        ge = np.full((pad + 1, SIZE), 1e-3, np.float32)
        slots = {**{("w", k): self.w[k] for k in WIDTHS}, **{("b", k): self.b[k] for k in WIDTHS}, "out": self.out}
        m, v = ({k: np.zeros_like(a) for k, a in slots.items()} for _ in range(2))
        step = 0
        for _ in range(-(-steps * BATCH // max(1, len(xs)))):
            order = rng.permutation(len(xs))
            for a in range(0, len(order), BATCH):
                chosen = order[a : a + BATCH]
                x, begins = self.joined([xs[i] for i in chosen], pad)
                x = np.where(rng.random(x.shape) < 0.1, pad, x)
                f, places = self.maxima(e, x, begins, where=True)
                g, at, total = self.gradients(e, x, f, places, labels[chosen])
                for k in WIDTHS:
                    g["w", k] += 1e-4 * self.w[k]
                step += 1
                for key, part in slots.items():
                    m[key] = 0.9 * m[key] + 0.1 * g[key]
                    v[key] = 0.99 * v[key] + 0.01 * g[key] ** 2
                    part -= (RATE * (m[key] / (1 - 0.9**step)) / (np.sqrt(v[key] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
                self.bias -= np.float32(RATE * 5 * g["bias"])
                ge[at] += total * total
                e[at] -= 0.05 * total / np.sqrt(ge[at])
                e[pad] = 0
        # an embedding that no maximum ever moved is still random: it is as unknown as an unseen word
        moved = (ge[:pad] > 1e-3 + 1e-12).any(1)
        self.known, self.e = self.known[moved], np.concatenate([e[:pad][moved], e[pad:]])

    def gradients(self, e: np.ndarray, x: np.ndarray, f: np.ndarray, places: list, labels: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        """Of the mean cross-entropy, given what maxima() made of x: by the filters, the logistic layer and the bias; rows of
        e that have a gradient, and these."""
        p = 1 / (1 + np.exp(-(f @ self.out + self.bias)))
        d = ((p - labels) / len(labels)).astype(f.dtype)
        g: dict = {"out": f.T @ d, "bias": d.sum()}
        df = d[:, None] * self.out * (f > 0)
        words, gwords = [], []
        for i, k in enumerate(WIDTHS):
            dk, at = df[:, i * FILTERS : (i + 1) * FILTERS], places[i]
            g["b", k] = dk.sum(0)
            g["w", k] = np.zeros_like(self.w[k])
            for j in range(k):
                seen = x[np.minimum(at + j, len(x) - 1)]  # text, filter, feature
                part = slice(j * SIZE, (j + 1) * SIZE)
                g["w", k][part] = np.einsum("tfs,tf->sf", e[seen].sum(2), dk)
                words.append(seen.ravel())
                gwords.append(np.repeat((dk[:, :, None] * self.w[k][part].T[None]).reshape(-1, SIZE), x.shape[1], 0))
        rows, inverse = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros((len(rows), SIZE), e.dtype)
        np.add.at(total, inverse, np.concatenate(gwords))
        return g, rows, total

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        if self.row_of is None:
            self.row_of = self.rows_of()
        e = self.e if len(self.e) else np.zeros((1, SIZE), np.float32)
        x, begins = self.joined([self.row_of[r] for r in rows], len(self.known))
        f, _ = self.maxima(e, x, begins)
        return 1 / (1 + np.exp(-np.clip((f @ self.out + self.bias).astype(np.float64), -40, 40)))

    def calibrate(self, scores: np.ndarray, labels: np.ndarray, langs: list) -> None:
        """The middle of the best interval by F1: over all rows, and for each language its own, weighted with the common one
        by how many rows of the rarer label it has."""
        self.threshold = best_threshold(scores, labels)
        for lang in sorted({x for x in langs if x is not None}):
            own = np.asarray([x == lang for x in langs])
            n = int(min((labels[own] == 1).sum(), (labels[own] == 0).sum()))
            self.thresholds[lang] = (n * best_threshold(scores[own], labels[own]) + PRIOR_ROWS * self.threshold) / (n + PRIOR_ROWS)


def evidence(texts: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """The signed root of twice the log-likelihood ratio of buckets' toxic texts against a common share, drawn to zero by
    what the greatest of so many buckets reaches by chance. The fewer texts there are, the fewer buckets say anything."""
    if not len(texts) or not 0 < share < 1:
        return np.zeros(len(texts))
    clean = texts - toxic
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(toxic > 0, toxic * np.log(toxic / (texts * share)), 0) + np.where(clean > 0, clean * np.log(clean / (texts * (1 - share))), 0)
    root = np.sqrt(2 * np.maximum(ratio, 0))
    return np.sign(toxic - texts * share) * np.maximum(root - np.sqrt(2 * np.log(len(texts) + 1)), 0)


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle between the neighbouring scores where F1 is best; 0.5 without rows of both labels."""
    if not (labels == 1).any() or not (labels == 0).any():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(labels[order] == 1)
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + hits[-1])
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores can't be parted
    at = int(f1.argmax())
    below = s[at + 1] if at + 1 < len(s) else 0.0
    return float((s[at] + below) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_chars: int = MOST_CHARS, all_chars: int = SAMPLE_CHARS) -> list:
    """At most `rows` rows (doc_id, text, lang, toxic) of at most about all_chars characters together, by a hash of the id.
    Only that many ids are broadcast."""
    some = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    some = some.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.length("text") <= most_chars)
    joined = texts.join(F.broadcast(some), F.col("doc_id") == F.col("id"))
    share = min(1.0, all_chars / max(1, joined.agg(F.sum(F.length("text"))).first()[0] or 1))
    joined = joined.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return sorted(joined.select("doc_id", "text", "lang", "toxic").limit(2 * rows).collect(), key=lambda r: (r.doc_id, r.text))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """A classifier of a sample of the labelled documents; without any it scores all texts alike."""
    classifier = _fitted(docs, labels, rows)
    give_back()
    return classifier


def _fitted(docs: DataFrame, labels: DataFrame, rows: int) -> Classifier:
    found = labelled_sample(docs, labels, rows)
    features = [word_features(r.text) for r in found]
    toxic, langs = np.asarray([r.toxic for r in found], np.float32), [r.lang for r in found]
    held = np.asarray([zlib.crc32(str(r.doc_id).encode()) // 4 % 5 == 0 for r in found], bool)
    # texts and words aren't needed while the driver trains
    found.clear()
    _places.clear()
    classifier = Classifier()
    learn, check = np.flatnonzero(~held).tolist(), np.flatnonzero(held).tolist()
    if learn:
        classifier.fit([features[k] for k in learn], toxic[learn])
    if check:
        classifier.calibrate(classifier.scores([features[k] for k in check]), toxic[check], [langs[k] for k in check])
    return classifier


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """docs with the columns toxicity (0 to 1) and toxic (beyond its language's threshold; lang is used for that alone).

    A null or empty text has no word and the score of no evidence. A null language takes the common threshold. Equal texts
    have equal scores, each row its own; a score at its threshold is beyond it. Texts may be of any length. An empty table
    gives an empty one. Columns of these names are replaced, others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    keep = docs.drop("toxicity", "toxic")
    at = keep.columns.index("text")
    lang_at = keep.columns.index("lang") if "lang" in keep.columns else None

    def run(batches):
        c = shared.value
        for batch in slices(batches, most_bytes=1 << 20):
            made = c.scores([word_features(t) for t in batch.column(at).to_pylist()])
            langs = batch.column(lang_at).to_pylist() if lang_at is not None else [None] * len(made)
            beyond = [s >= c.thresholds.get(x, c.threshold) for s, x in zip(made.tolist(), langs, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64()), pa.array(beyond, pa.bool_())], names=[*batch.schema.names, "toxicity", "toxic"])

    return in_arrow(keep, run, keep.withColumns({"toxicity": F.lit(0.0), "toxic": F.lit(True)}).schema)


def without_toxic(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The rows of docs whose score is below their language's threshold, with all their columns and no other; nulls and
    empty texts as in score()."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    at = docs.columns.index("text")
    lang_at = docs.columns.index("lang") if "lang" in docs.columns else None

    def run(batches):
        c = shared.value
        for batch in slices(batches, most_bytes=1 << 20):
            made = c.scores([word_features(t) for t in batch.column(at).to_pylist()])
            langs = batch.column(lang_at).to_pylist() if lang_at is not None else [None] * len(made)
            yield batch.filter(pa.array([s < c.thresholds.get(x, c.threshold) for s, x in zip(made.tolist(), langs, strict=True)], pa.bool_()))

    return in_arrow(docs, run, docs.schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold); learnt from the rows whose crc32 of the id as text isn't
    `held` modulo folds. A row without an id is held out."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % folds == held, F.lit(True))
    classifier = fit(docs, labels.where(~out))
    made = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), F.col("text").cast("string").alias("text")), classifier)
    return made.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= threshold).cast("int").alias("predicted"))
