"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

The network reads windows of WINDOW bytes in both directions with its state set to zero at their ends, gives every byte
position a distribution over the languages, and a document's probabilities are the means over all its positions. Windows
bound the memory and let one step run for thousands of positions at once, so that long texts take no longer a byte.

It is trained by backpropagation through time on a bounded sample (TRAIN_DOCS documents for each language, and windows
of these), with the document's language as the label of each position. Training takes the same time at any
size of input; scoring is one scan without an exchange.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, in_arrow, slices, text_column

WINDOW, HIDDEN = 64, 8
#: Documents for each language in the sample, most characters of one (longer ones give a stretch), and of all of them.
TRAIN_DOCS, MOST_CHARS, SAMPLE_CHARS = 400, 100_000, 48_000_000
STEPS, BATCH, RATE = 250, 128, 0.02
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")


def windows(texts: list[bytes], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in rows of width, each text beginning a row; how many bytes of each row count; the row after each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    rows = -(-sizes // width)
    ends = np.cumsum(rows)
    flat = np.zeros(int(rows.sum()) * width, np.uint8)
    for text, end, n in zip(texts, ends, rows, strict=True):
        at = (end - n) * width
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    counts = np.full(len(flat) // width, width, np.int64)
    last = ends[rows > 0] - 1
    counts[last] = (sizes - (rows - 1) * width)[rows > 0]
    return flat.reshape(-1, width), counts, ends


class Network:
    """Parameters of one direction d: byte tables tzr and tn, recurrent matrices uzr and un, bias bn; output head v, c."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden

        def weights(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p |= {f"tzr{d}": weights(256, 2 * hidden, scale=0.3), f"tn{d}": weights(256, hidden, scale=0.3), f"uzr{d}": weights(hidden, 2 * hidden, scale=0.3), f"un{d}": weights(hidden, hidden, scale=0.3), f"bn{d}": np.zeros(hidden, np.float32), f"v{d}": weights(hidden, len(langs), scale=0.3)}
        self.p["c"] = np.zeros(len(langs), np.float32)

    # training

    def _forward(self, x: np.ndarray, d: str) -> tuple[list, list]:
        p, k = self.p, self.hidden
        h, states, kept = np.zeros((x.shape[1], k), np.float32), [None] * len(x), [None] * len(x)
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            zr = 1 / (1 + np.exp(-(p[f"tzr{d}"][x[t]] + h @ p[f"uzr{d}"])))
            z, r = zr[:, :k], zr[:, k:]
            hn = h @ p[f"un{d}"] + p[f"bn{d}"]
            n = np.tanh(p[f"tn{d}"][x[t]] + r * hn)
            kept[t] = (h, z, r, hn, n)
            h = states[t] = n + z * (h - n)
        return states, kept

    def _backward(self, x: np.ndarray, d: str, kept: list, into: np.ndarray, g: dict) -> None:
        """into: the loss's gradient for each state, from the head."""
        p, k = self.p, self.hidden
        uzr, un = p[f"uzr{d}"].T, p[f"un{d}"].T
        dh = np.zeros((x.shape[1], k), np.float32)
        dzrs, dns = np.empty((*x.shape, 2 * k), np.float32), np.empty((*x.shape, k), np.float32)
        guzr, gun, gbn = np.zeros_like(p[f"uzr{d}"]), np.zeros_like(p[f"un{d}"]), np.zeros_like(p[f"bn{d}"])
        for t in reversed(range(len(x))) if d == "f" else range(len(x)):
            h, z, r, hn, n = kept[t]
            dh = dh + into[t]
            dn = dh * (1 - z) * (1 - n * n)
            dhn = dn * r
            dzr = np.concatenate([dh * (h - n) * z * (1 - z), dn * hn * r * (1 - r)], 1)
            guzr += h.T @ dzr
            gun += h.T @ dhn
            gbn += dhn.sum(0)
            dzrs[t], dns[t] = dzr, dn
            dh = dh * z + dzr @ uzr + dhn @ un
        hot = np.zeros((x.size, 256), np.float32)
        hot[np.arange(x.size), x.ravel()] = 1
        g |= {f"tzr{d}": hot.T @ dzrs.reshape(x.size, -1), f"tn{d}": hot.T @ dns.reshape(x.size, -1), f"uzr{d}": guzr, f"un{d}": gun, f"bn{d}": gbn}

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions of the rows, and its gradient."""
        x = np.ascontiguousarray(rows.T)
        states, kept = {}, {}
        for d in "fb":
            made, kept[d] = self._forward(x, d)
            states[d] = np.stack(made)
        logits = states["f"] @ self.p["vf"] + states["b"] @ self.p["vb"] + self.p["c"]
        logits -= logits.max(2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(2, keepdims=True)
        right = prob[:, np.arange(len(labels)), labels]
        loss = float(-np.log(right + 1e-9).mean())
        prob[:, np.arange(len(labels)), labels] -= 1
        prob /= x.size
        g = {"c": prob.sum((0, 1))}
        for d in "fb":
            g[f"v{d}"] = np.tensordot(states[d], prob, ([0, 1], [0, 1]))
            self._backward(x, d, kept[d], prob @ self.p[f"v{d}"].T, g)
        return loss, g

    def train(self, rows: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 7) -> float:
        """Adam over batches with as many windows of each language; the last loss."""
        rng = np.random.default_rng(seed)
        by = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        each = max(1, batch // len(by))
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        loss = 0.0
        for step in range(1, steps + 1):
            chosen = np.concatenate([rng.choice(own, each) for own in by if len(own)])
            loss, g = self.gradients(rows[chosen], labels[chosen])
            scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((a * a).sum() for a in g.values())))))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, a in g.items():
                m[k] = 0.9 * m[k] + 0.1 * scale * a
                v[k] = 0.99 * v[k] + 0.01 * (scale * a) ** 2
                self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return loss

    # scoring

    def _steps(self, x: np.ndarray, d: str):
        """Yields t and the state after it. Logistic functions are tanh of half the argument; buffers are reused."""
        p, k, n = self.p, self.hidden, x.shape[1]
        tzr, tn = p[f"tzr{d}"] / 2, p[f"tn{d}"]
        uzr, un, bn = p[f"uzr{d}"] / 2, p[f"un{d}"], p[f"bn{d}"]
        h, zr, mz = np.zeros((n, k), np.float32), np.empty((n, 2 * k), np.float32), np.empty((n, 2 * k), np.float32)
        hn, new = np.empty((n, k), np.float32), np.empty((n, k), np.float32)
        for t in range(len(x)) if d == "f" else reversed(range(len(x))):
            np.take(tzr, x[t], 0, out=zr, mode="clip")
            np.matmul(h, uzr, out=mz)
            zr += mz
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            np.matmul(h, un, out=hn)
            hn += bn
            hn *= zr[:, k:]
            np.take(tn, x[t], 0, out=new, mode="clip")
            new += hn
            np.tanh(new, out=new)
            h -= new
            h *= zr[:, :k]
            h += new
            yield t, h

    def pooled(self, texts: list[bytes], at_once: int = 4096) -> np.ndarray:
        """Mean probabilities of each text's positions; zeros for an empty text."""
        rows, counts, ends = windows(texts)
        sums = np.zeros((len(rows) + 1, len(self.langs)), np.float64)
        for a in range(0, len(rows), at_once):
            x = np.ascontiguousarray(rows[a : a + at_once].T)
            n = counts[a : a + at_once]
            full = int(n.min())
            ahead = np.empty((*x.shape, len(self.langs)), np.float32)
            for t, h in self._steps(x, "f"):
                np.matmul(h, self.p["vf"], out=ahead[t])
            total = np.zeros((x.shape[1], len(self.langs)), np.float32)
            for t, h in self._steps(x, "b"):
                logits = ahead[t]
                logits += h @ self.p["vb"]
                logits += self.p["c"]
                np.exp(np.clip(logits, -40, 40, out=logits), out=logits)
                logits /= logits.sum(1, keepdims=True)
                total += logits if t < full else logits * (t < n)[:, None]
            sums[a : a + x.shape[1]] = total
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        made = np.add.reduceat(sums, begins, axis=0) if len(begins) else sums[:0]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return np.where(sizes[:, None] > 0, made / np.maximum(sizes, 1)[:, None], 0)


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def predict(network: Network, texts: list[str | None]) -> tuple[list[str], list[float]]:
    said = [has_letter(t) for t in texts]
    prob = network.pooled([t.encode() if ok else b"" for t, ok in zip(texts, said, strict=True)])
    best = prob.argmax(1) if len(prob) else []
    langs = [network.langs[k] if ok and network.langs else UNKNOWN for k, ok in zip(best, said, strict=True)] if network.langs else [UNKNOWN] * len(texts)
    return langs, [min(1.0, float(p[k])) if ok else 0.0 for p, k, ok in zip(prob, best, said, strict=True)] if network.langs else [0.0] * len(texts)


def training_sample(docs: DataFrame, each: int = TRAIN_DOCS, most_chars: int = MOST_CHARS, all_chars: int = SAMPLE_CHARS) -> list:
    """Rows (lang, text) of about `each` documents for every language, fewer where languages are so many that the sample
    would have more than about all_chars characters, by a hash of id and text. Of a text longer than most_chars there is
    a stretch of that length from a place that the hash gives."""
    at = F.pmod(F.xxhash64(F.lit(2), "doc_id", "text"), F.greatest(F.length("text") - most_chars, F.lit(0)) + 1).cast("int") + 1
    docs = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("text_", F.col("text").substr(at, F.lit(most_chars)))
    counts = docs.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text_")).alias("chars"))
    of_all = counts.agg(F.count("*").alias("n"), F.sum(F.least(F.lit(1.0), 1.1 * each / F.col("n")) * F.col("chars")).alias("chars")).first()
    if not of_all.n:
        return []
    part = min(1.0, all_chars / of_all.chars)
    shares = counts.select(F.col("lang").alias("lang_"), (F.least(F.lit(1.0), 1.1 * each / F.col("n")) * part).alias("share"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    return docs.join(shares, F.col("lang") == F.col("lang_")).where(place < F.col("share")).select("lang", F.col("text_").alias("text")).collect()


def fit(docs: DataFrame, each: int = TRAIN_DOCS, steps: int = STEPS) -> Network:
    """A network trained on a sample of docs(doc_id, text, lang); without usable rows it knows no language."""
    network = _fitted(docs, each, steps)
    give_back()
    return network


def _fitted(docs: DataFrame, each: int, steps: int) -> Network:
    rows = sorted(training_sample(docs, each), key=lambda r: (r.lang, r.text))
    langs = sorted({r.lang for r in rows})
    network = Network(langs)
    if len(langs) > 1:
        made, counts, ends = windows([r.text.encode() for r in rows])
        labels = np.repeat([langs.index(r.lang) for r in rows], np.diff(ends, prepend=0))
        whole = counts == made.shape[1]
        if not all(np.any(whole & (labels == k)) for k in range(len(langs))):
            whole[:] = True
        network.train(made[whole], labels[whole], steps)
    return network


def identify(docs: DataFrame, learn: DataFrame) -> DataFrame:
    """docs with the columns lang_pred and lang_score; learn(doc_id, text, lang) has the rows to learn from.

    A text that is null or has no letter gets `und` and 0. Null languages aren't learnt from. Every row has its own
    result, equal texts equal ones; ties go to the first language in order of names. Where learn is empty all texts are
    `und`. Texts may be of any length. Columns of these two names are replaced, all others stay.
    """
    spark = docs.sparkSession
    network = spark.sparkContext.broadcast(fit(learn))
    keep = docs.drop("lang_pred", "lang_score")
    out = keep.withColumns({"lang_pred": F.lit("").cast("string"), "lang_score": F.lit(0.0)})
    return _with_predictions(keep, out.schema, network)


def _with_predictions(keep: DataFrame, schema, network) -> DataFrame:
    at = keep.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            langs, scores = predict(network.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "lang_score"])

    return in_arrow(keep, run, schema)


def language_report(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learnt from the rows whose crc32 of the id as text isn't `held` modulo folds.
    A row without an id is held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(True))
    made = identify(rows.select("doc_id", out.alias("held_out"), "text"), rows.where(~out))
    return made.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
