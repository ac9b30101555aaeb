"""Trained models: gradients, held-out accuracy, probabilities, awkward rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loamgrid.llm import lang_id, quality_lm, toxicity

SF = "/root/testdata/sf0.01"


def test_gradients_by_backpropagation_equal_differences():
    net = lang_id.Network(["a", "b", "c"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    rows, labels = rng.integers(0, 5, (4, 6)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, g = net.gradients(rows, labels)
    for name, value in net.p.items():
        for _ in range(3):
            at = tuple(rng.integers(0, n if k or name[0] != "t" else 5) for k, n in enumerate(value.shape))
            keep, e = value[at], 1e-3
            value[at] = keep + e
            up, _ = net.gradients(rows, labels)
            value[at] = keep - e
            down, _ = net.gradients(rows, labels)
            value[at] = keep
            assert g[name][at] == pytest.approx((up - down) / (2 * e), abs=2e-4), name


def test_scoring_equals_the_training_pass():
    net = lang_id.Network(["a", "b"])
    text = bytes(np.random.default_rng(1).integers(97, 110, 150).astype(np.uint8))
    rows, counts, _ = lang_id.windows([text])
    x = np.ascontiguousarray(rows.T)
    f, b = (np.stack(net._forward(x, d)[0]) for d in "fb")
    z = f @ net.p["vf"] + b @ net.p["vb"] + net.p["c"]
    p = np.exp(z) / np.exp(z).sum(2, keepdims=True)
    want = sum(p[: counts[k], k].sum(0) for k in range(len(counts))) / len(text)
    got = net.pooled([b"", text, b"x"])
    assert np.allclose(got[1], want, atol=1e-4) and not got[0].any() and got[2].sum() == pytest.approx(1, abs=1e-4)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = lang_id.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97 and all(0 <= r.score <= 1 for r in out)


def test_language_of_awkward_rows(awkward, nothing):
    rows = lang_id.language_report(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.lang_pred for r in rows if r.doc_id in (20, 21, 22)} == {"und"} and all(r.lang_pred != "und" for r in rows if r.doc_id in (None, 30, 41))
    assert lang_id.language_report(nothing).count() == 0
    assert set(lang_id.identify(awkward, awkward).columns) == {*awkward.columns, "lang_pred", "lang_score"}


def test_junk_goes_and_clean_text_stays(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_lm.quality_report(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect()
    junk = [r.kept for r in out if sum(r.text.count(c) for c in "#*$%&") > 0.5 * len(r.text.split()) and len(r.text.split()) > 20]
    clean = [r.kept for r in out if not any(c in r.text for c in "#*$%&|!") and len(r.text) > 200]
    assert len(junk) > 20 and np.mean(junk) < 0.05 and np.mean(clean) > 0.97


def test_quality_of_awkward_rows(spark, awkward, nothing):
    ids = spark.createDataFrame([(0,), (1,), (None,), (999,)], "doc_id long")
    rows = quality_lm.classify(awkward, ids).collect()
    assert len(rows) == awkward.count()
    assert all((r.perplexity is None) == (r.n_symbols == 0) and (r.n_symbols > 0 or not r.kept) for r in rows)
    assert quality_lm.classify(nothing, ids).count() == 0
    assert all(r.kept for r in quality_lm.classify(awkward, ids.where("doc_id < 0")).where("n_symbols > 0").collect())


def toxic_rows(n, seed=5):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 60))]
        if k % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["Grublish", "grubby!", "snork", "SNORKED"])
        out.append((k, " ".join(words), rng.choice(["en", "de", None]), int(k % 4 == 0)))
    return out


def brute_score(c, text):
    """Each window of each width by itself."""
    row_of, pad = c.rows_of(), len(c.known)
    rows = [c.e[row_of[r]].sum(0) for r in toxicity.word_features(text)] + [np.zeros(toxicity.SIZE)]
    f = []
    for k in toxicity.WIDTHS:
        windows = [np.concatenate([rows[at + j] if at + j < len(rows) else np.zeros(toxicity.SIZE) for j in range(k)]) for at in range(len(rows))]
        f += [max(0.0, max(float(w @ c.w[k][:, n]) for w in windows) + float(c.b[k][n])) for n in range(toxicity.FILTERS)]
    assert not c.e[pad].any()
    return 1 / (1 + math.exp(-(float(np.dot(f, c.out)) + float(c.bias))))


def test_convolution_equals_windows_one_by_one():
    c = toxicity.Classifier()
    rows = toxic_rows(300)
    c.fit([toxicity.word_features(r[1]) for r in rows], np.asarray([r[3] for r in rows], np.float32), steps=60)
    texts = [r[1] for r in toxic_rows(12, 9)] + ["", "snork", "unknown words only here"]
    assert c.scores([toxicity.word_features(t) for t in texts]) == pytest.approx([brute_score(c, t) for t in texts], abs=1e-5)


def test_toxicity_gradients_equal_differences():
    c, rng = toxicity.Classifier(), np.random.default_rng(3)
    for table in (c.w, c.b):
        table.update({k: v.astype(np.float64) for k, v in table.items()})
    for b in c.b.values():
        b += rng.normal(0, 0.2, b.shape)  # at 0 padding's windows lie on the kink of the maximum with 0
    c.out, c.bias = c.out.astype(np.float64), float(c.bias)
    e = np.concatenate([rng.normal(0, 1, (20, toxicity.SIZE)), np.zeros((1, toxicity.SIZE))])
    x, begins = c.joined([rng.integers(0, 20, (n, 3)) for n in (4, 1, 7)], 20)
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        f, _ = c.maxima(e, x, begins)
        p = 1 / (1 + np.exp(-(f @ c.out + c.bias)))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    f, places = c.maxima(e, x, begins, where=True)
    g, at, total = c.gradients(e, x, f, places, labels)
    ge = np.zeros_like(e)
    ge[at] = total
    pairs = [(e, ge, 20), (c.out, g["out"], None)] + [(c.w[k], g["w", k], None) for k in toxicity.WIDTHS] + [(c.b[k], g["b", k], None) for k in toxicity.WIDTHS]
    for value, grad, most in pairs:
        for _ in range(8):
            place = tuple(rng.integers(0, most if most and not k else n) for k, n in enumerate(value.shape))
            keep, step = value[place], 1e-6
            value[place] = keep + step
            up = loss()
            value[place] = keep - step
            down = loss()
            value[place] = keep
            assert grad[place] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_thresholds_of_languages_are_drawn_to_the_common_one():
    c = toxicity.Classifier()
    scores = np.array([0.1, 0.2, 0.8, 0.9] * 30 + [0.05, 0.3, 0.35, 0.6])
    labels = np.array([0, 0, 1, 1] * 30 + [0, 1, 1, 1])
    c.calibrate(scores, labels, ["a"] * 120 + ["b"] * 3 + [None])
    common = c.threshold
    own = toxicity.best_threshold(scores[120:123], labels[120:123])
    assert c.thresholds["b"] == pytest.approx((own + toxicity.PRIOR_ROWS * common) / (1 + toxicity.PRIOR_ROWS)) and set(c.thresholds) == {"a", "b"}


def test_few_labelled_texts_are_enough_for_frequent_words():
    """240 texts, 40 of them toxic by one of four words among 4,000 others."""
    def rows(n, seed):
        rng = random.Random(seed)
        made = [[f"w{min(rng.randrange(4000), rng.randrange(4000))}" for _ in range(60)] + ([rng.choice(["grublish", "snork", "vexoid", "plumf"])] if k % 6 == 0 else []) for k in range(n)]
        return [toxicity.word_features(" ".join(rng.sample(w, len(w)))) for w in made], np.asarray([k % 6 == 0 for k in range(n)], np.float32)

    c = toxicity.Classifier()
    c.fit(*rows(240, 1))
    features, labels = rows(600, 2)
    s = c.scores(features)
    assert np.mean(s[labels == 1] >= 0.3) > 0.8 and np.mean(s[labels == 0] >= 0.3) < 0.05


def test_toxicity_held_out(spark):
    rows = toxic_rows(1600)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    want = {r[0]: r[3] for r in rows}
    out = [r for r in toxicity.toxicity_report(docs, labels).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in out)
    assert np.mean([r.predicted == want[r.doc_id] for r in out]) > 0.97


def test_max_pooling_finds_one_word_in_a_long_text():
    c = toxicity.Classifier()
    rows = toxic_rows(1200)
    c.fit([toxicity.word_features(r[1]) for r in rows], np.asarray([r[3] for r in rows], np.float32))
    long = " ".join(f"w{k % 400}" for k in range(100_000))
    s = c.scores([toxicity.word_features(t) for t in (long, f"{long} snork {long}", "", None)])
    assert s[0] < 0.3 < s[1] and s[2] == s[3] < 0.3


def test_threshold():
    assert toxicity.best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == pytest.approx(0.5)
    assert toxicity.best_threshold(np.array([0.1, 0.2]), np.array([0, 0])) == 0.5


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (31, 0), (31, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity_report(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity_report(nothing, labels).count() == 0
    assert toxicity.toxicity_report(awkward, labels.limit(0)).count() == awkward.count()
    assert toxicity.score(awkward, toxicity.Classifier()).columns == [*awkward.columns, "toxicity", "toxic"]


def brute_points(texts, discounts_of):
    """Probabilities of code points by dictionaries, from the definition."""
    grams = Counter(s[k : k + 4] for t in texts for s in ["\0\0\0" + t] for k in range(len(t)))
    levels = [grams]
    for _ in range(3):
        levels.append(Counter(g[1:] for g in levels[-1]))

    def p(gram, level=0):
        if level == 4:
            return 1 / (len(levels[3]) + 1)
        c, d = levels[level], discounts_of(levels[level])
        cut = lambda n: d[min(n, 3) - 1]
        row = {g: n for g, n in c.items() if g[:-1] == gram[:-1]}
        if not row:
            return p(gram[1:], level + 1)
        n = row.get(gram, 0)
        return ((n - cut(n) if n else 0) + sum(map(cut, row.values())) * p(gram[1:], level + 1)) / sum(row.values())

    return p


def discounts(c):
    n = Counter(c.values())
    if not n[1] or not n[2]:
        return [0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.0]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def random_texts(seed=8):
    rng = random.Random(seed)
    return ["".join(rng.choice("abAB1жд中文\U0001f600 ") for _ in range(rng.randrange(1, 40))) for _ in range(40)]


def test_code_points_equal_definition(spark):
    texts = random_texts()
    model = quality_lm.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    p = brute_points(texts, discounts)
    tried = {("\0\0\0" + t)[k : k + 4] for t in [*texts[:3], "zzЖ中a", ""] for k in range(len(t))}
    rows = quality_lm.log_probabilities(model, spark.createDataFrame([(g,) for g in sorted(tried)], "gram string")).collect()
    assert {r.gram for r in rows} == tried and len(rows) == len(tried)
    assert [math.exp(r.log_p) for r in rows] == pytest.approx([p(r.gram) for r in rows], rel=1e-6)


@pytest.mark.parametrize("heavy", [0, 7, 100_000])
def test_perplexities_equal_definition_wherever_n_grams_are_looked_up(spark, heavy):
    """Sums over documents, several of which share a batch, some twice."""
    texts = random_texts()
    rows = [(k, t, "x") for k, t in enumerate([*texts, "zzЖ中a", "b", "", None])] + [(3, texts[3], "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    p = brute_points(texts[:20], discounts)
    out = quality_lm.classify(docs, docs.where("doc_id < 20").select("doc_id"), heavy=heavy).collect()
    # a document that is there three times teaches three times
    p = brute_points([*texts[:20], texts[3], texts[3]], discounts)
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    said = dict((r[0], r[1] or "") for r in rows)
    for r in out:
        t = said[r.doc_id]
        want = math.exp(-sum(math.log(p(("\0\0\0" + t)[k : k + 4])) for k in range(len(t))) / len(t)) if t else None
        assert r.n_symbols == len(t) and (r.perplexity is None if want is None else r.perplexity == pytest.approx(want, rel=1e-4))


def test_thresholds_are_the_languages_quantiles(spark):
    docs = spark.createDataFrame([(k, t, "ab"[k % 2]) for k, t in enumerate(random_texts(9))], "doc_id long, text string, lang string")
    out = quality_lm.classify(docs, docs.where("doc_id < 25").select("doc_id")).collect()
    for lang in "ab":
        own = sorted(math.log(r.perplexity) for r in out if r.lang == lang)
        median, upper = (own[math.ceil(q * len(own)) - 1] for q in (0.5, 0.75))
        most = median + quality_lm.FENCE * max(upper - median, quality_lm.LEAST_SPREAD)
        for r in (r for r in out if r.lang == lang):
            assert math.log(r.threshold) == pytest.approx(most)
            nats = r.n_symbols * math.log(r.perplexity)
            assert r.kept == ((nats + quality_lm.PRIOR * median) / (r.n_symbols + quality_lm.PRIOR) <= most)


def test_many_code_points_in_one_batch():
    text = "".join(chr(k) for k in range(1, 0x15000) if not 0xD800 <= k < 0xE000)
    rows, row, _ = quality_lm.distinct_grams([text, "ab"])
    s = [0, 0, 0, *map(ord, text)]
    assert len(rows) == len(text) + 2 and rows[row[:-2]].tolist() == [s[k : k + 4] for k in range(len(text))]


def test_prose_of_any_script_is_told_from_random_letters(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("абвгдежзик") for _ in range(rng.randrange(2, 7))) for _ in range(40)]
    prose = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    noise = ["".join(rng.sample(t, len(t))) for t in prose[:5]]
    docs = spark.createDataFrame([(k, t, "ru") for k, t in enumerate(prose + noise)], "doc_id long, text string, lang string")
    out = {r.doc_id: r.perplexity for r in quality_lm.classify(docs, docs.where("doc_id < 30").select("doc_id")).collect()}
    assert max(out[k] for k in range(30, 40)) * 1.5 < min(out[k] for k in range(40, 45))


def test_a_word_in_three_texts_is_learnt_from_at_any_size():
    rows = [toxicity.word_features(f"w{k % 40}" + (" snork" if k < 3 else "")) for k in range(4000)]
    c = toxicity.Classifier()
    c.fit(rows, np.asarray([k < 3 for k in range(4000)], np.float32), steps=1)
    assert np.isin(toxicity.word_features("snork"), c.known).any() and toxicity.TRAIN_ROWS >= 8000
