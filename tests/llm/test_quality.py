"""The language model against a plain Python version; what the classifier keeps on held-out rows."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tablefolio.llm import quality
from tablefolio.llm.common import bound_batches

LABELS = "doc_id long, quality int, toxic int, h string"


def symbols(text):
    return [quality.START] * 4 + [ord(c) if ord(c) < 0xF00 else 0xF00 + ((ord(c) * 2654435761) >> 7) % 0xFE for c in text]


def brute_model(texts):
    counts = {5: Counter()}
    for t in texts:
        s = symbols(t)
        counts[5].update(tuple(s[i:i + 5]) for i in range(len(s) - 4))
    for k in (4, 3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, context = {}, {}
    for k, c in counts.items():
        n = Counter(c.values())
        discount[k] = quality.discounts(n[1], n[2], n[3], n[4])
        context[k] = defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            context[k][g[:-1]][0] += v
            context[k][g[:-1]][1] += discount[k][min(v, 3) - 1]

    def p(g):
        out = 1 / (len(counts[1]) + 1)
        for k in range(1, 6):
            own = g[5 - k:]
            if own[:-1] in context[k]:
                total, spared = context[k][own[:-1]]
                v = counts[k][own]
                out = ((v - discount[k][min(v, 3) - 1]) / total if v else 0) + spared / total * out
        return out

    return p


def bits(p, text):
    s = symbols(text)
    return -sum(math.log2(p(tuple(s[i:i + 5]))) for i in range(len(s) - 4)) / len(text)


def prose(rng, n):
    return " ".join("".join(rng.choices(["an", "the", "ou", "ring", "sta", "ble", "é"], k=rng.randint(1, 4))) for _ in range(n))


def test_model_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "SLICE_CHARS", 100)  # texts span several slices
    monkeypatch.setattr(quality, "CHUNK_BYTES", 2000)  # and several chunks
    rng = random.Random(1)
    trusted = [prose(rng, 40) for _ in range(30)] + ["中文 😀 x"]
    model = quality.Model.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    p = brute_model(trusted)
    asked = [*trusted[:5], "!!! NO NO", "the qqq zz", "中", "x", prose(rng, 300)]
    rows = [(i, 0, "en", t) for i, t in enumerate(asked)]
    got = {r.id: r for r in quality.score(spark.createDataFrame(rows, "id long, h long, lang string, text string").repartition(3), model).collect()}
    for i, t in enumerate(asked):
        assert got[i].n == len(t) and got[i].bits == pytest.approx(bits(p, t), rel=1e-9)
    alphabet = sorted({c for t in trusted for c in t})
    g = symbols("the ")[-4:]
    assert sum(p((*g, ord(c) if ord(c) < 0xF00 else symbols(c)[-1])) for c in alphabet) == pytest.approx(1, abs=0.02)


def test_few_files_for_the_model(spark):
    """The tables of the model have no more files than a shuffle has partitions, though they are unions."""
    rng = random.Random(3)
    texts = spark.createDataFrame([(prose(rng, 40),) for _ in range(30)], "text string")
    settings = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, "true") for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert len(quality.Model.train(texts).lookup.inputFiles()) <= 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_batches_are_small(spark):
    """A row batch that waits in a task and in its Python worker takes 8 MB of each."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 64 << 20)
        bound_batches(spark)
        assert int(spark.conf.get(name)) == 8 << 20
    finally:
        spark.conf.set(name, before)


def test_frequent_grams_are_not_asked_for(spark, monkeypatch):
    """What the tasks know already moves no more, and the scores are the same to the last bit."""
    monkeypatch.setattr(quality, "CHUNK_BYTES", 2000)
    rng = random.Random(2)
    trusted = [prose(rng, 40) for _ in range(30)]
    model = quality.Model.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    rows = [(i, 0, "en", t) for i, t in enumerate([*trusted[:5], "!!! NO NO", prose(rng, 300)])]
    df = spark.createDataFrame(rows, "id long, h long, lang string, text string").repartition(3)
    of_text = {int(g) for r in rows for found in quality.grams(r[3]) for g in found}
    counts = {r.g: r.c for r in model.counted.collect()}
    asked, probabilities = [], model.probabilities
    monkeypatch.setattr(model, "probabilities", lambda wanted: asked.append({r.g for r in wanted.collect()}) or probabilities(wanted))
    got = {}
    for most in (0, 100, 1 << 18):
        monkeypatch.setattr(quality, "FREQUENT", most)
        asked.clear()
        got[most] = sorted(quality.score(df, model).collect())
        known = asked[0] if len(asked) > 1 else set()
        assert len(known) <= most and asked[-1] == of_text - known
        if known:
            assert min(counts[g] for g in known) >= max((c for g, c in counts.items() if g not in known), default=0)
    assert known == set(counts) and got[0] == got[100] == got[1 << 18]


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(7)
    texts, labels = [], []
    for i in range(400):
        junk = i % 10 == 9
        texts.append(" | ".join(prose(rng, 1).upper() + "!!" for _ in range(60)) if junk else prose(rng, rng.randint(20, 200)))
        if i % 4:
            labels.append((i, 0 if junk else 1, 0, "x"))
    return texts, labels


def test_held_out_accuracy(spark, odd, labelled):
    texts, labels = labelled
    got = {r.doc_id: r.kept for r in quality.classify(odd(texts), spark.createDataFrame(labels, LABELS)).collect()}
    unseen = [i for i in range(400) if i % 4 == 0 or i % 10 == 9]
    assert len(got) == 400
    assert sum(not got[i] for i in unseen if i % 10 == 9) == 40  # all junk goes
    clean = [i for i in range(400) if i % 10 != 9]
    assert sum(got[i] for i in clean) >= 0.98 * len(clean)


def test_odd_rows(spark, odd, labelled):
    texts, labels = labelled
    more = [None, "", "é", texts[9], texts[9], texts[0]]
    ids = [*range(400), 1000, 1001, 1002, 9, None, None]
    df = odd(texts + more, ids).withColumn("lang", quality.F.expr("if(doc_id = 1002, null, lang)"))
    kept = quality.accepted(df, spark.createDataFrame([*labels, (None, 1, 0, "x"), (1, 0, 0, "x"), (2, None, 1, "x")], LABELS))
    assert kept.columns == df.columns
    rows = kept.collect()
    assert {1000, 1001} <= {r.doc_id for r in rows} and not any(r.doc_id is not None and r.doc_id < 400 and r.doc_id % 10 == 9 for r in rows)
    assert sum(r.doc_id is None for r in rows) == 1  # the junk row without id goes, the clean one stays


def test_without_trusted_text_and_without_rows(spark, odd):
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept for r in quality.classify(odd(["!!", None, "x"]), none).collect())
    assert quality.classify(odd([]), spark.createDataFrame([(1, 1, 0, "x")], LABELS)).collect() == []


def test_worst_word_slice_by_slice(monkeypatch):
    monkeypatch.setattr(quality, "WORD_CHARS", 5)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices("abé 中-1", k=rng.randint(1, 40)))
        cost = [rng.random() * 8 for _ in text]
        words, step = quality.Words(), rng.randint(1, 12)
        for i in range(0, len(text), step):
            words.add(text[i:i + step], quality.np.array(cost[i:i + step]))
        want = []
        for run in re.finditer(r"[abé中]+", text):
            for a in range(run.start(), run.end(), 5):
                part = cost[a:min(a + 5, run.end())]
                want.append((sum(part) - 2 * len(part)) / len(part) ** 0.5)
        got = words.worst(2.0)
        assert got is None if not want else got == pytest.approx(max(want))


def test_strange_words_in_clean_prose(spark, odd, labelled):
    texts, labels = labelled
    rng = random.Random(9)
    planted = []
    for n in range(60, 180, 4):
        words = prose(rng, n).split()
        for word in ("idiot", "moron"):
            words[rng.randrange(n)] = word
        planted.append(" ".join(words))
    got = {r.doc_id: r for r in quality.classify(odd(texts + planted), spark.createDataFrame(labels, LABELS)).collect()}
    gone = [not got[i].kept for i in range(400, 400 + len(planted))]
    assert sum(gone) >= 0.9 * len(gone)
    clean = [i for i in range(400) if i % 10 != 9]
    assert sum(got[i].kept for i in clean) >= 0.96 * len(clean)


def test_labels_must_agree(spark):
    rows = [(1, 1, 0, "x"), (1, 1, 0, "x"), (2, 1, 0, "x"), (2, 0, 0, "x"), (3, 1, 1, "x"), (4, 1, None, "x")]
    assert [r.id for r in quality.trusted_ids(spark.createDataFrame(rows, LABELS)).collect()] == [1]
