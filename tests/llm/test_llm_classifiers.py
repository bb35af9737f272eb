import math
import random
import zlib

import numpy as np
import pyarrow as pa

from matchmart.llm import languages, toxicity
from matchmart.llm import textops as T


def out_of(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1


def toxic_rows(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(10, 200))]
        if i % 5 == 0:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["zorkish", "quuxer"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_toxicity_held_out(spark, make_docs):
    rows, labels = toxic_rows(900)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = make_docs(rows)
    out = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, table)).collect()}
    assert all(out[d].held_out == out_of(d) for d, _ in rows)
    held = [(out[d].predicted, t) for d, t in labels if out_of(d)]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())
    # Labels of the held-out third change nothing.
    turned = spark.createDataFrame([(d, 1 - t if out_of(d) else t) for d, t in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, turned)).collect()}
    assert again == {d: r.score for d, r in out.items()}


def test_toxicity_edges(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    labels = "doc_id long, toxic int, text string"
    some = spark.createDataFrame([(5, 1, "x"), (5, 0, "x"), (None, 1, "x"), (7, None, "x"), (8, 0, "x"), (10, 0, "x"),
                                  (3, 1, "x"), (404, 1, "x")], labels)
    for table in (some, some.where("false"), some.where("toxic = 1")):
        out = toxicity.score(docs, toxicity.train(docs, table)).collect()
        assert len(out) == len(edge_rows) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(make_docs([]), toxicity.train(make_docs([]), some)).collect() == []


def language_rows(n, seed=2):
    rng = random.Random(seed)
    parts = {"aa": ["ka", "mo", "li", "ta"], "bb": ["sch", "ung", "ein", "öt"], "cc": ["xi", "qu", "zhe", "ña"]}
    def text(lang, words):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))
    rows = [(i, text(lang, rng.randrange(3, 120)), lang) for i in range(n) for lang in [rng.choice(list(parts))]]
    return rows, text


def test_language_held_out_and_mixture(make_docs):
    rows, text = language_rows(500)
    langs, logs = languages.train(make_docs(rows))
    assert langs == ["aa", "bb", "cc"]
    mixed = [(9001, text("aa", 60) + "\n" + text("bb", 20), None), (9002, "12 34 !!", None), (9003, text("cc", 40).upper(), None)]
    out = {r.doc_id: r for r in languages.predict(make_docs(rows + mixed), langs, logs).collect()}
    held = [(out[d].lang_pred, lang) for d, _, lang in rows if out_of(d)]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert out[9001].lang_pred == "aa" and out[9001].languages == ["aa", "bb"] and abs(out[9001].score - 0.75) < 0.05
    assert (out[9002].lang_pred, out[9002].score) == ("und", 0.0)
    assert out[9003].lang_pred == "cc" and out[9003].languages == ["cc"]


def test_language_edges(make_docs, edge_rows):
    docs = make_docs([(*r, "aa" if i % 2 else "bb") for i, r in enumerate(edge_rows)])
    out = languages.predict(docs, *languages.train(docs)).collect()
    assert len(out) == len(edge_rows)
    assert {r.lang_pred for r in out if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(0 <= r.score <= 1 for r in out)
    none = make_docs(edge_rows)
    assert {r.lang_pred for r in languages.predict(none, *languages.train(none)).collect()} == {"und"}
    assert languages.predict(make_docs([]), *languages.train(make_docs([]))).collect() == []


def plain_mixture(text, logs):
    """The chosen languages' proportions of one text, by expectation-maximisation in plain loops."""
    data, off = T.utf8(pa.array([text.lower()]))
    bucket, word, _ = languages._grams(data, off)
    ends = [*word[1:].tolist(), len(bucket)]
    likelihood = [logs[bucket[a:b]].sum(0).astype(float) for a, b in zip(word.tolist(), ends)]
    p = [[math.exp(x - max(w)) for x in w] for w in likelihood]
    k, n = logs.shape[1], len(p)

    def em(allowed):
        pi = [1 / len(allowed) if j in allowed else 0.0 for j in range(k)]
        while True:
            new = [0.0] * k
            for w in p:
                total = sum(a * b for a, b in zip(w, pi)) + 1e-9
                new = [x + a * b / total / n for x, a, b in zip(new, w, pi)]
            moved, pi = max(abs(a - b) for a, b in zip(new, pi)), new
            if moved <= languages.TOLERANCE:
                return pi, sum(math.log(sum(a * b for a, b in zip(w, pi)) + 1e-9) for w in p)

    order = sorted(range(k), key=lambda j: (-em(range(k))[0][j], j))
    best, chosen = sum(math.log(w[order[0]] + 1e-9) for w in p), [float(j == order[0]) for j in range(k)]
    for size in range(2, k + 1):
        pi, value = em(order[:size])
        value -= languages.PENALTY * (size - 1) * math.log(n + 1)
        if value > best:
            best, chosen = value, pi
    return chosen


def test_language_equals_plain_mixture(make_docs):
    rows, text = language_rows(300)
    langs, logs = languages.train(make_docs(rows))
    rng = random.Random(3)
    mixed = [(5000 + i, " ".join(text(rng.choice(["aa", "bb", "cc"]), rng.randrange(2, 30)) for _ in range(3)), None)
             for i in range(40)]
    out = {r.doc_id: r for r in languages.predict(make_docs(rows[:40] + mixed), langs, logs).collect()}
    several = 0
    for d, t, _ in rows[:40] + mixed:
        want = plain_mixture(t, logs)
        top = max(range(len(langs)), key=lambda j: want[j])
        assert out[d].lang_pred == langs[top] and abs(out[d].score - want[top]) < 1e-3
        assert out[d].languages == [langs[j] for j in range(len(langs)) if want[j] > 0]
        several += len(out[d].languages) > 1
    assert several > 10


def plain_toxicity(texts, toxic, others):
    """The scores of ``others`` by a dense classifier over the distinct n-grams of each text."""
    def grams(t):
        points = np.frombuffer("".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t.lower()).encode("utf-32-le"), np.uint32)
        return {int(T.window_hashes(points[i:i + n].astype(np.uint64), n, 1)[0] >> np.uint64(64 - toxicity.BITS))
                for n in toxicity.ORDERS for i in range(len(points) - n + 1)}
    sets = [grams(t) for t in texts]
    columns = sorted(set().union(*sets))
    place = {c: i for i, c in enumerate(columns)}

    def dense(own):
        x = np.zeros(len(columns))
        x[[place[g] for g in own if g in place]] = 1
        return x
    x, y = np.array([dense(s) for s in sets]), np.array(toxic, bool)
    p, q = x[y].sum(0) + 1, x[~y].sum(0) + 1
    r = np.log(p / y.sum()) - np.log(q / (~y).sum())
    r = np.sign(r) * np.maximum(0, abs(r) - toxicity.ERRORS * np.sqrt(1 / p + 1 / q))

    def unit(x):
        x = x * r
        return x / max(np.linalg.norm(x), 1e-9)
    x = np.array([unit(row) for row in x])
    share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    w, b, w_old, b_old = np.zeros(len(columns)), 0.0, np.zeros(len(columns)), 0.0
    ahead, b_ahead = w, b
    for t in range(toxicity.STEPS):
        error = share * (1 / (1 + np.exp(-(x @ ahead + b_ahead))) - y)
        w, b = ahead - 2.0 * (x.T @ error + toxicity.RIDGE * ahead), b_ahead - 2.0 * error.sum()
        ahead, b_ahead = w + t / (t + 3) * (w - w_old), b + t / (t + 3) * (b - b_old)
        w_old, b_old = w, b
    return [1 / (1 + math.exp(-(unit(dense(grams(t))) @ w + b))) for t in others]


def test_toxicity_equals_a_plain_classifier(spark, make_docs):
    rows, labels = toxic_rows(150, seed=4)
    docs, table = make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, table)).collect()}
    known = [(t, y) for (d, t), (_, y) in zip(rows, labels) if not out_of(d)]
    held = [(d, t) for d, t in rows if out_of(d)]
    want = plain_toxicity([t for t, _ in known], [y for _, y in known], [t for _, t in held])
    assert max(abs(out[d] - s) for (d, _), s in zip(held, want)) < 1e-3
