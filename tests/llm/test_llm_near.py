import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from matchmart.llm import graph, near
from matchmart.llm import textops as T


def shingles(text):
    words = re.findall(r"[^ \t-\r]+", text)
    return collections.Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else {}


def brute(rows, threshold=0.8):
    """Classes by comparing all pairs of rows by their exact weighted similarity, from the words themselves."""
    n = max(2, len(rows))
    rows = [(d, shingles(t)) for d, t in rows if d is not None and t]
    df = collections.Counter(g for _, own in rows for g in own)
    sets = [(d, {g: c * (1 + round(16 * math.log(n / df[g]) / math.log(n)) / 16) for g, c in own.items()})
            for d, own in rows]
    root = {d: d for d, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, j in {(i, j) for own in holders.values() for i in own for j in own if i < j}:
        a, b = sets[i][1], sets[j][1]
        shared = sum(min(a[g], b[g]) for g in a.keys() & b.keys())
        if shared >= threshold * (sum(a.values()) + sum(b.values()) - shared):
            x, y = sorted((top(sets[i][0]), top(sets[j][0])))
            root[y] = x
    return {d: top(d) for d, _ in sets}


def near_rows(seed, groups, copies, length, changes):
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(changes + 1)):
                text[rng.randrange(length)] = f"c{rng.randrange(5000)}"
            rows.append((doc, " ".join(text)))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_against_all_pairs(make_docs, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rows = near_rows(5, 6, 25, 120, 6) + near_rows(6, 20, 1, 60, 0)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    docs = make_docs(rows)
    got = {r.doc_id: r.class_id for r in near.classes(docs).collect()}
    assert got == brute(rows)


def test_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    got = collections.Counter((r.doc_id, r.class_id) for r in near.classes(docs).collect())
    assert got == {(None, None): 2, (1, 1): 1, (2, 2): 1, (3, 3): 1, (4, 4): 1, (5, 5): 1, (6, 5): 1, (7, 7): 1, (8, 8): 1,
                   (9, 9): 2, (10, 9): 1, (11, 11): 1}
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["None", "None", "1", "2", "3", "4", "5", "7", "8", "9", "11"])


def test_empty(make_docs):
    assert near.classes(make_docs([])).collect() == []
    assert near.one_of_each(make_docs([])).collect() == []
    no_words = make_docs([(1, ""), (2, " \n"), (3, "")])
    assert sorted((r.doc_id, r.class_id, r.kept) for r in near.classes(no_words).collect()) == [
        (1, 1, True), (2, 2, True), (3, 3, True)]


def test_samples_collide_as_often_as_similar():
    sampler = near._Sampler()
    rng = random.Random(9)
    hits, share = 0, 0.0
    for _ in range(60):
        words = [str(rng.random()) for _ in range(200)]
        other = words[:rng.randrange(150, 200)] + [str(rng.random())] + words[:3] * 3
        data, off = T.utf8(pa.array([" ".join(words), " ".join(other)]))
        row, h, count = near._shingles(data, off)
        _, bands = sampler.bands(row, h, count, np.zeros(len(h), np.uint8))
        hits += (bands[0] == bands[1]).mean()
        a = dict(zip(h[row == 0].tolist(), count[row == 0]))
        b = dict(zip(h[row == 1].tolist(), count[row == 1]))
        j = sum(min(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys()) / sum(
            max(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys())
        share += j ** near.ROWS
    assert abs(hits - share) / 60 < 0.08


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(100)]
    root = {x: x for pair in links for x in pair}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for a, b in links if a != b for x in (a, b)}


def test_rows_that_share_a_doc_id_are_judged_by_their_texts(make_docs):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, "something else entirely is said here"), (1, long), (2, long + " more"), (None, long),
            (None, "no number on this one at all"), (None, "no number on this one at all")]
    docs = make_docs(rows)
    got = collections.Counter((r.doc_id, r.class_id, r.kept) for r in near.classes(docs).collect())
    assert got == {(1, 1, True): 3, (2, 1, False): 1, (None, 1, False): 1, (None, None, True): 2}
    kept = collections.Counter((r.doc_id, r.text) for r in near.one_of_each(docs).collect())
    assert kept == {(1, long): 1, (1, rows[1][1]): 1, (None, rows[5][1]): 1}


def test_links_found_among_all_similar_pairs(make_docs):
    """Recall of the whole operator: of the pairs at 0.8 or more, how many end in one class."""
    rows = near_rows(21, 40, 5, 90, 3)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    docs = make_docs(rows)
    want = brute(rows)
    got = {r.doc_id: r.class_id for r in near.classes(docs).collect()}
    pairs = [(i, j) for i in want for j in want if i < j and want[i] == want[j]]
    assert len(pairs) > 100 and sum(got[i] == got[j] for i, j in pairs) >= 0.99 * len(pairs)


def test_levels_are_exact_in_any_number_of_chunks(make_docs, monkeypatch):
    """Each document's levels against document frequencies counted from the words, in one chunk and in many."""
    rng = random.Random(8)
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(40))) + (" " + shared) * (i % 3 == 0))
            for i in range(300)] + [(300, None), (7, "one text"), (7, "one text"), (None, "one text")]
    df = collections.Counter(g for _, t in {r for r in rows if r[1]} for g in shingles(t))
    want = {(d, t): sorted(round(16 * math.log(len(rows) / df[g]) / math.log(len(rows))) for g in shingles(t))
            for d, t in rows if t}
    docs = make_docs(rows)
    for chunk, part in ((4_000_000, 8_000_000), (900, 300)):
        monkeypatch.setattr(near, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(near, "RANGE_BYTES", part)
        signed = near.signatures(docs)
        named = signed.join(near._keyed(docs.where("text is not null"), "text").distinct(), ["did", "node"]).collect()
        got = {(None if r.did == near._NO_ID else r.did, r.text): sorted(zlib.decompress(r.levels)) for r in named if r.text}
        assert got == want and len(named) == len({r for r in rows if r[1] is not None})


def test_weights_do_not_follow_the_size_of_the_table(make_docs):
    """Two texts that share a very common passage and nothing else stay apart, however many others there are."""
    passage = " ".join(f"p{i}" for i in range(84))
    for others in (20, 600):
        rows = [(i, f"{passage} " + " ".join(f"own{i}x{j}" for j in range(20))) for i in range(others // 3)]
        rows += [(1000 + i, " ".join(f"o{i}x{j}" for j in range(12))) for i in range(others)]
        found = {r.doc_id: r.class_id for r in near.classes(make_docs(rows)).collect()}
        assert found == brute(rows)
