import random

import numpy as np

from matchmart.llm import token_counts as C


def random_text(rng, n):
    parts = ["a", "b", " ", "\n", "'s", "12", "é", "word", " the", "  ", "!", "日", " ", "'ll", "\t"]
    return "".join(rng.choice(parts) for _ in range(n))


def edit_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, seq long, start long, removed long, inserted string")


def test_counts_after_edits_against_full_counts(spark, make_docs, edge_rows):
    rng = random.Random(3)
    ours = C.encoding()
    rows = [r for r in edge_rows if r[0] not in (None, 9)] + [(1000 + i, random_text(rng, rng.randrange(400)))
                                                              for i in range(200)]
    script = {}
    for d, t in rows:
        for q in range(rng.choice([0, 1, 2, 5, 30])):
            text = random_text(rng, 1500) if rng.random() < 0.05 else rng.choice(["", " ", "x", " y ", "'s", None])
            script.setdefault(d, []).append((d, q, rng.randrange(len(t or "") + 3), rng.choice([0, 1, 2, 10, 100]), text))
    edits = edit_table(spark, [e for own in script.values() for e in own] + [(-99, 0, 0, 1, "z"), (None, 0, 0, 1, "z"),
                                                                           (1000, 99, None, None, None)])
    states = C.build_states(make_docs(rows))
    out = C.apply_edits(C.with_edits(states, edits))
    texts = dict(rows)
    for r in out.collect():
        old = texts[r.doc_id] or ""
        own = C._merged([dict(seq=e[1], start=e[2], removed=e[3], inserted=e[4]) for e in script.get(r.doc_id, [])],
                        len(old))
        new = C._rewritten(old, 0, len(old), own)
        assert r.text == new
        assert r.n_tokens_before == len(ours.encode_ordinary(old))
        assert r.n_tokens == r.tokens[1] == len(ours.encode_ordinary(new))
        assert r.chars[1] == len(new)
    again = C.apply_edits(C.with_edits(out.select("doc_id", "text", "chars", "tokens"), edits))
    assert all(r.n_tokens == len(ours.encode_ordinary(r.text)) for r in again.collect())


def test_only_touched_leaves_are_read(spark, make_docs):
    text = " ".join(f"word{i}" for i in range(20_000))
    states = C.build_states(make_docs([(1, text), (2, text)]))
    r = C.apply_edits(C.with_edits(states, edit_table(spark, [(1, 0, 60_000, 3, "abc"), (1, 1, 90_000, 0, " new")])))
    r = {x.doc_id: x for x in r.collect()}
    assert r[1].n_leaves > 600 and 0 < r[1].n_leaves_read <= 6 and r[1].chars_read < 3000
    assert r[2].n_leaves_read == 0 and r[2].n_tokens == r[2].n_tokens_before


def test_tree():
    values = np.arange(1, 12)
    tree = C.heap(values)
    assert tree[1] == values.sum()
    ends = np.cumsum(values)
    for place in range(int(ends[-1])):
        leaf, begin = C.leaf_of(tree, place)
        assert leaf == np.searchsorted(ends, place, "right") and begin == ends[leaf] - values[leaf]
    C.update(tree, 3, np.array([50, 0, 7]))
    values[3:6] = [50, 0, 7]
    assert (tree == C.heap(values)).all()


def test_rows_that_share_a_doc_id_and_empty(spark, make_docs):
    edits = edit_table(spark, [(9, 0, 0, 4, "")])
    rows = [(9, "same text here"), (9, "same text here"), (None, "x")]
    out = C.apply_edits(C.with_edits(C.build_states(make_docs(rows)), edits)).collect()
    assert sorted(r.text for r in out) == [" text here", " text here", "x"]
    assert C.apply_edits(C.with_edits(C.build_states(make_docs([])), edits)).collect() == []


def test_redactions(make_docs):
    found = C.redactions(make_docs([(1, "call 12345678 or me@x.y now"), (2, None), (3, "none")])).collect()
    assert sorted((r.doc_id, r.seq, r.start, r.removed) for r in found) == [(1, 0, 5, 8), (1, 1, 17, 6)]


def test_redactions_stay_in_their_row(make_docs):
    rows = [(1, "mail me at someone@example.org or call 123456789"), (1, "nothing to see here at all friends"),
            (None, "key 0123456789abcdef0123"), (None, "none"), (2, None), (2, "")]
    ours = C.encoding()
    out = C.apply_edits(C.with_redactions(C.build_states(make_docs(rows)))).collect()
    import re
    want = sorted((str(d), re.sub(C.REDACTED, "[removed]", t or "")) for d, t in rows)
    assert sorted((str(r.doc_id), r.text) for r in out) == want
    assert all(r.n_tokens == len(ours.encode_ordinary(r.text)) for r in out)
