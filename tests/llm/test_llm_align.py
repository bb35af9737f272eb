import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from matchmart.llm import align as A

PATHS = A.vocabulary_path(A.VOCABULARY_A), A.vocabulary_path(A.VOCABULARY_B)


def plain_tokens(text):
    """Ids and byte ends of both whole-text encodings; None when the bytes do not come back."""
    if not text:
        return None
    (a, bytes_a), (b, bytes_b) = A.tokenizer_a(PATHS[0]), A.tokenizer_b(PATHS[1])
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if any(b"".join(t[i] for i in ids) != whole for ids, t in ((ids_a, bytes_a), (ids_b, bytes_b))):
        return None
    return [(ids, np.cumsum([len(t[i]) for i in ids]).tolist()) for ids, t in ((ids_a, bytes_a), (ids_b, bytes_b))]


def plain(texts):
    rows, links = [], []
    for text in texts:
        found = plain_tokens(text)
        if found is None:
            rows.append((0, 0, 0, "")), links.append([])
            continue
        (a, ends_a), (b, ends_b) = found
        common, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for e in common:
            x, y = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        rows.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(p, q) for p, e in zip(a, ends_a) for q, f in zip(b, ends_b) if e == f])
    count = Counter(k for own in links for k in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(*r, len(own), sum(count[k] == best[k[1]] for k in own), sum(count[k] for k in own))
            for r, own in zip(rows, links)]


def texts():
    rng = random.Random(11)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "2024", "é", "Straße", "日本", "🙂", " ", " ", "　", "<|endoftext|>",
             "<s>", "<0x41>", "\x00", "\x7f", "word", "tokenizer", "ation", "...", "!?", "ﬁ", "́", "\x85", "à", "​"]
    random_ones = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(250)]
    return [None, "", " ", "   ", "x ", " x", "▁", "a▁b", "same text", "same text", *random_ones]


def result(spark, rows):
    table = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, a string, links string")
    out = A.aligned(table).persist()
    pairs = A.suffix_pairs(*PATHS)
    found = A.with_counts(out, pairs, A.link_counts(out, len(pairs))).collect()
    return sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.groups_sha256, r.n_links, r.n_best, r.count_sum)
                   for r in found], key=lambda r: (r[0] is None, r[0]))


def test_equals_plain_alignment(spark):
    own = texts()
    got = result(spark, list(enumerate(own)))
    assert [r[1:] for r in got] == plain(own)


def test_edge_rows(spark, edge_rows):
    # The plain version is quadratic in the text: its long texts are cut here, the operator's test below has them whole.
    rows = [(i, t and t[:3000]) for i, t in edge_rows]
    got, expected = result(spark, rows), plain([t for _, t in rows])
    assert sorted([r[1:] for r in got]) == sorted(expected)
    assert result(spark, []) == []


def test_long_texts(spark, edge_rows):
    for r in result(spark, [r for r in edge_rows if r[0] in (5, 7, 11)]):
        text = dict(edge_rows)[r[0]]
        (a, ends_a), (b, ends_b) = plain_tokens(text)
        assert r[1:4] == (len(a), len(b), len(set(ends_a) & set(ends_b))) and r[5] == r[3]


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64, 2048])
def test_pieces_of_any_size_give_the_same_overlaps(work):
    rng = np.random.default_rng(work)
    for _ in range(30):
        n = int(rng.integers(1, 200))
        a, b = (np.append(np.flatnonzero(rng.random(n) < p) + 1, n + 1) for p in rng.random(2))
        ends = sorted(set(a.tolist()) | set(b.tolist()))
        both = set(a.tolist()) & set(b.tolist())
        expected = [(int((a < e).sum()), int((b < e).sum()), e, e in both) for e in ends]
        got = A.overlaps(a.astype(np.int64), b.astype(np.int64), work)
        assert list(zip(*(x.tolist() for x in got))) == expected
        i, j = A.diagonals(a, b, work)
        assert (np.diff(i + j)[:-1] == work).all() and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()


def test_detail_holds_the_overlaps(spark):
    table = spark.createDataFrame([(1, "tokenization is näive"), (2, None), (3, "a▁b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in A.aligned(table, detail=True).collect()}
    r, (a, b) = rows[1], plain_tokens("tokenization is näive")
    assert list(r.a_ids) == a[0] and list(r.b_ids) == b[0]
    assert sum(r.overlap_bytes) == len(" tokenization is näive".encode())
    assert sum(r.overlap_closes) == r.n_groups and r.overlap_a[0] == r.overlap_b[0] == 0
    ends = np.cumsum(r.overlap_bytes).tolist()
    assert [(x, y) for x, y in zip(r.overlap_a, r.overlap_b)] == [
        (sum(e < end for e in a[1]), sum(e < end for e in b[1])) for end in ends]
    assert rows[2].a_ids is None and rows[3].n_a == rows[3].n_b == 0


def test_every_link_is_a_suffix_pair():
    pairs = A.suffix_pairs(*PATHS)
    bytes_a, bytes_b = A.tokenizer_a(PATHS[0])[1], A.tokenizer_b(PATHS[1])[1]
    for p in pairs[::997].tolist():
        x, y = bytes_a[p >> 32], bytes_b[p & 0xFFFFFFFF]
        assert x.endswith(y) or y.endswith(x)
    assert len(pairs) < 1_000_000 and len(np.unique(pairs)) == len(pairs)
