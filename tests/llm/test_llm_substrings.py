import hashlib
import random
import re

from matchmart.llm.substrings import remove_repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=13):
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            w = WORDS.findall(text or "")
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = WORDS.findall(text or "")
        gone = set()
        for i in range(len(w) - n + 1):
            if doc_id is not None and first[tuple(w[i:i + n])] < doc_id:
                gone |= set(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def test_against_brute_force(make_docs):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        words = [rng.choice("abc") if rng.random() < 0.5 else str(rng.randrange(400)) for _ in range(rng.randrange(80))]
        if rows and rng.random() < 0.7:  # pieces of earlier texts, copies included
            other = rng.choice(rows)[1].split()
            a = rng.randrange(len(other) + 1)
            words[rng.randrange(len(words) + 1):0] = other[a:a + rng.choice([12, 13, 14, 25, 40])]
        rows.append((rng.randrange(90), rng.choice([" ", "  ", "\n", "\t"]).join(words)))
    assert found(remove_repeats(make_docs(rows))) == brute(rows)


def test_edges(make_docs, edge_rows):
    out = remove_repeats(make_docs(edge_rows), with_text=True)
    assert found(out.drop("kept_text")) == brute(edge_rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in out.collect())


def test_repeats_inside_one_document_stay(make_docs):
    text = " ".join(map(str, range(20)))
    rows = [(5, text + " " + text)]
    assert found(remove_repeats(make_docs(rows))) == brute(rows)
    assert remove_repeats(make_docs(rows)).first().n_removed == 0


def test_other_window_and_empty(make_docs):
    rows = [(1, "a b c d e f"), (2, "x a b c d y"), (3, "a b c")]
    assert found(remove_repeats(make_docs(rows), target=4)) == brute(rows, 4)
    assert remove_repeats(make_docs([])).collect() == []
