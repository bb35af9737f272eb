import collections
import random
import re

from matchmart.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = collections.Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def measures(df):
    return sorted((str(r.doc.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in quality.ledger(df).collect())


def test_measures_against_brute_force(make_docs, edge_rows):
    rng = random.Random(2)
    rows = edge_rows + [(100 + i, "".join(rng.choice(["a ", "b ", "c\n", "\n", "#", "\t", "é ", "\x0b", "long|"])
                                          for _ in range(rng.randrange(120)))) for i in range(150)]
    assert measures(make_docs(rows)) == sorted((str(d), *brute(t)) for d, t in rows)


def test_policies_and_rows_kept(make_docs):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, good), (1, good), (2, "short"), (3, "again and again " * 40), (4, " ".join(f"wo{i}$$$" for i in range(80))),
            (5, good.upper()), (6, None), (None, good)]
    docs = make_docs(rows)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]
    base = quality.ledger(docs).where(~quality.rejected(quality.BASE)).select("doc.doc_id").collect()
    assert sorted(str(r.doc_id) for r in base) == ["1", "1", "4", "5", "None"]


def test_ablation(make_docs):
    good = " ".join(f"word{i}" for i in range(80))
    docs = make_docs([(1, good), (2, "short"), (3, "a b c " * 40), (4, "a b c " * 5)])
    out = {(r.policy, r.rule): r for r in quality.ablation(quality.ledger(docs), [quality.BASE]).collect()}
    few = out["base", "few_words"]
    assert (few.n_docs, few.n_rejected, few.n_failed, few.n_alone, few.n_kept_without) == (4, 3, 2, 1, 2)


def test_empty(make_docs):
    assert quality.ledger(make_docs([])).collect() == []
    assert quality.kept_documents(make_docs([])).collect() == []
