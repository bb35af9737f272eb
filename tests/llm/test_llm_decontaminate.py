import random

from matchmart.llm import decontaminate


def edits(rng, text, n):
    s = list(text)
    for _ in range(n):
        i = rng.randrange(len(s))
        op = rng.randrange(3)
        if op == 0:
            s[i] = rng.choice("qxz")
        elif op == 1:
            s.insert(i, rng.choice("qxz"))
        else:
            del s[i]
    return "".join(s)


def least_edits(item, text):
    """Sellers' algorithm: the least edits of the item anywhere in the text."""
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(item):
            new.append(min(column[i] + (p != c), column[i + 1] + 1, new[i] + 1))
        column = new
        best = min(best, column[-1])
    return best


def table(spark, items):
    return spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, doc_id string")


def test_against_alignment(spark, make_docs):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéno") for _ in range(rng.randrange(2, 9)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(8, 40)))) for i in range(12)]
    rows = []
    for d in range(60):
        text = [word() for _ in range(rng.randrange(60))]
        item = rng.choice(items)[1]
        k = decontaminate.EDIT_RATE * len(item)
        text.insert(rng.randrange(len(text) + 1), edits(rng, item, rng.choice([0, 1, int(k / 2), int(k), int(3 * k)])))
        if d % 3:
            rows.append((d, " ".join(text)))
        else:
            rows.append((d, "\n".join(text).upper()))
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.leaks(make_docs(rows), table(spark, items)).collect()}
    want = {}
    for d, text in rows:
        for i, item in items:
            n = least_edits(item.lower(), text.lower().replace("\n", " "))
            if n <= int(decontaminate.EDIT_RATE * len(item)):
                want[d, i] = n
    assert len(want) > 30 and got == want


def test_edges_and_blocks(spark, make_docs, edge_rows, monkeypatch):
    items = [(1, None), (None, "this item has no number but is long"), (2, "w9x9 w8x"), (3, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5"),
             (4, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5"), (5, "nothing like this is anywhere in here")]
    docs = make_docs(edge_rows)
    want = [(5, 3, 0), (5, 4, 0), (6, 3, 0), (6, 4, 0)]
    assert sorted((r.doc_id, r.item_id, r.edits) for r in decontaminate.leaks(docs, table(spark, items)).collect()) == want
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 40)
    assert sorted((r.doc_id, r.item_id, r.edits) for r in decontaminate.leaks(docs, table(spark, items)).collect()) == want
    clean = decontaminate.clean_documents(docs, table(spark, items))
    assert clean.columns == docs.columns and clean.count() == len(edge_rows) - 2


def test_short_items_and_rows_without_a_doc_id(spark, make_docs):
    items = [(1, "answer is forty two"), (2, "Ja"), (3, "é?"), (4, "answer is forty two"), (5, ""), (6, "ten chars ")]
    rows = [(None, "Well, the ANSWER is\nforty two."), (None, "nothing"), (1, "the answer is forty twofold"), (1, "ja ja"),
            (2, "jam"), (3, "so é? é?"), (None, None), (7, "ten chars  more")]
    got = sorted((str(r.doc_id), r.item_id, r.edits, r.stop)
                 for r in decontaminate.leaks(make_docs(rows), table(spark, items)).collect())
    assert got == [("1", 2, 0, 2), ("3", 3, 0, 5), ("7", 6, 0, 10), ("None", 1, 0, 29), ("None", 4, 0, 29)]
    clean = decontaminate.clean_documents(make_docs(rows), table(spark, items)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in clean) == [
        ("1", "the answer is forty twofold"), ("2", "jam"), ("None", "None"), ("None", "nothing")]


def test_every_item_has_its_whole_budget(spark, make_docs):
    """Items of 24 to 60 characters with exactly a tenth of their characters changed."""
    rng = random.Random(5)
    items, rows = [], []
    for m in range(decontaminate.MIN_CHARS, 60):
        item = "".join(rng.choice("abcdefghij") for _ in range(m))
        k = m // 10
        text = list(item)
        for place in sorted(rng.sample(range(1, m - 1), k)):
            text[place] = "z"
        items.append((m, item))
        rows.append((m, "zzzz " * 5 + "".join(text) + " zzzz" * 5))
    found = {(r.doc_id, r.item_id): r.edits for r in decontaminate.leaks(make_docs(rows), table(spark, items)).collect()}
    assert found == {(m, m): m // 10 for m, _ in items}


def test_empty(spark, make_docs):
    items = [(5, "nothing like this is anywhere in here")]
    assert decontaminate.leaks(make_docs([]), table(spark, items)).collect() == []
    assert decontaminate.leaks(make_docs([(1, "x")]), table(spark, [])).collect() == []
