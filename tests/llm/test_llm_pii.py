import hashlib
import random
import re

import numpy as np
import pytest

from matchmart.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def right_check_digit(d):
    return sum((lambda x: x - 9 if x > 9 else x)(int(c) * (2 if i % 2 else 1)) for i, c in enumerate(d[::-1])) % 10 == 0


def brute(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and right_check_digit(d):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def card(rng):
    d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(d + c for c in "0123456789" if right_check_digit(d + c))


def labelled(rng, n):
    rows = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randrange(2, 6)):
            text += " ".join(rng.choice(["the", "of", "Haus", "on", "12", "x."]) for _ in range(rng.randrange(1, 8))) + " "
            kind = rng.randrange(4)
            found = [f"a{rng.randrange(99)}.b@c{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)),
                     card(rng), f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"][kind]
            spans.append((kind, len(text), len(text) + len(found)))
            text += found + " "
        rows.append((text, spans))
    return rows


@pytest.fixture(scope="module")
def field():
    return P.train(labelled(random.Random(1), 120))


def test_rules_against_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a.b@-_+1 2(3)95é%") for _ in range(rng.randrange(40)))
        assert P.base_spans(text) == brute(text)


def test_gradient():
    rng = np.random.default_rng(0)
    rows = labelled(random.Random(2), 3)
    chains = P.Chains([(i, t) for i, (t, _) in enumerate(rows)])
    gold = P.gold_labels(chains, {i: s for i, (_, s) in enumerate(rows)})
    field = P.Field(rng.normal(0, 0.3, (P._SIZE, P._LABELS)), rng.normal(0, 0.3, (P._LABELS, P._LABELS)))
    value, d_emit, d_move = field.gradient(chains, gold)
    for w, d, at in ((field.emit, d_emit, (chains.features[3, 0], 2)), (field.move, d_move, (0, 3)), (field.move, d_move, (2, 2))):
        w[at] += 1e-5
        assert abs((field.gradient(chains, gold)[0] - value) / 1e-5 - d[at]) < 1e-3
        w[at] -= 1e-5


def test_field_finds_held_out_spans(field):
    rows = labelled(random.Random(3), 60)
    found = P.added_spans([(i, t) for i, (t, _) in enumerate(rows)], {}, field)
    gold = {(i, *s) for i, (_, spans) in enumerate(rows) for s in spans}
    got = {(i, *s) for i, spans in found.items() for s in spans}
    assert len(gold & got) > 0.97 * len(gold) and len(got - gold) < 0.03 * len(gold)


def test_viterbi_against_all_paths(field):
    import itertools
    chains = P.Chains([(0, "+1 5")])
    labels = field.decode(chains)
    score = field.emit[chains.features].sum(1)
    best = max(itertools.product(range(P._LABELS), repeat=len(labels)), key=lambda y: sum(
        score[t, y[t]] + field.move[y[t - 1] if t else 0, y[t]] for t in range(len(y))))
    assert tuple(labels) == best


def test_tables(make_docs, edge_rows, field):
    rows = edge_rows + [(20, "mail me.x@y.example.com, ip 1.2.3.4 and 1.2.3.999 or +1 (555) 555-1234!"), (21, "nothing")]
    docs = make_docs(rows)
    got = {}
    for r in P.spans_of(docs, field).collect():
        got.setdefault(str(r.doc.doc_id), []).append([(s.kind, s.start, s.end) for s in r.spans if s.base])
    want = {}
    for d, t in rows:
        want.setdefault(str(d), []).append(P.base_spans(t) if d in (7, 11) else brute(t or ""))  # the plain patterns are quadratic there
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    out = P.redacted(docs, field)
    assert out.columns == docs.columns
    clean = {r.doc_id: r for r in out.where("doc_id >= 20").collect()}
    assert clean[20].text.startswith("mail [email], ip [ip] and ") and clean[20].text.endswith("[phone]!")
    assert clean[20].n_chars == len(clean[20].text) and clean[21].text == "nothing"
    assert out.count() == len(rows)


def test_query_columns_and_training_table(spark, make_docs, tmp_path):
    rng = random.Random(4)
    rows = [(i, t) for i, (t, _) in enumerate(labelled(rng, 40))] + [(90, None), (91, "")]
    make_docs(rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in P.op3_pii(spark, str(tmp_path)).collect()}
    for d, t in rows:
        spans = brute(t or "")
        assert out[d].base_sha256 == hashlib.sha256(P._joined(spans).encode()).hexdigest()
        assert [out[d].n_email, out[d].n_ip, out[d].n_card, out[d].n_phone] == [sum(s[0] == k for s in spans) for k in range(4)]
        assert set(P._joined(spans).split(",")) <= set(out[d].spans.split(","))


def test_without_labels(make_docs):
    field = P.train([])
    assert P.spans_of(make_docs([(1, "12 34 a@b")]), field).first().spans == []
    assert P.spans_of(make_docs([]), field).collect() == []
    assert P.redacted(make_docs([]), field).collect() == []


def test_spans_beside_each_other_are_added(spark, make_docs, tmp_path):
    """Cards side by side and a phone before an ip, which the rules merge and refuse."""
    import corpus_pipeline

    rng = random.Random(6)
    rows, want = [], {}
    for i in range(60):
        ip = ".".join(str(rng.randrange(100, 256)) for _ in range(4))
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        parts, kinds = (([card(rng), card(rng)], (2, 2)), ([phone, ip], (3, 1)))[i % 2]
        text, spans = "the word of 12 Haus. ", []
        for kind, part in zip(kinds, parts):
            spans.append((kind, len(text), len(text) + len(part)))
            text += part + " "
        rows.append((i, text + "and so on"))
        want[i] = P._joined(spans)
    rows += [(100 + i, f"order {rng.randrange(10**9)} of 2020, {i} items at 10.5, version 3.{i}.2") for i in range(40)]
    docs = make_docs(rows)
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in P.op3_pii(spark, str(tmp_path)).collect()}
    assert all(out[i].spans == spans for i, spans in want.items())
    assert all(out[i].n_added == 0 and out[i].spans == "" for i in range(100, 140))
    clean = {r.doc_id: r.text for r in corpus_pipeline.pii_stage(spark, docs, str(tmp_path)).collect()}
    assert all(clean[i].endswith(("[card] [card] and so on", "[phone] [ip] and so on")[i % 2]) for i in want)
