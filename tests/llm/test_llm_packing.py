import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from matchmart.llm import packing as P
from matchmart.llm import textops as T


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.vocabulary_path())


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(5)
    texts = ["", None, " ", "don't I'll we've he'd it's they're I'm o'clock 'tis ''s 's's 'st 'll '", "a" * 9000,
             "x<|endoftext|>y", "naïve ½ ²3 µ ª Ünïcode ×÷ Ÿ", "日本語 text é", "İstanbul ΑΣ ΣΑΣ", "éx", "12345 3.14 a1b2",
             "\x1c\x1f\x85\xa0a\xa0b", *map(chr, range(256))]
    texts += ["".join(rng.choice([chr(rng.randrange(256)), rng.choice("'stvermld'' aB1")]) for _ in range(rng.randrange(60)))
              for _ in range(1500)]
    ids, bounds = P._Encoder(P.vocabulary_path()).ids(*T.utf8(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_plan_is_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(150):
        counts = {rng.randrange(1, 33): rng.randrange(1, 30) for _ in range(rng.randrange(1, 60))}
        bins, total = {}, {}
        for length, _, ranks, first, offset, per in P.best_fit(counts, 32):
            for j in range(ranks):
                bins.setdefault(first + j // per, []).append((offset + j % per * length, length))
        for own in bins.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
                total[length] = total.get(length, 0) + 1
            assert end <= 32
        assert total == counts
        rooms = []
        for length in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
            fits = [x for x in rooms if x >= length]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 32) - length)
        assert len(rooms) == len(bins)


def test_packed_table(make_docs, edge_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(P, "GROUP_ROWS", 3)
    parts = P.pieces(make_docs(edge_rows), with_ids=True).checkpoint()
    out = P.pack(parts).collect()
    want = []
    for doc_id, text in edge_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(str(doc_id), a // 4096, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes()))
                 for a in range(0, len(ids), 4096)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(places) == -(-sum(r.length for r in out) // 4096)


def test_empty(make_docs):
    assert P.pack(P.pieces(make_docs([])).checkpoint()).collect() == []
