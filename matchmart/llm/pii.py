"""Personal data by rules and a conditional random field (operator 3).

Base spans come from four exact rules (email, ip, card, phone).  A linear-chain
conditional random field adds spans: its tokens are runs of letters, runs of
digits and single marks; its features are word shapes of the token and its
neighbours, the spaces around it, and whether a number is at most 255 or ends in
a right check digit; its labels say for each kind whether a
token begins, goes on with, or is outside a span.  It is trained on the driver
by gradient ascent on the exact conditional likelihood, from a small labelled
table of at most ``MAX_DOCS`` rows, and decoded by Viterbi in numpy batches.

All four kinds need a digit or an ``@``, so only tokens within ``CONTEXT``
tokens of such a token (or a ``+``) form the chains; the others are outside any
span.  Added spans that touch a base span are dropped, and so are those of a
kind whose marks they lack.

The query and the pipeline train on the hand-labelled texts of ``pii_labelled``,
which hold what the rules merge or refuse (cards side by side, a phone before an
ip) and forms outside them; nothing that the rules miss is taken as outside.

Edge cases: null texts are empty; rows are independent and never merged; the
rules run in time linear in the text, so very long texts and very long runs of
one character are safe; without labelled spans nothing is added.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm import pii_labelled
from matchmart.llm import textops as T

# The contract's kinds, in its order.
KINDS = ("email", "ip", "card", "phone")
MAX_DOCS = 400
CONTEXT = 6
STEPS = 120
LONGEST = 64  # tokens of a training chain

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_DIGITS = re.compile("[0-9]+")

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> list[Span]:
    out, at = [], 0
    while (mark := text.find("@", at)) >= 0:
        start = at + len(text[at:mark].rstrip(_LOCAL))
        found = _DOMAIN.match(text, mark + 1) if start < mark else None
        if found:
            out.append((0, start, found.end()))
        at = found.end() if found else mark + 1
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in m.group().split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


# ---- chains -----------------------------------------------------------------

_SHAPES = 64
_N_FEATURES = 9
_SIZE = 5 * _SHAPES + 4 * _SHAPES + 2 * _SHAPES * _SHAPES + 3
_LABELS = 1 + 2 * len(KINDS)  # outside; then begin and go on of each kind


def _shape(token: str) -> int:
    c = token[0]
    if "0" <= c <= "9":
        return min(len(token), 20)
    if c.isalpha():
        if len(token) == 1:
            return 26 if c.isupper() else 25
        return 21 if token.islower() else 22 if token.isupper() else 23 if token.istitle() else 24
    mark = string.punctuation.find(c)
    return 30 + mark if mark >= 0 else 62


def _number(digits: str) -> int:
    """1 for a number up to 255, 2 for 16 to 19 digits with a right check digit, else 0."""
    if len(digits) <= 3:
        return int(int(digits) <= 255)
    return 2 * int(16 <= len(digits) <= 19 and _luhn(digits))


class Chains:
    """Chains of tokens of some texts: spans, and feature numbers of each token.

    With ``longest``, longer chains are cut (for training only).
    """

    def __init__(self, texts: Sequence[tuple[int, str]], longest: int | None = None):
        rows, starts, ends, features, lengths = [], [], [], [], []
        for row, text in texts:
            spans = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
            if not spans:
                continue
            a, b = np.array(spans).T
            shape = np.array([_shape(text[i:j]) for i, j in spans])
            trigger = ((shape > 0) & (shape <= 20)) | (shape == _shape("@")) | (shape == _shape("+"))
            if not trigger.any():
                continue
            near = np.convolve(trigger, np.ones(2 * CONTEXT + 1), "same") > 0 if len(shape) > 2 * CONTEXT else np.ones(
                len(shape), bool)
            padded = np.concatenate([[0, 0], shape, [0, 0]])
            spaced = np.concatenate([[1], a[1:] > b[:-1], [1]])
            number = np.array([_number(text[i:j]) if 0 < s <= 20 else 0 for s, (i, j) in zip(shape, spans)])
            prev2, prev, nxt, nxt2 = padded[:-4], padded[1:-3], padded[3:-1], padded[4:]
            f = np.stack([shape, 64 + prev, 128 + nxt, 192 + prev2, 256 + nxt2,
                          320 + 4 * shape + 2 * spaced[:-1] + spaced[1:],
                          576 + 64 * prev + shape, 576 + 4096 + 64 * shape + nxt, 576 + 8192 + number], axis=1)
            edge = np.diff(np.concatenate([[0], near.astype(np.int8), [0]]))
            runs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
            for i, j in ((k, min(j, k + (longest or j))) for i, j in runs for k in range(i, j, longest or j - i)):
                lengths.append(j - i)
                rows.append(np.full(j - i, row))
                starts.append(a[i:j])
                ends.append(b[i:j])
                features.append(f[i:j])
        none = np.zeros(0, np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.row, self.start, self.end = (np.concatenate(x) if x else none for x in (rows, starts, ends))
        self.features = np.concatenate(features) if features else np.zeros((0, _N_FEATURES), np.int64)

    def batches(self, cells: int = 100_000):
        """(token numbers, real) of chains of about equal length, padded to the longest of each batch."""
        order = np.argsort(self.lengths, kind="stable")
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and self.lengths[order[j]] * (j + 1 - i) <= cells:
                j += 1
            own = order[i:j]
            step = np.arange(self.lengths[own[-1]])
            real = step < self.lengths[own][:, None]
            yield np.where(real, self.first[own][:, None] + step, 0), real
            i = j


class Field:
    """Weights of the conditional random field."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def _scores(self, features: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.emit[features[at]].sum(2)

    def decode(self, chains: Chains) -> np.ndarray:
        """The best label of each token (Viterbi)."""
        labels = np.zeros(len(chains.row), np.int8)
        for at, real in chains.batches():
            score = self._scores(chains.features, at)
            steps = at.shape[1]
            best = score[:, 0] + self.move[0]  # a chain begins as if after a token outside
            back = np.zeros((steps, len(at), _LABELS), np.int8)
            for t in range(1, steps):
                options = best[:, :, None] + self.move
                back[t] = options.argmax(1)
                ahead = options.max(1) + score[:, t]
                go = real[:, t, None]
                back[t] = np.where(go, back[t], np.arange(_LABELS))
                best = np.where(go, ahead, best)
            label = best.argmax(1)
            rows = np.arange(len(at))
            for t in range(steps - 1, -1, -1):
                own = real[:, t]
                labels[at[own, t]] = label[own]
                label = back[t][rows, label]
        return labels

    def gradient(self, chains: Chains, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the gold labels, and its gradients."""
        value, d_emit, d_move = 0.0, np.zeros_like(self.emit), np.zeros_like(self.move)
        for at, real in chains.batches():
            n, steps = at.shape
            score = self._scores(chains.features, at)
            y = gold[at]
            ahead = np.zeros((steps, n, _LABELS))
            ahead[0] = score[:, 0] + self.move[0]
            for t in range(1, steps):
                new = _log_sum(ahead[t - 1][:, :, None] + self.move, 1) + score[:, t]
                ahead[t] = np.where(real[:, t, None], new, ahead[t - 1])
            total = _log_sum(ahead[-1], 1)
            after = np.zeros((n, _LABELS))
            for t in range(steps - 1, -1, -1):
                own = real[:, t, None]
                p = np.exp(ahead[t] + after - total[:, None]) * own
                p[np.arange(n), y[:, t]] -= real[:, t]
                flat = chains.features[at[:, t]].reshape(-1)
                np.add.at(d_emit, flat, -np.repeat(p, _N_FEATURES, 0))
                if t:
                    both = ahead[t - 1][:, :, None] + self.move + (score[:, t] + after)[:, None, :] - total[:, None, None]
                    d_move -= (np.exp(both) * own[:, :, None]).sum(0)
                    np.add.at(d_move, (y[:, t - 1][real[:, t]], y[:, t][real[:, t]]), 1)
                    before = _log_sum(self.move + (score[:, t] + after)[:, None, :], 2)
                    after = np.where(own, before, after)
                else:
                    d_move[0] -= (np.exp(ahead[0] + after - total[:, None])).sum(0)
                    np.add.at(d_move[0], y[:, 0], 1)
            gold_score = np.take_along_axis(score, y[:, :, None], 2)[:, :, 0]
            gold_move = np.concatenate([self.move[0][y[:, :1]], self.move[y[:, :-1], y[:, 1:]]], 1)
            value += ((gold_score + gold_move) * real).sum() - total.sum()
        return value, d_emit, d_move


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def gold_labels(chains: Chains, spans: dict[int, list[Span]]) -> np.ndarray:
    labels = np.zeros(len(chains.row), np.int64)
    for row, own in spans.items():
        tokens = np.flatnonzero(chains.row == row)
        for kind, start, end in own:
            inside = tokens[(chains.start[tokens] >= start) & (chains.end[tokens] <= end)]
            labels[inside] = 2 + 2 * kind
            labels[inside[:1]] = 1 + 2 * kind
    return labels


def train(rows: Sequence[tuple[str, list[Span]]], ridge: float = 0.01, rate: float = 0.2) -> Field:
    """A field from labelled texts (text, spans), by Adam on the penalised likelihood."""
    field = Field(np.zeros((_SIZE, _LABELS)), np.zeros((_LABELS, _LABELS)))
    chains = Chains([(i, text) for i, (text, _) in enumerate(rows)], LONGEST)
    if not len(chains.row) or not any(spans for _, spans in rows):
        field.emit[:, 0] = 1.0
        return field
    gold = gold_labels(chains, {i: spans for i, (_, spans) in enumerate(rows)})
    # A span goes on only after its own begin or going on; nothing else may precede.
    for kind in range(len(KINDS)):
        before = np.ones(_LABELS, bool)
        before[[1 + 2 * kind, 2 + 2 * kind]] = False
        field.move[before, 2 + 2 * kind] = -30.0
    free = field.move > -30
    state = [(np.zeros_like(w), np.zeros_like(w)) for w in (field.emit, field.move)]
    for t in range(1, STEPS + 1):
        _, d_emit, d_move = field.gradient(chains, gold)
        for w, d, (m, v), ok in ((field.emit, d_emit, state[0], True), (field.move, d_move, state[1], free)):
            d = (d - ridge * w) * ok
            m *= 0.9
            m += 0.1 * d
            v *= 0.99
            v += 0.01 * d * d
            w += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) * ok
    return field


def added_spans(texts: Sequence[tuple[int, str]], base: dict[int, list[Span]], field: Field) -> dict[int, list[Span]]:
    """For each row the spans of the field that touch no base span."""
    chains = Chains(texts)
    labels = field.decode(chains)
    chain = np.repeat(np.arange(len(chains.lengths)), chains.lengths)
    begin = (labels % 2 == 1)
    out: dict[int, list[Span]] = {}
    by_row = dict(texts)
    for i in np.flatnonzero(begin):
        j = i + 1
        while j < len(labels) and chain[j] == chain[i] and labels[j] == labels[i] + 1:
            j += 1
        kind, row = int(labels[i]) // 2, int(chains.row[i])
        start, end = int(chains.start[i]), int(chains.end[j - 1])
        found = by_row[row][start:end]
        if (("@" in found) if kind == 0 else sum(map(len, _DIGITS.findall(found))) >= (4 if kind == 1 else 7)) and not any(
                s < end and start < e for _, s, e in base.get(row, [])):
            out.setdefault(row, []).append((kind, start, end))
    return out


# ---- tables -----------------------------------------------------------------

_TRIGGER = np.zeros(256, bool)
_TRIGGER[[*b"0123456789@+"]] = True
_FOUND = "array<struct<kind: int, start: int, end: int, base: boolean>>"


def _joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _some_texts(column: pa.Array):
    """(first row, row count, [(row, text)]) of each chunk, for the rows that can hold a span."""
    data, off = T.utf8(column)
    for lo, hi in T.row_chunks(off):
        own = off[lo:hi + 1]
        hit = np.flatnonzero(_TRIGGER[data[own[0]:own[-1]]]) + own[0]
        rows = np.unique(np.searchsorted(own, hit, "right") - 1)
        yield lo, hi - lo, [(int(i), data[own[i]:own[i + 1]].tobytes().decode("utf-8")) for i in rows]


def _find(field: Field):
    def run(batches):
        for batch in batches:
            for lo, n, texts in _some_texts(batch.column("text")):
                base = {i: base_spans(t) for i, t in texts}
                more = added_spans(texts, base, field)
                spans = [[{"kind": k, "start": a, "end": b, "base": own} for k, a, b, own in sorted(
                    [(*s, True) for s in base.get(i, [])] + [(*s, False) for s in more.get(i, [])])] for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(lo, n), pa.array(spans, pa.list_(pa.struct(
                        [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])))],
                    names=["doc", "spans"])
    return run


def spans_of(docs: DataFrame, field: Field) -> DataFrame:
    """Each row's other columns as a struct ``doc``, with its ``spans`` (kind number, start, end, base) by kind, then start."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text")
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_find(field), f"doc {kind}, spans {_FOUND}")


def labelled_by_hand(spark: SparkSession) -> DataFrame:
    """The labelled table (text, spans) that comes with the package."""
    return spark.createDataFrame(pii_labelled.rows(), "text string, spans string")


def _parsed(spans: str) -> list[Span]:
    return [(KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in spans.split(",") if x)]


def train_table(labelled: DataFrame, limit: int = MAX_DOCS) -> Field:
    """A field from a small table (text, spans as ``kind:start:end``, comma-joined)."""
    rows = labelled.where("text is not null").select("text", "spans").limit(limit).collect()
    rows.sort()  # the order of arrival must not change the weights
    return train([(r["text"], _parsed(r["spans"] or "")) for r in rows])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, and ``n_chars`` (if there) counted again."""
    def run(batches):
        for batch in batches:
            old = batch.column("text")
            new = old.to_pylist()
            for lo, n, texts in _some_texts(old):
                base = {i: base_spans(t) for i, t in texts}
                more = added_spans(texts, base, field)
                for i, t in texts:
                    parts, at = [], 0
                    for start, end, kind in sorted((a, b, k) for k, a, b in base[i] + more.get(i, [])):
                        if start >= at:
                            parts += [t[at:start], f"[{KINDS[kind]}]"]
                        at = max(at, end)
                    if parts:
                        new[lo + i] = "".join(parts) + t[at:]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a field trained on the hand-labelled texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    field = train_table(labelled_by_hand(spark))
    found = spans_of(docs, field)
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
