"""Personal data by boosted trees over candidate spans.

High-recall generators propose overlapping spans of four kinds; format and context features describe them; gradient boosted
trees, trained here on a bounded sample of documents (``TRAIN_DOCS``), give a score that a logistic curve on held-out
candidates turns into a probability; candidates at ``THRESHOLD`` or more are personal data. Spans that satisfy
the strict rules of a kind (``base_spans``) always are.

The strict rules also label the training candidates: a candidate that a strict span covers, or an address that ends in one, is
positive; one that touches a strict span of another kind or breaks a hard rule (a part over 255, a failed checksum, a domain without
a dot, digits glued to letters) is negative; and what is neither isn't trained on. Positive addresses also train in the
forms the strict rule doesn't know (``_variants``). The model decides about every candidate that
isn't part of a strict span of its kind, also where it extends one or crosses one of another kind.

Defined results: a NULL or empty text has no spans; without both classes in the sample only strict spans are found; overlapping
accepted spans are all reported and redacted as one, under the first one's kind; repeated rows are treated one by one; an empty
table gives no rows; other columns pass through ``redacted`` unchanged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from caseflow.llm.common import batches

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 20_000
THRESHOLD = 0.9
TREES, DEPTH, RATE, LEAF = 60, 3, 0.2, 8
Span = tuple[str, int, int]
# fixed values: the strict form of each kind
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
# generators: wider forms of each kind
_WIDE = {
    "email": re.compile(r"[^\s@<>()\[\],;:]{1,64}(?:@|\s?[\[(]at[\])]\s?)[^\s@<>()\[\],;:]{1,255}", re.I),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,6}(?:\s?\.\s?[0-9]{1,6}){3}(?![\w])|(?<![\w:])(?:[0-9a-fA-F]{1,4}:){4,7}[0-9a-fA-F]{1,4}(?![\w:])"),
    "card": re.compile(r"(?<!\w)[0-9](?:[ .\-/]?[0-9]){12,22}(?!\w)"),
    "phone": re.compile(r"(?<!\w)(?:\+|00)?\(?[0-9](?:[ ().\-/]{0,2}[0-9]){6,16}(?!\w)"),
}
_AT = re.compile(r"[\[(]at[\])]", re.I)
_EDGE = ".!?\"'`*_~|/\\-"  # not part of an address at its ends
_HINT = {
    "email": re.compile(r"mail|contact|correo|kontakt|courriel", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse", re.I),
    "card": re.compile(r"card|visa|carte|karte|tarjeta|credit", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobil|anruf|llam", re.I),
}


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str | None) -> list[Span]:
    """Spans of the strict forms, by kind as listed, then start."""
    out: list[Span] = []
    if not text:
        return out
    if "@" in text:
        out += [("email", *m.span()) for m in _EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def candidates(text: str | None) -> list[Span]:
    """Overlapping spans the generators propose."""
    if not text:
        return []
    out: list[Span] = []
    if "@" in text or _AT.search(text):
        for m in _WIDE["email"].finditer(text):
            own = m[0]
            out.append(("email", m.start() + len(own) - len(own.lstrip(_EDGE)), m.end() - len(own) + len(own.rstrip(_EDGE))))
    if _DIGIT.search(text):
        out += [(kind, *m.span()) for kind in ("ip", "card", "phone") for m in _WIDE[kind].finditer(text)]
    return out


def features(text: str, span: Span, strict: list[Span]) -> list[float]:
    """Format of the span, and its surroundings; among them, strict spans of another kind that it touches."""
    kind, start, end = span
    own, before, after = text[start:end], text[start - 1:start], text[end:end + 1]
    digits = _NOT_DIGIT.sub("", own)
    groups = re.findall(r"[0-9]+", own)
    sizes = [len(g) for g in groups] or [0]
    tail = own.rpartition("@")[2]
    context = text[max(0, start - 24):start]
    return [
        *(float(kind == k) for k in KINDS), float(len(own)), float(len(digits)), float(len(groups)), float(max(sizes)),
        float(min(sizes)), float(sum(map(str.isalpha, own))), float(own.count(".")), float(own.count("-")),
        float(own.count(" ")), float(own.count(":")), float(own.count("(")), float(own[:1] == "+"), float(own[:2] == "00"),
        float(tail.count(".")), float(len(tail.rpartition(".")[2])), float(sum(_small(g) for g in groups)),
        float(12 < len(digits) < 20 and luhn(digits)), float(own.isascii()), float(before.isspace() or not before),
        float(after.isspace() or not after), float(before.isalnum()), float(after.isalnum()),
        float(bool(_HINT[kind].search(context))), float(len(set(digits))),
        float(any(k != kind and min(end, b) > max(start, a) for k, a, b in strict))]


def weak_label(text: str, span: Span, strict: list[Span]) -> int | None:
    """1: a strict span of the kind covers most of it, or is the end of an address; 0: it breaks a hard rule; None: unknown."""
    kind, start, end = span
    if any(k == kind and 5 * (min(end, b) - max(start, a)) >= 4 * (end - start) for k, a, b in strict):
        return 1
    if kind == "email" and any(k == kind and start <= a and b == end for k, a, b in strict):
        return 1
    if any(min(end, b) > max(start, a) for k, a, b in strict if k != kind):
        return 0
    own = text[start:end]
    digits = _NOT_DIGIT.sub("", own)
    if kind == "email":
        broken = "." not in own.rpartition("@")[2].strip(".")
    elif kind == "ip":
        broken = ":" not in own and not all(map(_small, re.findall(r"[0-9]+", own)))
    elif kind == "card":
        broken = not 15 <= len(digits) <= 19 or not luhn(digits)
    else:
        broken = not 8 <= len(digits) <= 15 or own.count("(") != own.count(")") or own.isdigit()
    return 0 if broken else None


class Boosted:
    """Gradient boosted regression trees for the logistic loss, with a calibrating curve on top."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        fit = np.arange(len(y)) % 3 != 0  # the rest calibrates
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.05, 0.95, 15))) for j in range(x.shape[1])]
        share = np.clip(y[fit].mean(), 1e-3, 1 - 1e-3)
        self.start, self.trees = float(np.log(share / (1 - share))), []
        score = np.full(fit.sum(), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._tree(x[fit], y[fit] - p, p * (1 - p), DEPTH)
            self.trees.append(tree)
            score += RATE * self._value(tree, x[fit])
        self.curve = self._calibrate(self.raw(x[~fit]), y[~fit])

    def _tree(self, x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int):
        total_g, total_w = gradient.sum(), weight.sum()
        leaf = float(total_g / (total_w + 1.0))
        if depth == 0 or len(x) < 2 * LEAF:
            return leaf
        best = (1e-6, None, None)
        for j, cuts in enumerate(self.cuts):
            for cut in cuts:
                left = x[:, j] <= cut
                n = int(left.sum())
                if n < LEAF or len(x) - n < LEAF:
                    continue
                g, w = gradient[left].sum(), weight[left].sum()
                gain = g * g / (w + 1) + (total_g - g) ** 2 / (total_w - w + 1) - total_g ** 2 / (total_w + 1)
                if gain > best[0]:
                    best = (gain, j, cut)
        if best[1] is None:
            return leaf
        _, j, cut = best
        left = x[:, j] <= cut
        return (j, float(cut), self._tree(x[left], gradient[left], weight[left], depth - 1),
                self._tree(x[~left], gradient[~left], weight[~left], depth - 1))

    def _value(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, cut, low, high = tree
        return np.where(x[:, j] <= cut, self._value(low, x), self._value(high, x))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + RATE * sum(self._value(t, x) for t in self.trees)

    @staticmethod
    def _calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Slope and intercept of the curve; softened targets keep it finite on separable data."""
        high, low = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
        target, a, b = np.where(y > 0, high, low), 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-(a * score + b)))
            g = np.array([((target - p) * score).sum(), (target - p).sum()])
            w = p * (1 - p)
            h = np.array([[(w * score * score).sum(), (w * score).sum()], [(w * score).sum(), w.sum()]]) + 1e-6 * np.eye(2)
            step = np.linalg.solve(h, g)
            a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
            if np.abs(step).max() < 1e-8:
                break
        return a, b

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-(a * self.raw(x) + b)))


def _variants(text: str, span: Span) -> Iterator[tuple[str, Span]]:
    """A labelled address as people also write it: with a letter beyond ASCII, and with the sign spelled out."""
    kind, start, end = span
    name, _, domain = text[start:end].rpartition("@")
    if kind == "email" and name:
        for own in (f"{name}\u00fc{name[:1]}@{domain}", f"{name}(at){domain}", f"{name} [at] {domain}"):
            yield text[:start] + own + text[end:], (kind, start, start + len(own))


def _examples(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        x, y = [], []
        for text in batch.column("text").to_pylist():
            strict = base_spans(text)
            for span in candidates(text):
                label = weak_label(text, span, strict)
                if label is not None:
                    x.append(features(text, span, strict))
                    y.append(label)
                for other, own in _variants(text, span) if label else ():
                    near = slice(max(0, own[1] - 300), own[2] + 300)  # strict spans around it
                    moved = [(k, a + near.start, b + near.start) for k, a, b in base_spans(other[near])]
                    x.append(features(other, own, moved))
                    y.append(1)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32())], names=["x", "y"])


def train(docs: DataFrame) -> Boosted | None:
    """The model of a bounded sample: the documents with the smallest hash of their text and id."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    rows = sample.orderBy("doc_id").select("text").mapInArrow(_examples, "x array<double>, y int").collect()
    y = np.array([r["y"] for r in rows], dtype=float)
    if not 0 < y.sum() < len(y) or len(y) < 6 * LEAF:
        return None
    order = np.random.default_rng(3).permutation(len(y))
    return Boosted(np.array([r["x"] for r in rows])[order], y[order])


def accepted(texts: list[str | None], model: Boosted | None, threshold: float = THRESHOLD) -> list[tuple[list[Span], list[Span]]]:
    """Per text: strict spans, and all spans (strict ones and accepted candidates).

    A candidate equal to or inside a strict span of its kind says nothing new; all others, whatever they extend or cross,
    are the model's to judge.
    """
    strict = [base_spans(t) for t in texts]
    open_spans = [
        (i, span) for i, t in enumerate(texts) for span in dict.fromkeys(candidates(t) if model else ())
        if not any(k == span[0] and a <= span[1] and span[2] <= b for k, a, b in strict[i])]
    added: dict[int, list[Span]] = {}
    if open_spans:
        chance = model.probability(np.array([features(texts[i], span, strict[i]) for i, span in open_spans]))
        for (i, span), p in zip(open_spans, chance):
            if p >= threshold:
                added.setdefault(i, []).append(span)
    order = {k: n for n, k in enumerate(KINDS)}
    return [(own, sorted([*own, *added.get(i, ())], key=lambda s: (order[s[0]], s[1], s[2]))) for i, own in enumerate(strict)]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def found(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, a count per kind of strict span, their digest, and all spans."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            spans = accepted(batch.column("text").to_pylist(), model.value)
            counts = [pa.array([sum(k == kind for k, _, _ in own) for own, _ in spans], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(listed(own).encode()).hexdigest() for own, _ in spans]),
                 pa.array([listed(every) for _, every in spans], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its first kind."""
    out, last, open_to = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= open_to:
            out += [text[last:start], f"[{kind.upper()}]"]
        open_to = last = max(open_to, end)
    return "".join([*out, text[last:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced by its kind; ``n_chars`` follows where the text changed."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    schema = to_arrow_schema(docs.schema)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = batch.column("text").to_pylist()
            every = [spans for _, spans in accepted(texts, model.value)]
            new = [masked(t, s) if s else t for t, s in zip(texts, every)]
            columns = {name: batch.column(name) for name in schema.names}
            columns["text"] = pa.array(new, type=schema.field("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(
                    [len(t) if s else n for t, s, n in zip(new, every, batch.column("n_chars").to_pylist())],
                    type=schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in schema.names], schema=schema)

    return docs.mapInArrow(run, docs.schema)
