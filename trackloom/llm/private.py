"""Personal data by a skip-chain conditional random field.

Four patterns give the base spans; they always stay. The field adds what the patterns miss: its nodes are the words with a
digit or an ``@``, all other words count as clean. A node's own potential depends on its shape, neighbouring nodes are
linked in a chain, and a node is linked with the last one before it, however far away, that is the same or shares its first
or its second half. Loopy belief propagation runs over the nodes of a batch of documents at once; words inside base
spans are fixed to their kind. A word whose marginal for a kind reaches ``CERTAIN`` is added.

The potentials are log ratios of counts over all documents, with the base spans as labels: one aggregate over shapes and
pairs of labels. A shape is the first 40 signs of what a word looks like, so longer ones that begin alike share a potential.

Every pattern starts a match at the first sign of a run only, or at an ``@`` or a plus, and gives nothing back where that
can't help. So a text costs time in proportion to its length, whatever is in it.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
#: From the ``@`` on; what stands before it is taken from the left of it, back to the end of the last address.
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_ANY = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_PLAIN = re.compile(r"[^a-z0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")
#: A marginal from which a word is added, rounds of belief propagation, weight of the messages before.
CERTAIN, ROUNDS, DAMPING = 0.95, 12, 0.3
#: Occurrences by which the share of a kind in a shape is shrunk towards clean.
SHRINK = 20.0
_LABELS = len(KINDS) + 1
_EDGE = ".,;:!?\"'“”‘’[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        digits = _NOT_DIGIT.sub("", text)
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(_NOT_DIGIT.sub("", text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: of each ``@`` with a host behind it, the signs before it that no address has."""
    free = seen = 0
    for m in _HOST.finditer(text):
        before = text[max(free, seen) : m.start()]
        own = len(before) - len(before.rstrip(_LOCAL))
        seen = m.start() + 1
        if own:
            free = m.end()
            yield m.start() - own, free


def _matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        return _emails(text)
    return (m.span() for m in _PATTERNS[kind].finditer(text) if _valid(kind, m.group()))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), ordered; leftmost matches of each pattern, without those that fail its check."""
    if not _ANY.search(text):
        return []
    at, plus = "@" in text, "+" in text
    digit = _DIGIT.search(text) is not None
    out = []
    for k, kind in enumerate(KINDS):
        if at if kind == "email" else digit and (kind != "phone" or plus):
            out += [(k, a, b) for a, b in _matches(kind, text)]
    return out


def shape_of(word: str) -> str:
    """What a word looks like: runs of letters, digits with their number, marks; and whether a number checks out."""
    core = word.strip(_EDGE)
    shape = re.sub(r"[^\W\d_]+", "a", core)
    shape = re.sub(r"[0-9]+", lambda m: f"{min(len(m.group()), 20)}d", shape)[:40]
    digits = _NOT_DIGIT.sub("", core)
    if 12 <= len(digits) <= 24:
        shape += "+" if luhn(digits) else "-"
    if core.count(".") == 3 and not _valid("ip", core if re.fullmatch(r"[0-9.]+", core) and ".." not in core and core[0] != "." != core[-1] else "999"):
        shape += "-"
    return shape


class Field:
    """The nodes of some texts: document, span, shape, label from the base (0: none), and the links between them."""

    def __init__(self, texts: list[str | None]):
        self.base: list[list[tuple[int, int, int]]] = []
        doc, start, end, shape, label = [], [], [], [], []
        chain, skip = [], []
        for i, text in enumerate(texts):
            spans = base_spans(text) if text else []
            self.base.append(spans)
            if not text or not _ANY.search(text):
                continue
            # spans of a kind are in order and don't overlap: each list is walked once, along with the words
            of_kind = [[s for s in spans if s[0] == k] for k in range(len(KINDS))]
            at = [0] * len(KINDS)
            before: dict[str, int] = {}
            previous = -1
            for m in _WORD.finditer(text):
                node = len(doc)
                a, b = m.start(), m.end()
                word = m.group()
                touching = []
                for k, own in enumerate(of_kind) if spans else ():
                    while at[k] < len(own) and own[at[k]][2] <= a:
                        at[k] += 1
                    if at[k] < len(own) and own[at[k]][1] < b:
                        touching.append((own[at[k]][1], k))
                inside = min(touching)[1] + 1 if touching else 0
                lead, tail = len(word) - len(word.lstrip(_EDGE)), len(word) - len(word.rstrip(_EDGE))
                doc.append(i)
                start.append(a + (lead if lead < len(word) else 0))
                end.append(b - (tail if lead < len(word) else 0))
                shape.append(shape_of(word))
                label.append(inside)
                if previous >= 0 and a - previous <= 1:
                    chain.append((node - 1, node))
                previous = b
                plain = _PLAIN.sub("", word.lower())
                names = [f"={plain}"] + ([f"<{plain[: len(plain) // 2]}", f">{plain[len(plain) // 2 :]}"] if len(plain) >= 7 else [])
                for name in {before[n] for n in names if n in before} if len(plain) >= 3 else ():
                    skip.append((name, node))
                for n in names:
                    before[n] = node
        self.doc, self.start, self.end, self.shape = np.array(doc, np.int64), np.array(start, np.int64), np.array(end, np.int64), shape
        self.label = np.array(label, np.int64)
        self.chain, self.skip = np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a shape has a label, and how often linked nodes have two."""
    for batch in slices(batches):
        field = Field(batch.column("text").to_pylist())
        rows: dict[tuple[str, int, int], int] = {}
        for s, y in zip(field.shape, field.label.tolist(), strict=True):
            rows[s, y, 0] = rows.get((s, y, 0), 0) + 1
        for name, links in (("\tchain", field.chain), ("\tskip", field.skip)):
            for a, b in zip(*(field.label[links[:, i]].tolist() for i in (0, 1)), strict=True):
                rows[name, a, b] = rows.get((name, a, b), 0) + 1
        if rows:
            s, a, b = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(rows.values()), pa.int64())], ["shape", "a", "b", "n"])


class Potentials:
    def __init__(self, counts: list[tuple[str, int, int, int]]):
        links = {"\tchain": np.ones((_LABELS, _LABELS)), "\tskip": np.ones((_LABELS, _LABELS))}
        shapes: dict[str, np.ndarray] = {}
        for shape, a, b, n in counts:
            if shape in links:
                links[shape][a, b] += n
            else:
                shapes.setdefault(shape, np.zeros(_LABELS))[a] += n
        self.unknown = np.log(np.array([0.99] + [0.01 / len(KINDS)] * len(KINDS)))
        prior = np.exp(self.unknown)
        self.shapes = {s: np.log((n + SHRINK * prior) / (n.sum() + SHRINK)) for s, n in shapes.items() if n[1:].any()}
        self.pairs = []
        for n in (links["\tchain"], links["\tskip"]):
            n = n + n.T  # a link has no direction
            p = n / n.sum()
            self.pairs.append(np.clip(np.log(p / np.outer(p.sum(1), p.sum(0))), -3, 3))


def learn(docs: DataFrame) -> Potentials:
    """Counts over all documents. Shapes that are never part of a base span are not collected: they are clean."""
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_counts, "shape string, a int, b int, n long").groupBy("shape", "a", "b").agg(F.sum("n").alias("n"))
    private = counts.where("a > 0 or shape in ('\tchain', '\tskip')")
    # shapes have 40 signs of a small alphabet and numbers up to 20, and must stand in a base span
    shapes = private.select("shape").distinct()
    return Potentials([tuple(r) for r in counts.join(shapes, "shape", "left_semi").collect()])


def marginals(field: Field, model: Potentials) -> np.ndarray:
    """Probabilities of the labels of each node, by loopy belief propagation."""
    n = len(field.label)
    own = np.stack([model.shapes.get(s, model.unknown) for s in field.shape]) if n else np.zeros((0, _LABELS))
    fixed = np.flatnonzero(field.label)
    own[fixed] = -50.0
    own[fixed, field.label[fixed]] = 0.0
    a = np.concatenate((field.chain[:, 0], field.chain[:, 1], field.skip[:, 0], field.skip[:, 1]))
    b = np.concatenate((field.chain[:, 1], field.chain[:, 0], field.skip[:, 1], field.skip[:, 0]))
    c, s = len(field.chain), len(field.skip)
    pair = np.concatenate((np.repeat(model.pairs[0][None], 2 * c, axis=0), np.repeat(model.pairs[1][None], 2 * s, axis=0)))
    back = np.concatenate((np.arange(c) + c, np.arange(c), 2 * c + s + np.arange(s), 2 * c + np.arange(s)))
    messages = np.zeros((len(a), _LABELS))
    for _ in range(ROUNDS if len(a) else 0):
        belief = own.copy()
        np.add.at(belief, b, messages)
        sent = (belief[a] - messages[back])[:, :, None] + pair
        top = sent.max(axis=1)
        sent = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
        sent -= sent.max(axis=1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * sent
    belief = own.copy()
    np.add.at(belief, b, messages)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True)) if n else belief
    return belief / np.maximum(belief.sum(axis=1, keepdims=True), 1e-12)


def find(texts: list[str | None], model: Potentials) -> list[tuple[list, list]]:
    """Per text the base spans and all spans, each (kind, start, end) and ordered."""
    field = Field(texts)
    p = marginals(field, model)
    best = p[:, 1:].argmax(axis=1) if len(p) else np.zeros(0, np.int64)
    sure = (p[np.arange(len(p)), best + 1] >= CERTAIN) & (field.label == 0)
    added: dict[int, list] = {}
    last = None
    for i in np.flatnonzero(sure).tolist():
        doc, kind, a, b = int(field.doc[i]), int(best[i]), int(field.start[i]), int(field.end[i])
        spans = added.setdefault(doc, [])
        if last == i - 1 and spans and spans[-1][0] == kind and texts[doc][spans[-1][2] : a].strip(" ().,-") == "" and a - spans[-1][2] <= 3:
            spans[-1] = (kind, spans[-1][1], b)  # one number in several words
        else:
            spans.append((kind, a, b))
        last = i
    return [(base, sorted(base + added[i]) if i in added else base) for i, base in enumerate(field.base)]


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def private_spans(docs: DataFrame, model: Potentials | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256 and spans (all), one row per input row.

    A null or empty text has none. Repeated rows and repeated or null doc_ids come back as they are. Columns besides doc_id
    and text are left out, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def run(batches):
        for batch in slices(batches):
            found = find(batch.column("text").to_pylist(), shared.value)
            n = [[sum(s[0] == k for s in base) for base, _ in found] for k in range(len(KINDS))]
            sha = [hashlib.sha256(spans_text(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in n], pa.array(sha), pa.array([spans_text(all_) for _, all_ in found])], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by the name of its kind in angle brackets; of overlapping ones the first stands."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind].upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def mask_private(docs: DataFrame, model: Potentials | None = None) -> DataFrame:
    """The documents with all their columns and personal data masked; ``n_chars`` follows the text if there is one."""
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def run(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            out = [masked(t, spans) if spans else t for t, (_, spans) in zip(texts, find(texts, shared.value), strict=True)]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, batch.column("text").type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
