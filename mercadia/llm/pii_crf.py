"""Personal data by rules and a skip-chain conditional random field.

The rules find emails, IPv4 addresses, card and phone numbers. What looks alike but
falls through them (a card number run together with digits before it, a phone number
without its plus) is left to the random field: its nodes are a document's rule
spans and look-alikes, its edges join neighbours in the text (the chain) and, at any
distance, mentions with equal or similar characters (the skips). Loopy belief
propagation spreads the rule spans' labels along the edges, so that one entity gets
one label throughout a document. Look-alikes whose belief in a label exceeds one
half become spans too.

Weights are log-ratios of counts (piecewise training): of shape and label of nodes,
and of the labels at both ends of each kind of edge, over all documents.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import id_text, slices

# The kinds in the order of the results, and the rules' patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

OTHER = len(KINDS)  # label of what is no personal data
#: Least digits of a look-alike; most of one that is not looked into by its parts: by words,
#: and by groups of digits that other mentions of the document have too.
LEAST_DIGITS, MOST_DIGITS = 7, 19
#: Pull of the rules' refusal on a look-alike. Bounds of the weights: shape and two neighbours
#: alone make up for the refusal at most; a skip edge to a rule span makes up for both.
REFUSED, MOST = -6.0, {"node": 4.0, "chain": 0.5, "same": 12.0, "similar": 12.0}
#: Counts before any are seen: of a label, and of equal and unequal labels at a skip's ends.
PRIOR, PRIOR_SAME, PRIOR_OTHER = 0.5, 20.0, 0.0002
#: Weight of what cannot be, whatever the neighbours say, however many.
NEVER = -1e9
#: Messages run until they settle; a field that never does is stopped after as many rounds as it
#: has nodes (a message has crossed it by then), ROUNDS at least.
ROUNDS, DAMPING, SETTLED = 40, 0.3, 1e-4

_AT_WORD = re.compile(r"[^\s@]+@[^\s@]+")
_NUMBER_RUN = re.compile(r"[+(]?[0-9][0-9 ().+-]*[0-9]")
_GROUP = re.compile(r"[0-9]+")
_NUMBER_WORD = re.compile(r"[0-9][0-9().+-]*[0-9]")
_HINT = re.compile(r"[0-9@]")


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    kind: int | None  # of a rule span; None: a look-alike
    shape: str
    key: str


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(filter(str.isdecimal, text))


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of LOCAL@DOMAIN, from one @ to the next, in linear time."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1, start):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1  # no match can go across this @
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind by the rules: leftmost, non-overlapping within the kind."""
    if not _HINT.search(text):
        return [[] for _ in KINDS]
    emails = _emails(text)
    ips = [m.span() for m in IP.finditer(text) if all(len(p) < 4 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
    cards = [m.span() for m in CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return [emails, ips, cards, phones]


def _shape(text: str) -> str:
    if "@" in text:
        return "@"
    n = len(_digits(text))
    return f"{n if n < 20 else 20}|{text.count('.') if text.count('.') < 4 else 4}|{'+' in text:d}{'(' in text:d}{' ' in text:d}{'-' in text:d}"


def _parts(text: str, start: int, end: int, known: set[str], ends: set[str]) -> list[tuple[int, int]]:
    """Consecutive groups of digits of a number run that equal a known number or end as one
    does (``ends``: their last digits, LEAST_DIGITS or more), apart from each other: equal
    ones first, then those that agree longest. A group counts if most of its digits agree.
    As known numbers are short, linear in the run but for the sorting of what is found."""
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    digits = "".join(text[a:b] for a, b in groups)
    first, at = [], 0  # of each group, its first digit's place
    for a, b in groups:
        first.append(at)
        at += b - a
    found = []
    for i, stop in enumerate([*first[1:], at] if groups else []):
        n = LEAST_DIGITS
        if stop < n or digits[stop - n:stop] not in ends:
            continue
        while n < stop and digits[stop - n - 1:stop] in ends:
            n += 1
        j = bisect_right(first, stop - n) - 1
        if 2 * (first[j] + groups[j][1] - groups[j][0] - (stop - n)) <= groups[j][1] - groups[j][0]:
            j += 1
        if j <= i and stop - first[j] >= LEAST_DIGITS:
            found.append((digits[first[j]:stop] not in known, -n, groups[j][0], groups[i][1]))
    return _apart([(a, b) for _, _, a, b in sorted(found)], [], among=True)


def _apart(spans: list[tuple[int, int]], others: list[tuple[int, int]], inside: bool = False, among: bool = False) -> list[tuple[int, int]]:
    """The spans that overlap none of ``others``, which lie apart themselves; ``inside``: that lie
    in none of them; ``among``: that overlap no span chosen before either."""
    taken = sorted(others)
    out = []
    for a, b in spans:
        i = bisect_right(taken, a, key=lambda t: t[0])
        before, after = taken[i - 1] if i else (0, 0), taken[i] if i < len(taken) else (b, b)
        if before[1] >= b if inside else before[1] > a or after[0] < b:
            continue
        out.append((a, b))
        if among:
            taken.insert(i, (a, b))
    return out


def mentions(text: str, base: list[list[tuple[int, int]]]) -> list[Mention]:
    """Rule spans and look-alikes in the order of their start; look-alikes overlap no rule span."""
    key = lambda s: s.lower() if "@" in s else _digits(s)
    out = [Mention(a, b, k, _shape(text[a:b]), key(text[a:b])) for k, spans in enumerate(base) for a, b in spans]
    if not _HINT.search(text):
        return out
    taken: list[tuple[int, int]] = []
    for a, b in sorted(s for spans in base for s in spans):
        if taken and a < taken[-1][1]:
            taken[-1] = taken[-1][0], max(b, taken[-1][1])
        else:
            taken.append((a, b))
    starts = [a for a, _ in taken]

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, a)
        return not (i and taken[i - 1][1] > a) and not (i < len(taken) and taken[i][0] < b)

    found = [m.span() for m in _AT_WORD.finditer(text)] if "@" in text else []
    known = {m.key for m in out if m.kind is not None and KINDS[m.kind] in ("card", "phone")}
    runs: list[tuple[int, int, list[tuple[int, int]]]] = []
    for m in _NUMBER_RUN.finditer(text):
        n = len(_digits(m[0]))
        if n < LEAST_DIGITS:
            continue
        if n <= MOST_DIGITS and free(*m.span()):
            found.append(m.span())
            known.add(_digits(m[0]))
        else:
            words = [w.span() for w in _NUMBER_WORD.finditer(text, m.start(), m.end()) if LEAST_DIGITS <= len(_digits(w[0])) <= MOST_DIGITS]
            known.update(_digits(text[a:b]) for a, b in words if free(a, b))
            runs.append((*m.span(), words))
    ends = {k[-n:] for k in known for n in range(LEAST_DIGITS, len(k) + 1)} if runs else set()
    for a, b, words in runs:
        parts = [p for p in _parts(text, a, b, known, ends) if free(*p)] if ends else []
        parts = _apart(parts, [w for w in words if free(*w)], inside=True)
        found += _apart(words, parts) + parts
    out += [Mention(a, b, None, _shape(text[a:b]), key(text[a:b])) for a, b in found if free(a, b)]
    return sorted(out, key=lambda m: (m.start, m.end, -1 if m.kind is None else m.kind))


def edges(nodes: list[Mention]) -> dict[str, list[tuple[int, int]]]:
    """Pairs of nodes by kind of edge. chain: neighbours. same: one key; similar: numbers
    with one last LEAST_DIGITS digits, addresses with one local part. Mentions of one
    group are joined one to the next, and each to the group's first rule span of each kind,
    wherever that stands: edges grow with the mentions, and what the rules know is one
    step away from all of them."""
    out: dict[str, list[tuple[int, int]]] = {"chain": [(i, i + 1) for i in range(len(nodes) - 1)], "same": [], "similar": []}
    parts = [("similar", "@" in m.key, m.key.split("@")[0] if "@" in m.key else m.key[-LEAST_DIGITS:]) for m in nodes]
    known: dict[tuple, dict[int, int]] = {}
    for i, (m, part) in enumerate(zip(nodes, parts, strict=True)):
        if m.kind is not None:
            known.setdefault(part, {}).setdefault(m.kind, i)
    last: dict[tuple, int] = {}
    for i, (m, part) in enumerate(zip(nodes, parts, strict=True)):
        whole = "same", m.key
        if whole in last:
            out["same"].append((last[whole], i))
        elif part in last:
            out["similar"].append((last[part], i))
        joined = last.get(whole, last.get(part))
        for j in known.get(part, {}).values():
            if j != i and j != joined and m.kind is None:
                out["same" if nodes[j].key == m.key else "similar"].append((j, i))
        last[whole] = last[part] = i
    return out


def label_counts(nodes: list[Mention]) -> Counter:
    """Counts of (factor, feature, label[, label]) of a document under the rules' labels. Of a
    look-alike the rules say nothing: skip edges count between rule spans only."""
    y = [OTHER if m.kind is None else m.kind for m in nodes]
    n = Counter(("node", m.shape, k, -1) for m, k in zip(nodes, y, strict=True))
    for kind, pairs in edges(nodes).items():
        n.update(("edge", kind, y[i], y[j]) for i, j in pairs if kind == "chain" or OTHER not in (y[i], y[j]))
    return n


class Field:
    """Log-potentials of nodes by shape and of edges by kind."""

    def __init__(self, counts: dict[tuple, int]):
        labels = OTHER + 1
        self.node: dict[str, np.ndarray] = {}
        tables = {k: np.zeros((labels, labels)) for k in ("chain", "same", "similar")}
        for (factor, feature, a, b), n in counts.items():
            if factor == "node":
                self.node.setdefault(feature, np.zeros(labels))[a] += n
            else:
                tables[feature][a, b] += n
                tables[feature][b, a] += n
        for shape, n in self.node.items():
            w = np.clip(np.log((n + PRIOR) / (n[OTHER] + PRIOR)), -MOST["node"], MOST["node"])
            self.node[shape] = w + np.where(np.arange(labels) == OTHER, 0.0, REFUSED)
        self.edge = {}
        for kind, n in tables.items():
            if kind == "chain":
                n = n + PRIOR
                joint, one = n / n.sum(), n.sum(axis=1) / n.sum()
                w = np.log(joint / np.outer(one, one))
            else:  # how much more often both ends agree than not; the same for all labels, so that frequent ones don't pull less
                agree = np.trace(n)
                w = np.log((agree + PRIOR_SAME) / (n.sum() - agree + PRIOR_OTHER)) * np.eye(labels)
            self.edge[kind] = np.clip(w, -MOST[kind], MOST[kind])

    def _node(self, m: Mention) -> np.ndarray:
        if m.kind is not None:  # a rule span keeps its label
            w = np.full(OTHER + 1, NEVER)
            w[m.kind] = 0.0
            return w
        w = self.node.get(m.shape, np.where(np.arange(OTHER + 1) == OTHER, 0.0, REFUSED)).copy()
        for k, name in enumerate(KINDS):
            if (name == "email") != ("@" in m.key):
                w[k] = NEVER
        return w

    def beliefs(self, nodes: list[Mention]) -> np.ndarray:
        """Marginals (nodes x labels) by damped loopy sum-product message passing."""
        unary = np.array([self._node(m) for m in nodes])
        by_kind = edges(nodes)
        pairs = np.array([p for ps in by_kind.values() for p in ps], np.int64).reshape(-1, 2)
        if not len(pairs):
            return _normal(unary)
        table = np.concatenate([np.repeat(self.edge[k][None], len(ps), 0) for k, ps in by_kind.items() if ps])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        table = np.concatenate([table, table.transpose(0, 2, 1)])  # source label by target label
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        message = np.zeros((len(source), OTHER + 1))
        for _ in range(max(ROUNDS, len(nodes))):
            total = unary.copy()
            np.add.at(total, target, message)
            out = (total[source] - message[back])[:, :, None] + table
            top = out.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0]
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if moved < SETTLED:
                break
        total = unary.copy()
        np.add.at(total, target, message)
        return _normal(total)

    def added(self, nodes: list[Mention]) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the look-alikes that the field takes for personal data."""
        if all(m.kind is not None for m in nodes):
            return []
        p = self.beliefs(nodes)
        return [(int(k), m.start, m.end) for m, row in zip(nodes, p, strict=True)
                if m.kind is None and (k := row.argmax()) != OTHER and row[k] > 0.5]


def _normal(log: np.ndarray) -> np.ndarray:
    p = np.exp(log - log.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


_COUNTED = "factor string, feature string, a int, b int, n long"


def train_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Weights from all documents. Tasks sum their counts, whose keys are shapes and labels
    (some thousands at most), before Spark adds them up."""
    def count(batches):
        total: Counter = Counter()
        for part in slices(batches):
            for text in part.column(1).to_pylist():
                if _HINT.search(text):
                    total.update(label_counts(mentions(text, base_spans(text))))
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.array([k[2] for k in keys], pa.int32()), pa.array([k[3] for k in keys], pa.int32()),
                                          pa.array([total[k] for k in keys], pa.int64())], ["factor", "feature", "a", "b", "n"])
    rows = id_text(docs, id_col, text_col).mapInArrow(count, _COUNTED).groupBy("factor", "feature", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Field({(r.factor, r.feature, r.a, r.b): r.n for r in rows})


def find_spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the rule spans, and of those that the field adds; by kind, then start."""
    base = base_spans(text)
    own = [(k, a, b) for k, spans in enumerate(base) for a, b in spans]
    nodes = mentions(text, base)
    return own, field.added(nodes) if nodes else []


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (rule spans),
    n_added, base_sha256 (of the rule spans), spans (all, as kind:start:end in code
    points, by kind, then start, comma-joined).

    A null or empty text has no spans; repeated rows each get a row; null ids and
    other columns are let be; very long texts are read whole, in linear time; an empty
    table gives none. Runs one job to train the field on the same documents.
    """
    held = docs.sparkSession.sparkContext.broadcast(train_field(docs, id_col, text_col))

    def find(batches):
        field = held.value
        for part in slices(batches):
            found = [find_spans(t, field) for t in part.column(1).to_pylist()]
            counts = [Counter(k for k, _, _ in base) for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(OTHER)),
                 pa.array([len(added) for _, added in found], pa.int64()),
                 pa.array([hashlib.sha256(_told(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([_told(base + added) for base, added in found], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"])
    return id_text(docs, id_col, text_col).mapInArrow(
        find, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", n_added long, base_sha256 string, spans string")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of ``text_col`` replaced by their kind in square brackets;
    spans that overlap become one, of the kind that starts first. Null texts stay null."""
    held = docs.sparkSession.sparkContext.broadcast(train_field(docs, id_col, text_col))

    def mask(text: str | None) -> str | None:
        if text is None or not _HINT.search(text):
            return text
        base, added = find_spans(text, held.value)
        out, done = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b in base + added):
            if a >= done:
                out += [text[done:a], f"[{KINDS[k].upper()}]"]
            done = max(done, b)
        return "".join(out) + text[done:]

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(mask)

    return docs.withColumn(text_col, masked(F.col(f"`{text_col}`").cast("string")))
