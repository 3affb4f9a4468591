"""Personal data: base patterns, and a skip-chain conditional random field that adds to them.

Nodes of a document's graph are its tokens (between ASCII white space; runs of more than
``LONG_RUN`` characters are parted further, at commas, brackets, quotes, other signs that part
fields, and all that is not ASCII) with a digit or an ``@``; all others are certainly outside.
Tokens are looked at whole, however long. Edges join

* neighbours in the text (nothing but white space between them),
* repeated tokens, each with the next one that has the same letters and digits (short ones
  have a table of their own; octets must have the same dots too),
* similar tokens, each with the next one of the same shape of at least ``SHAPE`` characters,
* the tokens of neighbouring groups of digits, as in phones and cards, with those of the next
  groups that have the same digits however grouped, or the same shape,

so distant mentions share potentials and the graph grows with the tokens, not with pairs.
Tokens inside base matches are fixed to their kind; the others get marginals by loopy
sum-product message passing (damped rounds over all edges at once until no message changes by
``SETTLED``; where they do not settle, steps shrink after ``ROUNDS`` rounds). A token whose
likeliest kind has ``CERTAIN`` or more becomes a span, joined with neighbours of that kind.
Addresses that the base pattern does not read (dots in brackets, octets parted by white space,
IPv6) have the features of addresses, and training leaves them out, as it does not know them.

The weights are trained here, by pseudo-likelihood, on a sample of at most about ``SAMPLE``
documents with such tokens (``TOKENS`` tokens of each), labelled by the base patterns.
During training a feature is left out now and then, so none is needed alone.

Null text has no spans. Repeated rows get the same spans.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.shared import only

KINDS = ("email", "ip", "card", "phone")
SHAPE, ROUNDS, SETTLED, CERTAIN = 8, 100, 1e-3, 0.95
#: Digits of neighbouring groups that are linked: from a phone without area code to a card.
GROUPED = (7, 19)
LONG_RUN = 200
SAMPLE, TOKENS = 3000, 100

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts where a run of digits starts; possessive runs keep failures linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"[0-9]+")
_RUN = re.compile(r"[^\x20\x09-\x0D]++")
_PIECE = re.compile(r"""[^\x20\x09-\x0D,;|&=<>{}\[\]()"'`\x80-\U0010FFFF]++""")
_WANTED = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_WORD_BEFORE = re.compile(r"([^\x20\x09-\x0D]{1,24})[\x20\x09-\x0D]+\Z")
_EDGE = " \t.,;:!?\"'()[]{}<>"
_CUES = {"tel", "phone", "call", "fax", "mobile", "mail", "email", "contact", "card", "visa", "ip", "host", "server"}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        match = _DOMAIN.match(text, at)
        start = at
        if match:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base matches, by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        if "+" in text:
            found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


_BRACKETED = re.compile(r"[\[({] ?(?:\.|dot) ?[\])}]", re.IGNORECASE)
_DOT = r"[ \t]*+(?:\.|[\[({] ?(?:\.|dot) ?[\])}])[ \t]*+"
_SPELLED = re.compile(rf"(?<![0-9])[0-9]++(?:{_DOT}[0-9]++){{3}}", re.IGNORECASE)
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]*+:[0-9A-Fa-f]*+:)[0-9A-Fa-f:]++[0-9.]*+(?![0-9A-Za-z:])")


def octets_of(text: str) -> list[str]:
    """The four parts of an IPv4 address in any spelling, or none."""
    t = _BRACKETED.sub(".", text)
    parts = t.replace(".", " ").split()
    whole = len(parts) == 4 and t.count(".") in (0, 3) and all(
        p.isascii() and p.isdigit() and len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in parts)
    return parts if whole else []


def is_ip6(text: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def spelled_addresses(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, how) of addresses that are no base matches; how as in ``Token.spelled``."""
    base = {(a, b) for a, b, k in spans if k == 1}
    found = []
    if "." in text or "dot" in text.lower():
        found = [(*m.span(), 1 if _SPACE.search(m[0]) else 2) for m in _SPELLED.finditer(text)
                 if m.span() not in base and octets_of(m[0])]
    if text.count(":") > 1:
        for m in _IP6.finditer(text):
            if is_ip6(t := m[0].rstrip(".")):
                found.append((m.start(), m.start() + len(t), 2))
    return sorted(found)


class Seen(NamedTuple):
    """What the field takes from a token; texts that may be long are hashed."""
    features: tuple[bool, ...]
    same: str  # what repeated tokens have in common
    shape: str
    digits: str  # of a token without letters; never more than tell that it is too long to be grouped
    parts: str  # octets, if white space parts the address


@dataclass
class Token:
    start: int
    end: int
    text: str
    before: str
    adjacent: bool  # only white space since the token before
    label: int  # kind + 1 inside a base match, else 0
    #: Touches an address in another spelling: 2, or 1 where white space parts it; 0 if not.
    spelled: int = 0
    inside: tuple[int, int] | None = None  # that address in the text
    kept: Seen | None = None

    @property
    def seen(self) -> Seen:
        if self.kept is None:
            t = self.text
            digits = "" if "@" in t or any(c.isalpha() for c in t) else "".join(_DIGIT.findall(t))
            self.kept = Seen(tuple(features(self)), _short(_same(t)), _short(_shape(t)), digits[:GROUPED[1] + 1],
                             ".".join(_NUMBER.findall(t)) if self.spelled == 1 else "")
        return self.kept


def _short(key: str) -> str:
    return key if len(key) <= 64 else hashlib.sha256(key.encode("utf-8", "surrogatepass")).hexdigest()


def _pieces(text: str):
    """(start, end, first piece of a run) of the tokens."""
    for run in _RUN.finditer(text):
        if run.end() - run.start() <= LONG_RUN:
            if _WANTED.search(run[0]):
                yield *run.span(), True
            continue
        first = True
        for m in _PIECE.finditer(text, *run.span()):
            if _WANTED.search(m[0]):
                yield *m.span(), first
                first = False


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> list[Token]:
    out: list[Token] = []
    spans = sorted((a, b, k) for k, a, b in base)
    others, other = spelled_addresses(text, spans), 0
    nearest, last_end = 0, -1
    for start, end, first in _pieces(text):
        while nearest < len(spans) and spans[nearest][1] <= start:
            nearest += 1
        label, k = 0, nearest
        while k < len(spans) and spans[k][0] < end:
            if spans[k][1] > start:
                label = spans[k][2] + 1
                break
            k += 1
        before = _WORD_BEFORE.search(text, max(0, start - 32), start)
        while other < len(others) and others[other][1] <= start:
            other += 1
        a, b, how = others[other] if other < len(others) and others[other][0] < end else (-1, -1, 0)
        gap = text[last_end:start].strip()
        adjacent = last_end >= 0 and (not gap or 0 <= a < last_end or not first and not gap.strip("()"))
        out.append(Token(start, end, text[start:end], before[1] if before else "", adjacent, label,
                         how, (a, b) if how else None))
        last_end = end
    return out


#: Names of the features of a token, in the order of the weights.
FEATURES = ("one", "at", "at_dot", "digits_1_3", "digits_4_6", "digits_7_9", "digits_10_15", "digits_16_19",
            "digits_20", "octets", "octets_small", "letters", "mostly_letters", "plus", "parentheses", "dash",
            "equals", "quote", "luhn", "cue", "only_digits")


def features(token: Token) -> list[bool]:
    t = token.text.strip(_EDGE)
    digits = "".join(_DIGIT.findall(t))
    n, letters = len(digits), sum(c.isalpha() for c in t)
    parts = t.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    cue = token.before.strip(_EDGE).lower() in _CUES
    if token.spelled and not token.label:  # what else it is made of says nothing more
        return [name in ("one", "octets") or (name == "octets_small" and token.spelled > 1) or (name == "cue" and cue)
                for name in FEATURES]
    return [True, "@" in t, "." in t.rpartition("@")[2] and "@" in t, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 9,
            10 <= n <= 15, 16 <= n <= 19, n >= 20, octets, octets and all(len(p) <= 3 for p in parts), letters > 0,
            2 * letters > len(t), "+" in token.text, "(" in token.text or ")" in token.text, "-" in t, "=" in t,
            '"' in token.text or "'" in token.text, 16 <= n <= 19 and luhn(digits),
            cue, n > 0 and letters == 0 and "@" not in t]


def _shape(text: str) -> str:
    return re.sub("[a-z]+", "a", re.sub("[0-9]", "9", text.strip(_EDGE).lower()))


def _same(text: str) -> str:
    """What repeated tokens have in common."""
    t = _BRACKETED.sub(".", text.strip(_EDGE).lower())
    if t.count(".") == 3 and not any(c.isalpha() for c in t):
        return t
    return "".join(c for c in t if c.isalnum() or c == "@")


def _groups(tokens: list[Token]):
    """(first, last, digits, shape) of neighbouring tokens of digits, two or more, or one."""
    digits = [t.seen.digits for t in tokens]
    for first, start in enumerate(digits):
        joined, last = start, first
        while joined and len(joined) <= GROUPED[1]:
            if len(joined) >= GROUPED[0]:
                yield first, last, joined, " ".join(t.seen.shape for t in tokens[first:last + 1])
            last += 1
            if last == len(tokens) or not tokens[last].adjacent or not digits[last]:
                break
            joined += digits[last]


def edges_of(tokens: list[Token]) -> list[np.ndarray]:
    """Pairs of tokens for each edge type: neighbours, repeated, similar, short repeated."""
    chain = [(k - 1, k) for k, t in enumerate(tokens) if t.adjacent]
    repeated, similar, short = {}, {}, {}  # as sets in order

    def link(last: dict, key: str, first: int, end: int, into: dict):
        a, b = last.get(key, (0, first))
        if b < first:
            into.update(((min(a + k, b), min(first + k, end)), None) for k in range(max(b - a, end - first) + 1))
        last[key] = first, end

    last_same, last_shape, last_digits, last_groups = {}, {}, {}, {}
    for k, t in enumerate(tokens):
        if same := t.seen.same:
            link(last_same, same, k, k, repeated if len(same) >= GROUPED[0] else short)
        first, parts = k, []
        while t.spelled == 1 and first >= 0 and tokens[first].spelled == 1 and len(parts) < 4:
            parts = tokens[first].seen.parts.split(".") + parts
            first -= 1
        if len(parts) == 4:  # octets parted by white space
            link(last_same, ".".join(parts), first + 1, k, repeated)
        shape = t.seen.shape
        if len(shape) >= SHAPE:
            link(last_shape, shape, k, k, similar)
    for first, last, digits, shape in _groups(tokens):
        link(last_digits, digits, first, last, repeated)
        if first < last:
            link(last_groups, shape, first, last, similar)
    similar = [e for e in similar if e not in repeated and e not in short]
    short = [e for e in short if e not in repeated]
    return [np.array(list(e), np.int64).reshape(-1, 2) for e in (chain, repeated, similar, short)]


#: Prior of the label tables: repeated and similar tokens agree unless training says otherwise.
PRIOR = (0.0, 2.0, 1.0, 0.5)


class SkipChain:
    """Weights: features by labels, and a label by label table for each edge type."""

    def __init__(self):
        labels = len(KINDS) + 1
        self.unary = np.zeros((len(FEATURES), labels))
        self.prior = np.stack([p * np.eye(labels) for p in PRIOR])
        self.pair = self.prior.copy()

    def train(self, documents: list[list[Token]], steps: int = 300, rate: float = 0.1, drop: float = 0.2,
              seed: int = 3) -> "SkipChain":
        """Pseudo-likelihood: each token's label given the labels of its neighbours."""
        flat = [t for d in documents for t in d]
        if not flat:
            return self
        x = np.array([t.seen.features for t in flat], float)
        y = np.array([t.label for t in flat])
        labels = self.unary.shape[1]
        known = np.array([t.label > 0 or not t.spelled for t in flat])[:, None]
        one_hot = np.eye(labels)[y] * known
        edges, first = [[] for _ in PRIOR], 0
        for document in documents:
            for kind, e in enumerate(edges_of(document)):
                edges[kind].append(e + first)
            first += len(document)
        around = np.zeros((len(PRIOR), len(y), labels))
        for kind in range(len(PRIOR)):
            a, b = np.concatenate(edges[kind]).T
            np.add.at(around[kind], a, one_hot[b])
            np.add.at(around[kind], b, one_hot[a])
        rng = np.random.default_rng(seed)
        # Rare kinds count as much as common ones.
        weight = 1 / np.sqrt(np.maximum(np.bincount(y, minlength=labels), 1))[y] * known[:, 0]
        weight = weight / max(weight.sum(), 1e-300)
        mean, square = [0.0, 0.0], [0.0, 0.0]
        for step in range(1, steps + 1):
            seen = x * (rng.random(x.shape) >= drop)
            seen[:, 0] = 1
            near = around * (rng.random((len(PRIOR), len(y), 1)) >= drop)
            score = seen @ self.unary + np.einsum("knl,klm->nm", near, self.pair)
            error = (_softmax(score) - one_hot) * weight[:, None]
            table = np.einsum("knl,nm->klm", near, error)
            grads = [seen.T @ error + 1e-4 * self.unary, (table + table.transpose(0, 2, 1)) / 2 + 1e-4 * (self.pair - self.prior)]
            for k, (target, g) in enumerate(zip((self.unary, self.pair), grads)):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                target -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def marginals(self, tokens: list[Token]) -> np.ndarray:
        """Label probabilities of each token by loopy message passing; base labels are fixed."""
        unary = np.array([t.seen.features for t in tokens], float) @ self.unary
        fixed = np.array([t.label for t in tokens])
        unary[fixed > 0] = -50
        unary[fixed > 0, fixed[fixed > 0]] = 0
        types = edges_of(tokens)
        pairs = np.concatenate(types)
        if not len(pairs):
            return _softmax(unary)
        kind = np.repeat(np.arange(len(PRIOR)), [len(e) for e in types])
        source, target = np.concatenate([pairs, pairs[:, ::-1]]).T
        table = self.pair[np.concatenate([kind, kind])]
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        message = np.zeros((len(source), unary.shape[1]))
        step, change, done = 0.5, SETTLED, 0
        while change >= SETTLED and step >= SETTLED:
            total = unary.copy()
            np.add.at(total, target, message)
            out = (total[source] - message[back])[:, :, None] + table
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - message).max()
            message += step * (new - message)
            done += 1
            if done > ROUNDS:
                step *= 0.98
        total = unary.copy()
        np.add.at(total, target, message)
        return _softmax(total)

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans that the field finds outside base matches."""
        tokens = tokens_of(text, base)
        if all(t.label for t in tokens):
            return []
        found = self.marginals(tokens)
        out: list[tuple[int, int, int]] = []
        last = -2
        for k, (t, p) in enumerate(zip(tokens, found)):
            label = int(p.argmax())
            if t.label or not label or p[label] < CERTAIN:
                continue
            whole = text[t.start:t.end]
            start = t.start + len(whole) - len(whole.lstrip(_EDGE))
            end = t.end - len(whole) + len(whole.rstrip(_EDGE))
            if label == 2 and t.inside:
                start, end = max(start, t.inside[0]), min(end, t.inside[1])
            if start >= end:
                continue
            if out and last == k - 1 and t.adjacent and out[-1][0] == label - 1:
                out[-1] = (label - 1, out[-1][1], end)
            else:
                out.append((label - 1, start, end))
            last = k
        return [s for s in out if plausible(s[0], text[s[1]:s[2]])]


def plausible(kind: int, text: str) -> bool:
    """What a span of the kind must have in any spelling."""
    digits = len(_DIGIT.findall(text))
    if kind == 0:
        name, _, host = text.partition("@")
        return bool(name and host)
    if kind == 1:
        return bool(octets_of(text.split(":")[0])) or is_ip6(text)
    if kind == 2:
        return 13 <= digits <= 19
    return 9 <= digits <= 15 or digits == 8 and ("+" in text or not dated("".join(_DIGIT.findall(text))))


def dated(digits: str) -> bool:
    """Do eight digits read as a date or as two years?"""
    def year(y: str) -> bool:
        return "1500" <= y < "2100"
    def day(a: str, b: str) -> bool:
        return "01" <= min(a, b) <= "12" and "01" <= max(a, b) <= "31"
    head, tail = digits[:4], digits[4:]
    return year(head) and (year(tail) or day(tail[:2], tail[2:])) or year(tail) and day(head[:2], head[2:])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, sample: int = SAMPLE, per_doc: int = TOKENS) -> SkipChain:
    """Train on a bounded sample of (doc_id, text) rows that have a digit or an ``@``."""
    able = only(docs, doc_id="doc_id", text="text").filter(F.col("text").rlike("[0-9@]"))
    share = sample / max(1, able.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                tokens = tokens_of(text, base_spans(text))[:per_doc]
                rows.append([[str(int(t.adjacent)), str(t.label), str(t.spelled),
                              "".join("01"[f] for f in t.seen.features), *t.seen[1:]] for t in tokens])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.list_(pa.string())))], names=["tokens"])

    rows = able.filter(draw < share).limit(2 * sample).select("text").mapInArrow(
        run, "tokens array<array<string>>").collect()
    documents = sorted([tuple(tuple(t) for t in r[0]) for r in rows])
    return SkipChain().train([[
        Token(0, 0, "", "", a == "1", int(y), int(s), None, Seen(tuple(b == "1" for b in bits), *keys))
        for a, y, s, bits, *keys in d] for d in documents])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, field: SkipChain | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    field = field or fit(docs)

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                more = field.added(text, base) if "@" in text or _DIGIT.search(text) else []
                counts = [sum(k == kind for kind, _, _ in base) for k in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()] * 2)]],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return only(docs, doc_id="doc_id", text="text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each stretch of overlapping spans becomes the name of its first kind."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def mask(docs: DataFrame, field: SkipChain | None = None, length: str | None = None) -> DataFrame:
    """``docs`` with the spans in ``text`` masked; ``length`` names a column to recount."""
    field = field or fit(docs)
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = []
            for text in batch.column(names.index("text")):
                text = text.as_py()
                if text and ("@" in text or _DIGIT.search(text)):
                    base = base_spans(text)
                    text = masked(text, base + field.added(text, base))
                texts.append(text)
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(texts, pa.string())
            if length:
                columns[names.index(length)] = pa.array([None if t is None else len(t) for t in texts],
                                                        columns[names.index(length)].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return docs.mapInArrow(run, docs.schema)
