"""Personal data: fixed patterns, and a skip-chain conditional random field
that finds mentions the patterns miss, secrets among them.

Patterns give the base spans.  The field is over a document's tokens.  Those
without a digit or an @ are observed as none; the others are nodes, with a
unary potential from their shape and the words before them, a chain potential
between neighbours, and skip potentials between tokens that repeat or resemble
each other (equal letters and digits, equal last digits, one mail host),
however far apart.  Tokens of base spans are observed.  Loopy message passing
gives each other token's label; runs that are a kind of personal data with
enough certainty are added.

All potentials are trained together by the likelihood of a bounded sample of
documents, with the base spans as labels, and for secrets the values that
follow a name like token or password and an equals sign or colon.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._shared import tidy

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
RUNS = ("card", "phone")  # may be of several tokens
LABELS = ("none", *ALL_KINDS, *(f"{k}+" for k in RUNS))
SAMPLE_DOCS = 20_000  # documents to train on, at most about so many
SAMPLE_NODES = 400  # of a document to train on; those of more nodes aren't drawn
CERTAIN = 0.9
ROUNDS = 8
STEPS = 120
BUCKETS = 4096
WIDTH = 8
MARKS = ":.,;=!?\"'()"
SPACES = " \t\n\v\f\r"

NODE = re.compile(r"[0-9@]")
TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
SECRET = re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\x20\"']{0,2}[:=]\x20?[\"']?([A-Za-z0-9+/_-]{12,}+)")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c)
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards."""
    found, floor = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            floor = match.end()
        else:
            floor = at + 1
        at = text.find("@", max(at + 1, floor))
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, by start, then kind."""
    found = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text) if text.count(".") > 2 else ():
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def tokens(text: str) -> list[tuple[int, int]]:
    """The runs of non-space characters that hold a digit or an @: the nodes."""
    return [m.span() for m in TOKEN.finditer(text)] if NODE.search(text) else []


def observed(nodes: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> list[int]:
    """The label of each node: that of the first span that touches it (LABELS),
    as its begin or its continuation, or 0."""
    out, k, last = [], 0, -1
    spans = sorted(spans)
    reach = np.maximum.accumulate([e for _, e, _ in spans]) if spans else []
    for s, e in nodes:
        while k < len(spans) and reach[k] <= s:
            k += 1
        j = k
        while j < len(spans) and spans[j][0] < e and spans[j][1] <= s:
            j += 1
        if j == len(spans) or spans[j][0] >= e:
            out.append(0)
            continue
        kind = spans[j][2]
        out.append(LABELS.index(kind + "+") if j == last and kind in RUNS else LABELS.index(kind))
        last = j
    return out


def core(text: str, start: int, end: int) -> tuple[int, int]:
    """A node without the marks around it."""
    while start < end and not text[start].isalnum():
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def features(text: str, start: int, end: int) -> list[int]:
    """WIDTH buckets of a node's shape and its neighbours."""
    a, b = core(text, start, end)
    raw = text[a:b]
    digits = re.sub("[^0-9]", "", raw)
    shape = re.sub("[^\\W0-9_]+", "a", re.sub("[0-9]", "9", raw))
    short = re.sub("9+", "9", shape)
    turns = min(len(short), 9) if len(short) > 6 and set(short) <= {"a", "9"} else 0
    before = text[max(0, start - 32) : start].split()[-2:]
    check = f"{luhn(digits)}{12 <= len(digits) <= 19}" if len(digits) == len(raw) and len(digits) >= 12 else ""
    names = (
        f"s{shape if len(shape) <= 40 and not turns else ''}",
        f"g{short if not turns else 'mixed'}",
        f"n{min(len(digits), 20)} {check}",
        f"l{min(len(raw).bit_length(), 8)} {turns}",
        f"q{text[max(start, a - 1) : a]}{text[b : min(end, b + 1)]}",
        f"w{before[-1].lower().strip(MARKS) if before else ''}",
        f"v{before[0].lower().strip(MARKS) if len(before) > 1 else ''}",
        "b",
    )
    return [zlib.crc32(x.encode("utf-8", "replace")) % BUCKETS for x in names]


def keys(text: str, start: int, end: int) -> list[str]:
    """What tokens that repeat (r) or resemble (d, h) each other have in common."""
    raw = text[slice(*core(text, start, end))].lower()
    plain = re.sub("[^a-z0-9@]", "", raw)
    digits = re.sub("[^0-9]", "", raw)
    out = [f"r{plain}"] if len(plain) >= 4 else []
    if len(digits) >= 7 and "@" not in raw:
        out.append(f"d{digits[-7:]}")
    if "@" in raw:
        out.append(f"h{raw.partition('@')[2]}")
    return out


def skip_edges(found: list[list[str]]) -> list[tuple[int, int, int]]:
    """(i, j, potential): each token and the last before it with a key in
    common, so as many edges as keys at most, and all tokens that share a key
    connected.  1 is for repeated tokens, 2 for similar ones."""
    last: dict[str, int] = {}
    edges: dict[tuple[int, int], int] = {}
    for i, names in enumerate(found):
        for name in names:
            if name in last:
                edges.setdefault((last[name], i), 1 if name[0] == "r" else 2)
            last[name] = i
    return [(i, j, k) for (i, j), k in edges.items()]


@dataclass
class Graph:
    """The tokens of some documents: features (nodes, WIDTH), labels (-1 if
    not observed), whether a plain word stands before and after, and edges
    (i, j, potential) with 0 for neighbours."""

    at: np.ndarray
    seen: np.ndarray
    after_plain: np.ndarray
    before_plain: np.ndarray
    edges: np.ndarray


def node_rows(text: str, spans: list[tuple[int, int, str]]) -> list[tuple]:
    """(start, end, label, features, keys, whether a plain word stands before
    and after) of a document's nodes; between two nodes without a word the
    field has an edge."""
    nodes = tokens(text)
    labels = observed(nodes, spans)
    out = []
    for i, (s, e) in enumerate(nodes):
        before = bool(text[nodes[i - 1][1] if i else 0 : s].strip(SPACES))
        after = bool(text[e : nodes[i + 1][0] if i + 1 < len(nodes) else len(text)].strip(SPACES))
        out.append((s, e, labels[i], features(text, s, e), keys(text, s, e), before, after))
    return out


def graph_of(docs: list[list[tuple]], seen: list[list[int]]) -> Graph:
    """One graph of all documents' node rows; seen: their labels or -1."""
    edges, base = [], 0
    for rows in docs:
        edges += [(base + i, base + i + 1, 0) for i in range(len(rows) - 1) if not rows[i][6]]
        edges += [(base + i, base + j, k) for i, j, k in skip_edges([r[4] for r in rows])]
        base += len(rows)
    flat = [r for rows in docs for r in rows]
    return Graph(
        np.array([r[3] for r in flat], np.int64).reshape(-1, WIDTH),
        np.array([x for labels in seen for x in labels], np.int64),
        np.array([r[5] for r in flat], bool),
        np.array([r[6] for r in flat], bool),
        np.array(edges, np.int64).reshape(-1, 3),
    )


@dataclass
class Field:
    """Log potentials: unary (BUCKETS, labels); pairs (3, labels, labels) of
    neighbours, repeated and similar tokens."""

    unary: np.ndarray
    pairs: np.ndarray

    def own(self, g: Graph, kept: np.ndarray | None = None) -> np.ndarray:
        """Scores of the nodes by themselves, from the features kept (nodes,
        WIDTH).  Plain words are observed as none, so beside one a neighbours'
        potential is a score as well."""
        score = self.unary[g.at].sum(1) if kept is None else (self.unary[g.at] * kept[:, :, None]).sum(1)
        score += g.after_plain[:, None] * self.pairs[0][0][None, :] + g.before_plain[:, None] * self.pairs[0][:, 0][None, :]
        known = np.flatnonzero(g.seen >= 0)
        score[known] = -50.0
        score[known, g.seen[known]] = 0.0
        return score

    def passed(self, g: Graph, own: np.ndarray, messages: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Messages along the edges, both ways, after some rounds, and the
        nodes' log beliefs."""
        src, dst, pot, back = self._both(g)
        for _ in range(rounds):
            total = own.copy()
            np.add.at(total, dst, messages)
            out = (total[src] - messages[back])[:, :, None] + pot
            top = out.max(1, keepdims=True)
            new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
            messages = 0.5 * messages + 0.5 * (new - new.max(1, keepdims=True))
        total = own.copy()
        np.add.at(total, dst, messages)
        return messages, total

    def _both(self, g: Graph) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        m = len(g.edges)
        src, dst = np.concatenate([g.edges[:, 0], g.edges[:, 1]]), np.concatenate([g.edges[:, 1], g.edges[:, 0]])
        pot = self.pairs[g.edges[:, 2]]
        return src, dst, np.concatenate([pot, pot.transpose(0, 2, 1)]), np.concatenate([np.arange(m, 2 * m), np.arange(m)])

    def beliefs(self, g: Graph) -> np.ndarray:
        """Label probabilities (nodes, labels) after loopy message passing."""
        own = self.own(g)
        if len(g.edges):
            own = self.passed(g, own, np.zeros((2 * len(g.edges), len(LABELS))), ROUNDS)[1]
        return _normal(own)


def _normal(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(-1, keepdims=True))
    return p / p.sum(-1, keepdims=True)


def trained(docs: list[list[tuple]], steps: int = STEPS) -> Field:
    """From documents' node rows: all potentials together, by the gradient of
    the likelihood, with the marginals of loopy message passing.  In every
    second step half of the features are left out, so that the pairs'
    potentials learn to speak for tokens of odd shapes."""
    n = len(LABELS)
    field = Field(np.zeros((BUCKETS, n)), np.zeros((3, n, n)))
    label = np.array([r[2] for rows in docs for r in rows], np.int64)
    if not len(label):
        return field
    g = graph_of(docs, [[-1] * len(rows) for rows in docs])
    truth, m = np.eye(n)[label], len(g.edges)
    a, b, kind = g.edges.T
    held = np.zeros((3, n, n))
    np.add.at(held, (kind, label[a], label[b]), 1)
    messages = np.zeros((2 * m, n))
    squares = [np.full_like(field.unary, 1e-2), np.full_like(field.pairs, 1e-2)]
    rng = np.random.default_rng(5)
    for k in range(steps):
        kept = (rng.random(g.at.shape) < (0.5 if k % 2 else 1.0)).astype(float)
        own = field.own(g, kept)
        messages, total = field.passed(g, own, messages, 2)  # they go on from the step before
        wrong = truth - _normal(total)
        unary = np.zeros_like(field.unary)
        for j in range(WIDTH):
            np.add.at(unary, g.at[:, j], wrong * kept[:, j, None])
        both = (total[a] - messages[m:])[:, :, None] + field.pairs[kind] + (total[b] - messages[:m])[:, None, :]
        both = _normal(both.reshape(m, n * n)).reshape(m, n, n)
        pairs = held.copy()
        np.add.at(pairs, kind, -both)
        pairs[0][0] += wrong[g.after_plain].sum(0)
        pairs[0][:, 0] += wrong[g.before_plain].sum(0)
        pairs[1:] = (pairs[1:] + pairs[1:].transpose(0, 2, 1)) / 2
        for x, step, square, least in ((field.unary, unary, squares[0], 0.02), (field.pairs, pairs, squares[1], 0.1)):
            step -= least * x
            square += step * step
            x += 0.5 * step / np.sqrt(square)
    return field


def added(text: str, rows: list[tuple], p: np.ndarray, certain: float = CERTAIN) -> list[tuple[int, int, str]]:
    """The spans that the beliefs of a document's nodes add to its base spans:
    runs of tokens that the patterns leave alone, each likelier so than not,
    and one of them as certain as asked for."""
    found: list[list] = []  # start, end, kind, the greatest certainty of a token
    open_kind = None
    for i, (s, e, label, *_, plain_before, _) in enumerate(rows):
        mass = {k: float(p[i, LABELS.index(k)] + (p[i, LABELS.index(k + "+")] if k in RUNS else 0.0)) for k in ALL_KINDS}
        kind = max(mass, key=mass.get)
        a, b = core(text, s, e)
        if label or mass[kind] < 0.5 or a == b:
            open_kind = None
            continue
        if kind == open_kind and kind in RUNS and not plain_before and p[i, LABELS.index(kind + "+")] > p[i, LABELS.index(kind)]:
            found[-1][1], found[-1][3] = b, max(found[-1][3], mass[kind])
        else:
            found.append([a, b, kind, mass[kind]])
        open_kind = kind
    return [(a, b, kind) for a, b, kind, most in found if most >= certain]


def all_spans(texts: list[str], field: Field, certain: float = CERTAIN) -> list[tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]]:
    """(base spans, all spans) of each text; the texts' fields are one graph."""
    bases = [base_spans(t) for t in texts]
    rows = [node_rows(t, base) for t, base in zip(texts, bases, strict=True)]
    open_docs = [i for i, doc in enumerate(rows) if any(not r[2] for r in doc)]
    more: dict[int, list] = {}
    if open_docs:
        g = graph_of([rows[i] for i in open_docs], [[r[2] or -1 for r in rows[i]] for i in open_docs])
        p, at = field.beliefs(g), 0
        for i in open_docs:
            more[i] = added(texts[i], rows[i], p[at : at + len(rows[i])], certain)
            at += len(rows[i])
    order = lambda x: (x[0], ALL_KINDS.index(x[2]), x[1])
    return [(base, sorted(base + more.get(i, []), key=order)) for i, base in enumerate(bases)]


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span, or run of overlapping spans, as [KIND]."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def labelled_rows(text: str) -> list[tuple]:
    """A document's node rows with their labels for training."""
    secrets = [(*m.span(1), "secret") for m in SECRET.finditer(text) if DIGIT.search(m[1])] if "=" in text or ":" in text else []
    return node_rows(text, base_spans(text) + secrets)


_NODES = pa.list_(pa.struct([("l", pa.int32()), ("f", pa.list_(pa.int32())), ("k", pa.list_(pa.string())), ("b", pa.bool_()), ("a", pa.bool_())]))


def fitted(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Train on about ``sample_docs`` documents, drawn by the hash of id and
    text, so that a text's copies are drawn one by one; fewer are all taken.
    Documents of more than SAMPLE_NODES nodes aren't trained on."""
    n = docs.count()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    key = F.xxhash64("i", "t")
    if n > sample_docs:
        rows = rows.where(F.pmod(key, F.lit(1_000_003)) < int(1_000_003 * sample_docs / n))

    def run(batches):
        for batch in batches:
            hashes, out = [], []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                nodes = labelled_rows(text or "")
                if 0 < len(nodes) <= SAMPLE_NODES:
                    hashes.append(h)
                    out.append([{"l": x, "f": f, "k": k, "b": b, "a": a} for _, _, x, f, k, b, a in nodes])
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(out, _NODES)], names=["h", "m"])

    found = rows.select(key.alias("h"), "t").mapInArrow(tidy(run), "h long, m array<struct<l:int,f:array<int>,k:array<string>,b:boolean,a:boolean>>")
    found = sorted(found.orderBy("h").limit(sample_docs).collect(), key=lambda r: (r["h"], repr(r["m"])))
    return trained([[(0, 0, x["l"], x["f"], x["k"], x["b"], x["a"]) for x in r["m"]] for r in found])


def _in_parts(texts: list[str], size: int = 1 << 20):
    """(first, texts) of about ``size`` characters, whole documents each."""
    low = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield low, texts[low : i + 1]
            low, total = i + 1, 0
    if low < len(texts):
        yield low, texts[low:]


def personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (all, as kind:start:end in code points), n_added and
    n_spans.  A null or empty text has no spans; repeated rows are alike.  No
    shuffle."""
    field = field or fitted(docs, id_col=id_col, text_col=text_col)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, texts in _in_parts([t or "" for t in batch.column(1).to_pylist()]):
                out = []
                for i, (base, spans) in enumerate(all_spans(texts, field)):
                    kinds = [k for *_, k in base]
                    out.append((ids[low + i], *map(kinds.count, KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans) - len(base), len(spans)))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if n in ("base_sha256", "spans") else pa.int64()) for n, x in zip(names, zip(*out, strict=True), strict=True)], names=names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tidy(run), schema)


def without_personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns, with all spans replaced in the text."""
    field = field or fitted(docs, id_col=id_col, text_col=text_col)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            out: list[str | None] = []
            for low, part in _in_parts([t or "" for t in texts]):
                out += [None if texts[low + i] is None else redacted(part[i], spans) for i, (_, spans) in enumerate(all_spans(part, field))]
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))

    return docs.mapInArrow(tidy(run), docs.schema)
