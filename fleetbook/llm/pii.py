"""Personal data in whole texts: rules, and a skip-chain conditional random field.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers (``rule_spans``);
each kind is searched in time linear in the text. The field then labels further mentions,
such as a phone number written again without its country code.

Nodes of a document are the rule spans, with their label fixed, and all other chunks that
could be personal data: tokens with an ``@`` and groups of at least seven digits. Factors:
features of a node (signs, digit counts, checks passed, neighbouring characters, the word
before); a chain between successive nodes; skip edges between distant nodes with equal
digits or address, and between nodes whose last seven digits agree. Equal nodes are linked
each to the next one, so edges grow with mentions, not with their pairs. Labels a chunk
cannot have (a card of nine digits) are ruled out. Loopy message passing runs over all
documents of a batch at once; a chunk is added as a span where one kind has at least
``SURE`` of the probability.

Training maximises the pseudo-likelihood over at most ``SAMPLE`` documents, those with
candidates and the smallest hash of doc_id. Labels are those of the rules; as mentions that
break a rule carry no label there, some nodes get a rewritten second mention (no plus sign,
other separators) with the label of the first and a skip edge.

Defined cases: null and empty texts have no spans; rows are independent, so repeated rows
and rows without doc_id give their own results; no rows give no rows.
"""

import bisect
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm.tables import stage, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none",) + KINDS
SAMPLE, ROUNDS, SURE = 4_000, 12, 0.9
HASHED = 64                      # places for the word before a node

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CHUNK = re.compile(r"[+(]{0,2}[0-9](?:[ ().-]{0,3}[0-9]){6,}")
_WORD_BEFORE = re.compile(r"([^\W\d_]+)\W*$")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text):
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text):
    """Leftmost matches of local part, @ and dotted domain. A local part is the run before
    an @, no further left than the last match."""
    out, bound, at = [], 0, text.find("@")
    while at >= 0:
        run = text[bound:at]
        local = len(run) - len(run.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at + 1) if local else None
        if match:
            out.append((at - local, match.end()))
        bound = match.end() if match else at + 1
        at = text.find("@", bound)
    return out


def addresses(text):
    """Four dotted numbers up to 255; longer rows of numbers are taken four at a time."""
    out = []
    for row in _NUMBERS.finditer(text):
        if "." not in row.group():
            continue
        parts = row.group().split(".")
        at = row.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def cards(text):
    out = []
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text):
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]


def rule_spans(text):
    """(kind, start, end) by kind as listed, then start; code points, end exclusive."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, find in (("ip", addresses), ("card", cards)):
            out += [(kind, a, b) for a, b in find(text)]
        if "+" in text:
            out += [("phone", a, b) for a, b in phones(text)]
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the field ---------------------------------------------------------------------------

_FLAGS = 40
FEATURES = _FLAGS + HASHED


def _features(chunk, before, after, word):
    """Places of the features of a node that are set."""
    digits = _digits(chunk)
    n = len(digits)
    on = [0, 1 + min(n, 20) // 2]
    for k, c in enumerate("@+(-. "):
        if c in chunk:
            on.append(14 + k)
    on.append(20 + min(chunk.count("."), 4))
    if 13 <= n <= 19 and luhn(digits):
        on.append(26)
    if chunk.startswith("+"):
        on.append(27)
    if before.isalnum():
        on.append(28)
    if after.isalnum():
        on.append(29)
    if n and n == len(chunk):
        on.append(30)
    if before in "=\"'":
        on.append(31)
    if chunk.count(".") == 3 and addresses(chunk) == [(0, len(chunk))]:
        on.append(32)
    if "@" in chunk and emails(chunk) == [(0, len(chunk))]:
        on.append(33)
    if word:
        on.append(_FLAGS + int.from_bytes(hashlib.blake2b(word.lower().encode(), digest_size=2).digest(), "big") % HASHED)
    return on


def _possible(chunk):
    """Which labels a chunk can have at all."""
    n, at = len(_digits(chunk)), "@" in chunk
    quad = len([p for p in chunk.split(".") if p.isdigit()]) == 4 and not at
    return [True, at, quad, 13 <= n <= 19 and not at, 7 <= n <= 15 and not at]


def _outer(spans):
    """Spans by position; of overlapping ones the first stands."""
    out, reach = [], -1
    for span in sorted(spans):
        if span[0] >= reach:
            out.append(span)
            reach = span[1]
    return out


_GAP = re.compile(r"[ \n\t]")


def nodes(text, spans):
    """Nodes of a text by position: (start, end, label or -1). Chunks that overlap a rule
    span are left to it."""
    more = [(*m.span(), -1) for m in _CHUNK.finditer(text)]
    bound, at = 0, text.find("@")
    while at >= 0:
        a = max(bound, text.rfind(" ", bound, at) + 1, text.rfind("\n", bound, at) + 1, text.rfind("\t", bound, at) + 1)
        gap = _GAP.search(text, at)
        bound = gap.start() if gap else len(text)
        if 3 < bound - a < 200:
            more.append((a, bound, -1))
        at = text.find("@", bound)
    ruled = _outer((a, b, LABELS.index(k)) for k, a, b in spans)
    starts = [r[0] for r in ruled]
    free = []
    for a, b, label in more:
        k = bisect.bisect_left(starts, b)
        if not k or ruled[k - 1][1] <= a:
            free.append((a, b, label))
    return sorted(ruled + _outer(free))


def _keys(chunk):
    """Identity of a chunk, and what similar chunks share."""
    if "@" in chunk:
        return chunk.lower().strip(".,;:()<>\"'"), None
    digits = _digits(chunk)
    return digits, digits[-7:] if len(digits) >= 7 else None


def graph(documents):
    """Arrays of the nodes and edges of many documents ``[(text, nodes), ...]``."""
    feats, labels, mask, chain, equal, similar, keys = [], [], [], [], [], [], []
    for text, marks in documents:
        last, seen, alike = None, {}, {}
        for a, b, label in marks:
            k, chunk = len(labels), text[a:b]
            word = _WORD_BEFORE.search(text[max(0, a - 40):a])
            feats.append(_features(chunk, text[a - 1:a], text[b:b + 1], word.group(1) if word else ""))
            labels.append(label)
            mask.append(_possible(chunk))
            if last is not None:
                chain.append((last, k))
            last = k
            one, two = _keys(chunk)
            if one in seen:
                equal.append((seen[one], k))
            elif two is not None and two in alike:
                similar.append((alike[two], k))
            seen[one] = k
            if two is not None:
                alike[two] = k
            keys.append(chunk)
    edges = [np.array(e, np.int64).reshape(-1, 2) for e in (chain, equal, similar)]
    return feats, np.array(labels, np.int64), np.array(mask, bool).reshape(-1, len(LABELS)), edges, keys


def _matrix(feats):
    x = np.zeros((len(feats), FEATURES))
    for i, on in enumerate(feats):
        x[i, on] = 1
    return x


def _rewritten(chunk, label, rng):
    """A second mention of a labelled chunk in another spelling."""
    if label == LABELS.index("email"):
        return chunk.upper()
    digits = _digits(chunk)
    if label == LABELS.index("phone"):
        digits = digits[-max(7, min(10, len(digits))):]
    return digits if rng.random() < 0.5 else " ".join(digits[k:k + 4] for k in range(0, len(digits), 4))


def fit(documents, steps=300, rate=0.5, decay=1e-3):
    """Weights (features, three pair tables) by the pseudo-likelihood of labelled nodes.
    Each node's label is predicted from its features and its neighbours' labels."""
    n = len(LABELS)
    weights, pairs = np.zeros((FEATURES, n)), np.zeros((3, n, n))
    start = np.stack([np.zeros((n, n)), 2.0 * np.eye(n), 1.5 * np.eye(n)])
    pairs += start
    feats, labels, mask, edges, chunks = graph(documents)
    if not len(labels):
        return weights, pairs
    labels = np.maximum(labels, 0)
    rng, extra = np.random.default_rng(7), []
    for k in np.flatnonzero(labels):
        if labels[k] != LABELS.index("ip") and rng.random() < 0.3:
            again = _rewritten(chunks[k], labels[k], rng)
            feats.append(_features(again, " ", " ", ""))
            extra.append((k, len(feats) - 1, _keys(again)[0] == _keys(chunks[k])[0]))
    labels = np.concatenate([labels, [labels[k] for k, _, _ in extra]]).astype(np.int64)
    edges[1] = np.concatenate([edges[1], np.array([(a, b) for a, b, e in extra if e], np.int64).reshape(-1, 2)])
    edges[2] = np.concatenate([edges[2], np.array([(a, b) for a, b, e in extra if not e], np.int64).reshape(-1, 2)])
    x, y = _matrix(feats), np.eye(n)[labels]
    around = np.zeros((3, len(labels), n))
    for kind, e in enumerate(edges):
        np.add.at(around[kind], e[:, 0], y[e[:, 1]])
        np.add.at(around[kind], e[:, 1], y[e[:, 0]])
    for _ in range(steps):
        logits = x @ weights + sum(around[k] @ pairs[k] for k in range(3))
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (y - p / p.sum(axis=1, keepdims=True)) / len(labels)
        weights += rate * (len(labels) ** 0.5 * x.T @ error - decay * weights)
        for k in range(3):
            g = around[k].T @ error
            pairs[k] += rate * (len(labels) ** 0.5 * (g + g.T) / 2 - decay * (pairs[k] - start[k]))
    return weights, pairs


def _log(x):
    with np.errstate(divide="ignore"):
        return np.log(x)


def marginals(feats, labels, mask, edges, model, rounds=ROUNDS):
    """Label probabilities of all nodes by loopy message passing."""
    weights, pairs = model
    unary = _matrix(feats) @ weights
    unary = np.where(mask, unary, -1e9)
    fixed = labels >= 0
    unary[fixed] = -1e9
    unary[fixed, labels[fixed]] = 0
    src = np.concatenate([np.concatenate([e[:, 0], e[:, 1]]) for e in edges])
    dst = np.concatenate([np.concatenate([e[:, 1], e[:, 0]]) for e in edges])
    table = np.concatenate([np.full(2 * len(e), k) for k, e in enumerate(edges)]).astype(int)
    back = np.concatenate([np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))]) + 2 * sum(map(len, edges[:k]))
                           for k, e in enumerate(edges)]).astype(int)
    message = np.zeros((len(src), len(LABELS)))
    for _ in range(rounds if len(src) else 0):
        total = unary.copy()
        np.add.at(total, dst, message)
        inner = total[src] - message[back]
        inner = inner[:, :, None] + pairs[table]
        top = inner.max(axis=1, keepdims=True)
        fresh = top[:, 0] + _log(np.exp(inner - top).sum(axis=1))
        fresh -= fresh.max(axis=1, keepdims=True)
        message = 0.5 * message + 0.5 * np.maximum(fresh, -50)
    np.add.at(unary, dst, message)
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added(documents, model):
    """Spans that the field adds to each document ``(text, nodes)``."""
    feats, labels, mask, edges, _ = graph(documents)
    out = [[] for _ in documents]
    if not len(labels) or (labels >= 0).all():
        return out
    p = marginals(feats, labels, mask, edges, model)
    k = 0
    for i, (_, marks) in enumerate(documents):
        for a, b, label in marks:
            best = int(p[k].argmax())
            if label < 0 and best and p[k, best] >= SURE:
                out[i].append((LABELS[best], a, b))
            k += 1
    return out


def train(docs, sample=SAMPLE):
    """The field's weights, learned in one task from at most ``sample`` documents."""
    candidates = texts(docs).filter("text IS NOT NULL AND doc_id IS NOT NULL").filter(F.col("text").rlike("[0-9]{3}|@"))
    rows = candidates.select("doc_id", "text", F.xxhash64("doc_id", F.lit(7)).alias("h"))
    chosen = stage(rows.select("h", "doc_id").orderBy("h", "doc_id").limit(sample), "chosen")
    # Written first: only the bounded sample, not the scan, goes to the one task below.
    rows = stage(rows.join(F.broadcast(chosen.distinct()), ["h", "doc_id"]).select("h", "text"), "sample")

    def learn(batches):
        documents = []
        for batch in batches:
            for h, text in zip(batch["h"].to_pylist(), batch["text"].to_pylist()):
                documents.append((h, text, nodes(text, rule_spans(text))))
        documents.sort(key=lambda d: d[:2])
        weights, pairs = fit([(text, marks) for _, text, marks in documents])
        flat = np.concatenate([weights.ravel(), pairs.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "value"])

    got = rows.coalesce(1).mapInArrow(learn, "at long, value double").collect()
    flat = np.zeros(FEATURES * len(LABELS) + 3 * len(LABELS) ** 2)
    for row in got:
        flat[row["at"]] = row["value"]
    cut = FEATURES * len(LABELS)
    return flat[:cut].reshape(FEATURES, -1), flat[cut:].reshape(3, len(LABELS), -1)


_FOUND = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def find(docs, model=None):
    """doc_id, n_<kind> (rule spans), base_sha256 (of the rule spans) and spans (all) of
    every row."""
    model = model or train(docs)

    def run(batches):
        for batch in batches:
            found = [text or "" for text in batch["text"].to_pylist()]
            base = [rule_spans(text) for text in found]
            marks = [(text, nodes(text, spans)) if spans or _DIGIT.search(text) else (text, []) for text, spans in zip(found, base)]
            spans = [sorted(b + m, key=lambda s: (KINDS.index(s[0]), s[1])) for b, m in zip(base, added(marks, model))]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"]] + [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS]
                + [pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                   pa.array([joined(s) for s in spans], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return texts(docs).mapInArrow(run, _FOUND)


def redact(text, spans):
    """``text`` with every span replaced by its kind in brackets; overlapping spans as one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b > at:
            out += [text[at:max(at, a)], f"[{kind}]" if a >= at else ""]
            at = b
    return "".join(out) + text[at:]
