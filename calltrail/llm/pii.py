"""Personal data: base patterns, and a skip-chain conditional random field that carries their labels to other mentions.

Nodes are base matches, digit groups that together spell one, and the other tokens that hold a digit or "@". Neighbours in
the text share a chain potential. All nodes of the same digits or letters, and all of the same last eight digits, share a
skip potential with a hub of their entity, however far apart they stand; a hub is held to the labels that its nodes are
seen with. Loopy belief propagation over all documents of a batch, each until it settles, enforces one label for one entity.

Node weights, chain and skip potentials are fitted together, by the conditional likelihood of each node's label given its
features, the labels beside it, and the label that the other mentions of its entity have.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.llm.common import ids_and_texts, in_slices, unused

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Different texts that the field is fitted on, at most; those of the smallest hashes are taken.
FIT_ROWS = 3000
#: Messages have settled when none moves by more; rounds end at MOST_ROUNDS where a document's never settle.
SETTLED, MOST_ROUNDS = 1e-4, 1000
#: Score of the labels that a seen node, or the hub of one, does not have.
HELD = -1e4
#: log potential of a token and its hub with the same label, against different ones: what fitting starts from and is
#: drawn towards where a corpus has few repeated entities.
SAME, SIMILAR = 10.0, 5.0
#: How hard parameters are drawn to where they start, per training node; rounds of the fit.
DRAWN, FIT_ROUNDS = 1e-5, 600
#: A label is taken where it is likelier than all others together.
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails at its first digit fails at each, so matches start at run starts and keep whole parts.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]\S*")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_GROUPS = re.compile(r"[0-9]+(?:(?: ?\(|\)[ -]?|[ .-])[0-9]+)*")
_DIGITS = re.compile(r"[0-9]+")
_CUES = re.compile(r"(mail)|(\bip\b|addr|host)|(card|visa|credit)|(phone|tel|call|mobile)", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(d if (d := 2 * int(c)) < 10 else d - 9 for c in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind then start; failing matches are dropped."""
    out = []
    if "@" in text:
        done, at = 0, text.find("@")
        while at >= 0:
            m = _AT.match(text, at)
            start = at
            while m and start > done and text[start - 1] in _LOCAL:
                start -= 1
            if m and start < at:
                out.append((0, start, m.end()))
                done = m.end()
            at = text.find("@", max(at + 1, done))
    if _NOT_DIGIT.fullmatch(text) or not text:
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Spans of tokens between white space that hold a digit or "@", without marks around them."""
    out, left = [], 0
    for m in _HINT.finditer(text):
        start = m.start()
        while start > left and not text[start - 1].isspace():
            start -= 1
        token = text[start : m.end()]
        inner = token.strip(".,;:!?()[]{}<>\"'|")
        if inner:
            start += token.index(inner)
            out.append((start, start + len(inner)))
        left = m.end()
    return out


def mentions_of(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Neighbouring digit groups that together spell the digits of a base span, or share its last eight.

    Equal digits go first, then ends of one another, then equal last eights; of these the leftmost, then the longest.
    """
    keys = {d for k, a, b in spans if k and len(d := _NOT_DIGIT.sub("", text[a:b])) >= 6}
    tails: dict[str, list[str]] = {}
    for d in keys:
        if len(d) >= 8:
            tails.setdefault(d[-8:], []).append(d)
    taken = sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in taken]
    ends = list(accumulate((b for _, b in taken), max))
    out = []
    for run in _GROUPS.finditer(text) if keys else ():
        groups = [(run.start() + m.start(), run.start() + m.end()) for m in _DIGITS.finditer(run[0])]
        found: list[tuple[int, int, int]] = []
        for i, (a, _) in enumerate(groups):
            if text[a - 1 : a].isalpha():
                continue
            digits = ""
            for j in range(i, len(groups)):
                digits += text[slice(*groups[j])]
                if len(digits) > 19:
                    break
                if text[groups[j][1] : groups[j][1] + 1].isalpha():
                    continue
                if digits in keys:
                    found.append((0, i, j))
                elif digits[-8:] in tails:
                    found.append((1 if any(d.endswith(digits) or digits.endswith(d) for d in tails[digits[-8:]]) else 2, i, j))
        used = [False] * len(groups)
        for _, i, j in sorted(found, key=lambda x: (x[0], x[1], -x[2])):
            a, b = groups[i][0], groups[j][1]
            before = bisect_left(starts, b)
            if not any(used[i : j + 1]) and not (before and ends[before - 1] > a):
                used[i : j + 1] = [True] * (j + 1 - i)
                out.append((a - 1 if text[a - 1 : a] == "(" and ")" in text[a:b] else a, b))
    return sorted(out)


def nodes_of(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Base spans of digits, mentions of them, and the tokens that overlap neither, in the order of the text."""
    wide: list[tuple[int, int]] = []
    for a, b in sorted([(a, b) for k, a, b in spans if k] + mentions_of(text, spans)):
        if wide and a < wide[-1][1]:
            wide[-1] = (wide[-1][0], max(b, wide[-1][1]))
        else:
            wide.append((a, b))
    ends = [b for _, b in wide]
    rest = [(a, b) for a, b in tokens_of(text) if (k := bisect_right(ends, a)) == len(wide) or wide[k][0] >= b]
    return sorted(wide + rest)


#: Features of a token: at, count of digits in steps, dots, plus, dash, letters, all digits, parts up to 255, length in steps, cue before it.
N_FEATURES = 1 + 1 + 7 + 4 + 1 + 1 + 2 + 1 + 1 + 4 + 5


def features(text: str, start: int, end: int) -> tuple[int, ...]:
    """Indices of the features that hold."""
    token = text[start:end]
    digits = _NOT_DIGIT.sub("", token)
    n, dots = len(digits), token.count(".")
    out = [0]
    if "@" in token:
        out.append(1)
    out.append(2 + (0 if n == 0 else 1 if n < 4 else 2 if n < 8 else 3 if n < 12 else 4 if n < 16 else 5 if n < 20 else 6))
    out.append(9 + min(3, dots))
    if token[0] == "+" or text[start - 1 : start] == "+":
        out.append(13)
    if "-" in token:
        out.append(14)
    letters = len(token) - n - dots - sum(map(token.count, "- ()"))
    out.append(15 if letters > 0 else 16)
    if n == len(token):
        out.append(17)
    if dots == 3 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in token.split(".")):
        out.append(18)
    out.append(19 + (0 if end - start < 8 else 1 if end - start < 16 else 2 if end - start < 32 else 3))
    cue = None
    for cue in _CUES.finditer(text, max(0, start - 24), start):
        pass
    out.append(23 + (cue.lastindex if cue else 0))
    return tuple(out)


def label_nodes(nodes: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Label of each node by the base span that it overlaps, 0 for none."""
    labels = [0] * len(nodes)
    for kind, a, b in spans:
        k = int(np.searchsorted([e for _, e in nodes], a, side="right")) if nodes else 0
        while k < len(nodes) and nodes[k][0] < b:
            labels[k] = labels[k] or kind + 1
            k += 1
    return labels


def entities_of(text: str, nodes: list[tuple[int, int]]) -> list[tuple[list[int], bool]]:
    """(nodes, same): those of one key, and those of different keys with one end of eight digits; two nodes at least."""
    same: dict[str, list[int]] = {}
    near: dict[str, list[int]] = {}
    keys: dict[str, set[str]] = {}
    for k, (a, b) in enumerate(nodes):
        token = text[a:b]
        digits = _NOT_DIGIT.sub("", token)
        key = digits if len(digits) >= 6 and "@" not in token else token.lower() if "@" in token else None
        if key is None:
            continue
        same.setdefault(key, []).append(k)
        if len(digits) >= 8:
            near.setdefault(digits[-8:], []).append(k)
            keys.setdefault(digits[-8:], set()).add(key)
    return [(own, True) for own in same.values() if len(own) > 1] + [(own, False) for tail, own in near.items() if len(keys[tail]) > 1]


class SkipChainField:
    """Node weights by feature and label, chain potentials by pair of labels, skip potentials by kind of link."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, same: float = SAME, similar: float = SIMILAR):
        self.weights, self.chain = weights, chain
        n = len(LABELS)
        self.same, self.similar = same * np.eye(n), similar * np.eye(n)

    def marginals(self, scores: np.ndarray, edges: np.ndarray, kinds: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """P(label) of each node when the messages have settled. kinds: 0 chain, 1 same, 2 similar; owner: an edge's document.

        A document's messages stop on their own account, so that its result does not depend on the others.
        """
        if not len(edges):
            return _softmax(scores)
        tables = np.exp(np.stack([self.chain, self.same, self.similar]))
        down, up = np.zeros((len(edges), scores.shape[1])), np.zeros((len(edges), scores.shape[1]))
        live = np.arange(len(edges))
        for _ in range(MOST_ROUNDS):
            (a, b), table = edges[live].T, tables[kinds[live]]
            belief = scores.copy()
            np.add.at(belief, b, down[live])
            np.add.at(belief, a, up[live])
            moved = np.zeros(len(live))
            for mine, sent, how in ((down, belief[a] - up[live], "ei,eij->ej"), (up, belief[b] - down[live], "ej,eij->ei")):
                new = np.log(np.einsum(how, np.exp(sent - sent.max(axis=1, keepdims=True)), table) + 1e-30)
                step = 0.5 * (new - new.max(axis=1, keepdims=True) - mine[live])
                mine[live] += step
                moved = np.maximum(moved, np.abs(step).max(axis=1))
            most = np.zeros(owner.max() + 1)
            np.maximum.at(most, owner[live], moved)
            live = live[most[owner[live]] > SETTLED]
            if not len(live):
                break
        belief = scores.copy()
        np.add.at(belief, edges[:, 1], down)
        np.add.at(belief, edges[:, 0], up)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_rows(text: str) -> Iterator[str]:
    """One line a node whose label is known: its features, the labels left and right of it, those that the other mentions of
    its entity (same, similar) have, and its own; "-" where there is none.

    A node that no base pattern matches has the label none, unless it stands for an entity that one does match: its label
    is what the field shall find, so it is nobody's example. In its place, each matched number is an example as it would
    look elsewhere: its bare digits as another mention of the same entity, and their last eight as one of a similar one.
    """
    spans = base_spans(text)
    nodes = nodes_of(text, spans)
    labels: list[int | None] = [*label_nodes(nodes, spans)]
    hubs: list[dict[bool, str]] = [{} for _ in nodes]
    for members, same in entities_of(text, nodes):
        for k in members:
            others = {labels[j] for j in members if j != k} - {0, None}
            hubs[k][same] = str(min(others)) if len(others) == 1 else "-"
    for k, own in enumerate(hubs):
        if labels[k] == 0 and any(v != "-" for v in own.values()):
            labels[k] = None
    show = lambda k: "-" if k < 0 or k >= len(nodes) or labels[k] is None else str(labels[k])
    for k, (a, b) in enumerate(nodes):
        if labels[k] is not None:
            left = show(k - 1) if k and a - nodes[k - 1][1] <= 4 else "-"
            right = show(k + 1) if k + 1 < len(nodes) and nodes[k + 1][0] - b <= 4 else "-"
            yield f"{','.join(map(str, features(text, a, b)))}:{left}:{right}:{hubs[k].get(True, '-')}:{hubs[k].get(False, '-')}:{labels[k]}"
            digits = _NOT_DIGIT.sub("", text[a:b])
            for part, links in ((digits, f"{labels[k]}:-"), (digits[-8:], f"-:{labels[k]}")) if labels[k] > 1 and len(digits) >= 6 else ():
                near = text[max(0, a - 32) : a]
                yield f"{','.join(map(str, features(near + part, len(near), len(near) + len(part))))}:-:-:{links}:{labels[k]}"


def fit_rows_to_field(counted: dict[str, int]) -> SkipChainField:
    """Climbs the conditional likelihood of counted training rows."""
    n = len(LABELS)
    weights, chain, link = np.zeros((N_FEATURES, n)), np.zeros((n, n)), np.array([SAME, SIMILAR])
    weights[0, 0] = 4.0  # nothing seen: no label
    if not counted:
        return SkipChainField(weights, chain)
    parts = [r.split(":") for r in counted]
    one_hot = lambda k: np.array([np.eye(n)[int(p[k])] if p[k] != "-" else np.zeros(n) for p in parts])
    x = np.zeros((len(parts), N_FEATURES))
    for row, p in zip(x, parts, strict=True):
        row[[int(i) for i in p[0].split(",")]] = 1
    left, right, same, similar, target = map(one_hot, (1, 2, 3, 4, 5))
    share = np.array([*counted.values()], float)
    share /= share.sum()
    start = weights.copy(), chain.copy(), link.copy()
    moved = [np.zeros_like(weights), np.zeros_like(chain), np.zeros_like(link)]
    for _ in range(FIT_ROUNDS):
        score = x @ weights + left @ chain + right @ chain.T + link[0] * same + link[1] * similar
        error = share[:, None] * (_softmax(score) - target)
        steps = (x.T @ error, left.T @ error + error.T @ right, np.array([(error * same).sum(), (error * similar).sum()]))
        for value, first, step, speed in zip((weights, chain, link), start, steps, moved, strict=True):
            speed *= 0.9
            speed -= 0.5 * (step + DRAWN * (value - first))
            value += speed
    return SkipChainField(weights, chain, max(0.0, link[0]), max(0.0, link[1]))


def fit_field(docs: DataFrame, text_col: str = "text", rows: int = FIT_ROWS) -> SkipChainField:
    """Fits the field on labels of the base patterns in at most `rows` different texts, those of the smallest hashes.

    Training rows are counted on the executors; what reaches the driver has a row for a set of features and labels, of
    which there are a few hundred. Repeated texts count once.
    """
    own = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    h = F.xxhash64("text")
    total = own.agg(F.approx_count_distinct(h)).first()[0]
    spot = F.pmod(h, F.lit(1 << 20))
    few = own.where(spot <= int((1 << 20) * min(1.0, 4 * rows / max(1, total)))).select(h.alias("h")).distinct()
    chosen = F.broadcast(few.orderBy(F.pmod("h", F.lit(1 << 20)), "h").limit(rows))  # `rows` hashes at most
    sample = own.withColumn("h", h).join(chosen, "h").groupBy("h").agg(F.min("text").alias("text")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for key in training_rows(text):
                    seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["key", "n"])

    found = sample.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()
    return fit_rows_to_field({r["key"]: r["n"] for r in found})


def label_texts(texts: list[str], field: SkipChainField) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, added spans) of each text. Added ones never overlap a base span."""

    def held(labels: list[int]) -> np.ndarray:
        s = np.full(len(LABELS), HELD)
        s[labels] = 0.0
        return s

    out, nodes, scores, edges, kinds, owner, where = [], [], [], [], [], [], []
    for t, text in enumerate(texts):
        spans = base_spans(text)
        out.append((spans, []))
        if not spans:
            continue  # labels come from base spans alone: without one, nothing is carried on
        own = nodes_of(text, spans)
        labels = label_nodes(own, spans)
        first = len(nodes)
        for k, ((a, b), x) in enumerate(zip(own, labels, strict=True)):
            nodes.append((a, b))
            where.append((t, x))
            scores.append(held([x]) if x else field.weights[list(features(text, a, b))].sum(axis=0))
            if k and a - own[k - 1][1] <= 4:
                edges.append((first + k - 1, first + k))
                kinds.append(0)
        for members, same in entities_of(text, own):
            seen = sorted({labels[k] for k in members} - {0})
            edges += [(first + k, len(nodes)) for k in members]
            kinds += [1 if same else 2] * len(members)
            nodes.append((0, 0))
            where.append((t, -1))
            scores.append(held(seen) if seen else np.zeros(len(LABELS)))
        owner += [t] * (len(edges) - len(owner))
    if nodes:
        p = field.marginals(np.array(scores), np.array(edges, np.int64).reshape(-1, 2), np.array(kinds, np.int64), np.array(owner, np.int64))
        best = p.argmax(axis=1)
        linked = {a for (a, b), k in zip(edges, kinds, strict=True) if k and min(scores[b]) == HELD}  # to an entity that some base span shows
        for i in np.flatnonzero((best > 0) & (p.max(axis=1) >= THRESHOLD)).tolist():
            t, x = where[i]
            if not x and i in linked:
                out[t][1].append((int(best[i]) - 1, *nodes[i]))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, n_spans, found: one row for each row of docs.

    Null and empty texts have no spans; repeated rows and null ids keep their rows. The result of a text does not depend on the rows around it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_field(docs, text_col, fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            _, texts = ids_and_texts(batch)
            found = label_texts(texts, shared.value)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
            digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
            spans = [_joined(base + added) for base, added in found]
            total = [pa.array([len(a) for _, a in found], pa.int64()), pa.array([len(base) + len(a) for base, a in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digests), pa.array(spans), *total, pa.array([bool(s) for s in spans])], names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_spans", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long, found boolean")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each run of overlapping spans becomes the name of its first kind."""
    out, end = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= end:
            out += [text[end:a], f"<{KINDS[k].upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redact_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", fit_rows: int = FIT_ROWS) -> DataFrame:
    """docs with all spans replaced in their texts; chars_col, if there, follows texts that changed. All rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_field(docs, text_col, fit_rows))

    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        found = label_texts([t or "" for t in text], shared.value)
        return pd.Series([redact(t, base + added) if base else t for t, (base, added) in zip(text, found, strict=True)], dtype=object)

    new = unused(docs, "__clean")
    out = docs.withColumn(new, clean(F.col(text_col).cast("string")))
    changed = ~F.col(new).eqNullSafe(F.col(text_col))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col(new).alias(c))
        elif c == chars_col:
            columns.append(F.when(changed, F.length(new).cast(docs.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)
