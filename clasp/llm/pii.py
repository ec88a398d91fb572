"""Personal data: checked patterns, and boosted trees over candidates.

Four kinds of base spans come from patterns with a check each. Beyond them,
high-recall generators propose spans that may overlap: obfuscated or odd
addresses, numbers in other formats. Gradient-boosted trees score each
candidate by its format and context; per kind, the threshold is the least
one that keeps the wanted precision on rows the trees haven't seen. Base
spans always stay; of the rest, the likeliest of overlapping ones is kept.

The trees are fitted by Spark ML on a bounded set of labelled rows: made-up
personal data and decoys in many formats, set into texts of a bounded sample
of the documents, plus that sample's own base spans and failed matches.
Scoring is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clasp.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone")
#: The patterns of base spans, written so that each runs in time linear in the text.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[Span]:
    """Per kind, leftmost non-overlapping matches that pass their check."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:  # what stands before an @ can't hold another
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", max(end, at + 1))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m.group())]
    out += [("card", *m.span()) for m in _CARD.finditer(text)
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


#: Generators of candidates. Each is anchored at a character that is rare in prose and bounded in length.
_AT_WORD = re.compile(r"[\[({ ]at[\])} ]", re.I)
_DOT_DOMAIN = re.compile(r"\s?[A-Za-z0-9-]{1,63}(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s|\s?[\[({]\.[\])}]\s?|\.)"
                         r"[A-Za-z0-9-]{2,63}){1,4}", re.I)
_LEFT_PART = re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?$")
_IP_LIKE = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?[\[({]?\.[\])}]?\s?[0-9]{1,3}){3}(?![0-9.])")
_CARD_LIKE = re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){12,18}(?![0-9])")
_PHONE_LIKE = re.compile(r"(?<![0-9A-Za-z+])(?:\+|00\s?)?(?:\([0-9]{1,4}\)|[0-9]{2,4})(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9A-Za-z])")
_LONG = re.compile(r"(?<![0-9A-Za-z+])[0-9]{9,12}(?![0-9A-Za-z])")


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data; they may overlap."""
    out: list[Span] = []
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > 0 and at - start < 64 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and end - at < 128 and not text[end].isspace():
            end += 1
        if start < at and end > at + 1:
            out.append(("email", start, end))
        at = text.find("@", at + 1)
    for m in _AT_WORD.finditer(text):
        left, right = _LEFT_PART.search(text[max(0, m.start() - 66):m.start()]), _DOT_DOMAIN.match(text, m.end())
        if left and right:
            out.append(("email", max(0, m.start() - 66) + left.start(), right.end()))
    out += [("ip", *m.span()) for m in _IP_LIKE.finditer(text)]
    out += [("card", *m.span()) for m in _CARD_LIKE.finditer(text)]
    out += [("phone", *m.span()) for m in _PHONE_LIKE.finditer(text)]
    out += [("phone", *m.span()) for m in _LONG.finditer(text)]
    return out


#: Words near personal data, by kind.
CUES = {"email": ("mail", "contact", "write", "send"), "ip": ("ip", "host", "server", "address", "addr"),
        "card": ("card", "visa", "payment", "pay", "credit"), "phone": ("phone", "call", "tel", "fax", "mobile", "number")}
FEATURES = (*(f"is_{k}" for k in KINDS), "length", "digits", "letters", "spaces", "dashes", "dots", "parens", "slashes",
            "plus", "at_sign", "at_word", "dot_word", "luhn", "octets", "groups", "longest_group", "shortest_group",
            "distinct_digits", "own_cue", "other_cue", "money_or_unit", "before_alnum", "after_alnum", "before_eq_or_hash",
            "upper", "colon_before", "first_zero")


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    s, before = text[start:end], text[max(0, start - 32):start].lower()
    after = text[end:end + 8].lower()
    d = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    near = re.findall(r"[a-z]+", before)
    sizes = [len(g) for g in groups] or [0]
    low = s.lower()
    return [float(x) for x in (
        *(kind == k for k in KINDS), len(s), len(d), sum(c.isalpha() for c in s), s.count(" "), s.count("-"), s.count("."),
        s.count("(") + s.count(")") + s.count("[") + s.count("]"), s.count("/"), s.startswith("+"), s.count("@"),
        bool(_AT_WORD.search(s)), "dot" in low, bool(13 <= len(d) <= 19 and luhn(d)),
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups), len(groups), max(sizes), min(sizes),
        len(set(d)), any(w in CUES[kind] for w in near), any(w in c for k, c in CUES.items() if k != kind for w in near),
        bool(re.search(r"[$€£]\s*$", before)) or bool(re.match(r"\s*(%|kg|km|usd|eur)\b", after)),
        bool(before) and before[-1].isalnum(), bool(after) and after[0].isalnum(),
        bool(re.search(r"[=#/_]\s*[\"']?$", before)), sum(c.isupper() for c in s), bool(re.search(r":\s*$", before)),
        d[:1] == "0")]


@dataclass
class Trees:
    """Fitted trees as arrays, with the thresholds of each kind."""
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # feature (-1: leaf), split, right child, value
    thresholds: dict[str, float]

    def probability(self, rows: list[list[float]]) -> np.ndarray:
        x = np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))
        margin = np.zeros(len(x))
        for feature, split, right, value in self.nodes:
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := np.flatnonzero(feature[at] >= 0)).size:
                here = at[inner]
                at[inner] = np.where(x[inner, feature[here]] <= split[here], here + 1, right[here])
            margin += value[at]
        return 1 / (1 + np.exp(-2 * margin))


def _arrays(tree, weight: float) -> tuple[np.ndarray, ...]:
    """A Spark ML tree in pre-order: a node's left child follows it."""
    feature, split, right, value = [], [], [], []

    def add(node) -> None:
        here = len(feature)
        inner = node.getClass().getSimpleName() == "InternalNode"
        feature.append(node.split().featureIndex() if inner else -1)
        split.append(node.split().threshold() if inner else 0.0)
        right.append(0)
        value.append(0.0 if inner else node.prediction() * weight)
        if inner:
            add(node.leftChild())
            right[here] = len(feature)
            add(node.rightChild())
    add(tree._java_obj.rootNode())
    return tuple(np.array(x) for x in (feature, split, right, value))


def _with_check_digit(r: random.Random, n: int) -> str:
    body = "".join(r.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _grouped(digits: str, size: int, sep: str) -> str:
    return sep.join(digits[i:i + size] for i in range(0, len(digits), size))


def made_up(r: random.Random) -> tuple[str, str, bool]:
    """``(kind, string, is personal data)``: formats that base patterns
    miss or take, and decoys that look like them."""
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    kind = r.choice(KINDS)
    if r.random() < 0.5:
        if kind == "email":
            name, host, top = f"{word()}.{num(2)}", word() + num(1), r.choice(["com", "org", "net", "de"])
            at = r.choice(["@", " [at] ", " (at) ", " at ", "[at]", "(at)"])
            dot = r.choice([".", " [dot] ", " dot ", "(dot)"]) if at != "@" else "."
            return kind, f"{name}{at}{host}{dot}{top}", True
        if kind == "ip":
            return kind, r.choice([".", "[.]", "(.)", " . "]).join(str(r.randint(0, 255)) for _ in range(4)), True
        if kind == "card":
            return kind, _grouped(_with_check_digit(r, 16), r.choice([4, 4, 16]), r.choice(["", " ", "-", ".", "/", "  "])), True
        sep = r.choice(["-", " ", "."])
        return kind, r.choice([f"+1 ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}{sep}{num(4)}",
                               f"{num(3)}{sep}{num(3)}{sep}{num(4)}", f"00{num(2)} {num(3)} {num(3)} {num(3)}",
                               f"+{num(2)} {num(3)} {num(3)} {num(4)}"]), True
    if kind == "email":
        return kind, r.choice([f"@{word()}", f"{word()}@{word()}", f"{num(2)}@{num(3)}", f"{word()} at {word()}.{word()}",
                               f"{word()}@{num(1)}", f"{word()}:{word()}@"]), False
    if kind == "ip":
        return kind, r.choice([".".join(str(r.randint(256, 999)) for _ in range(4)), f"{num(1)}.{num(1)}.{num(3)}.{num(3)}9",
                               f"{r.randint(1, 9)} . {r.randint(1, 9)}. {r.randint(1, 9)} .{num(3)}"]), False
    if kind == "card":
        n = r.randint(13, 19)
        body = num(n)
        while luhn(body):
            body = num(n)
        return kind, _grouped(body, r.choice([3, 4, 5, 19]), r.choice(["", " ", "-", "."])), False
    return kind, r.choice([f"{r.randint(1900, 2099)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{num(2)}/{num(2)}/{num(4)}",
                           num(r.randint(9, 12)), f"{num(2)}.{num(2)}.{num(2)}", f"{num(4)} {num(4)} {num(4)}",
                           f"{num(2)}-{num(2)}-{num(2)}-{num(2)}", f"{num(3)} {num(2)} {num(2)}"]), False


def labelled_rows(text: str, made: int, seed: int) -> list[tuple[float, str, list[float]]]:
    """``(label, kind, features)`` from made-up strings set between words of
    a text, and from the text's own spans."""
    r, rows, words = random.Random(seed), [], text.split()
    for _ in range(made if words else 0):
        k = r.randrange(len(words))
        kind, s, good = made_up(r)
        cue = r.choice(CUES[kind]) + r.choice([" ", ": "]) if r.random() < 0.3 else ""
        head = " ".join(words[max(0, k - 6):k]) + " " + cue
        around = head + s + r.choice([" ", ". ", ", "]) + " ".join(words[k:k + 6])
        for span in candidates(around):
            if span[0] == kind and span[1] < len(head) + len(s) and span[2] > len(head):
                whole = abs(span[1] - len(head)) <= 1 and abs(span[2] - len(head) - len(s)) <= 2
                rows.append((float(good and whole), kind, features(around, span)))
    base = base_spans(text)
    rows += [(1.0, b[0], features(text, b)) for b in base]
    rows += [(0.0, c[0], features(text, c)) for c in candidates(text)
             if c[0] == "card" and not any(b[1] < c[2] and c[1] < b[2] for b in base)]
    return rows


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2_000, made: int = 4_000,
        precision: float = 0.98, iterations: int = 12, depth: int = 4, seed: int = 7) -> Trees:
    """Boosted trees and thresholds. The sample is the rows whose id hash
    lies below ``sample_rows`` / row count; each whole text gives its share
    of ``made`` strings, in its own task. Three quarters of the labelled
    rows fit the trees, the rest the thresholds."""
    spark = docs.sparkSession
    n = docs.count()
    rate = int(min(1.0, sample_rows / max(1, n)) * 1_000_000)
    share = -(-made // max(1, min(n, sample_rows)))
    hashed = F.pmod(F.xxhash64(F.lit("pii"), F.col(id_col).cast("string")), F.lit(1_000_000))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(h, i, *row) for h, t in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist())
                for i, row in enumerate(labelled_rows(t, share, seed + h))]
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.float64(), pa.string(), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["h", "i", "label", "kind", "features"])
    sample = docs.where((hashed < rate) & F.col(text_col).isNotNull()).select(hashed.alias("h"), F.col(text_col).alias("text"))
    found = arrow_map(sample, run, "h long, i int, label double, kind string, features array<double>").orderBy("h", "i").collect()
    rows = [(r.label, r.kind, list(r.features)) for r in found]
    rows = rows or labelled_rows("a text of few words to stand around", made, seed)
    train = spark.createDataFrame([(y, Vectors.dense(x)) for i, (y, _, x) in enumerate(rows) if i % 4], ["label", "features"])
    model = GBTClassifier(maxIter=iterations, maxDepth=depth, seed=seed).fit(train.coalesce(1))
    trees = Trees([_arrays(t, w) for t, w in zip(model.trees, model.treeWeights)], {})
    test = rows[::4]
    p = trees.probability([x for _, _, x in test])
    for kind in KINDS:
        ranked = sorted(((p[i], y) for i, (y, k, _) in enumerate(test) if k == kind), reverse=True)
        good, best = 0.0, math.inf
        for place, (score, y) in enumerate(ranked, 1):
            good += y
            if good / place >= precision and (place == len(ranked) or ranked[place][0] < score):
                best = score
        trees.thresholds[kind] = max(float(best), 0.5)
    return trees


def all_spans(text: str, trees: Trees | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and those with the added ones; by kind, then start."""
    order = lambda s: (KINDS.index(s[0]), s[1])
    base = base_spans(text)
    out = list(base)
    proposed = candidates(text) if trees else []
    proposed = [c for c in proposed if not any(b[1] < c[2] and c[1] < b[2] for b in base)]
    if proposed:
        p = trees.probability([features(text, c) for c in proposed])
        for score, c in sorted(zip(p.tolist(), proposed), key=lambda x: (-x[0], order(x[1]), x[1][2])):
            if score >= trees.thresholds[c[0]] and not any(b[1] < c[2] and c[1] < b[2] for b in out):
                out.append(c)
    return sorted(base, key=order), sorted(out, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans),
    ``base_sha256, spans, redacted``, one row per input row.

    Offsets are code points, ends exclusive. ``redacted`` is the text with
    every span replaced by its kind in angle brackets. A null text counts as
    empty (its redaction is null). Without ``trees``, base spans only. Other
    columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(7)]
        for text in batch.column("text").to_pylist():
            base, every = all_spans(text or "", sent.value)
            kinds = [s[0] for s in base]
            row = [*(kinds.count(k) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every),
                   None if text is None else redact(text, every)]
            for col, v in zip(cols, row):
                col.append(v)
        types = [pa.int64()] * 4 + [pa.string()] * 3
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run,
                     f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                     "spans string, redacted string")


def redact(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append(f"<{kind}>")
        at = end
    return "".join([*out, text[at:]])
