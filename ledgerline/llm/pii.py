"""Personal data by weak supervision.

Patterns propose spans. Labelers vote on each one (for, against or not at all): the strict pattern,
the span's inner structure, a gazetteer, the words before it and the characters beside it. Expectation
maximisation over the counted vote patterns estimates each labeler's reliability per kind and the
chance that a span is personal data; a logistic classifier of votes and shape is trained on those
chances and decides on spans that the strict patterns don't already give.

Only counts of distinct vote and shape patterns reach the driver; there are at most some thousands,
whatever the data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import map_rows, quoted, task_rows

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
CONTEXT_CHARS = 40
LABELERS = 5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits whose start did not match.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED_MAIL = re.compile(
    r"(?<![\w.%+-])[\w.%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{2,63}){1,5}"
)
_NATIONAL_PHONE = re.compile(r"(?<![\w+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?!\w)")
_SHORT_CARD = re.compile(r"(?<![\w-])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![\w-])")

# Common top-level domains, country calling codes and card issuer prefixes.
TOP_DOMAINS = frozenset("com org net edu gov mil int info io co ai app dev de fr es it uk nl ch at be eu us ca au jp".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49",
                 "52", "55", "61", "81", "82", "86", "91")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
CUES = {
    "email": re.compile(r"\b(e-?mail|mail|contact|write|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(ip|host|server|address|addr|from|login)\b", re.I),
    "card": re.compile(r"\b(card|credit|visa|mastercard|amex|payment|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(phone|tel|telephone|call|mobile|fax|cell|telefon|llamar)\b", re.I),
}
DOUBTS = re.compile(r"\b(version|isbn|order|invoice|serial|ticket|article|section|id|no)\b\W*$", re.I)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the strict patterns, leftmost and non-overlapping per kind, by kind and start."""
    found = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    """Further spans that may be personal data."""
    found = []
    if "(at" in text or "[at" in text:
        found += [("email", *m.span()) for m in _SPELLED_MAIL.finditer(text)]
    found += [("card", *m.span()) for m in _SHORT_CARD.finditer(text)]
    found += [("phone", *m.span()) for m in _NATIONAL_PHONE.finditer(text)]
    return found


def votes(text: str, kind: str, start: int, end: int, strict: bool) -> tuple[int, ...]:
    """Votes of the labelers: 1 for, -1 against, 0 none."""
    span, digits = text[start:end], _digits(text[start:end])
    if kind == "email":
        last = re.split(r"[.)\] ]+", span.rstrip("])"))[-1].lower()
        structure, gazetteer = (1 if last.isalpha() and 2 <= len(last) <= 24 else -1), (1 if last in TOP_DOMAINS else 0)
    elif kind == "ip":
        parts = span.split(".")
        structure = -1 if any(len(p) > 1 and p[0] == "0" for p in parts) else 1
        gazetteer = -1 if parts[0] in ("0", "127", "255") else 1
    elif kind == "card":
        structure = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    else:
        structure = 1 if 10 <= len(digits) <= 13 else -1
        gazetteer = (1 if digits.startswith(CALLING_CODES) else -1) if span[0] == "+" else (-1 if digits[0] in "01" else 0)
    before = text[max(0, start - CONTEXT_CHARS) : start]
    context = 1 if CUES[kind].search(before) else -1 if DOUBTS.search(before) else 0
    beside = text[start - 1 : start] + text[end : end + 1]
    edge = -1 if any(c.isalnum() or c in "_@/" for c in beside) else 1
    return (1 if strict else 0, structure, gazetteer, context, edge)


def candidates(text: str | None) -> list[tuple[str, int, int, bool, tuple[int, ...], int]]:
    """All proposed spans: kind, start, end, strict, votes, shape."""
    if not text:
        return []
    strict = strict_spans(text)
    out = [(k, s, e, True) for k, s, e in strict]
    taken = [(s, e) for _, s, e in strict]
    for k, s, e in loose_spans(text):
        if all(e <= a or s >= b for a, b in taken):
            out.append((k, s, e, False))
            taken.append((s, e))
    return [(k, s, e, b, votes(text, k, s, e, b), min((e - s) // 8, 5)) for k, s, e, b in out]


def pattern(kind: str, vote: tuple[int, ...], shape: int) -> str:
    return f"{kind}:{','.join(map(str, vote))}:{shape}"


def parse_pattern(key: str) -> tuple[str, tuple[int, ...], int]:
    kind, vote, shape = key.split(":")
    return kind, tuple(map(int, vote.split(","))), int(shape)


def _count(parts):
    held: dict[str, int] = {}
    for part in parts:
        for text in part.column("text").to_pylist():
            for kind, _, _, _, vote, shape in candidates(text):
                key = pattern(kind, vote, shape)
                held[key] = held.get(key, 0) + 1
    yield {"pattern": list(held), "n": list(held.values())}


def reliabilities(counts: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """Chance that a span of each pattern is personal data, by expectation maximisation.

    Per kind, spans are true or not, and a labeler votes with probabilities that depend on that
    alone. It starts from the majority of the votes; one pseudo-count keeps all chances inside (0, 1).
    """
    chance: dict[str, float] = {}
    for kind in KINDS:
        keys = [k for k in counts if parse_pattern(k)[0] == kind]
        if not keys:
            continue
        vote = np.array([parse_pattern(k)[1] for k in keys])
        weight = np.array([counts[k] for k in keys], dtype=float)
        true = 1 / (1 + np.exp(-vote.sum(axis=1).astype(float) + 0.5))
        for _ in range(rounds):
            log = np.zeros((2, len(keys)))
            for y, share in enumerate((1 - true, true)):
                mass = weight * share
                log[y] = np.log((mass.sum() + 1) / (weight.sum() + 2))
                for j in range(LABELERS):
                    p = np.array([mass[vote[:, j] == v].sum() for v in (-1, 0, 1)]) + np.array([(2, 1, 0.5), (0.5, 1, 2)][y])
                    log[y] += np.log(p / p.sum())[vote[:, j] + 1]
            true = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        chance.update(zip(keys, true.tolist(), strict=True))
    return chance


@dataclass
class SpanClassifier:
    weights: np.ndarray

    @staticmethod
    def features(keys: list[str]) -> np.ndarray:
        """Kind, each vote by kind, and shape, one-hot."""
        x = np.zeros((len(keys), len(KINDS) * (1 + LABELERS * 3) + 6))
        for row, key in enumerate(keys):
            kind, vote, shape = parse_pattern(key)
            base = KINDS.index(kind) * (1 + LABELERS * 3)
            x[row, base] = 1
            for j, v in enumerate(vote):
                x[row, base + 1 + 3 * j + v + 1] = 1
            x[row, -6 + shape] = 1
        return x

    @classmethod
    def fit(cls, chance: dict[str, float], counts: dict[str, int], rounds: int = 25) -> SpanClassifier:
        """Ridge logistic regression on the estimated chances, by Newton steps."""
        keys = sorted(chance)
        x = cls.features(keys)
        y = np.array([chance[k] for k in keys])
        n = np.log1p(np.array([counts[k] for k in keys], dtype=float))  # frequent patterns count more, not all
        w = np.zeros(x.shape[1])
        for _ in range(rounds if keys else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (n * (y - p)) - 0.1 * w
            w += np.linalg.solve(x.T @ (x * (n * np.maximum(p * (1 - p), 1e-4))[:, None]) + 0.1 * np.eye(len(w)), slope)
        return cls(w)

    def chance(self, key: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features([key])[0] @ self.weights, -30, 30))))


def train(docs: DataFrame, text_col: str = "text") -> SpanClassifier:
    """The span classifier of a corpus, from the votes on all its spans."""
    slim = docs.select(F.col(quoted(text_col)).cast("string").alias("text")).where("text is not null")
    partial = task_rows(slim, "pattern string, n bigint", _count, 4 << 20)
    counts = {r["pattern"]: r["n"] for r in partial.groupBy("pattern").agg(F.sum("n").alias("n")).collect()}
    return SpanClassifier.fit(reliabilities(counts), counts)


def model_spans(texts: list[str | None], model: SpanClassifier) -> list[list[dict]]:
    """Spans of each text: strict ones and those the classifier accepts, by kind and start."""
    known: dict[str, float] = {}
    result = []
    for text in texts:
        spans = []
        for kind, start, end, strict, vote, shape in candidates(text):
            key = pattern(kind, vote, shape)
            if key not in known:
                known[key] = model.chance(key)
            if strict or known[key] >= ACCEPT:
                spans.append((KINDS.index(kind), start, end, strict, known[key]))
        spans.sort()
        result.append([{"kind": KINDS[k], "start": s, "end": e, "strict": b, "chance": p} for k, s, e, b, p in spans])
    return result


def find(docs: DataFrame, model: SpanClassifier, text_col: str = "text", out: str = "result") -> DataFrame:
    """Rows of ``docs`` as struct ``row`` beside a struct ``out`` with the array ``spans``.

    A span has ``kind``, ``start`` and ``end`` (code points, end exclusive), ``strict`` (given by a
    strict pattern, always kept) and ``chance``; spans are ordered by kind (as in ``KINDS``) and
    start. Null and empty texts have none. Rows are independent; other columns are carried along.
    """

    def run(block):
        return {"spans": model_spans(block["text"], model)}

    spans = "spans array<struct<kind:string,start:bigint,end:bigint,strict:boolean,chance:double>>"
    return map_rows(docs, {"text": F.col(quoted(text_col)).cast("string")}, spans, run, out)


def mask(text: str | None, spans: list[dict]) -> str | None:
    """The text with each span replaced by its kind; of overlapping spans the first and longest counts."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind']}>"]
        at = s["end"]
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SpanClassifier, text_col: str = "text", out: str = "result") -> DataFrame:
    """Rows of ``docs`` as struct ``row`` beside a struct ``out``: the ``text`` with its spans masked
    and ``n_spans``. Null stays null."""

    def run(block):
        spans = model_spans(block["text"], model)
        masked = [mask(t, s) for t, s in zip(block["text"], spans, strict=True)]
        return {"text": masked, "n_spans": [len(s) for s in spans]}

    return map_rows(docs, {"text": F.col(quoted(text_col)).cast("string")}, "text string, n_spans bigint", run, out)
