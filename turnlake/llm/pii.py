"""Personal data by weak supervision.

Strict patterns give the base spans, which always stay. Looser patterns give further candidates: written-out addresses, telephone numbers
without a plus, long IP addresses, card numbers with a slip. Labelers (a pattern's shape, a gazetteer, the words before it, a check of the
value) vote on base spans and candidates alike. Spark counts the vote patterns; expectation-maximisation over the counts estimates how
reliable each labeler is, and a logistic span classifier is fitted to the posteriors. Candidates that it accepts join the base spans.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.llm.arrow import text_slices, texts
from turnlake.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
#: Endings of mail domains, first digits of card issuers, and words that speak for or against a kind.
DOMAIN_ENDINGS = frozenset("com org net edu gov mil int info biz io ai app dev co uk de fr es it nl be ch at eu us ca au jp cn in br ru se no dk fi pl pt".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "30", "6011", "65", "35", "62")
CONTEXT = {
    "email": "email e-mail mail contact write reach address courriel correo kontakt".split(),
    "ip": "ip address host server login client from adresse".split(),
    "card": "card visa mastercard amex credit debit payment carte tarjeta karte kreditkarte".split(),
    "phone": "phone tel telephone call mobile cell fax whatsapp dial number appel telefon telefono".split(),
}
AGAINST = frozenset("version isbn issn order invoice id token page part model serial doi ref hash commit chapter section figure".split())

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.@-])(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9A-Za-z@-])")
_AT = re.compile(r" ?[\[({] ?at ?[\])}] ?| at ", re.I)
_DOTTED = re.compile(r"[A-Za-z0-9-]++(?:(?: ?[\[({] ?dot ?[\])}] ?| dot |\.)[A-Za-z0-9-]++)+", re.I)
_DOT = re.compile(r" ?[\[({] ?dot ?[\])}] ?| dot |\.", re.I)
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]*+(?<=[0-9A-Fa-f:])(?![0-9A-Za-z:])")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The strict patterns' spans, leftmost and without overlap within a kind, in order of start and then kind."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p) < 20 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m[0])
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidate_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of the looser patterns that touch no base span and no earlier candidate."""
    found: list[Span] = []
    if " at " in text or "[" in text or "(" in text or "{" in text:
        for m in _AT.finditer(text):
            start, domain = m.start(), _DOTTED.match(text, m.end())
            while start and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < m.start() and domain:
                found.append(("email", start, domain.end()))
    if ":" in text:  # eight groups, or fewer around a gap: not a clock time, nor the six of a network card
        found += [("ip", *m.span()) for m in _IP6.finditer(text) if (m[0].count(":") == 7 or "::" in m[0]) and len(m[0]) > 2 and max(map(len, m[0].split(":"))) <= 4]
    if _DIGIT.search(text):
        found += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(_digits(m[0])) <= 19]
        found += [("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    starts = [a for _, a, _ in base]  # in order
    reach = list(accumulate((b for _, _, b in base), max))  # how far the base spans up to each one go
    out: list[Span] = []
    for s in sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))):
        earlier = bisect_left(starts, s[2])
        if (not out or s[1] >= out[-1][2]) and not (earlier and reach[earlier - 1] > s[1]):
            out.append(s)
    return out


def words_of(text: str) -> tuple[list[int], list[str]]:
    """Where the text's words end, and the words."""
    found = [(m.end(), m[0]) for m in _WORD.finditer(text)]
    return [e for e, _ in found], [w for _, w in found]


def votes(text: str, span: Span, words: tuple[list[int], list[str]] | None = None) -> str:
    """The labelers' votes on a span and two of its features, one character each: shape, gazetteer, context, value; length, separators.

    The context is the five words before the span, however far they are; ``words`` are the text's, to find once for many spans.
    """
    kind, start, end = span
    value = text[start:end]
    ends, known = words or words_of(text)
    last = bisect_right(ends, start)
    before = [w.lower() for w in known[max(0, last - 5) : last]]
    digits = _digits(value)
    context = "+" if any(w in CONTEXT[kind] for w in before) else "-" if any(w in AGAINST for w in before) else "0"
    if kind == "email":
        labels = _DOT.split(re.split(r"@|" + _AT.pattern, value, maxsplit=1, flags=re.I)[-1])
        shape = "+" if "@" in value or re.search(r"[\[({] ?at", value, re.I) else "-"
        gazetteer = "+" if labels[-1].lower() in DOMAIN_ENDINGS else "-"
        check = "+" if all(x and x[0] != "-" and x[-1] != "-" for x in labels) and labels[-1].isalpha() else "-"
    elif kind == "ip":
        shape = "+" if value.count(":") == 7 or "::" in value[1:-1] or value.count(".") == 3 else "-"
        gazetteer = "+" if value.startswith(("2001", "2a0", "fe80", "fd", "10.", "192.168.")) else "0"
        try:
            ipaddress.ip_address(value)
            check = "+"
        except ValueError:
            check = "-"
    elif kind == "card":
        shape = "+" if re.fullmatch(r"[0-9]{15,16}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", value) else "-"
        gazetteer = "+" if digits.startswith(CARD_STARTS) else "-"
        check = "+" if _luhn(digits) else "-"
    else:
        groups = re.findall(r"[0-9]+", value)
        shape = "+" if value[0] == "+" or [*map(len, groups)][-3:] == [3, 3, 4] else "-"
        gazetteer = "+" if value[0] == "+" or groups[0][0] not in "1" and value[0] in "(0" else "0" if groups[0][0] in "23456789" else "-"
        check = "+" if 10 <= len(digits) <= 13 else "-"
    length = min(len(digits) // 4, 5)
    return f"{kind}{shape}{gazetteer}{context}{check}{length}{'s' if re.search(r'[ .-]', value) else 'n'}"


def _em(patterns: np.ndarray, weight: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of "personal" for each row of votes (0, 1, 2 for against, silent, for) of conditionally independent labelers."""
    n, labelers = patterns.shape
    belief = np.clip(0.5 + 0.4 * np.sign((patterns - 1).sum(1)), 0.1, 0.9)
    onehot = np.stack([patterns == v for v in range(3)], axis=2).astype(float)
    for _ in range(rounds):
        logs = []
        for b in (belief, 1 - belief):
            mass = np.einsum("n,nlv->lv", b * weight, onehot) + 1.0
            rate = np.log(mass / mass.sum(1, keepdims=True))
            prior = np.log(((b * weight).sum() + 1) / (weight.sum() + 2))
            logs.append(prior + np.einsum("nlv,lv->n", onehot, rate))
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        if np.abs(new - belief).max() < 1e-9:
            break
        belief = new
    return belief


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method for soft labels; returns the fitted probabilities."""
    theta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        grad = x.T @ (weight * (p - y)) + ridge * theta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    return 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))


def train(counts: Iterable[tuple[str, int]]) -> dict[str, float]:
    """The span classifier as a table from vote pattern to probability. There are at most some thousand patterns, whatever the input."""
    model: dict[str, float] = {}
    for kind in KINDS:
        rows = sorted((p, n) for p, n in counts if p.startswith(kind))
        if not rows:
            continue
        tails = [p[len(kind) :] for p, _ in rows]
        weight = np.array([n for _, n in rows], float)
        cast = np.array([["-0+".index(c) for c in t[:4]] for t in tails])
        belief = _em(cast, weight)
        columns = [np.ones(len(rows)), *[(cast[:, j] == v).astype(float) for j in range(4) for v in (0, 2)]]
        columns += [np.array([t[4] == str(d) for t in tails], float) for d in range(6)]
        columns.append(np.array([t[5] == "s" for t in tails], float))
        fitted = _logistic(np.stack(columns, 1), belief, weight / max(1.0, weight.max() / 1e4))
        model |= dict(zip((p for p, _ in rows), fitted.tolist(), strict=True))
    return model


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)``: every base span and candidate as a struct ``kind, start, end, base, votes``; offsets are code points."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            rows = []
            for text in texts(batch, 1):
                base = base_spans(text)
                both = [(s, True) for s in base] + [(s, False) for s in candidate_spans(text, base)]
                words = words_of(text) if both else None
                rows.append([{"kind": s[0], "start": s[1], "end": s[2], "base": b, "votes": votes(text, s, words)} for s, b in both])
            column = pa.array(rows, pa.list_(pa.struct(fields)))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["id", "spans"])

    return source.mapInArrow(run, f"id {kind}, spans array<struct<kind: string, start: long, end: long, base: boolean, votes: string>>")


def fit(found: DataFrame) -> dict[str, float]:
    """Train on the vote patterns of all spans in a table of :func:`detect`."""
    patterns = found.select(F.explode("spans.votes").alias("votes")).groupBy("votes").count()
    return train([(r["votes"], r["count"]) for r in patterns.collect()])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(id, spans)``, one row per document: base spans and accepted candidates, as structs ``kind, start, end, base``, by start and kind.

    Null and empty texts have no spans; texts of any length are read whole; null ids and repeated rows stay (a repeated row counts again in
    training); other columns are ignored; an empty table gives an empty result and trains nothing.
    """
    found = materialize(detect(docs, id_col, text_col), "spans")
    accepted = sorted(p for p, x in fit(found).items() if x >= threshold)
    keep = F.filter("spans", lambda s: s["base"] | s["votes"].isin(accepted) if accepted else s["base"])
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.array_sort(
        F.transform(keep, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["base"].alias("base"), s["kind"].alias("kind")))
    )
    spans = F.transform(ranked, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    return found.select(F.col("id").alias(id_col), spans.alias("spans"))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The same rows and columns with the personal data in the text masked. Null texts stay null."""
    kept = docs.schema
    at = docs.columns.index(text_col)
    # The model is fitted on all rows first; spans are then found again beside the text, so rows need no key.
    found = materialize(detect(docs.select(F.lit(0).alias("none"), text_col), "none", text_col), "spans")
    accepted = frozenset(p for p, x in fit(found).items() if x >= threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, at):
            new = []
            for x in batch.column(at):
                text = x.as_py()
                if text:
                    base = base_spans(text)
                    more = candidate_spans(text, base)
                    words = words_of(text) if more else None
                    more = [s for s in more if votes(text, s, words) in accepted]
                    text = masked(text, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]))))
                new.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, kept)
