"""Personal data by weak supervision.

Fixed patterns find the base spans (e-mail, IP, card, phone), which always stay.
Wider patterns propose further candidates (obfuscated e-mail, national phone
numbers, identifiers, secrets).  Regex, gazetteer and context labelers vote on
every candidate; expectation-maximisation over the counts of vote patterns in
the whole corpus estimates how reliable each labeler is; the resulting soft
labels train a logistic span classifier, which decides on the further
candidates.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "identifier", "national_phone", "obfuscated_email", "secret")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    """Four numbers joined by dots at a time, from the left of each dotted run."""
    out = []
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at = m.start()
        parts = m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, at + size))
            at += size + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(ch for ch in text if "0" <= ch <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The fixed patterns' spans (code points, end exclusive), leftmost and without overlap
    per kind; matches that fail their check are dropped."""
    out = {k: [] for k in BASE}
    if "@" in text:
        out["email"] = _emails(text)
    if _DIGIT.search(text):
        out["ip"] = _ips(text)
        for m in _CARD.finditer(text):
            if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text)
                            if 9 <= len(_digits(m.group())) <= 15]
    return out


_WIDER = {
    "identifier": re.compile(
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
        r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20?[A-Z0-9]{4}){3,7}"
        r"(?:\x20?[A-Z0-9]{1,3})?|(?:\x20?[A-Z0-9]{4}){2}\x20?[A-Z0-9]{3})(?![A-Za-z0-9])"),
    "national_phone": re.compile(
        r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-]?[0-9])"),
    "obfuscated_email": re.compile(
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
        r"[a-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[a-z0-9-]{1,63}){1,5}"),
    "secret": re.compile(
        r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
        r"|(?i:(?<![a-z])(?:password|passwd|pwd|token|secret|api[_-]?key)\x20{0,2}[=:]\x20{0,2}"
        r"[\"']?[^\s\"']{6,}+[\"']?)"),
}


_AT = re.compile(r"(?i)\(at\)|\[at\]|\x20at\x20")
_SENTENCE = re.compile(r"\.\x20(?=[A-Z])")


def _last_label(span: str) -> str:
    return re.split(r"[^A-Za-z0-9]+", span.rstrip(")]. "))[-1].lower()


def _obfuscated(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern, without the sentence behind a known top-level domain.  A match
    without one may hide the next address, so the search goes on inside it."""
    pattern = _WIDER["obfuscated_email"]
    m = pattern.search(text)
    while m:
        start, end = m.span()
        stop = next((start + d.start() for d in _SENTENCE.finditer(m.group())
                     if pattern.fullmatch(text, start, start + d.start())
                     and _last_label(text[start:start + d.start()]) in _TLDS), None)
        yield start, stop or end
        inside = stop is None and _last_label(m.group()) not in _TLDS
        m = pattern.search(text, _AT.search(text, start).end() if inside else stop or end)


def _iban(span: str) -> bool:
    moved = span.replace(" ", "")
    moved = moved[4:] + moved[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _identifiers(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern; an IBAN ends where its check digits hold, since a word in
    capitals behind it may look like one more group."""
    for m in _WIDER["identifier"].finditer(text):
        start, end = m.span()
        stops = [end, *(i for i in range(end - 1, start + 14, -1) if text[i] == " ")]
        if "-" not in m.group():
            end = next((i for i in stops if _iban(text[start:i])), end)
        yield start, end


class Taken:
    """Spans in order, to find those that overlap another one without walking all of them."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [s for s, _ in self.spans]
        self.ends = list(accumulate((e for _, e in self.spans), max))

    def over(self, start: int, end: int) -> list[tuple[int, int]]:
        """The spans that overlap [start, end), in order."""
        some = self.spans[bisect_right(self.ends, start):bisect_left(self.starts, end)]
        return [(s, e) for s, e in some if e > start]


def _outside(start: int, end: int, taken: Taken) -> Iterator[tuple[int, int]]:
    """The parts of a span that lie in no taken span."""
    for s, e in taken.over(start, end):
        if s > start:
            yield start, s
        start = max(start, e)
    if start < end:
        yield start, end


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int]]:
    """Further candidates, each kind leftmost, none overlapping a base span but secrets whose
    value has begun before it (``all_spans`` then gives the parts around it)."""
    digit = bool(_DIGIT.search(text))
    run = {"identifier": digit, "national_phone": digit,
           "obfuscated_email": any(at in text.lower() for at in ("(at)", "[at]", " at ")),
           "secret": "AKIA" in text or "=" in text or ":" in text}
    taken = Taken([s for spans in base.values() for s in spans])
    out = []
    for kind, wanted in run.items():
        spans = _obfuscated(text) if kind == "obfuscated_email" else (
            _identifiers(text) if kind == "identifier" else (
                m.span() for m in _WIDER[kind].finditer(text)))
        for start, end in spans if wanted else ():
            over = taken.over(start, end)
            if not over:
                out.append((kind, start, end))
            elif kind == "secret" and _WIDER[kind].match(text, start, max(over[0][0], start)):
                out.append((kind, start, end))
    return out


# Gazetteers and context words of the labelers.
_TLDS = frozenset("com org net edu gov io de fr es uk eu info".split())
_NAMES = frozenset("""
    adam alan alex alice amy ana andrea andrew angela anna anne anthony antonio barbara ben bob
    brian carla carlos carmen carol charles charlotte chris claire claudia daniel david diana
    diego elena elizabeth emily emma eric eva felix francis frank george hans helen henry irene
    isabel jack james jan jane javier jean jennifer jim joan joe johann john jorge jose joseph
    juan julia karen karl katharina kevin klaus laura lea leo linda lisa louis lucas lucia luis
    marc maria marie mark marta martin mary max michael miguel monica nicole nina olivia pablo
    patricia paul pedro peter petra philip pierre rachel ralf richard robert rosa ruth sabine
    sam sara sarah sophie stefan steven susan teresa thomas tim tom ursula uwe victor walter
""".split())
_KEY_HEADS = ("AKIA", "ghp_", "sk-", "xox")
_CONTEXT = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "whatsapp"),
    "identifier": ("ssn", "social", "iban", "account", "konto", "cuenta"),
    "secret": ("password", "token", "secret", "key", "pwd", "credential"),
}
_CONTEXT |= {"obfuscated_email": _CONTEXT["email"], "national_phone": _CONTEXT["phone"]}
_AGAINST = ("version", "isbn", "figure", "page", "section", "commit", "chapter", "article")


def _named(span: str) -> bool:
    """Whether the part before "at" looks like a person's mailbox: a first name among its
    parts, or letters joined to figures, dots or underscores."""
    local = re.split(r"(?i)\x20at\x20", span)[0]
    parts = re.split(r"[^A-Za-z]+", local.lower())
    return bool(_NAMES & set(parts)) or bool(re.fullmatch(
        r"[A-Za-z]+[0-9._+-]+[A-Za-z0-9._+-]*[A-Za-z0-9]", local))


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Votes of the labelers on one span: 1 personal, -1 not, 0 abstains."""
    span, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - 40):start].lower()
    out = []
    # Regex: the strict form of the kind.
    strict = {"email": r"[\w.%+-]+@(?:[\w-]+\.)+[A-Za-z]{2,}", "ip": r"(?:\d{1,3}\.){3}\d{1,3}",
              "card": r"\d{13,19}|(?:\d{4}[ -]){3}\d{1,7}", "phone": r"\+\d[\d ().-]{7,24}\d",
              "identifier": r"\d{3}-\d{2}-\d{4}|[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}",
              "national_phone": r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}",
              "obfuscated_email": r"(?i).*(?:\(at\)|\[at\]| at ).*(?:\.|dot).*",
              "secret": r"(?s)AKIA[0-9A-Z]{16}|.*[=:].*"}[kind]
    # "at" between words is common speech: it joins an address only if the top-level domain is
    # known and a name, a figure or the context says so.
    plain = kind == "obfuscated_email" and not re.search(r"(?i)[(\[](?:at|dot)[)\]]", span)
    named = plain and _named(span)
    asked = any(w in before for w in _CONTEXT[kind])
    prose = plain and bool(_SENTENCE.search(span) or _last_label(span) not in _TLDS
                           or not (named or asked or re.search(r"(?i)\x20dot\x20", span)))
    out.append(1 if re.fullmatch(strict, span) and not prose else -1)
    # Structure: checksums and value ranges.
    if kind == "card":
        out.append(1 if luhn(digits) else -1)
    elif kind == "ip":
        out.append(-1 if span.startswith(("0.", "127.", "255.")) else 1)
    elif kind in ("phone", "national_phone"):
        out.append(1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1)
    elif kind == "identifier" and "-" in span:
        out.append(-1 if span[:3] in ("000", "666") or span[0] == "9" else 1)
    elif kind == "identifier":
        out.append(1 if _iban(span) else -1)
    elif kind == "secret":
        out.append(1 if len(set(span.split("=")[-1].split(":")[-1].strip(" \"'"))) >= 6 else -1)
    elif kind == "obfuscated_email":
        out.append(-1 if prose else
                   1 if re.search(r"(?i)[(\[]at[)\]]", span) or _last_label(span) in _TLDS else -1)
    else:
        out.append(0)
    # Gazetteers: top-level domains, first names and key heads.
    if "email" in kind:
        out.append(1 if _last_label(span) in _TLDS and not prose else -1)
    elif kind == "secret":
        out.append(1 if any(h in span for h in _KEY_HEADS) else 0)
    else:
        out.append(0)
    # Contexts for and against, and whether the span stands by itself.
    out.append(1 if asked or kind == "secret" and any(w in span.lower() for w in _CONTEXT[kind])
               else 0)
    out.append(-1 if any(w in before for w in _AGAINST) else 0)
    alone = not (start and text[start - 1].isalnum()) and not (
        end < len(text) and text[end].isalnum())
    out.append(1 if alone else -1)
    return tuple(out)


def shape(text: str, start: int, end: int) -> tuple[int, int]:
    """Coarse features of the classifier: length and share of digits, in four steps."""
    n = end - start
    return (min(3, n // 10), min(3, 4 * len(_digits(text[start:end])) // max(n, 1)))


def _pattern(text: str, kind: str, start: int, end: int) -> str:
    return ",".join(map(str, (KINDS.index(kind), *votes(text, kind, start, end),
                              *shape(text, start, end))))


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, dict]:
    """Probability that each vote pattern is personal data, and the labelers' reliabilities.

    Two classes, labelers independent given the class; a prior per kind.  Columns of
    ``patterns``: kind, votes.  Starts from the majority of the votes."""
    kind, vote = patterns[:, 0], patterns[:, 1:]
    post = 1 / (1 + np.exp(-1.5 * vote.sum(1).astype(float)))
    table: np.ndarray = np.zeros(0)
    prior: np.ndarray = np.zeros(0)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - post), counts * post])          # class, pattern
        # table[class, labeler, vote + 1]; smoothed so that no vote decides alone
        table = np.array([[np.bincount(vote[:, j] + 1, w, 3) + 1.0 for j in range(vote.shape[1])]
                          for w in weight])
        table /= table.sum(2, keepdims=True)
        prior = np.stack([np.bincount(kind, w, len(KINDS)) + 1.0 for w in weight])
        prior /= prior.sum(0)
        log = np.log(prior[:, kind]) + sum(np.log(table[:, j, vote[:, j] + 1])
                                           for j in range(vote.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - post).max(initial=0) < 1e-6:
            post = new
            break
        post = new
    return post, {"prior": prior, "reliability": table}


def _features(patterns: np.ndarray) -> np.ndarray:
    """One-hot kind, votes (for and against), and shape; with a constant."""
    kind, vote, form = patterns[:, 0], patterns[:, 1:7], patterns[:, 7:9]
    return np.concatenate([np.ones((len(patterns), 1)), np.eye(len(KINDS))[kind], vote == 1,
                           vote == -1, np.eye(4)[form[:, 0]], np.eye(4)[form[:, 1]]], 1).astype(float)


def train_classifier(patterns: np.ndarray, soft: np.ndarray, counts: np.ndarray,
                     rounds: int = 300) -> np.ndarray:
    """Logistic regression on soft labels, weighted by log counts, by Newton steps."""
    x, w = _features(patterns), np.log1p(counts)
    beta = np.zeros(x.shape[1])
    for _ in range(min(rounds, 30)):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (soft - p)) - 0.1 * beta
        hess = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weights of the span classifier, from the vote patterns of all candidates of all texts.

    The patterns are counted in Spark; their number is bounded by the labelers' and
    shapes' combinations, not by the corpus.  Without any candidate the weights are 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in text_batches(batches):
            for t in texts:
                base = base_spans(t)
                for k, spans in base.items():
                    seen.update(_pattern(t, k, *s) for s in spans)
                seen.update(_pattern(t, *c) for c in candidates(t, base))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()),
                                                                             pa.int64())],
                                             ["pattern", "n"])
    rows = docs.select(F.lit(0).alias("one"), docs[text].cast("string").alias("text")).mapInArrow(
        run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return np.zeros(_features(np.zeros((1, 9), int)).shape[1])
    rows.sort(key=lambda r: r.pattern)
    patterns = np.array([[int(v) for v in r.pattern.split(",")] for r in rows])
    counts = np.array([float(r.n) for r in rows])
    soft, _ = em(patterns[:, :7], counts)
    return train_classifier(patterns, soft, counts)


def all_spans(text: str, weights: np.ndarray) -> tuple[dict, list[tuple[str, int, int]]]:
    """(base spans, all spans in the order of kinds and starts)."""
    base = base_spans(text)
    out = [(k, s, e) for k in BASE for s, e in base[k]]
    more = candidates(text, base)
    if more:
        found = np.array([[int(v) for v in _pattern(text, *c).split(",")] for c in more])
        keep = _features(found) @ weights > 0
        taken = Taken([(s, e) for _, s, e in out])
        out += sorted(((k, *part) for (k, s, e), ok in zip(more, keep, strict=True) if ok
                       for part in _outside(s, e, taken)),
                      key=lambda c: (KINDS.index(c[0]), c[1]))
    return base, out


SPANS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
         "base array<struct<kind:string,start:int,end:int>>, "
         "spans array<struct<kind:string,start:int,end:int>>")


def find(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base`` and ``spans``
    (all, in the order of kinds and starts; code points, end exclusive), a row per row.

    Null and empty texts have no span.  Repeated rows and ids each keep their row.  Empty
    tables give no rows; other columns are ignored.  Texts of any length are searched whole,
    in work that follows the length and the number of spans."""
    names = [f.split()[0] for f in re.split(r", (?![a-z]+:)", SPANS)]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_batches(batches):
            rows = [all_spans(t, weights) for t in texts]

            def listed(spans):
                return [{"kind": k, "start": s, "end": e} for k, s, e in spans]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()),
                *(pa.array([len(b[k]) for b, _ in rows], pa.int64()) for k in BASE),
                pa.array([listed(s for s in x if s[0] in BASE) for _, x in rows], kind),
                pa.array([listed(x) for _, x in rows], kind)], names)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text")).mapInArrow(run, SPANS)


def redact(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in angle brackets.

    Spans that overlap are replaced together, under the first one's kind.  All columns
    stay; a null text stays null."""
    place = docs.columns.index(text)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        spans = sorted(((s, e, k) for k, s, e in all_spans(t, weights)[1]))
        out, done = [], 0
        for s, e, k in spans:
            if s >= done:
                out += [t[done:s], f"<{k.upper()}>"]
            done = max(done, e)
        return "".join([*out, t[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            col = pa.array([clean(t) for t in batch.column(place).to_pylist()],
                           batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), col)
    return docs.mapInArrow(run, docs.schema)

