"""Personal data by weak supervision.

Base spans are found by exact patterns.  Beside them, loose patterns propose
candidates; labelers of three sorts (patterns and checks, gazetteers, context)
vote on every span, expectation-maximisation estimates each labeler's
reliability from the votes of the whole corpus, and a logistic classifier,
trained on the resulting probabilities, decides which candidates become spans.
Base spans always stay.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_slices, stage, table, texts_of

KINDS = ("email", "ip", "card", "phone")
ADD_AT = 0.9                 # probability from which a candidate becomes a span
EM_ROUNDS = 100
CONTEXT_CHARS = 48

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The lookbehind skips starts inside a run of digits, which cannot match where
# the run's first digit did not; it keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT_WORD = re.compile(r"([A-Za-z0-9][A-Za-z0-9._%+-]{0,63})(?: ?[\[(] ?at ?[\])] ?)"
                      r"([A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]{1,63})+)")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")

TOP_LEVELS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au".split())
CUES = {
    "email": (frozenset("email mail e-mail contact write address correo courriel kontakt".split()),
              frozenset("twitter handle version".split())),
    "ip": (frozenset("ip host server address login from client dns".split()),
           frozenset("version section chapter release v figure".split())),
    "card": (frozenset("card visa mastercard credit payment tarjeta carte karte".split()),
             frozenset("isbn order invoice tracking serial part".split())),
    "phone": (frozenset("phone tel call telephone mobile cell fax contact".split()),
              frozenset("isbn order invoice version part".split())),
}
_WORD = re.compile(r"[A-Za-z-]+")

VOTES = 5                    # labelers; each votes -1, 0 (abstains) or 1
PATTERNS = 3 ** VOTES        # vote patterns of a kind


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octets_fit(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, walked from each @: the local
    part is the run before it, from the end of the last match at the earliest."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    return found


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind, in the order of KINDS."""
    out = [_emails(text), [], [], []]
    for m in _IP.finditer(text):
        if _octets_fit(m.group()):
            out[1].append(m.span())
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out[2].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(m.group().count, "0123456789")) <= 15:
                out[3].append(m.span())
    return out


def loose_spans(text: str) -> list[list[tuple[int, int]]]:
    """Candidates by kind beyond the base patterns."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    if "at" in text and ("[" in text or "(" in text):
        out[0] = [m.span() for m in _AT_WORD.finditer(text)]
    if ":" in text:
        out[1] = [m.span() for m in _IPV6.finditer(text)]
    for m in _CARD.finditer(text):
        if 13 <= len(m.group().replace(" ", "").replace("-", "")) <= 19:
            out[2].append(m.span())
    out[3] = [m.span() for m in _LOCAL_PHONE.finditer(text)]
    return out


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """The labelers' votes on one span: strict pattern, check, gazetteer, cue
    words before it, and its borders."""
    name, body = KINDS[kind], text[start:end]
    digits = "".join(c for c in body if c in "0123456789")
    strict = 1 if base else 0
    check = gazetteer = 0
    if name == "email":
        top = re.split(r"\.|dot", body)[-1].strip(" ])[(").lower()
        gazetteer = 1 if top in TOP_LEVELS else -1 if not top.isalpha() else 0
        check = 1 if len(body) <= 254 else -1
    elif name == "ip":
        if ":" in body:
            check = 1 if re.search("[a-fA-F]", body) else 0
        else:
            parts = [int(p.lstrip("0") or 0) for p in body.split(".")]
            check = 1 if all(p == "0" or p[0] != "0" for p in body.split(".")) else -1
            gazetteer = -1 if parts[0] == 0 else 1 if parts[0] >= 10 else 0
    elif name == "card":
        check = 1 if _luhn(digits) else -1
        issuer = digits[0] in "3456" or digits[:2] in ("22", "23", "24", "25", "26", "27")
        gazetteer = 1 if issuer and len(set(digits)) > 2 else -1
    else:
        check = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = -1 if len(set(digits)) <= 2 else 1 if body[0] in "+(" else 0
    before = [w.lower() for w in _WORD.findall(text, max(0, start - CONTEXT_CHARS), start)][-5:]
    good, bad = CUES[name]
    cue = (any(w in good for w in before)) - (any(w in bad for w in before))
    around = text[max(0, start - 1):start] + text[end:end + 1]
    border = -1 if any(c.isalnum() or c in "_@" for c in around) else 1
    return strict, check, gazetteer, int(cue), border


def pattern_of(kind: int, vote: tuple[int, ...]) -> int:
    code = kind
    for v in vote:
        code = 3 * code + v + 1
    return code


def votes_of(code: int) -> tuple[int, list[int]]:
    vote = []
    for _ in range(VOTES):
        vote.append(code % 3 - 1)
        code //= 3
    return code, vote[::-1]


def spans_of(text: str) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, vote pattern, base) of base spans and of candidates
    that overlap no base span of any kind nor an earlier candidate of theirs."""
    base = base_spans(text)
    taken = sorted(s for spans in base for s in spans)
    starts = np.array([s for s, _ in taken], dtype=np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in taken], dtype=np.int64)) if taken else starts
    out = []
    for kind, loose in enumerate(loose_spans(text)):
        for s, e in base[kind]:
            out.append((kind, s, e, pattern_of(kind, votes(text, kind, s, e, True)), True))
        for s, e in loose:
            k = int(np.searchsorted(starts, e)) - 1      # the last base span that starts before e
            if k < 0 or ends[k] <= s:
                out.append((kind, s, e, pattern_of(kind, votes(text, kind, s, e, False)), False))
    return sorted(out)


@dataclass
class SpanModel:
    """Labelers' reliabilities and the final classifier's probability by pattern."""

    reliability: np.ndarray      # [labeler, truth, vote + 1]
    probability: np.ndarray      # [pattern]


def fit_spans(counts: dict[int, int], rounds: int = EM_ROUNDS, penalty: float = 1.0) -> SpanModel:
    """EM over the vote patterns of the whole corpus, then the classifier.

    Each labeler has one table P(vote | personal or not), each kind a prior;
    the first beliefs are the mean votes.  The classifier is a logistic
    regression on kind and votes, fitted by Newton steps to the beliefs with
    the counts as weights.  Without candidates, nothing is added.
    """
    codes = sorted(counts)
    out = np.zeros(len(KINDS) * PATTERNS)
    table_ = np.full((VOTES, 2, 3), 1 / 3)
    if not codes:
        return SpanModel(table_, out)
    n = np.array([counts[c] for c in codes], dtype=np.float64)
    kind = np.array([votes_of(c)[0] for c in codes])
    vote = np.array([votes_of(c)[1] for c in codes])
    belief = 1 / (1 + np.exp(-1.5 * vote.sum(axis=1)))
    for _ in range(rounds):
        for j in range(VOTES):
            for v in (-1, 0, 1):
                table_[j, 1, v + 1] = (n * belief * (vote[:, j] == v)).sum() + 1
                table_[j, 0, v + 1] = (n * (1 - belief) * (vote[:, j] == v)).sum() + 1
        table_ /= table_.sum(axis=2, keepdims=True)
        prior = np.array([((n * belief * (kind == k)).sum() + 1) / ((n * (kind == k)).sum() + 2)
                          for k in range(len(KINDS))])
        odds = np.log(prior[kind] / (1 - prior[kind])) + sum(
            np.log(table_[j, 1, vote[:, j] + 1] / table_[j, 0, vote[:, j] + 1]) for j in range(VOTES))
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def features(k: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.hstack([np.eye(len(KINDS))[k], v == 1, v == -1]).astype(np.float64)

    x, w = features(kind, vote), np.zeros(len(KINDS) + 2 * VOTES)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (n * (p - belief)) + penalty * w)
    every = [votes_of(c) for c in range(len(out))]
    z = features(np.array([k for k, _ in every]), np.array([v for _, v in every])) @ w
    return SpanModel(table_, 1 / (1 + np.exp(-np.clip(z, -30, 30))))


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``found``: all base spans and candidates of whole texts."""
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                      ("pattern", pa.int32()), ("base", pa.bool_())])

    def make():
        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            rows = [[dict(zip(("kind", "start", "end", "pattern", "base"), s)) for s in spans_of(t)]
                    for t in texts_of(part, text)]
            return [pa.array(rows, pa.list_(kind))]
        return fn

    return map_slices(docs, make, "found array<struct<kind:int,start:long,end:long,"
                                  "pattern:int,base:boolean>>")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       add_at: float = ADD_AT) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans): per row of
    ``docs`` the numbers of base spans by kind, and the base spans and all spans
    as kind:start:end, comma-joined by kind and start (code points, end exclusive).

    Null and empty texts have none.  Repeated rows are found alike; other
    columns are ignored; an empty table gives an empty result.  The texts are
    read once; their spans, staged, train the model and are then filtered.
    """
    held = stage(with_candidates(docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                                             F.col(f"`{text}`").alias("text")))
                 .drop("text"), "spans")
    counts = {r["p"]: r["n"] for r in held.select(F.explode("found.pattern").alias("p"))
              .groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}   # at most 4 * 3^5 rows
    model = fit_spans(counts)
    added = [int(c) for c in np.flatnonzero(model.probability >= add_at)]
    good = F.array(*[F.lit(c) for c in added]).cast("array<int>")
    base = F.filter("found", lambda s: s["base"])
    every = F.filter("found", lambda s: s["base"] | F.array_contains(good, s["pattern"]))
    return held.select("doc_id", *[_of_kind(base, k).alias(f"n_{name}")
                                   for k, name in enumerate(KINDS)],
                       _joined(base).alias("base_spans"), _joined(every).alias("spans"))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")
