"""Personal data by weak supervision.

Base spans (``BASE_KINDS``) are fixed patterns with checks. Beside them every
text gives looser candidates (card numbers of other lengths, numbers written
like phone numbers, masked addresses, IPv6, IBAN, social security numbers,
names of persons). On each candidate, base spans included, three labelers
vote yes (1), no (-1) or nothing (0):

* the regex labeler looks at its form and checksum,
* the gazetteer labeler at lists (top level domains, issuer prefixes, reserved
  networks, country codes, given names),
* the context labeler at cue words in the ``CONTEXT`` characters before it.

1. One narrow pass counts the patterns (kind, base, votes, features) of all
   texts. Their number is bounded by the labelers and features
   (``PATTERNS``), not by the data; only these counts are aggregated and
   reach the driver.
2. Expectation-maximisation estimates, per kind, how often spans of either
   class get each vote from each labeler, and the share of true spans among
   base spans and among loose ones; pseudo counts say that labelers are
   better than chance.
3. A logistic span classifier per kind is fitted to the features with the
   posteriors as soft labels, over all patterns and their counts (and, as
   pseudo counts, over all vote patterns: where there is no data the
   classifier says what the votes say).
4. A second narrow pass finds the spans again, scores candidates with the
   classifier and adds those of ``THRESHOLD`` or more that touch no base span
   and no span added before. A loose span whose form or checksum is wrong
   (regex labeler: no) is never added.

Everything is deterministic and decided per text. Offsets are code points.

Defined cases: a null or empty text has no spans; repeated rows get the same
spans; without candidates the classifier is the prior; an empty table gives
no rows; other columns are carried, clashing ones replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import without

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "person")
#: Characters before a span in which cue words count.
CONTEXT = 40
THRESHOLD = 0.5
#: Pseudo observations behind the labelers' initial vote rates and the share.
PRIOR = 20.0
#: Initial shares of true spans among loose and among base spans.
SHARES = (0.25, 0.9)
#: Initial rates of the votes (-1, 0, 1) for false and true spans.
VOTE_RATES = ((0.45, 0.45, 0.10), (0.05, 0.45, 0.50))
RIDGE = 1.0

# What the gazetteer and context labelers know.
DOMAINS = frozenset("com org net edu gov mil int info biz name io de fr es it nl be ch at uk eu us ca au jp cn in br mx ru se no dk fi pl pt ie".split())
FILE_ENDINGS = frozenset("png jpg jpeg gif svg css js html htm pdf zip gz txt xml json py java cpp".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420 421".split())
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20,
                "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
TITLES = frozenset("Mr Mrs Ms Miss Dr Prof Professor Herr Frau Monsieur Madame Señor Señora".split())
GIVEN_NAMES = frozenset("James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas "
                        "Sarah Charles Karen Daniel Nancy Matthew Anthony Mark Paul Steven Andrew Hans Peter Klaus Jürgen Wolfgang Ursula Monika Sabine "
                        "Jean Pierre Michel Philippe Marie Nathalie Isabelle Sylvie José Antonio Manuel Francisco Carmen María Dolores".split())
CUES = {
    "email": frozenset("mail email e contact write reach address adresse kontakt correo".split()),
    "ip": frozenset("ip ipv4 ipv6 host server address client login addr".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax whatsapp telefon anruf téléphone teléfono".split()),
    "iban": frozenset("iban account bank konto compte cuenta transfer".split()),
    "ssn": frozenset("ssn social security".split()),
    "person": frozenset("name named called i am signed regards sincerely dear contact by".split()),
}
COUNTER_CUES = frozenset("order invoice isbn issn version release tracking serial part item section chapter page ref reference ticket build model sku".split())
FEATURES = ("bias", "strict", "loose", "known", "unlisted", "cue", "counter_cue", "glued_before", "glued_after", "separated",
            "long", "few_digits", "labelled", "neighbour")
#: Patterns there can be: kinds, base or not, three votes, binary features.
PATTERNS = len(KINDS) * 2 * 27 * (1 << (len(FEATURES) - 1))

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MASKED = re.compile(r"[\[(] ?at ?[\])] ?[A-Za-z0-9-]+(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]+|\.[A-Za-z0-9-]+)+")
_IPV6 = re.compile(r"(?<![:0-9A-Za-z])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![:0-9A-Za-z])")
_NATIONAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,4}\) ?|0?[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PERSON = re.compile(r"[A-Z][^\W\d_]+\.? [A-Z][^\W\d_]+(?: [A-Z][^\W\d_]+)?")
_WORD = re.compile(r"[^\W\d_]+|[0-9]+")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _local_start(text: str, low: int, at: int) -> int:
    """Where the run of local part characters before ``at`` begins."""
    step, start = 64, at
    while start > low:
        lo = max(low, start - step)
        rest = text[lo:start].rstrip(_LOCAL)
        start = lo + len(rest)
        if rest:
            break
        step *= 2
    return start


def base_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of the base kinds, in order."""
    if "@" in text:
        end = 0
        for m in _AT.finditer(text):
            start = _local_start(text, end, m.start())
            if start < m.start():
                end = m.end()
                yield 0, start, end
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m.group().split("."))):
                yield 1, m.start(), m.end()
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m.group())
                if 16 <= len(d) <= 19 and luhn(d):
                    yield 2, m.start(), m.end()
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m.group())) <= 15:
                    yield 3, m.start(), m.end()


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Further candidates, which the classifier decides on."""
    if "at" in text:
        for m in _MASKED.finditer(text):
            head = text[:m.start()].rstrip(" ") if m.start() < 256 else text[m.start() - 256:m.start()].rstrip(" ")
            shift = max(0, m.start() - 256)
            start = _local_start(text, shift, shift + len(head))
            if start < shift + len(head):
                yield 0, start, m.end()
    for m in _PERSON.finditer(text):
        first = m.group().split()[0].rstrip(".")
        if first in TITLES or first in GIVEN_NAMES:
            yield 6, m.start(), m.end()
    if not _DIGIT.search(text):
        return
    if text.count(":") >= 7:
        for m in _IPV6.finditer(text):
            yield 1, m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(_digits(m.group())) <= 19:
            yield 2, m.start(), m.end()
    for m in _NATIONAL.finditer(text):
        if 8 <= len(_digits(m.group())) <= 13:
            yield 3, m.start(), m.end()
    for m in _IBAN.finditer(text):
        yield 4, m.start(), m.end()
    for m in _SSN.finditer(text):
        yield 5, m.start(), m.end()


def _form(kind: int, s: str, base: bool) -> int:
    """The regex labeler."""
    d = _digits(s)
    if kind == 2:
        return 1 if luhn(d) else -1
    if kind == 4:
        c = s.replace(" ", "")
        return 1 if len(c) >= 15 and int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1 else -1
    if kind == 5:
        return -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    if kind == 6:
        return 1 if s.split()[0].rstrip(".") in TITLES else 0
    if kind == 3 and not base:
        return -1 if len(set(d)) == 1 else 0
    return 1


def _listed(kind: int, s: str) -> int:
    """The gazetteer labeler."""
    if kind == 0:
        top = re.split(r"[^A-Za-z0-9]+", s.rstrip(")] "))[-1].lower()
        return 1 if top in DOMAINS else -1 if top in FILE_ENDINGS else 0
    if kind == 1:
        if ":" in s:
            return 1 if s[0] in "23" or s[:2].lower() in ("fc", "fd", "fe") else -1
        first = int(s.split(".")[0].lstrip("0") or 0)
        return -1 if first in (0, 127) or first > 239 else 1
    d = _digits(s)
    if kind == 2:
        issuer = (d[0] == "4" and len(d) in (13, 16, 19) or d[:2] in ("34", "37") and len(d) == 15 or len(d) == 16 and (
            "51" <= d[:2] <= "55" or "2221" <= d[:4] <= "2720" or d[:4] == "6011" or d[:2] == "65"))
        return 1 if issuer else 0
    if kind == 3:
        return (1 if any(d[:n] in CALLING_CODES for n in (1, 2, 3)) else -1) if s[0] == "+" else 0
    if kind == 4:
        c = s.replace(" ", "")
        return 1 if IBAN_LENGTHS.get(c[:2]) == len(c) else -1
    if kind == 6:
        return 1 if any(w in GIVEN_NAMES for w in s.split()) else 0
    return 0


def _cued(kind: int, before: str, s: str) -> int:
    """The context labeler."""
    for w in reversed(_WORD.findall(before.lower())):  # the nearest cue decides
        if w in CUES[KINDS[kind]]:
            return 1
        if w in COUNTER_CUES:
            return -1
    return 0


def pattern(text: str, kind: int, start: int, end: int, base: bool, near: bool) -> tuple[int, bool, int, int]:
    """(kind, base, votes as a number in base 3, feature bits) of a span."""
    s, before = text[start:end], text[max(0, start - CONTEXT):start]
    votes = (_form(kind, s, base), _listed(kind, s), _cued(kind, before, s))
    d = _digits(s)
    after = text[end:end + 1]
    bits = (*_vote_bits(votes), before[-1:].isalnum(), after.isalnum(), any(c in " -.()" for c in s), len(s) > 15, 0 < len(set(d)) <= 2,
            before.rstrip(" ")[-1:] in (":", "=", "#"), near)
    return kind, base, (votes[0] + 1) * 9 + (votes[1] + 1) * 3 + votes[2] + 1, _number(bits)


def _vote_bits(votes) -> list[bool]:
    return [x for v in votes for x in (v > 0, v < 0)]


def _number(bits) -> int:
    return sum(1 << i for i, b in enumerate(bits) if b)


def candidates(text: str) -> list[tuple[int, int, int, bool, tuple[int, bool, int, int]]]:
    """(kind, start, end, base, pattern) of all base spans and of the looser
    candidates that touch none, by kind and start."""
    base = list(base_spans(text))
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, int)

    def free(a: int, b: int) -> bool:
        at = int(np.searchsorted(starts, b))  # spans that start before b
        return at == 0 or ends[at - 1] <= a
    loose = [x for x in loose_spans(text) if free(x[1], x[2])]
    if not base and not loose:
        return []
    every = sorted({(k, a, b, True) for k, a, b in base} | {(k, a, b, False) for k, a, b in loose})
    at = np.sort(np.array([a for _, a, _, _ in every]))
    out = []
    for k, a, b, is_base in every:
        others = int(np.searchsorted(at, a + 100, "right") - np.searchsorted(at, a - 100)) > 1
        out.append((k, a, b, is_base, pattern(text, k, a, b, is_base, others)))
    return out


def pattern_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, base, votes, features, n) over all texts; at most ``PATTERNS`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    found.update(c[4] for c in candidates(t))
        if found:
            k, base, v, f = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(base, pa.bool_()), pa.array(v, pa.int32()), pa.array(f, pa.int32()),
                                              pa.array(found.values(), pa.int64())], names=["kind", "base", "votes", "features", "n"])
    rows = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "kind int, base boolean, votes int, features int, n long")
    return rows.groupBy("kind", "base", "votes", "features").agg(F.sum("n").alias("n"))


def posteriors(votes: np.ndarray, share: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Probability of being true of spans with these votes."""
    like = np.log(rates[:, np.arange(votes.shape[1]), votes + 1]).sum(-1)
    odds = like[1] - like[0] + np.log(share) - np.log1p(-share)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def estimate(votes: np.ndarray, base: np.ndarray, n: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1 with
    counts): the shares of true spans among loose and base ones, the
    labelers' vote rates [class, labeler, vote], the patterns' posteriors."""
    start = np.repeat(np.array(VOTE_RATES)[:, None, :], votes.shape[1], axis=1)
    rates, share, group = start.copy(), np.array(SHARES), base.astype(int)
    post = np.full(len(votes), -1.0)
    for _ in range(rounds):
        new = posteriors(votes, share[group], rates)
        done = np.abs(new - post).max(initial=0) < 1e-10
        post = new
        if done:
            break
        for y, w in enumerate((n * (1 - post), n * post)):
            seen = np.stack([[w[votes[:, j] == v].sum() for v in (-1, 0, 1)] for j in range(votes.shape[1])])
            rates[y] = (seen + PRIOR * start[y]) / (seen.sum(1, keepdims=True) + PRIOR)
        share = np.array([((n * post)[group == g].sum() + PRIOR * SHARES[g]) / (n[group == g].sum() + PRIOR) for g in (0, 1)])
    return share, rates, post


def _split(votes: np.ndarray) -> np.ndarray:
    """Votes of the three labelers from their number in base 3."""
    return np.stack((votes // 9 - 1, votes // 3 % 3 - 1, votes % 3 - 1), axis=1)


def _matrix(features: np.ndarray) -> np.ndarray:
    bits = features[:, None] >> np.arange(len(FEATURES) - 1) & 1
    return np.concatenate((np.ones((len(features), 1)), bits), axis=1).astype(float)


def fit_classifier(features: np.ndarray, target: np.ndarray, n: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Ridge logistic weights for soft targets with counts, by Newton steps.
    Counts weigh as shares of 1,000 spans, so that the ridge means the same
    at every size."""
    x, weight = _matrix(features), n / n.sum() * 1000.0
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + RIDGE * beta
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta -= step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return beta


class Model:
    """Per kind: shares and vote rates from EM, and the classifier's weights."""

    def __init__(self, patterns: pa.Table):
        kind, base, votes, features, n = (patterns.column(c).to_numpy() for c in ("kind", "base", "votes", "features", "n"))
        order = np.lexsort((features, votes, base, kind))
        kind, base, votes, features, n = kind[order], base[order], votes[order], features[order], n[order].astype(float)
        every = np.arange(27)
        pseudo = np.array([_number(_vote_bits(v)) for v in _split(every)])
        self.reliability: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.weights = np.zeros((len(KINDS), len(FEATURES)))
        for k, name in enumerate(KINDS):
            mine = kind == k
            share, rates, post = estimate(_split(votes[mine]), base[mine], n[mine])
            self.reliability[name] = (share, rates)
            said = posteriors(_split(every), np.full(27, share[0]), rates)
            self.weights[k] = fit_classifier(np.concatenate((features[mine], pseudo)), np.concatenate((post, said)),
                                             np.concatenate((n[mine], np.full(27, PRIOR))))

    def score(self, kind: int, features: int) -> float:
        w = self.weights[kind]
        z = w[0] + sum(w[i + 1] for i in range(len(FEATURES) - 1) if features >> i & 1)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def train(docs: DataFrame, text: str = "text") -> Model:
    return Model(pattern_counts(docs, text).toArrow())


def spans_of(text: str, model: Model, threshold: float = THRESHOLD) -> list[tuple[int, int, int, float, bool]]:
    """(kind, start, end, score, base) by kind and start."""
    out, added = [], []
    for k, a, b, base, (_, _, votes, bits) in candidates(text):
        p = model.score(k, bits)
        if base:
            out.append((k, a, b, p, True))
        elif p >= threshold and votes >= 9:
            added.append((k, a, b, p, False))
    reach: list[tuple[int, int]] = []
    for x in sorted(added, key=lambda x: (-x[3], x[0], x[1])):  # the surest first
        if all(x[2] <= a or b <= x[1] for a, b in reach):
            reach.append(x[1:3])
            out.append(x)
    return sorted(out)


def find_pii(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, mask: bool = False) -> DataFrame:
    """``docs`` plus ``pii_spans`` (kind, start, end, score, base) and, with
    ``mask``, ``pii_text``: the text with each span replaced by its kind in
    angle brackets (of overlapping spans, the first). One narrow pass."""
    docs = without(docs, "pii_spans", "pii_text")
    extra = StructType.fromDDL("pii_spans array<struct<kind: string, start: int, end: int, score: double, base: boolean>>" + ", pii_text string" * mask).fields
    names, at = [*docs.columns, *(f.name for f in extra)], docs.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            spans = [spans_of(t, model, threshold) if t else [] for t in texts]
            new = [pa.array([[(KINDS[k], *rest) for k, *rest in s] for s in spans], kind)]
            if mask:
                new.append(pa.array([_masked(t, s) for t, s in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=names)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *extra]))


def _masked(text: str | None, spans: list) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for k, a, b, *_ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
            at = b
    return "".join([*out, text[at:]])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
