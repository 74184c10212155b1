"""Personal data by weak supervision.

Base kinds (email, ip, card, phone) are found by pattern and always stay. Other candidates are quoted or bare tokens that hold digits or
an at sign and that no base span touches. Labelers vote on each: patterns (long hexadecimal or base-64 strings, number groups), a gazetteer
(words that name secrets or contacts, and plain number words such as versions) and the context before the token. A labeler may
abstain. Expectation-maximisation over the counts of vote patterns of all documents (their number is bounded by the
labelers) estimates each labeler's reliability and each pattern's posterior; a logistic span classifier over shape and
context features is then trained on those posteriors, weighted by counts. Candidates it accepts are spans of the kind ``secret``.

Positions are code points, end exclusive. Spans are in order of start, then kind (email, ip, card, phone, secret). Nulls and empty texts: no spans.
Null doc_id and repeated rows: each row has its own spans. No candidates at all: base spans only. Overlaps of base kinds all stay. Other columns are
ignored.
"""
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts

KINDS = ("email", "ip", "card", "phone", "secret")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that failed from its start fails from every later digit too, so matches may begin at runs only.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D\"'<>,;()\[\]{}=]+")
_DIGIT = re.compile(r"[0-9]")
_HEX = re.compile(r"[0-9a-fA-F]{16,}\Z")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{20,}=*\Z")
_GROUPS = re.compile(r"[0-9]{2,}(?:[-./][0-9]{2,}){1,4}\Z")
_PLAIN_NUMBER = re.compile(r"v?[0-9]{1,4}(?:\.[0-9]{1,3}){0,2}\.?\Z")
SECRET_WORDS = frozenset(("token", "key", "apikey", "api_key", "secret", "password", "passwd", "pwd", "bearer", "auth", "credential", "ssn", "iban", "passport", "account"))
PLAIN_WORDS = frozenset(("version", "page", "chapter", "section", "year", "figure", "table", "item", "part", "no", "in", "vol"))
LABELERS = ("hex", "base64", "groups", "named", "plain_context", "plain_number", "assigned", "mixed")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches: each holds one at sign, so each at sign is tried with the longest run before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str):
    """(start, end, place of the kind) of all base spans."""
    found = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def candidates(text: str, taken):
    """(start, end, votes, features): tokens with digits or an at sign that no base span touches. A vote is 1, 0 or -1 (abstains)."""
    reach, k = 0, 0
    spans = sorted(taken)
    for m in _TOKEN.finditer(text):
        token = m[0]
        if not (_DIGIT.search(token) or "@" in token):
            continue
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][1])
            k += 1
        if reach > m.start():
            continue
        before = text[max(0, m.start() - 24):m.start()]
        words = re.findall(r"[A-Za-z_]+", before.lower())
        last = words[-1] if words else ""
        digits = sum("0" <= c <= "9" for c in token)
        letters = any(c.isalpha() for c in token)
        named, plain = last in SECRET_WORDS, last in PLAIN_WORDS
        number = bool(_PLAIN_NUMBER.match(token))
        votes = (1 if _HEX.match(token) else -1, 1 if _BASE64.match(token) and digits and letters else -1, 1 if _GROUPS.match(token) and digits >= 9 else -1,
                 1 if named else -1, 0 if plain else -1, 0 if number else -1, 1 if re.search(r"[=:]\s*[\"']?\Z", before) else 0,
                 1 if digits >= 6 and letters else (0 if digits < 4 else -1))
        features = (min(len(token) // 4, 12), min(4, int(4 * digits / len(token))), letters, named, plain, before[-1:] in "\"'", "@" in token, token[-1:] in ".!?:")
        yield m.start(), m.end(), votes, tuple(int(x) for x in features)


def _vector(features):
    out = np.zeros(13 + 5 + 7)
    out[features[0]] = 1
    out[13 + features[1]] = 1
    out[18:24] = features[2:]
    out[24] = 1
    return out


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 200):
    """Expectation-maximisation for independent labelers: (prior, right given positive, right given negative, posterior of each pattern).

    ``votes``: patterns x labelers, of 1, 0, -1. Smoothing keeps labelers better than chance at the start, and away from 0 and 1.
    """
    n = votes.shape[1]
    prior, up, down = 0.3, np.full(n, 0.8), np.full(n, 0.2)
    said, yes = votes >= 0, votes == 1
    posterior = np.zeros(len(votes))
    for _ in range(rounds):
        a = np.log(prior) + np.where(said, np.where(yes, np.log(up), np.log(1 - up)), 0).sum(1)
        b = np.log(1 - prior) + np.where(said, np.where(yes, np.log(down), np.log(1 - down)), 0).sum(1)
        now = 1 / (1 + np.exp(np.clip(b - a, -500, 500)))
        done = np.abs(now - posterior).max() < 1e-9
        posterior = now
        w, v = counts * posterior, counts * (1 - posterior)
        prior = (w.sum() + 1) / (counts.sum() + 3)
        up = ((w[:, None] * yes).sum(0) + 4) / ((w[:, None] * said).sum(0) + 5)
        down = ((v[:, None] * yes).sum(0) + 1) / ((v[:, None] * said).sum(0) + 5)
        if done:
            break
    return prior, up, down, posterior


def fit(patterns):
    """Span classifier weights from rows (votes, features, count)."""
    if not patterns:
        return None
    counts = np.array([p[2] for p in patterns], np.float64)
    _, _, _, posterior = reliabilities(np.array([p[0] for p in patterns]), counts)
    x = np.array([_vector(p[1]) for p in patterns])
    weight = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        g = x.T @ (counts * (p - posterior)) + weight
        h = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(len(weight))
        step = np.linalg.solve(h, g)
        weight -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return weight


def _name(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def found(docs: DataFrame, accept: float = 0.5) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret of every row of ``docs``."""
    source = texts(docs)
    kinds = "votes string, features string, n long"

    def vote(batches):
        seen: dict = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if "@" in text or _DIGIT.search(text):
                    for _, _, votes, features in candidates(text, base_spans(text)):
                        seen[votes, features] = seen.get((votes, features), 0) + 1
        yield pa.record_batch([pa.array([",".join(map(str, v)) for v, _ in seen], pa.string()), pa.array([",".join(map(str, f)) for _, f in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["votes", "features", "n"])

    # At most one row for each vote pattern and feature vector there can be.
    rows = source.select("text").mapInArrow(vote, kinds).groupBy("votes", "features").agg(F.sum("n").alias("n")).orderBy("votes", "features").collect()
    model = fit([([int(x) for x in r["votes"].split(",")], [int(x) for x in r["features"].split(",")], r["n"]) for r in rows])
    shared = source.sparkSession.sparkContext.broadcast(model)
    empty = hashlib.sha256(b"").hexdigest()

    def find(batches):
        weight = shared.value
        for batch in batches:
            counts, prints, spans = [], [], []
            for text in batch.column(1).to_pylist():
                if "@" not in text and not _DIGIT.search(text):
                    counts.append((0, 0, 0, 0, 0))
                    prints.append(empty)
                    spans.append("")
                    continue
                base = base_spans(text)
                more = [(a, b, 4) for a, b, _, f in candidates(text, base) if weight is not None and 1 / (1 + np.exp(-_vector(f) @ weight)) >= accept]
                every = sorted(base + more, key=lambda s: (s[0], s[2], s[1]))
                counts.append(tuple(sum(s[2] == k for s in every) for k in range(5)))
                prints.append(hashlib.sha256(_name(base).encode()).hexdigest() if base else empty)
                spans.append(_name(every))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(5)]
            yield pa.record_batch([batch.column(0), *columns[:4], pa.array(prints, pa.string()), pa.array(spans, pa.string()), columns[4]], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret"])

    return source.mapInArrow(find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long")
