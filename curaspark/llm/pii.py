"""Personal data: weak labelers, their reliabilities by expectation-maximisation, a span classifier.

Base patterns find e-mail addresses, addresses of hosts, card and phone numbers. Wider patterns add
candidates of the same kinds. On every candidate of every text, labelers vote for or against:
a strict form, a checksum, a gazetteer of top-level domains and cue words (a few fixed ones, and those that the corpus
itself shows: endings of many addresses, words that stand before the base matches of one kind far more
often than elsewhere), and context (what stands before and after, neighbours of the same kind). The votes and a few form features make
a pattern of small bounded numbers; the corpus is reduced to counts of such patterns (all documents
count; at most a few thousand patterns exist). On the counts, expectation-maximisation estimates each
labeler's accuracy and each candidate pattern's probability (Dawid and Skene's model, one hidden
class for each kind), and a logistic classifier on the features is trained with these probabilities as
soft labels. Candidates outside the base spans that it accepts are added spans, of kind ``more_`` and
their kind.

Defined results: null or empty texts have no spans; without candidates the classifier accepts none;
equal texts get equal spans.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common, spans

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *(f"more_{kind}" for kind in BASE))
# An address is read from its @ outwards and a host number from the start of its digits, so that one very
# long run of such characters takes linear time; the matches are those of the patterns read from the left.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
# wider forms: an address written out, a host with a port or leading zeros, long numbers, phone numbers without the plus
_WIDE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:00[1-9][0-9]{0,2}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"),
}
_URL = re.compile(r"https?://[A-Za-z0-9.-]*\.([A-Za-z]{2,})")
_WORD = re.compile(r"[^\W\d_]{2,}")
_AT, _DOT = re.compile(r"\x20?(?:@|\(at\)|\[at\])\x20?"), re.compile(r"\x20?(?:\.|\(dot\)|\[dot\])\x20?")
# fixed values: cue words and common top-level domains
_CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "carte", "karte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
}
_DOMAINS = frozenset("com org net edu gov info io de fr es it uk eu us ca ch at be nl pl ru cn jp br in".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c)
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _number(part: str) -> int:
    """A run of digits as a number, 1000 for anything that is larger."""
    part = part.lstrip("0")
    return int(part or "0") if len(part) <= 3 else 1000


def _emails(text: str) -> list[spans.Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            found.append(("email", begin, match.end()))
            free = match.end()
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[spans.Span]:
    found: list[spans.Span] = []
    if "@" in text:
        found += _emails(text)
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_number(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return found


# ---- labelers ----

N_LABELERS = 6
N_FEATURES = 8
#: How many characters before a candidate are its context.
NEAR = 24


@dataclass
class Gazetteer:
    """Endings of addresses, and for each kind the words that announce it."""

    domains: frozenset[str] = _DOMAINS
    cues: dict[str, frozenset[str]] = field(default_factory=dict)

    def announces(self, kind: str, near: str) -> bool:
        return any(c in near for c in _CUES[kind]) or not self.cues.get(kind, frozenset()).isdisjoint(_WORD.findall(near))


def _address(value: str) -> str:
    """An address as it would be typed, where its signs are written out."""
    return _DOT.sub(".", _AT.sub("@", value))


def _votes(kind: str, text: str, a: int, b: int, is_base: bool, company: int, known: Gazetteer) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes (1 for, -1 against, 0 none) and small form features of one candidate."""
    value = text[a:b]
    digits = _digits(value)
    before, after = text[a - 1] if a else " ", text[b] if b < len(text) else " "
    near = text[max(0, a - NEAR) : a].lower()
    if kind == "email":
        typed = _address(value)
        strict = 1 if typed.count("@") == 1 and " " not in typed and typed[0] not in ".-%" else -1
        check = 1 if typed.rsplit(".", 1)[-1].lower() in known.domains else -1
    elif kind == "ip":
        parts = value.split(".")
        strict = 1 if len(parts) == 4 and all(_number(p) <= 255 and (p == "0" or p[0] != "0") for p in parts) else -1
        check = -1 if any(_number(p) > 255 for p in parts) or parts[0] == "0" else 1
    elif kind == "card":
        strict = 1 if 15 <= len(digits) <= 16 else -1 if not 14 <= len(digits) <= 19 else 0
        check = 1 if luhn(digits) else -1
    else:
        strict = 1 if value.startswith("+") and "(" in value else 1 if value.startswith("+") else 0
        check = 1 if 10 <= len(digits) <= 15 else -1
    cue = 1 if known.announces(kind, near) else 0
    frame = 1 if before in " \n\t(:;,<\"'." and after in " \n\t),.;:>\"'%#$&*!|" else -1 if before.isalnum() or after.isalnum() else 0
    pattern = 1 if is_base else -1 if kind in ("card", "phone") else 0
    crowd = 1 if 1 <= company <= 3 else -1 if company > 8 else 0
    votes = (pattern, strict, check, cue, frame, crowd)
    features = (int(strict > 0), int(check > 0), int(check < 0), cue, int(frame > 0), int(frame < 0), int(" " in value or "(" in value), int(company > 8))
    return votes, features


def places(text: str, base: list[spans.Span]) -> list[tuple[spans.Span, bool]]:
    """Base spans and wider candidates outside them."""
    held = [(span, True) for span in base]
    digit, at = _DIGIT.search(text) is not None, "@" in text or "at)" in text or "at]" in text
    for kind, pattern in _WIDE.items():
        if at if kind == "email" else digit:
            cover = spans.Cover([span for span, _ in held])
            held += [((kind, m.start(), m.end()), False) for m in pattern.finditer(text) if not cover.meets(m.start(), m.end())]
    return held


def candidates(text: str, base: list[spans.Span], known: Gazetteer) -> list[tuple[spans.Span, bool, tuple[int, ...], tuple[int, ...]]]:
    """The places with votes and features."""
    held = places(text, base)
    company = Counter(span[0] for span, _ in held)
    return [(span, is_base, *_votes(span[0], text, span[1], span[2], is_base, company[span[0]], known)) for span, is_base in held]


def learn_gazetteer(rows: DataFrame, min_seen: int = 5, lift: float = 4.0, max_cues: int = 200, max_domains: int = 2000) -> Gazetteer:
    """From all texts: endings seen ``min_seen`` times in addresses and links; words before base matches of a kind.

    A word is a cue of a kind if at least ``min_seen`` base matches of the kind have it close before them, and it
    stands there ``lift`` times as often as in the middle of a text. ``max_cues`` of each kind and
    ``max_domains`` bound what the driver takes, most frequent first.
    """

    def run(batches):
        total: Counter = Counter()

        def out():
            keys = list(total)
            yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], pa.string()) for i in range(2)], pa.array([total[k] for k in keys], pa.int64())], ["what", "word", "n"])
            total.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                if "://" in text:
                    total.update(("domain", m[1].lower()) for m in _URL.finditer(text))
                # what stands at an ordinary place of a text: its middle
                middle = len(text) // 2
                total.update(("all", w) for w in {"", *_WORD.findall(text[max(0, middle - NEAR) : middle].lower())})
                for kind, a, b in base_spans(text):
                    total.update((kind, w) for w in {"", *_WORD.findall(text[max(0, a - NEAR) : a].lower())})
                    if kind == "email":
                        total["domain", text[a:b].rsplit(".", 1)[-1].lower()] += 1
            if len(total) > 100_000:
                yield from out()
        yield from out()

    counted = common.stored(common.map_arrow(rows.select("text"), run, "what string, word string, n bigint").groupBy("what", "word").agg(F.sum("n").alias("n")))
    domains = counted.filter((F.col("what") == "domain") & (F.col("n") >= min_seen)).orderBy(F.col("n").desc(), "word").limit(max_domains).collect()
    # the empty word stands in every context: at most five totals
    totals = {r.what: r.n for r in counted.filter("word = ''").collect()}
    whole = counted.filter("what = 'all'").select("word", F.col("n").alias("everywhere"))
    cues = {}
    for kind in BASE:
        if kind in totals:
            rate = F.col("n") / totals[kind] >= lift * F.coalesce("everywhere", F.lit(0)) / totals["all"]
            found = counted.filter((F.col("what") == kind) & (F.col("n") >= min_seen) & (F.col("word") != "")).join(whole, "word", "left").filter(rate)
            cues[kind] = frozenset(r.word for r in found.orderBy(F.col("n").desc(), "word").limit(max_cues).collect())
    return Gazetteer(_DOMAINS | {r.word for r in domains if r.word.isalpha()}, cues)


# ---- reliabilities and the classifier, on counts of patterns ----


@dataclass
class SpanClassifier:
    reliabilities: dict[str, np.ndarray]
    accepted: dict[tuple[str, tuple[int, ...]], float]
    known: Gazetteer = field(default_factory=Gazetteer)

    def probability(self, kind: str, features: tuple[int, ...]) -> float:
        """Of a candidate outside the base spans; one that fails its own checksum or range is none."""
        return 0.0 if features[2] else self.accepted.get((kind, features), 0.0)


def estimate(counts: list[tuple[str, tuple[int, ...], tuple[int, ...], int]], rounds: int = 40, ridge: float = 1.0) -> SpanClassifier:
    """From (kind, votes, features, n): labeler reliabilities by EM, then logistic regression."""
    reliabilities, accepted = {}, {}
    for kind in BASE:
        rows = sorted(r for r in counts if r[0] == kind)
        if not rows:
            continue
        votes = np.array([r[1] for r in rows]) + 1
        features = np.array([(1, *r[2]) for r in rows], np.float64)
        n = np.array([r[3] for r in rows], np.float64)
        # log P(vote | class): a labeler begins as right four times in five where it votes
        share = np.array([[[0.6, 0.2, 0.2], [0.2, 0.2, 0.6]]] * N_LABELERS)
        prior = 0.5
        for _ in range(rounds):
            logs = np.log([1 - prior, prior])[None, :] + sum(np.log(share[k][:, votes[:, k]]).T for k in range(N_LABELERS))
            q = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
            prior = float(np.clip((n * q).sum() / n.sum(), 0.02, 0.98))
            for k in range(N_LABELERS):
                for c, weight in enumerate((n * (1 - q), n * q)):
                    # pseudo-counts hold the classes in place where few patterns exist
                    seen = np.bincount(votes[:, k], weights=weight, minlength=3) + 10 * np.array([[0.6, 0.2, 0.2], [0.2, 0.2, 0.6]])[c]
                    share[k, c] = seen / seen.sum()
        reliabilities[kind] = share
        weights = np.zeros(features.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
            slope = features.T @ (n * (q - p)) - ridge * weights
            bend = (features * (n * p * (1 - p))[:, None]).T @ features + ridge * np.eye(len(weights))
            weights = weights + np.linalg.solve(bend, slope)
        for row, x in zip(rows, features):
            accepted[kind, row[2]] = float(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))
    return SpanClassifier(reliabilities, accepted)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SpanClassifier:
    """Labelers vote on every candidate of every text; only counts of patterns reach the driver."""
    rows = common.id_and_text(docs, id_col, text_col)
    known = learn_gazetteer(rows)
    held = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        known = held.value
        total: dict = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for (kind, _, _), _, votes, features in candidates(text, base_spans(text), known) if text else ():
                    total[kind, votes, features] = total.get((kind, votes, features), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in total], pa.string()), pa.array([list(v) for _, v, _ in total], pa.list_(pa.int32())), pa.array([list(f) for _, _, f in total], pa.list_(pa.int32())), pa.array(list(total.values()), pa.int64())],
            ["kind", "votes", "features", "n"],
        )

    counted = common.map_arrow(rows, run, "kind string, votes array<int>, features array<int>, n bigint").groupBy("kind", "votes", "features").agg(F.sum("n").alias("n"))
    # at most 4 x 3**6 x 2**8 patterns, whatever the input
    model = estimate([(r.kind, tuple(r.votes), tuple(r.features), r.n) for r in counted.collect()])
    model.known = known
    return model


def find_personal_data(docs: DataFrame, model: SpanClassifier, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.5) -> DataFrame:
    """(doc_id, spans, and the digest columns) of every whole text."""
    rows = common.id_and_text(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        for batch in batches:
            found, shas, listed = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                judged = [(span, is_base, model.probability(span[0], features)) for span, is_base, _, features in (candidates(text, base, model.known) if text else ())]
                kept = [((k if is_base else f"more_{k}", a, b), is_base, p) for (k, a, b), is_base, p in judged if is_base or p >= accept]
                found.append([{"kind": s[0], "start": s[1], "end": s[2], "base": is_base, "score": p} for s, is_base, p in kept])
                shas.append(spans.digest(base, KINDS))
                listed.append(spans.joined([s for s, _, _ in kept], KINDS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, spans.SPAN_ARROW), pa.array(shas, pa.string()), pa.array(listed, pa.string())], ["doc_id", "found", "base_sha256", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, found {spans.SPAN}, base_sha256 string, spans string")
