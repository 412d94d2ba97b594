"""Mixing sources to target weights, in DataFrame operations only.

A labelled table (quality, toxic) names three domains: ``toxic``, ``low`` and ``high``. A naive Bayes
classifier on binned text measures and on the words that tell the domains apart predicts soft
memberships of every document. Document rates r >= 0 then minimise, over domains, the squared relative
distance of the expected token totals (sum of tokens x membership x rate) from the targets, by
projected gradient steps from one common rate. A step depends on a document only
through its memberships, which are kept to three decimals: the iterations run on the table of distinct
memberships (at most half a million rows whatever the input) and the rates are joined back.

Bounds: the word list is learned from ``max_labelled`` labelled documents and has ``vocabulary`` words;
measures are learned from all labelled rows. Everything else covers all documents and whole texts.

Defined results: a null or empty text has no tokens, the prior memberships of its measures and a rate;
a domain without labelled rows gets membership 0; with no labels at all every membership is a third;
a target for a domain that no document belongs to can't be met and leaves the others as near as possible (a warning
says so); repeated rows of documents are rows of their own, repeated label rows count as often as they stand.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common

DOMAINS = ("high", "low", "toxic")
TARGETS = {"high": 0.85, "low": 0.10, "toxic": 0.05}


def domain_of() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "high")


#: Upper edges of the bins of each measure.
_EDGES = {
    "bars": (0.001, 0.01, 0.05),
    "marks": (0.001, 0.01, 0.05),
    "shouts": (0.005, 0.02, 0.06),
    "capitals": (0.01, 0.05, 0.2, 0.5),
    "digits": (0.001, 0.02, 0.1),
    "distinct": (0.05, 0.2, 0.4, 0.6, 0.8),
    "length": (2.0, 4.0, 5.5, 7.0, 9.0),
}


def _words(text: Column) -> Column:
    """Lower-case words, between spaces and line ends."""
    return F.filter(F.split(F.replace(F.lower(text), F.lit("\n"), F.lit(" ")), " "), lambda w: w != "")


def _measured(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, bins, words): binned measures and the distinct lower-case words."""
    text = F.coalesce("text", F.lit(""))
    # what the measures count is a few characters in a hundred; one pass takes them out
    marks = F.regexp_replace(text, r"[^\p{Lu}0-9|!#$%&*]+", "")
    rows = docs.select("doc_id", F.length(text).alias("chars"), marks.alias("marks"), _words(text).alias("words"))
    without = {"bars": r"[|]", "marks": r"[#$%&*]", "shouts": "!", "capitals": r"\p{Lu}", "digits": "[0-9]"}
    n = F.greatest(F.col("chars"), F.lit(1))
    one = F.greatest(F.size("words"), F.lit(1))
    rows = rows.withColumn("n_tokens", F.size("words").cast("long")).withColumn("per_word", n / one)
    rows = rows.withColumn("words", F.array_distinct("words"))
    value = {name: F.regexp_count("marks", F.lit(pattern)) / n for name, pattern in without.items()}
    value |= {"distinct": F.size("words") / F.greatest(F.col("n_tokens"), F.lit(1)), "length": F.col("per_word")}
    rows = rows.select("doc_id", "n_tokens", "words", *[v.alias(f"v_{name}") for name, v in value.items()])
    bins = [reduce(lambda total, edge: total + (F.col(f"v_{name}") > edge).cast("int"), _EDGES[name], F.lit(0)) for name in value]
    return rows.select("doc_id", "n_tokens", F.array(*bins).alias("bins"), "words")


def _told(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", domain_of().alias("domain")).filter("domain is not null and doc_id is not null")


def memberships(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, vocabulary: int = 256, min_support: int = 8, min_spread: float = 1.5) -> DataFrame:
    """(doc_id, n_tokens, p): soft memberships in DOMAINS, to three decimals, adding up to one."""
    told = _told(labels)
    chosen = told.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(max_labelled)
    counted = docs.join(F.broadcast(chosen), "doc_id").select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    sums = counted.groupBy("word").agg(*[F.sum((F.col("domain") == d).cast("long")).alias(d) for d in DOMAINS])
    totals = {r.domain: r["count"] for r in chosen.groupBy("domain").count().collect()}
    rate = {d: (F.col(d) + 0.5) / (totals.get(d, 0) + 1.0) for d in DOMAINS}
    spread = F.greatest(*[F.log(v) for v in rate.values()]) - F.least(*[F.log(v) for v in rate.values()])
    # a word counts when the domains use it at clearly different rates; mere frequency adds up to false certainty
    strong = sums.filter((sum(F.col(d) for d in DOMAINS) >= min_support) & (spread >= min_spread)).orderBy((spread * F.sqrt(sum(F.col(d) for d in DOMAINS).cast("double"))).desc(), "word").limit(vocabulary)
    words = [r.word for r in strong.select("word").collect()]

    rows = _measured(docs)
    listed = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    features = common.stored(rows.select("doc_id", "n_tokens", "bins", F.transform(F.array_intersect("words", listed), lambda w: F.array_position(listed, w).cast("int")).alias("hits")))
    known = features.join(told, "doc_id")
    # a few counts for each bin and word of the bounded lists
    names = list(_EDGES)
    seen = {(r.domain, r.k, r.bin): r["count"] for r in known.select("domain", F.posexplode("bins").alias("k", "bin")).groupBy("domain", "k", "bin").count().collect()}
    hit = {(r.domain, words[r.hit - 1]): r["count"] for r in known.select("domain", F.explode("hits").alias("hit")).groupBy("domain", "hit").count().collect()}
    n = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    everyone = sum(n.values())

    def log_of(domain: str) -> Column:
        own = n.get(domain, 0)
        base = math.log(own / everyone)
        score = F.lit(base)
        for k, name in enumerate(names):
            width = len(_EDGES[name]) + 1
            logs = [math.log((seen.get((domain, k, b), 0) + 0.5) / (own + 0.5 * width)) for b in range(width)]
            score = score + F.element_at(F.array(*map(F.lit, logs)), F.col("bins")[k] + 1)
        if words:
            p = {w: (hit.get((domain, w), 0) + 0.5) / (own + 1.0) for w in words}
            # only words that stand in the text: a word may be absent because the text is in another language
            odds = F.array(*[F.lit(math.log(p[w])) for w in words])
            score = score + F.aggregate("hits", F.lit(0.0), lambda t, k: t + F.element_at(odds, k))
        return score

    present = [d for d in DOMAINS if n.get(d)]
    if not present:
        third = F.array(F.lit(0.334), F.lit(0.333), F.lit(0.333))
        return features.select("doc_id", "n_tokens", third.alias("p"))
    scored = features.select("doc_id", "n_tokens", *[log_of(d).alias(d) for d in present])
    top = F.greatest(*present) if len(present) > 1 else F.col(present[0])
    scored = scored.select("doc_id", "n_tokens", *[F.exp(F.col(d) - top).alias(d) for d in present])
    whole = sum(F.col(d) for d in present)
    later = {d: F.round(F.col(d) / whole, 3) if d in present else F.lit(0.0) for d in DOMAINS}
    # what rounding leaves goes to the first domain that has rows
    later[present[0]] = F.round(1.0 - sum(later[d] for d in DOMAINS if d != present[0]), 3)
    return scored.select("doc_id", "n_tokens", F.array(*[later[d] for d in DOMAINS]).alias("p"))


def _power(matrix: list[list[float]], rounds: int = 200) -> float:
    """The largest eigenvalue of a small symmetric nonnegative matrix."""
    v, value = [1.0] * len(matrix), 0.0
    for _ in range(rounds):
        w = [sum(a * x for a, x in zip(row, v)) for row in matrix]
        value = math.sqrt(sum(x * x for x in w))
        if value == 0:
            return 0.0
        v = [x / value for x in w]
    return value


def _solved(matrix: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a small positive definite system, made a little more definite."""
    n = len(right)
    lift = 1e-9 * sum(matrix[i][i] for i in range(n)) + 1e-12
    rows = [[matrix[i][j] + (lift if i == j else 0.0) for j in range(n)] + [right[i]] for i in range(n)]
    for i in range(n):
        for k in range(i + 1, n):
            part = rows[k][i] / rows[i][i]
            rows[k] = [x - part * y for x, y in zip(rows[k], rows[i])]
    found = [0.0] * n
    for i in reversed(range(n)):
        found[i] = (rows[i][n] - sum(rows[i][j] * found[j] for j in range(i + 1, n))) / rows[i][i]
    return found


def fit_rates(masses: DataFrame, targets: list[float], start: float, steps: int = 60, tolerance: float = 1e-4, every: int = 6) -> DataFrame:
    """(p, rate) for a table (p, tokens): projected gradient steps on relative squared distances, rates never below 0.

    A step goes along the gradient, once as it is and once scaled by the curvature over the rates that are free to
    move, with several lengths; the best of these candidates is taken, so the distance falls at every step and
    at least as fast as by plain projected gradient. Steps end when every total is within ``tolerance`` of its target
    or nothing improves. Where the targets are not met then (they may be out of reach) a warning says by how much.
    """
    kinds = range(len(targets))
    unit = [1 / t if t > 0 else 1.0 for t in targets]
    wanted = [1.0 if t > 0 else 0.0 for t in targets]
    q = [F.col("p")[i] * unit[i] for i in kinds]

    def gram(rows: DataFrame) -> list[list[float]]:
        sums = rows.agg(*[F.sum(F.col("tokens") * q[i] * q[j]).alias(f"m{i}_{j}") for i in kinds for j in kinds]).first()
        return [[sums[f"m{i}_{j}"] or 0.0 for j in kinds] for i in kinds]

    def moved(pull: list[float]) -> Column:
        return F.greatest(F.lit(0.0), F.col("rate") - sum(q[i] * F.lit(pull[i]) for i in kinds))

    state = masses.select("p", "tokens", F.lit(float(start)).alias("rate"))
    largest = _power(gram(state))
    if largest == 0:
        return state.select("p", "rate")
    sums = state.agg(*[F.sum(F.col("tokens") * q[i] * F.col("rate")).alias(f"s{i}") for i in kinds]).first()
    off = [sums[f"s{i}"] - wanted[i] for i in kinds]
    for step in range(steps):
        if max(map(abs, off)) < tolerance:
            break
        # one small row of each pass reaches the driver
        free = (F.col("rate") > 0) | (sum(q[i] * F.lit(off[i]) for i in kinds) < 0)
        scaled = _solved(gram(state.filter(free)), off)
        pulls = [[2.0**-k * x for x in scaled] for k in range(6)] + [[2.0**k * x / largest for x in off] for k in range(4)]
        tried = state.select("tokens", "p", *[moved(pull).alias(f"r{k}") for k, pull in enumerate(pulls)])
        sums = tried.agg(*[F.sum(F.col("tokens") * q[i] * F.col(f"r{k}")).alias(f"s{k}_{i}") for k in range(len(pulls)) for i in kinds]).first()
        left = [[sums[f"s{k}_{i}"] - wanted[i] for i in kinds] for k in range(len(pulls))]
        best = min(range(len(pulls)), key=lambda k: sum(x * x for x in left[k]))
        if sum(x * x for x in left[best]) >= sum(x * x for x in off) * (1 - 1e-10):
            break
        state, off = state.select("p", "tokens", moved(pulls[best]).alias("rate")), left[best]
        if step % every == every - 1:
            state = common.stored(state)
    if max(map(abs, off)) >= tolerance:
        warnings.warn(f"targets not met: expected totals over targets are off by {[round(x, 5) for x in off]}", stacklevel=2)
    return state.select("p", "rate")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, budget: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, p_high, p_low, p_toxic, rate, expected_tokens) of every document.

    ``budget`` is the part of all tokens that the mixture shall have; ``weights`` its parts by domain.
    """
    weights = weights or TARGETS
    rows = common.stored(memberships(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), labels))
    masses = common.stored(rows.groupBy("p").agg(F.sum("n_tokens").cast("double").alias("tokens")).filter("tokens > 0"))
    total = masses.agg(F.sum("tokens").alias("t")).first().t or 0.0
    targets = [budget * total * weights.get(d, 0.0) for d in DOMAINS]
    rates = common.stored(fit_rates(masses, targets, budget))
    # at most 501,501 memberships to three decimals exist
    found = rows.join(common.if_small(rates), "p", "left").withColumn("rate", F.coalesce("rate", F.lit(budget)))
    return found.select("doc_id", "n_tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", (F.col("n_tokens") * F.col("rate")).alias("expected_tokens"))
