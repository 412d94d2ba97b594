"""Secret scans: plain patterns, and formats learned as probabilistic automata.

The base patterns are assignments, access keys and hexadecimal runs. Their values, a bounded sample
taken over the whole corpus, are labelled credentials: one prefix tree of character classes for
each kind, whose states are merged where Hoeffding's bound does not tell their outgoing shares apart
(ALERGIA). Long tokens outside the base spans are the candidates of the second pass; each is scored
with every automaton against a background of ordinary long tokens, all candidates of every text, digits or not.
A candidate becomes a ``grammar`` span when the best format explains it better than the background
by a margin that the learned credentials themselves keep.

Bounds: ``max_labelled`` values of each kind and ``max_background`` tokens are learned from, the first
in the order of their hashes over the whole corpus.

Defined results: null or empty texts have no spans; without any labelled credential there are base
spans only; equal texts get equal spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common, spans

KINDS = ("assign", "access", "hex", "grammar")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: The characters and the least length of a labelled value.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
_PART = re.compile(r"[A-Za-z0-9+/_=-]{8,}")


def base_spans(text: str) -> list[spans.Span]:
    found: list[spans.Span] = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def tokens(text: str, base: list[spans.Span]) -> list[tuple[int, int]]:
    """The places of all long tokens outside the base spans."""
    cover = spans.Cover(base)
    return [m.span() for m in _CANDIDATE.finditer(text) if not (base and cover.meets(*m.span()))]


def values(text: str) -> list[tuple[str, str]]:
    """The credential inside each base span, by kind."""
    found = []
    for kind, a, b in base_spans(text):
        match = _ASSIGN.match(text, a) if kind == "assign" else None
        found.append((kind, match[2] if match else text[a:b]))
    return found


# ---- probabilistic automata ----

#: Character classes and the number of characters in each.
_CLASSES = {**dict.fromkeys("0123456789", "9"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"), **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G")}
_SIZES = Counter(_CLASSES.values())


def classes(value: str) -> str:
    return "".join(_CLASSES.get(c, c) for c in value)


@dataclass
class State:
    arrivals: int = 0
    ends: int = 0
    moves: dict[str, State] = field(default_factory=dict)
    counts: Counter = field(default_factory=Counter)


def _tree(words: list[str]) -> State:
    root = State()
    for word in words:
        state = root
        state.arrivals += 1
        for symbol in word:
            state.counts[symbol] += 1
            state = state.moves.setdefault(symbol, State())
            state.arrivals += 1
        state.ends += 1
    return root


def _differ(f1: int, n1: int, f2: int, n2: int, slack: float) -> bool:
    return abs(f1 / n1 - f2 / n2) > slack * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def _compatible(red: State, blue: State, slack: float) -> bool:
    """Whether the bound tells no two states apart that the same symbols lead to, however long the words are."""
    work = [(red, blue)]
    while work:
        one, two = work.pop()
        if _differ(one.ends, one.arrivals, two.ends, two.arrivals, slack):
            return False
        for symbol in set(one.counts) | set(two.counts):
            if _differ(one.counts[symbol], one.arrivals, two.counts[symbol], two.arrivals, slack):
                return False
        work += [(one.moves[s], two.moves[s]) for s in set(one.moves) & set(two.moves) if one.moves[s] is not two.moves[s]]
    return True


def _fold(red: State, blue: State) -> None:
    """Add a subtree's counts to the automaton, state by state."""
    work = [(red, blue)]
    while work:
        into, tree = work.pop()
        into.arrivals += tree.arrivals
        into.ends += tree.ends
        into.counts.update(tree.counts)
        for symbol, child in tree.moves.items():
            if symbol in into.moves:
                work.append((into.moves[symbol], child))
            else:
                into.moves[symbol] = child


@dataclass
class Automaton:
    """States by number: (moves, log share of each symbol for one character, log share of the end)."""

    moves: list[dict[str, int]]
    logs: list[dict[str, float]]
    ends: list[float]

    def score(self, word: str) -> float:
        """Log likelihood of a class string, each step with a floor for unseen ones."""
        at, total = 0, 0.0
        for symbol in word:
            logs = self.logs[at]
            if symbol not in logs:
                return total + FLOOR * (len(word) + 1)
            total += logs[symbol]
            at = self.moves[at][symbol]
        return total + self.ends[at]


FLOOR = -8.0


def infer(words: list[str], alpha: float = 0.05) -> Automaton:
    """Merge compatible states of the prefix tree of class strings, nearest to the root first."""
    slack = math.sqrt(0.5 * math.log(2 / alpha))
    root = _tree(sorted(words))
    red, queue = [root], deque((root, s) for s in sorted(root.moves))
    while queue:
        parent, symbol = queue.popleft()
        blue = parent.moves[symbol]
        if any(blue is r for r in red):
            continue
        for state in red:
            if _compatible(state, blue, slack):
                parent.moves[symbol] = state
                _fold(state, blue)
                # the fold may have reached any red state and given it moves
                known, reds = {(id(p), s) for p, s in queue}, {id(r) for r in red}
                queue.extend((r, s) for r in red for s in sorted(r.moves) if id(r.moves[s]) not in reds and (id(r), s) not in known)
                break
        else:
            red.append(blue)
            queue.extend((blue, s) for s in sorted(blue.moves))
    number = {id(state): k for k, state in enumerate(red)}
    automaton = Automaton([], [], [])
    for state in red:
        total = state.arrivals + 1
        automaton.moves.append({s: number[id(t)] for s, t in state.moves.items()})
        automaton.logs.append({s: math.log(n / total / _SIZES.get(s, 1)) for s, n in state.counts.items()})
        automaton.ends.append(math.log((state.ends + 0.5) / total))
    return automaton


@dataclass
class Grammar:
    formats: dict[str, Automaton]
    background: Automaton | None
    margins: dict[str, float]
    #: what tokens seen before gave
    known: dict[str, list[tuple[int, int, float]]] = field(default_factory=dict)

    def margin(self, token: str) -> tuple[float, str]:
        """The best format's log likelihood over the background's, for one character, and its kind."""
        word = classes(token)
        plain = self.background.score(word) if self.background else FLOOR * (len(word) + 1)
        return max(((a.score(word) - plain) / (len(word) + 1) - self.margins[kind], kind) for kind, a in self.formats.items())

    def added(self, text: str, base: list[spans.Span]) -> list[tuple[spans.Span, float]]:
        if not self.formats:
            return []
        found = []
        for a, b in tokens(text, base):
            token = text[a:b]
            hits = self.known.get(token)
            if hits is None:
                hits = self.hits(token)
                if len(self.known) >= 100_000:
                    self.known.clear()
                if len(token) <= 64:
                    self.known[token] = hits
            found += [(("grammar", a + start, a + end), margin) for start, end, margin in hits]
        return found

    def hits(self, token: str) -> list[tuple[int, int, float]]:
        """(start, end, margin) of what of a token fits a format: the whole of it, or else its parts between dots."""
        whole, _ = self.margin(token)
        if whole >= 0:
            return [(0, len(token), whole)]
        if "." not in token:
            return []
        parts = [(m.start(), m.end(), self.margin(m[0])[0]) for m in _PART.finditer(token)]
        return [p for p in parts if p[2] >= 0]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = 400, max_background: int = 2000) -> Grammar:
    """Automata from the corpus's own base matches and ordinary tokens."""
    rows = common.id_and_text(docs, id_col, text_col)

    def run(batches):
        seen: set[tuple[str, str]] = set()  # only spares repetitions
        for batch in batches:
            kinds, found = [], []
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                held = {*values(text), *(("plain", text[a:b]) for a, b in tokens(text, base_spans(text)))} - seen
                if len(seen) > 200_000:
                    seen.clear()
                seen |= held
                kinds += [k for k, _ in held]
                found += [v for _, v in held]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(found, pa.string())], ["kind", "value"])

    distinct = common.stored(common.map_arrow(rows, run, "kind string, value string").distinct())
    labelled: dict[str, list[str]] = {}
    for kind, n in (("assign", max_labelled), ("access", max_labelled), ("hex", max_labelled), ("plain", max_background)):
        # at most n short values
        best = distinct.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(n).collect()
        if best:
            labelled[kind] = [r.value for r in best]
    return grammar(labelled)


def grammar(labelled: dict[str, list[str]]) -> Grammar:
    """From credentials by kind, and under ``plain`` ordinary tokens."""
    plain = labelled.get("plain", [])
    background = infer([classes(v) for v in plain]) if plain else None
    model = Grammar({}, background, {})
    for kind in KINDS[:3]:
        known = labelled.get(kind)
        if not known:
            continue
        # every fifth value is kept from the automaton and sets the margin
        tests = known[::5] if len(known) >= 10 else known
        learned = [v for k, v in enumerate(known) if k % 5] if len(known) >= 10 else known
        model.formats[kind] = infer([classes(v) for v in learned])
        model.margins[kind] = 0.0
        kept = sorted((model.formats[kind].score(classes(v)) - (background.score(classes(v)) if background else FLOOR * (len(v) + 1))) / (len(v) + 1) for v in tests)
        model.margins[kind] = max(0.0, kept[len(kept) // 20])
    return model


def find_secrets(docs: DataFrame, model: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, and the digest columns) of every whole text."""
    rows = common.id_and_text(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = held.value
        for batch in batches:
            found, shas, listed = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                more = model.added(text, base) if text else []
                found.append([{"kind": k, "start": a, "end": b, "base": True, "score": 1.0} for k, a, b in base] + [{"kind": k, "start": a, "end": b, "base": False, "score": s} for (k, a, b), s in more])
                shas.append(spans.digest(base, KINDS))
                listed.append(spans.joined(base + [s for s, _ in more], KINDS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, spans.SPAN_ARROW), pa.array(shas, pa.string()), pa.array(listed, pa.string())], ["doc_id", "found", "base_sha256", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, found {spans.SPAN}, base_sha256 string, spans string")
