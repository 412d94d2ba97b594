"""What the two span finders share: spans as (kind, start, end) lists and their digests."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa

#: (kind, start, end) in code points, end exclusive.
Span = tuple[str, int, int]
SPAN = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))


def joined(spans: list[Span], order: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    rank = {kind: k for k, kind in enumerate(order)}
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2])))


def digest(spans: list[Span], order: tuple[str, ...]) -> str:
    return hashlib.sha256(joined(spans, order).encode()).hexdigest()


class Cover:
    """Spans in order, to ask in logarithmic time whether any of them overlaps another."""

    def __init__(self, spans: list[Span]):
        placed = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in placed]
        self.reach = list(accumulate((b for _, b in placed), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start
