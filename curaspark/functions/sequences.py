"""Scalar functions over aligned nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amino acids of the codons over TCAG in order, mitochondrial code 4 (TGA is W).
_BASES, _AMINO = "TCAG", "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = dict(zip((a + b + c for a in _BASES for b in _BASES for c in _BASES), _AMINO))


def translate4(c: Column) -> Column:
    """Codons of frame 1 to amino acids, X for any that is unknown, a rest of one or two bases left out."""
    table = F.create_map(*[F.lit(x) for pair in CODONS.items() for x in pair])
    starts = F.when(F.length(c) >= 3, F.sequence(F.lit(1), F.length(c) - 2, F.lit(3))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(starts, lambda i: F.coalesce(F.element_at(table, F.upper(F.substring(c, i, F.lit(3)))), F.lit("X"))), "")


def count_stops(c: Column) -> Column:
    amino = translate4(c)
    return F.length(amino) - F.length(F.replace(amino, F.lit("*"), F.lit("")))


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(F.upper(c), "ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN"))


def place_in_window(c: Column, offset: Column, width: int) -> Column:
    """The sequence at an offset of a window, N elsewhere; what stands outside is cut."""
    shifted = F.when(offset >= 0, F.concat(F.repeat(F.lit("N"), offset.cast("int")), c)).otherwise(F.substring(c, (1 - offset).cast("int"), F.lit(width)))
    return F.rpad(shifted, width, "N")


def window_span(offset: Column, length: Column, width: int) -> Column:
    return F.struct(F.greatest(offset + 1, F.lit(1)).alias("first"), F.least(offset + length, F.lit(width)).alias("last"))


def determined_bases(c: Column) -> Column:
    return F.length(F.regexp_replace(F.upper(c), "[^ACGT]", ""))


def sequence_masks(c: Column, width: int, word: int = 60) -> Column:
    """For A, C, G, T in turn the positions that carry the base, as ``word``-bit numbers.

    The bits of a word are summed as powers of two of the characters' positions.
    """
    words = range(0, width, word)

    def packed(base: str, start: int) -> Column:
        binary = F.regexp_replace(F.regexp_replace(F.rpad(F.substring(F.upper(c), start + 1, word), word, "N"), f"[^{base}]", "0"), base, "1")
        return F.conv(binary, 2, 10).cast("long")

    return F.array(*[packed(b, s) for b in "ACGT" for s in words])


def masks_compared(a: Column, b: Column, width: int, word: int = 60) -> tuple[Column, Column, Column, Column]:
    """(positions determined in both, mismatches among them, only in a, only in b) of two mask arrays."""
    n = -(-width // word)

    def known(m: Column, w: int) -> Column:
        return m[w].bitwiseOR(m[n + w]).bitwiseOR(m[2 * n + w]).bitwiseOR(m[3 * n + w])

    both = sum(F.bit_count(known(a, w).bitwiseAND(known(b, w))) for w in range(n))
    same = sum(F.bit_count(a[k * n + w].bitwiseAND(b[k * n + w])) for w in range(n) for k in range(4))
    own_a, own_b = (sum(F.bit_count(known(m, w)) for w in range(n)) for m in (a, b))
    return both, both - same, own_a - both, own_b - both


def sequence_change_text(was: Column, now: Column, shown: int = 8) -> Column:
    """Positions where two sequences of one length differ, the first few written out."""
    cells = F.zip_with(F.split(was, ""), F.split(now, ""), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    changes = F.filter(F.transform(cells, lambda x, i: F.when(~x["a"].eqNullSafe(x["b"]), F.concat(x["a"], (i + 1).cast("string"), x["b"]))), lambda t: t.isNotNull())
    more = F.when(F.size(changes) > shown, F.concat(F.lit(" and "), (F.size(changes) - shown).cast("string"), F.lit(" more"))).otherwise("")
    return F.when(F.length(was) != F.length(now), "length differs").otherwise(F.concat(F.array_join(F.slice(changes, 1, shown), ", "), more))


# The bases that each ambiguity code stands for.
CODES = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG"}


def code_matches(a: Column, b: Column) -> Column:
    """Positions where one side has an ambiguity code that covers the other side's base."""
    table = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])

    def covers(code: Column, base: Column) -> Column:
        return F.coalesce(base.isin(*"ACGT") & F.element_at(table, code).contains(base), F.lit(False))

    hits = F.zip_with(F.split(F.upper(a), ""), F.split(F.upper(b), ""), lambda x, y: covers(x, y) | covers(y, x))
    return F.size(F.filter(hits, lambda v: v))
