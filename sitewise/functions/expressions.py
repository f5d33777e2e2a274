"""Column expressions of the domain; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the public alignment-record flag field.
UNMAPPED, REVERSE, SECONDARY, PAIRED, MATE_UNMAPPED = 0x4, 0x10, 0x100, 0x1, 0x8


def phred(quality: Column) -> Column:
    """An array of base qualities from a Phred+33 string; empty for an empty string."""
    # split() on the empty pattern leaves one character for each element
    return F.transform(F.filter(F.split(quality, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def low_quality_share(quality: Column, below: int = 30) -> Column:
    """Share of bases under the quality; null for an empty string."""
    q = phred(quality)
    return F.size(F.filter(q, lambda x: x < below)) / F.nullif(F.size(q), F.lit(0))


def near_literal(sequence: Column, expected: str, substitutions: int = 1) -> Column:
    """Whether a sequence equals the expected one up to substitutions; equal lengths make one edit one substitution.

    Beyond one, edits could pair an insertion with a deletion, so mismatches are counted by position.
    """
    same_length = F.length(sequence) == len(expected)
    if substitutions <= 1:
        return same_length & (F.levenshtein(sequence, F.lit(expected)) <= substitutions)
    mismatches = sum(((F.substring(sequence, i + 1, 1) != base).cast("int") for i, base in enumerate(expected)), F.lit(0))
    return same_length & (mismatches <= substitutions)


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that an alignment covers: the sum over M, D, N, = and X."""
    runs = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(runs, F.lit(0).cast("long"), lambda total, run: total + run.cast("long"))


def cigar_runs(cigar: Column) -> Column:
    """An alignment's runs as an array of (length, op), in order; empty where there is none (* or null)."""
    found = lambda group: F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(group))
    return F.zip_with(found(1), found(2), lambda n, op: F.struct(n.cast("long").alias("length"), op.alias("op")))


def query_place(runs: Column, start: Column, pos: Column) -> Column:
    """Where a read that is aligned from start (zero-based) holds a position of the reference: a struct of kind and offset.

    kind is base (offset is the place in the sequence, from 0), deleted (D), skipped (N), clipped (under a soft clip, which lies before or after the aligned part; its bases have an offset too)
    or outside. Insertions (I) move the offset, hard clips and padding (H, P) move nothing. One walk over the runs: read and reference advance as each of them says.
    """
    pos, none = pos.cast("long"), F.lit(None).cast("long")
    begin = F.struct(start.cast("long").alias("ref"), F.lit(0).cast("long").alias("query"), F.lit(False).alias("aligned"), F.lit("outside").alias("kind"), none.alias("offset"))

    def step(seen: Column, run: Column) -> Column:
        op, length = run["op"], run["length"]
        on_reference, on_read = op.isin("M", "D", "N", "=", "X"), op.isin("M", "I", "S", "=", "X")
        first = F.when((op == "S") & ~seen["aligned"], seen["ref"] - length).otherwise(seen["ref"])  # a clip before the aligned part ends at start
        hit = (on_reference | (op == "S")) & (pos >= first) & (pos < first + length) & (seen["kind"] == "outside")
        kind = F.when(op == "D", "deleted").when(op == "N", "skipped").when(op == "S", "clipped").otherwise("base")
        return F.struct(
            (seen["ref"] + F.when(on_reference, length).otherwise(0)).alias("ref"), (seen["query"] + F.when(on_read, length).otherwise(0)).alias("query"), (seen["aligned"] | on_reference).alias("aligned"),
            F.when(hit, kind).otherwise(seen["kind"]).alias("kind"), F.when(hit & on_read, seen["query"] + pos - first).otherwise(seen["offset"]).alias("offset"),
        )

    return F.aggregate(runs, begin, step, lambda seen: F.struct(seen["kind"].alias("kind"), seen["offset"].alias("offset")))


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(bit) != 0


def ratio(part: Column, whole: Column) -> Column:
    """A share as a double; null where there is nothing to divide by."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent_text(share: Column) -> Column:
    """Text such as 12.34%; only for sinks, never for comparing."""
    return F.format_string("%.2f%%", share * 100)


def named_token(name: Column, label: str) -> Column:
    """The value that follows a label in a ~~label~value read name; null where the label is missing."""
    return F.nullif(F.regexp_extract(name, f"~~{label}~([^~]*)", 1), F.lit(""))
