"""Counters to one wide row for each library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions.expressions import percent_text, ratio

#: What the logs of the steps say, as patterns with the place of the number. Only an importer of old logs needs them.
LOG_PATTERNS = {
    "umi_hq": (r"^.* (\d+)/(\d+) \([0-9.%]+\).*flag_extract\.py:246", 1),
    "input": (r"^.* (\d+)/(\d+) \([0-9.%]+\).*flag_extract\.py:246", 2),
    "prefix": (r"^.* (\d+)/(\d+) \([0-9.%]+\).*flag_regex\.py:156", 1),
    "unmapped": (r"^\s+(\d+) \([0-9.]+%\) aligned 0 times", 1),
    "second_aln": (r"^\s+(\d+) \([0-9.]+%\) aligned >1 times", 1),
    "from_cs": (r"^.*?Output: (\d+) \([0-9.]+%\) UMI sequences over (\d+)", 1),
    "uniq": (r"^(\d+) UMIs left after deduplication", 1),
    "unassigned": (r"^(\d+) reads were unassignable", 1),
    "genome1": (r"^(\d+) reads were specific for genome 1", 1),
    "genome2": (r"^(\d+) reads were specific for genome 2", 1),
    "weird": (r"^(\d+) reads did not contain one of the expected bases at known SNP positions", 1),
    "conflict": (r"^(\d+) contained conflicting allele-specific SNPs", 1),
}

#: Each share of the library summary: (column, part, whole). Reads from cut sites are a share of those on chromosomes that have sites.
SHARES = (
    ("umi_hq_share", "umi_hq", "input"), ("prefix_share", "prefix", "umi_hq"), ("mapped_share", "mapped", "prefix"),
    ("from_cs_share", "from_cs", "n_umis"), ("uniq_share", "uniq", "from_cs"), ("out_share", "uniq", "input"),
)
COUNTERS = ("input", "umi_hq", "prefix", "unmapped", "second_aln", "chrm", "low_mapq", "mapped", "n_umis", "from_cs", "uniq")


def log_values(lines: DataFrame, patterns: dict = LOG_PATTERNS, by: tuple[str, ...] = ("library_id",)) -> DataFrame:
    """Long counters from log lines (library_id, line_no, line); of several lines that match, the last counts."""
    each = [F.when(F.col("line").rlike(p), F.struct(F.lit(m).alias("metric"), F.regexp_extract("line", p, g).cast("long").alias("value"))) for m, (p, g) in patterns.items()]
    found = lines.select(*by, "line_no", F.explode(F.array_compact(F.array(*each))).alias("x"))
    return found.groupBy(*by, F.col("x.metric").alias("metric")).agg(F.max_by("x.value", "line_no").alias("value"))


def wide(counters: DataFrame, metrics: tuple[str, ...], by: str = "library_id") -> DataFrame:
    """One row for each library, a column for each named metric; a metric that is missing is null. The list spares a scan for it."""
    return counters.groupBy(by).pivot("metric", list(metrics)).agg(F.first("value", ignorenulls=True))


def with_shares(table: DataFrame, shares=SHARES) -> DataFrame:
    return table.withColumns({name: ratio(F.col(part), F.col(whole)) for name, part, whole in shares})


def require(table: DataFrame, *columns: str) -> DataFrame:
    """Fails the job on a library in which a metric is missing."""
    message = lambda c: F.concat(F.lit(f"no {c} for library "), F.col("library_id").cast("string"))
    return table.withColumns({c: F.when(F.col(c).isNull(), F.raise_error(message(c)).cast(table.schema[c].dataType)).otherwise(F.col(c)) for c in columns})


def library_summary(counters: DataFrame, run: str = "") -> DataFrame:
    table = with_shares(wide(counters, COUNTERS))
    return table.select(F.lit(run).alias("prep_run"), "*")


def allelic_summary(counters: DataFrame) -> DataFrame:
    """counters: library_id, genome (g1, g2, m or empty for the whole library), metric, value."""
    named = counters.withColumn("metric", F.when(F.col("genome") == "", F.col("metric")).otherwise(F.concat_ws("_", "genome", "metric")))
    own = ("mapped", "unassigned", "genome1", "genome2", "weird", "conflict")
    tails = tuple(f"{g}_{m}" for g in ("g1", "g2", "m") for m in ("n_umis", "from_cs", "uniq"))
    return allelic_shares(wide(named, own + tails))


def allelic_shares(table: DataFrame) -> DataFrame:
    """The shares of the allelic summary, from its counters in columns."""
    table = table.withColumn("both", F.col("genome1") + F.col("genome2"))
    shares = [(f"{c}_share", c, "mapped") for c in ("unassigned", "genome1", "genome2", "weird", "conflict")]
    for g, whole in (("g1", "genome1"), ("g2", "genome2"), ("m", "both")):
        shares += [(f"{g}_from_cs_share", f"{g}_from_cs", f"{g}_n_umis"), (f"{g}_uniq_share", f"{g}_uniq", f"{g}_from_cs"), (f"{g}_out_share", f"{g}_uniq", whole)]
    return with_shares(table, shares).drop("both")


def as_text(table: DataFrame) -> DataFrame:
    """Shares as percent text under <name>%; for a sink."""
    return table.select(*(percent_text(F.col(c)).alias(c.removesuffix("_share") + "%") if c.endswith("_share") else F.col(c) for c in table.columns))
