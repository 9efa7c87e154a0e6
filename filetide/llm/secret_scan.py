"""Secrets in whole texts, with Spark SQL functions only.

Three fixed patterns give the base spans. Beyond them, every long run of key characters is tested for
randomness over the smallest alphabet that holds it: chi-squared of its letter counts, number of runs
above and below the middle of the alphabet, and correlation of neighbours. Runs that any test rejects
are no secrets. For the others, the chance that an ordinary identifier changes its character class so
often, or has so many letters that are uncommon in words, is bounded, and in each class of lengths only as many are reported as keep the share of false
ones below ``FALSE_SHARE`` (Benjamini and Hochberg's rule, from a histogram of all tested runs).

A null text is empty and has no spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filetide.llm.spans import matches

KEYWORDS = "(?i:password|passwd|secret|token|api_?key)"
ASSIGN = f"({KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
# Whole runs of these characters that are long enough: a shorter run has no longer part.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_RUN = 20
RUN = "[A-Za-z0-9+/_-]{%d,}" % LEAST_RUN

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {  # kind: letters in the order of their values
    "random_hex": DIGITS + "abcdef", "random_upper_hex": DIGITS + "ABCDEF", "random_lower": LOWER, "random_upper": UPPER,
    "random_base32": UPPER + "234567", "random_lower_base32": LOWER + "234567", "random_base36": DIGITS + LOWER,
    "random_upper_base36": DIGITS + UPPER,
    "random_base62": UPPER + LOWER + DIGITS, "random_base64": UPPER + LOWER + DIGITS + "+/",
    "random_base64url": UPPER + LOWER + DIGITS + "-_", "random_key": UPPER + LOWER + DIGITS + "+/-_",
}
KINDS = ["assign", "access", "hex", *ALPHABETS]
REJECT = 3.0  # standard deviations at which a test rejects randomness
CHANGE = 0.1  # an identifier changes its character class at most this often
RARE, RARELY = "bcfgjkmpqvwxyz", 0.25  # at most this share of a word's letters; below 0.2 in en, de, fr and es
FALSE_SHARE = 0.01
STEP, STEPS = 0.25, 80  # bins of -log10 of the chance


def base_spans(text: Column) -> Column:
    named = lambda kind, found: F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))
    assign = F.filter(matches(text, ASSIGN, KEYWORDS, group=2), lambda x: F.length(x["match"]) >= 6)
    return F.concat(named("assign", assign), named("access", matches(text, ACCESS, "AKIA")),
                    named("hex", matches(text, HEX)))


def alphabet(run: Column) -> Column:
    """The number of the first alphabet that has all letters of the run."""
    kind = F.lit(len(ALPHABETS) - 1)
    for number, letters in reversed(list(enumerate(ALPHABETS.values()))[:-1]):
        kind = F.when(F.length(F.translate(run, letters, "")) == 0, number).otherwise(kind)
    return kind


def battery(run: Column, kind: Column) -> Column:
    """The largest of the three test statistics, in standard deviations from randomness."""
    letters = F.element_at(F.array(*[F.lit(x) for x in ALPHABETS.values()]), kind + 1)
    k, n = F.length(letters).cast("double"), F.length(run).cast("double")
    values = F.transform(F.split(run, ""), lambda c: F.instr(letters, c).cast("double"))  # from 1; 0: a trailing empty part
    values = F.filter(values, lambda v: v > 0)
    squares = F.aggregate(F.array_distinct(F.split(run, "")), F.lit(0.0), lambda acc, c: F.when(
        c == "", acc).otherwise(acc + F.pow(n - F.length(F.replace(run, c, F.lit(""))), F.lit(2.0))))
    chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    half = F.array_join(F.transform(values, lambda v: F.when(v > k / 2, "1").otherwise("0")), "")
    above = F.length(F.replace(half, F.lit("0"), F.lit(""))).cast("double")
    both = 2 * above * (n - above)
    expected = both / n + 1
    spread = F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(0.01))
    runs = F.abs(F.length(F.regexp_replace(half, "0+|1+", "x")) - expected) / F.sqrt(spread)
    # From plain sums: nothing of the whole run is worked out again for each letter.
    total = lambda parts: F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)
    mean = total(values) / n
    whole = total(F.transform(values, lambda v: v * v)) - n * mean * mean
    products = total(F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1),
                                lambda x, y: x * y))
    ends = F.element_at(values, 1) + F.element_at(values, -1)
    next_to = products - mean * (2 * n * mean - ends) + (n - 1) * mean * mean
    serial = F.abs(next_to / F.greatest(whole, F.lit(1e-9)) + 1 / n) * F.sqrt(n)
    return F.greatest(chi, runs, serial)


def exceeding(share: Column, most: float, steps: Column) -> Column:
    """-log10 of a bound on the chance of such a share in so many steps, where ``most`` is usual."""
    share = F.least(share, F.lit(1 - 1e-9))
    excess = share * F.log(share / most) + (1 - share) * F.log((1 - share) / (1 - most))
    return F.when(share > most, steps * excess / math.log(10)).otherwise(0.0)


def chance(run: Column) -> Column:
    """-log10 of a bound on the chance that an ordinary identifier changes class so often or has so many
    uncommon letters among its letters; the bound is doubled where there are both to choose from."""
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        run, "[a-z]+", "."), "[A-Z]+", ","), "[0-9]+", ";"), "[+/_-]+", ":")
    n = F.length(run).cast("double")
    plain = F.regexp_replace(F.lower(run), "[^a-z]+", "")
    letters = F.length(plain).cast("double")
    rare = letters - F.length(F.translate(plain, RARE, ""))
    words = F.when(letters > 0, exceeding(rare / letters, RARELY, letters)).otherwise(0.0)
    changes = exceeding((F.length(classes) - 1) / (n - 1), CHANGE, n - 1)
    return F.when(F.length(classes) == 1, words).otherwise(F.greatest(changes, words) - math.log10(2))


def tested_runs(text: Column) -> Column:
    """Every long run with its kind, length class and bin of chances; only those no test rejects."""
    with_kind = F.transform(matches(text, RUN), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), alphabet(x["match"]).alias("kind"), x["match"].alias("match")))
    judged = F.transform(with_kind, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"),
        F.floor(2 * F.log2((x["end"] - x["start"]).cast("double"))).cast("int").alias("size"),
        F.least(F.floor(F.greatest(chance(x["match"]), F.lit(0.0)) / STEP), F.lit(STEPS)).cast("int").alias("bin"),
        (battery(x["match"], x["kind"]) < REJECT).alias("random")))
    return judged


def limits(tested: DataFrame) -> dict[int, int]:
    """For each class of lengths the least bin that is reported; at most one row for each class and bin
    reaches the driver. Rejected runs count as tested, with chance 1."""
    rows = tested.select(F.explode("tested").alias("t")).select(
        F.col("t.size").alias("size"), F.when(F.col("t.random"), F.col("t.bin")).otherwise(0).alias("bin")).groupBy(
            "size", "bin").count().collect()
    found = {}
    for size in {r["size"] for r in rows}:
        counts = {r["bin"]: r["count"] for r in rows if r["size"] == size}
        total = sum(counts.values())
        passing = [b for b in range(1, STEPS + 1) if (
            more := sum(c for x, c in counts.items() if x >= b)) and 10 ** (-b * STEP) <= FALSE_SHARE * more / total]
        if passing:
            found[size] = min(passing)
    return found


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``secrets``, an array of (start, kind, end): kind is a number in
    KINDS, ordered by start and then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    least = limits(docs.select(tested_runs(whole).alias("tested")))
    base = base_spans(whole)
    if least:
        table = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
        random = F.transform(
            F.filter(tested_runs(whole), lambda x: x["random"] & (x["bin"] >= table[x["size"]])),
            lambda x: F.struct(x["start"].alias("start"), (x["kind"] + 3).cast("int").alias("kind"), x["end"].alias("end")))
        base = F.concat(base, random)
    return docs.withColumn("secrets", F.array_sort(base))


def written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
