"""Secret scan: three base patterns, and a battery of randomness tests on every long token.

Only DataFrame functions are used. Places in a text come from its split at the matches: the lengths of gaps and
matches are added up in order, so only numbers, not texts, are shuffled, and only for texts that match.

A candidate is a run of 20 or more characters of the usual encodings. Its encoding is inferred (hexadecimal, letters of one case, base 32,
base 36, base 64; digits alone have none) and three statistics are taken against it:

* chi-squared of the counts of the k symbols against a uniform alphabet;
* the number of runs of character classes (lower, upper, digit; marks left out, as they also join words) given how
  many of each there are;
* the lag-one serial correlation of symbol values.

Where all characters are of one class the runs have no distribution; that test is left out. A random token passes all others, which share
the level ALPHA (two-sided). To be a discovery it must also be unlike
ordinary text: the p-value that prose in that encoding, which repeats symbols and rarely changes class,
looks as even and as broken up. The noncentral chi-squared and the binomial behind this p-value grow with
length, so a short token is never enough by itself. Benjamini-Hochberg's step-up at the rate FDR, in each
stratum of encoding and length, decides over all candidates of the corpus. P-values are rounded up to
steps of a quarter of a decimal power, so counts of steps, of bounded number, are all it needs.

Defined results: a null text is empty; copies of a text are one text to the false-discovery control; a random span inside a
base span is not repeated; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.common import attach, text_hash
from pluvia.session import materialise

ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a run of 32 or more is the same as any run, of which the short ones are dropped
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")

ALPHA = 0.01
FDR = 0.01
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"
#: Encoding: symbols, and the chance that two symbols of ordinary text in it are the same.
ENCODINGS = {"hex": (16, 0.12), "letters": (26, 0.065), "base32": (32, 0.065), "base36": (36, 0.065), "base64": (64, 0.065)}
#: How often ordinary text changes its character class from one symbol to the next.
CLASS_CHANGES = 0.1
LENGTH_BAND, BANDS = 16, 8
STEPS = 4  # of p-values in a decimal power

TEXT = ["row", "check"]


def upper_tail(z: Column) -> Column:
    """The chance that a standard normal number is over ``z``, to a relative error below 1.2e-7 (the usual
    rational approximation of erfc by Chebyshev fitting)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.5 * x)
    # Fixed values of the approximation, from the constant term on.
    terms = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)
    poly = F.lit(0.0)
    for c in reversed(terms):
        poly = poly * t + c
    tail = t * F.exp(-x * x + poly) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def matched(text: str, pattern: str, kind: str) -> Column:
    """An array of (kind, at, gap, match): each match, its number, and the code points since the one before."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(F.col(text), pattern, -1)
    structs = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), F.char_length(x["g"]).cast("long").alias("gap"), x["m"].alias("match")),
    )
    return F.when(F.col(text).rlike(pattern), structs)


def spans(docs: DataFrame) -> DataFrame:
    """(row, check, kind, start, end, match): base spans that hold, and every candidate, once for each text."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(text_hash().alias("row"), F.crc32("text").alias("check"), "text")
    kinds = zip((ASSIGN, ACCESS, HEX, CANDIDATE), KINDS, strict=True)
    arrays = [F.coalesce(matched("text", p, k), F.array().cast("array<struct<kind:string,at:int,gap:bigint,match:string>>")) for p, k in kinds]
    rows = texts.select(*TEXT, F.concat(*arrays).alias("all")).where(F.size("all") > 0)
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    rows = rows.select(*TEXT, "uid", F.explode("all").alias("x")).select(*TEXT, "uid", "x.*")
    length = F.char_length("match").cast("long")
    end = F.sum(F.col("gap") + length).over(Window.partitionBy("uid", "kind").orderBy("at"))
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - length)
    value = F.regexp_extract("match", ASSIGN, 2)
    holds = (
        F.when(F.col("kind") == "assign", F.char_length(value) >= 8).when(F.col("kind") == "access", length >= 16).otherwise(F.lit(True))
    )
    return placed.where(holds).select(*TEXT, "kind", "start", "end", "match").distinct()


def encoding(token: str = "match") -> Column:
    t = F.col(token)
    return (
        F.when(t.rlike(r"^[0-9]+$"), F.lit(None))
        .when(t.rlike(r"^([0-9a-f]+|[0-9A-F]+)$"), F.lit("hex"))
        .when(t.rlike(r"^([a-z]+|[A-Z]+)$"), F.lit("letters"))
        .when(t.rlike(r"^[A-Z2-7]+$"), F.lit("base32"))
        .when(t.rlike(r"^([0-9a-z]+|[0-9A-Z]+)$"), F.lit("base36"))
        .otherwise(F.lit("base64"))
    )


def battery(candidates: DataFrame) -> DataFrame:
    """``candidates`` with a known encoding, and: symbols, n, uniform_z, runs_z (null for one class), serial_z, p (of ordinary text)."""
    pick = lambda i: F.coalesce(*[F.when(F.col("encoding") == k, F.lit(float(v[i]))) for k, v in ENCODINGS.items()])
    total = lambda array, f: F.aggregate(array, F.lit(0.0), lambda a, x: a + f(x))
    df = candidates.withColumn("encoding", encoding()).where("encoding is not null")
    df = df.withColumn("n", F.char_length("match").cast("double")).withColumn("k", pick(0)).withColumn("same", pick(1))
    df = df.withColumn("chars", F.split("match", ""))
    kept = lambda pattern: F.char_length(F.regexp_replace("match", f"[^{pattern}]", "")).cast("double")
    df = df.withColumn("class_counts", F.array(kept("a-z"), kept("A-Z"), kept("0-9"))).withColumn("m", kept("a-zA-Z0-9"))
    df = df.withColumn("runs", F.regexp_count(F.regexp_replace("match", "[+/_-]", ""), F.lit("[a-z]+|[A-Z]+|[0-9]+")).cast("double"))
    df = df.withColumn("values", F.transform("chars", lambda c: F.position(c, F.lit(ALPHABET)).cast("double")))
    squares = total(F.array_distinct("chars"), lambda c: F.pow(F.col("n") - F.char_length(F.replace(F.col("match"), c, F.lit(""))), 2))
    n, k, free = F.col("n"), F.col("k"), F.col("k") - 1
    df = df.withColumn("chi2", k / n * squares - n)
    # Wilson and Hilferty: the cube root of chi-squared is close to normal.
    uniform = (F.cbrt(F.col("chi2") / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    s2, s3 = total("class_counts", lambda c: c * c), total("class_counts", lambda c: c * c * c)
    m = F.greatest(F.col("m"), F.lit(2.0))
    mean = m + 1 - s2 / m
    var = (s2 * (s2 + m * (m + 1)) - 2 * m * s3 - m * m * m) / (m * m * (m - 1))
    # Columns of their own: an expression that others name several times would be written out each time.
    df = df.withColumns({"var": var, "mean": mean})
    runs = F.when(F.col("var") > 1e-9, (F.col("runs") - F.col("mean")) / F.sqrt("var"))
    v = F.col("values")
    shifted = F.concat(F.slice(v, 2, F.size(v)), F.slice(v, 1, 1))
    sum1, sum2, lagged = total(v, lambda x: x), total(v, lambda x: x * x), total(F.zip_with(v, shifted, lambda a, b: a * b), lambda x: x)
    df = df.withColumns({"sum1": sum1, "sum2": sum2, "lagged": lagged})
    square = F.col("sum1") * F.col("sum1")
    spread = n * F.col("sum2") - square
    serial = F.when(spread > 1e-9, ((n * F.col("lagged") - square) / spread + 1 / (n - 1)) * (n - 1) * F.sqrt(n - 2) / n).otherwise(F.lit(99.0))
    excess = n * (k * F.col("same") - 1)
    even = (free + excess - F.col("chi2")) / F.sqrt(2 * (free + 2 * excess))
    changes = (F.col("runs") - 1 - CLASS_CHANGES * (m - 1)) / F.sqrt(CLASS_CHANGES * (1 - CLASS_CHANGES) * (m - 1))
    df = df.withColumns({"uniform_z": uniform, "runs_z": runs, "serial_z": serial, "even": even, "changes": changes})
    unlike = F.when(F.col("var") > 1e-9, (F.col("even") + F.col("changes")) / F.sqrt(F.lit(2.0))).otherwise(F.col("even"))
    df = df.withColumn("unlike", unlike).withColumn("p", upper_tail(F.col("unlike")))
    names = ["chars", "values", "class_counts", "same", "k", "m", "runs", "chi2", "var", "mean", "sum1", "sum2", "lagged", "even", "changes", "unlike"]
    return df.drop(*names)


def discoveries(tested: DataFrame, alpha: float = ALPHA, fdr: float = FDR) -> DataFrame:
    """The rows of ``tested`` that look random and that the step-up procedure of their stratum accepts."""
    step = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-99))) * STEPS + 1e-9), F.lit(99 * STEPS)).cast("int")
    rows = tested.withColumns({"band": F.least(F.floor(F.col("n") / LENGTH_BAND), F.lit(BANDS)).cast("int"), "step": step})
    tests, random = F.when(F.col("runs_z").isNull(), F.lit(2)).otherwise(F.lit(3)), F.lit(True)
    for z in ("uniform_z", "runs_z", "serial_z"):
        random = random & F.coalesce(2 * upper_tail(F.abs(F.col(z))) >= alpha / tests, F.lit(True))
    counts = rows.groupBy("encoding", "band", "step").agg(F.count("*").alias("n"))
    strata = Window.partitionBy("encoding", "band")  # at most 99 * STEPS rows in each
    share = F.sum("n").over(strata.orderBy(F.col("step").desc())) / F.sum("n").over(strata)
    accepted = counts.withColumn("share", share).where(F.pow(F.lit(10.0), -F.col("step") / STEPS) <= fdr * F.col("share"))
    least = accepted.groupBy("encoding", "band").agg(F.min("step").alias("least"))
    return rows.where(random).join(F.broadcast(least), ["encoding", "band"]).where("step >= least")


def scan(docs: DataFrame, **rates: float) -> DataFrame:
    """(row, check, found) for each text with a span; found holds (start, order, end, kind), sorted."""
    all_spans = materialise(spans(docs), "spans")
    base = all_spans.where(F.col("kind") != "random").select(*TEXT, "kind", "start", "end")
    extra = discoveries(battery(all_spans.where(F.col("kind") == "random")), **rates).select(*TEXT, "kind", "start", "end")
    inside = base.select(*TEXT, F.col("start").alias("b0"), F.col("end").alias("b1"))
    extra = extra.join(inside, (extra.row == inside.row) & (extra.check == inside.check) & (extra.start >= inside.b0) & (extra.end <= inside.b1), "left_anti")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    return base.unionByName(extra).groupBy(*TEXT).agg(F.sort_array(F.collect_set(F.struct("start", order.alias("order"), "end", "kind"))).alias("found"))


def with_secrets(docs: DataFrame, **rates: float) -> DataFrame:
    """(doc_id, found) of every row; see ``scan``."""
    keys = docs.select("doc_id", text_hash().alias("row"), F.crc32(F.coalesce("text", F.lit(""))).alias("check"))
    return attach(keys, scan(docs, **rates), TEXT).select("doc_id", F.coalesce("found", F.expr("array()")).alias("found"))
