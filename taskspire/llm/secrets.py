"""Operator 8, secret scans, with DataFrame functions only.

Three base patterns are matched as they stand. Beyond them, every run of 20 or more token characters is put to a battery of
randomness tests over its inferred encoding: chi-squared uniformity of the alphabet, runs about the alphabet's middle, serial
correlation. Their p-values are combined by Fisher's method, and within each class of length false discoveries are controlled
over them: what is found not to be random goes. Of the rest, a run counts as random if ordinary writing would hardly make it,
by its likelihood ratio to a model of writing (letters by their frequency, digits that repeat or count up, few changes
between lower case, upper case, digits and marks); there, too, false discoveries are controlled by class of length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taskspire.llm.common import materialize

# The base patterns, and the least lengths of what they find.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")
#: What is put to the battery.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Encodings by the first pattern that fits: name, pattern, alphabet. '=' at the end is padding.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", LOWER),
    ("upper", "^[A-Z]+$", UPPER),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", LOWER + DIGITS),
    ("BASE36", "^[A-Z0-9]+$", UPPER + DIGITS),
    ("base62", "^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
)
ANY_ALPHABET = UPPER + LOWER + DIGITS + "+/-_="
#: The share of each letter in writing, in per mille, a to z.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: In writing: the share of neighbours that differ in class; of neighbouring digits, the shares that are equal and that differ by 1.
TEXT_CHANGE, SAME_DIGIT, NEXT_DIGIT = 0.02, 0.4, 0.2
#: Share of false discoveries allowed in either direction, steps of log10 p, and the least log10 p that is told apart.
FDR, STEP, FLOOR = 0.01, 0.05, -300.0
# The rational approximation of the complementary error function (absolute error under 1.5e-7).
ERFC_P, ERFC = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def log_tail(z: Column) -> Column:
    """ln of the two-sided tail of the normal distribution."""
    x = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + ERFC_P * x)
    poly = F.lit(0.0)
    for c in reversed(ERFC):
        poly = (poly + c) * t
    return F.least(F.lit(0.0), F.log(poly) - x * x)


def _matches(pattern: str, kind: str, group: int) -> Column:
    """Each match of a kind in order: the code points before it since the last match, its own, those that decide, its text."""
    text, n = F.col("text"), KINDS.index(kind)
    whole, inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), inner.alias("inner"))
    one = lambda x: F.struct(
        F.lit(n).alias("kind"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("own"), F.length(x["inner"]).alias("inner"), (x["whole"] if kind == "random" else F.lit("")).alias("token")
    )
    return F.filter(F.transform(zipped, one), lambda x: x["own"].isNotNull())


def find_matches(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and all matches of each document. text_key tells texts apart; it is null where nothing can match."""
    low = F.lower("text")
    keyword = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    some = F.coalesce(keyword | F.col("text").rlike(TOKEN), F.lit(False))
    found = F.concat(
        F.when(keyword, _matches(ASSIGN, "assign", 1)).otherwise(F.array()),
        F.when(F.col("text").contains("AKIA"), _matches(ACCESS, "access", 0)).otherwise(F.array()),
        F.when(F.col("text").rlike("[0-9a-f]{24}"), _matches(HEX, "hex", 0)).otherwise(F.array()),
        F.when(F.col("text").rlike(TOKEN), _matches(TOKEN, "random", 0)).otherwise(F.array()),
    )
    return docs.select("doc_id", F.when(some, F.md5(F.encode("text", "UTF-8"))).alias("text_key"), F.when(some, found).alias("found"))


def positions(matches: DataFrame) -> DataFrame:
    """A row for each match of each distinct text, with start and end; those too short to count are gone."""
    flat = matches.where("text_key is not null").select("text_key", F.posexplode("found").alias("at", "m")).select("text_key", "at", "m.*").dropDuplicates(["text_key", "at"])
    before = Window.partitionBy("text_key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ended = flat.withColumn("end", F.sum(F.col("gap") + F.col("own")).over(before))
    long_enough = F.col("inner") >= F.element_at(F.array(*(F.lit(LEAST.get(k, 0)) for k in KINDS)), F.col("kind") + 1)
    return ended.where(long_enough).select("text_key", "kind", (F.col("end") - F.col("own")).alias("start"), "end", "token")


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (token) with n, encoding, z_chi, z_runs, z_serial, and log10 of two p-values: log_random of the battery, for a random token, and log_text, a bound for writing."""
    body = F.regexp_replace("token", "=+$", "")
    named, letters = F.lit("mixed"), F.lit(ANY_ALPHABET)
    for name, pattern, alphabet in reversed(ENCODINGS):
        fits = F.col("body").rlike(pattern)
        named, letters = F.when(fits, name).otherwise(named), F.when(fits, alphabet).otherwise(letters)
    t = tokens.withColumn("body", F.when(F.length(body) > 0, body).otherwise(F.col("token")))
    t = t.withColumns({"encoding": named, "letters": letters}).withColumns({"n": F.length("body").cast("double"), "k": F.length("letters").cast("double"), "chars": F.split("body", "")})
    squares = F.aggregate(F.split("letters", ""), F.lit(0.0), lambda a, c: a + F.pow(F.length("body") - F.length(F.replace(F.col("body"), c, F.lit(""))), F.lit(2.0)))
    half = F.floor(F.col("k") / 2).cast("int")
    sides = F.array_join(F.transform("chars", lambda c: F.when(F.instr(F.col("letters"), c) > half, "1").otherwise("0")), "")
    codes = F.transform("chars", lambda c: F.instr(F.col("letters"), c).cast("double"))
    kinds = F.translate(F.col("body"), UPPER + LOWER + DIGITS + "+/-_=", "u" * 26 + "l" * 26 + "d" * 10 + "s" * 5)
    # ln of a letter's or mark's share in its class; digits go by their neighbours
    shares = F.array(F.lit(0.0), *(F.lit(math.log(x / sum(LETTERS))) for x in LETTERS))
    own = lambda c: F.when(c.isin(*"+/-_="), math.log(0.2)).otherwise(F.get(shares, F.instr(F.lit(LOWER), F.lower(c))))
    digit = lambda c: F.instr(F.lit(DIGITS), c)
    gap = lambda a, b: F.abs(digit(a) - digit(b))
    after = lambda a, b: F.when(digit(b) == 0, 0.0).when(digit(a) == 0, math.log(0.1)).when(gap(a, b) == 0, math.log(SAME_DIGIT)).when(gap(a, b) == 1, math.log(NEXT_DIGIT / 2)).otherwise(math.log((1 - SAME_DIGIT - NEXT_DIGIT) / 7))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    first, rest = F.slice("chars", F.lit(1), F.size("chars") - 1), F.slice("chars", F.lit(2), F.size("chars") - 1)
    t = t.withColumns({
        "squares": squares, "sides": sides, "codes": codes, "changes": (F.regexp_count(kinds, F.lit("u+|l+|d+|s+")) - 1).cast("double"),
        "shares": total(F.transform("chars", own)) + total(F.zip_with(first, rest, after)) + F.when(digit(F.get("chars", F.lit(0))) > 0, math.log(0.1)).otherwise(0.0),
    })
    n, k = F.col("n"), F.col("k")
    products = total(F.zip_with(F.slice("codes", F.lit(1), F.size("codes") - 1), F.slice("codes", F.lit(2), F.size("codes") - 1), lambda a, b: a * b))
    t = t.withColumns({
        "n1": F.length(F.replace(F.col("sides"), F.lit("0"), F.lit(""))).cast("double"), "runs": F.regexp_count("sides", F.lit("0+|1+")).cast("double"),
        "mean": total(F.col("codes")) / n, "sq": total(F.transform("codes", lambda x: x * x)), "products": products,
    })
    both, less = 2 * F.col("n1") * (n - F.col("n1")), F.greatest(n - 1, F.lit(1.0))
    spread = both * (both - n) / (n * n * less)
    variance = F.col("sq") - n * F.col("mean") * F.col("mean")
    ends = F.element_at("codes", 1) + F.element_at("codes", -1)
    lagged = F.col("products") - F.col("mean") * (2 * n * F.col("mean") - ends) + (n - 1) * F.col("mean") * F.col("mean")
    # the cube root of a chi-squared value is near normal; the shape is that of the multinomial's mean and variance
    ninth = 2 * less / (9 * (k - 1) * n)
    chi = F.greatest(k / n * F.col("squares") - n, F.lit(0.0)) / (k - 1)
    tails = [log_tail(F.col(f"z_{x}")) for x in ("chi", "runs", "serial")]
    half_sum = F.greatest(-sum(tails[1:], tails[0]), F.lit(0.0))
    changes = F.col("changes")
    writing = F.col("shares") + changes * math.log(TEXT_CHANGE / 3) + (n - 1 - changes) * math.log(1 - TEXT_CHANGE) + math.log(0.25)
    ten = math.log(10.0)
    return t.withColumns({
        "z_chi": (F.pow(chi, F.lit(1 / 3)) - (1 - ninth)) / F.sqrt(ninth),
        "z_runs": F.when(spread > 0, (F.col("runs") - both / n - 1) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(F.lit(99.0)),
        "z_serial": F.when(variance > 1e-9, (lagged / F.greatest(variance, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0)),
    }).withColumns({
        "log_random": (F.log(1 + half_sum + half_sum * half_sum / 2) - half_sum) / ten,
        "log_text": F.least(F.lit(0.0), (writing + n * F.log(k)) / ten),
    }).drop("body", "letters", "chars", "squares", "sides", "codes", "changes", "shares", "n1", "runs", "mean", "sq", "products")


def rejected(rows: DataFrame, log_p: str) -> DataFrame:
    """``rows`` (n, ``log_p``) with ``out``: whether the step-up rule at FDR rejects them within their class of length (doublings).

    The rule runs over a histogram, whose cells are bounded, so nothing is sorted as a whole; a cell's largest p stands for it.
    """
    row = rows.withColumns({"stratum": F.floor(F.log2("n")).cast("int"), "step": F.floor(F.greatest(F.col(log_p), F.lit(FLOOR)) / STEP).cast("int")})
    histogram = row.groupBy("stratum", "step").agg(F.count("*").alias("c"))
    up, everything = Window.partitionBy("stratum").orderBy("step"), Window.partitionBy("stratum")
    ranked = histogram.withColumns({"rank": F.sum("c").over(up), "m": F.sum("c").over(everything)})
    limits = ranked.where((F.col("step") + 1) * STEP <= F.log10(F.lit(FDR) * F.col("rank") / F.col("m"))).groupBy("stratum").agg(F.max("step").alias("limit"))
    return row.join(F.broadcast(limits), "stratum", "left").withColumn("out", F.coalesce(F.col("step") <= F.col("limit"), F.lit(False))).drop("stratum", "step", "limit")  # one row for each doubling of length


def discoveries(tested: DataFrame) -> DataFrame:
    """The rows of ``tested`` (n, log_random, log_text) that count as random: not found unlike a random token, and found unlike writing."""
    left = rejected(tested, "log_random").where("not out").drop("out")
    return rejected(left, "log_text").where("out").drop("out")


def scan(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Null or empty text: no spans. Repeated rows count as one text in the control of false discoveries. Rows with equal texts get equal spans. Matches of one kind don't overlap; those of two kinds may.
    """
    matches = materialize(find_matches(docs), "secret-matches")
    placed = positions(matches)
    # dealt anew, as tokens are few bytes but much work; written once, as both controls read it
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokens = placed.where(F.col("kind") == KINDS.index("random")).repartition(parts, "text_key", "start")
    tested = materialize(battery(tokens).select("text_key", "kind", "start", "end", "n", "log_random", "log_text"), "tested-tokens")
    random = discoveries(tested)
    spans = placed.where(F.col("kind") < KINDS.index("random")).drop("token").unionByName(random.select("text_key", "kind", "start", "end"))
    listed = spans.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    names = F.array(*map(F.lit, KINDS))
    text_of = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("all", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("all", lambda x: x["kind"] < KINDS.index("random"))
    found = listed.select("text_key", *(of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("all")).alias("spans"))
    # rows without a key get keys of their own, so that they don't meet in one task
    rows = matches.select("doc_id", F.coalesce("text_key", F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("text_key"))
    zero, none = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    return rows.join(found, "text_key", "left").select(
        "doc_id", *(F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in KINDS[:3]), F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_random", zero).alias("n_random")
    )


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op8_secret_scan": op8_secret_scan}
SQL: dict[str, str] = {}
