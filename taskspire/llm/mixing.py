"""Operator 3, mixing sources to target weights by soft membership, with DataFrame functions only.

A classifier learned from the labelled table gives each document its probabilities of the domains good, poor and toxic: the
weights of hashed terms (log-odds by domain, less their uncertainty) are added up, and naive Bayes over their sums and a few
statistics of the text turns them into probabilities. Rates for the documents are then fitted by projected-gradient least
squares, so that the expected tokens of each domain (rate * tokens * probability, over all documents) meet the targets; no
rate is negative. A rate over 1 takes a document more than once.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import fits_broadcast, materialize

DOMAINS = ("good", "poor", "toxic")
#: Production: each domain's share of the mixture's expected tokens.
WEIGHTS = {"good": 0.87, "poor": 0.12, "toxic": 0.01}
#: The classifier is fitted on about so many labelled rows, picked by a hash of doc_id.
TRAIN_ROWS = 20_000
#: Words are hashed into so many terms. A term weighs its log-odds less so many standard errors, and nothing if that leaves none.
TERMS, CAUTION = 1 << 15, 3.0
#: Weights are kept in steps of 1 / SCALE, up to 127 of them.
SCALE = 16
#: The highest rate; None: rates are only kept from being negative, so targets are met as long as every domain has tokens.
MOST_RATE: float | None = None
#: Rounds of the fit, and the relative residual at which it ends.
ROUNDS, TOLERANCE = 40, 1e-6
#: It also ends when a step lessens the squared residual by this share only, or none does under so much damping.
SETTLED, MOST_DAMPING = 1e-4, 1e3
#: What separates words, besides white space.
PUNCTUATION = ".,;:!?\"'()[]{}|*%$#&"
MARKS = ("!", "*", "|", "%", "$", "#", "&")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once. A plain column expression would be copied into each of its uses when the optimizer moves a filter down, and grow with every level."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _words() -> Column:
    separators = "\n\t\r" + PUNCTUATION
    return F.filter(F.split(F.translate(F.lower("text"), separators, " " * len(separators)), " "), lambda w: w != "")


def _terms(words: Column) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(TERMS)).cast("int"))


def _numbers(values: list[int]) -> Column:
    """An array of many constants; the optimizer folds it into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


#: For each of the two questions, toxic or not, poor or good: the weight of the terms that have one.
Weights = tuple[dict[int, float], dict[int, float]]
#: Bins of each statistic.
BINS, KINDS = 8, 8


def statistics(weights: Weights) -> Column:
    """n_tokens of a text, and ``bins``, small whole numbers that describe it: size, kinds of marks, repetition, sums of its terms' weights."""
    size = F.greatest(F.octet_length("text"), F.lit(1))
    share = lambda c: F.coalesce(F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit(c), F.lit(""))), F.lit(0))
    step = lambda x, *edges: let(x, lambda v: sum((F.when(v >= e, 1).otherwise(0) for e in edges), F.lit(0)))
    marks = sum((share(c) for c in MARKS[1:]), F.lit(0))
    words = F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(_words())
    # a place for each term, so that a look-up takes one step; it holds both weights, as one small number
    packed = [round(weights[0].get(t, 0.0) * SCALE) * 256 + round(weights[1].get(t, 0.0) * SCALE) for t in range(TERMS)]
    table = _numbers(packed) if any(packed) else None
    poor = lambda v: F.pmod(v + 128, F.lit(256)) - 128
    looked_up = lambda terms: F.array().cast("array<int>") if table is None else F.filter(F.transform(terms, lambda t: F.get(table, t)), lambda v: v != 0)
    total = lambda values, part: F.aggregate(values, F.lit(0), lambda a, v: a + part(v)) / float(SCALE)
    counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("all"), F.size(F.array_distinct(w)).alias("kinds"), looked_up(F.array_distinct(_terms(w))).alias("weights"), F.coalesce(share("!") / size, F.lit(0.0)).alias("calls"), F.coalesce(marks / size, F.lit(0.0)).alias("marks")))
    scored = let(counts, lambda c: F.struct(c["all"].alias("all"), c["kinds"].alias("kinds"), c["calls"].alias("calls"), c["marks"].alias("marks"), total(c["weights"], lambda v: ((v - poor(v)) / 256).cast("int")).alias("toxic"), total(c["weights"], poor).alias("poor")))
    n = lambda c: F.greatest(c["all"], F.lit(1))
    return let(scored, lambda c: F.struct(c["all"].alias("n_tokens"), F.array(
        step(c["all"], 20, 100, 500, 2000),
        step(c["calls"], 0.0005, 0.005, 0.05),
        step(c["marks"], 0.0005, 0.005, 0.02, 0.1),
        # repetition for a text of its size
        step(0.85 * F.log(n(c)) - F.log(F.greatest(c["kinds"], F.lit(1))), -0.5, -0.25, 0.0, 0.25, 0.75, 1.5),
        step(c["toxic"], -4, -1, 0.25, 1, 2, 4, 8),
        step(c["toxic"] / n(c), 0.001, 0.004, 0.01, 0.03, 0.1),
        step(c["poor"], -8, -4, -1, 0.25, 1, 4, 8),
        step(c["poor"] / n(c), -0.02, -0.005, 0.005, 0.02, 0.1),
    ).alias("bins")))


def labelled(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS) -> DataFrame:
    """text and domain of about ``most_rows`` labelled documents. Of several label rows of one document, toxic wins, then poor."""
    rows = labels.where("quality is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    named = rows.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor").alias("domain"))
    n = named.count()
    if n > most_rows:
        named = named.where(F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1_000_000)) < int(1_000_000 * most_rows / n))
    return docs.select("doc_id", "text").join(F.broadcast(named) if fits_broadcast(named, 32) else named, "doc_id").select("text", "domain")


def term_weights(sample: DataFrame) -> Weights:
    """What each term says on either question: its log-odds, moved towards 0 by CAUTION standard errors. At most TERMS rows are read."""
    sizes = dict(sample.groupBy("domain").count().collect())
    seen = sample.where("text is not null").select("domain", F.explode(F.array_distinct(_terms(_words()))).alias("t")).groupBy("t")
    counts = seen.agg(*(F.count(F.when(F.col("domain") == d, 1)).alias(d) for d in DOMAINS)).collect()
    out: Weights = ({}, {})
    for own, these, others in zip(out, (("toxic",), ("poor",)), (("good", "poor"), ("good",)), strict=True):
        n_these, n_others = (sum(sizes.get(d, 0) for d in x) for x in (these, others))
        if not n_these or not n_others:
            continue
        for r in counts:
            a, b = (sum(r[d] for d in x) + 0.5 for x in (these, others))
            c, d = n_these + 1 - a, n_others + 1 - b
            odds, error = math.log(a / c) - math.log(b / d), math.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
            if abs(odds) > CAUTION * error:
                own[r["t"]] = max(-127, min(127, round(math.copysign(abs(odds) - CAUTION * error, odds) * SCALE))) / SCALE
    return out


Model = tuple[Weights, dict[str, float], dict[tuple[int, int, str], float]]


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The terms' weights, the log prior of each domain, and the log probability of each bin of each statistic in each domain. None if no document is labelled."""
    sample = materialize(labelled(docs, labels), "mix-sample")
    weights = term_weights(sample)
    counted = sample.select("domain", F.posexplode(statistics(weights)["bins"]).alias("i", "bin")).groupBy("domain", "i", "bin").count().collect()  # some tens of rows
    sizes = {d: sum(r["count"] for r in counted if r["domain"] == d and r["i"] == 0) for d in DOMAINS}
    total = sum(sizes.values())
    if not total:
        return None
    prior = {d: math.log((sizes[d] + 1) / (total + len(DOMAINS))) for d in DOMAINS}
    seen = {(r["i"], r["bin"], r["domain"]): r["count"] for r in counted}
    return weights, prior, {(i, b, d): math.log((seen.get((i, b, d), 0) + 0.5) / (sizes[d] + 4)) for i in range(KINDS) for b in range(BINS) for d in DOMAINS}


def with_posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with n_tokens and p_good, p_poor, p_toxic, which add up to 1."""
    return posteriors(docs, learn(docs, labels))


def posteriors(docs: DataFrame, model: Model | None) -> DataFrame:
    return docs.withColumn("_p", posterior(model)).select(*docs.columns, F.col("_p.n_tokens").alias("n_tokens"), *(F.col("_p.p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)))


def posterior(model: Model | None) -> Column:
    """n_tokens of a text and the array p of its domains' probabilities, as one struct; all alike where nothing was learned."""
    weights, prior, table = model or (({}, {}), dict.fromkeys(DOMAINS, 0.0), {(i, b, d): 0.0 for i in range(KINDS) for b in range(BINS) for d in DOMAINS})
    rows = {d: F.array(*(F.array(*(F.lit(table[i, b, d]) for b in range(BINS))) for i in range(KINDS))) for d in DOMAINS}
    score = lambda x, d: sum((F.get(F.get(rows[d], F.lit(i)), F.get(x["bins"], F.lit(i))) for i in range(KINDS)), F.lit(prior[d]))
    scored = let(statistics(weights), lambda x: F.struct(x["n_tokens"].alias("n_tokens"), F.array(*(score(x, d) for d in DOMAINS)).alias("s")))
    scaled = let(scored, lambda x: F.struct(x["n_tokens"].alias("n_tokens"), F.transform(x["s"], lambda v: F.exp(v - F.array_max(x["s"]))).alias("e")))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return let(scaled, lambda x: F.struct(x["n_tokens"].alias("n_tokens"), let(total(x["e"]), lambda t: F.transform(x["e"], lambda v: v / t)).alias("p")))


def solve(a: list[list[float]], b: list[float]) -> list[float]:
    """a x = b for a small symmetric matrix, with a slight ridge so that an absent domain does no harm."""
    n = len(b)
    ridge = 1e-9 * (sum(a[i][i] for i in range(n)) or 1.0)
    m = [[*a[i], b[i]] for i in range(n)]
    for i in range(n):
        m[i][i] += ridge
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(i + 1, n):
            f = m[r][i] / m[i][i]
            m[r] = [x - f * y for x, y in zip(m[r], m[i], strict=True)]
    x = [0.0] * n
    for i in reversed(range(n)):
        x[i] = (m[i][n] - sum(m[i][j] * x[j] for j in range(i + 1, n))) / m[i][i]
    return x


def rate_of(moved: list[float], most_rate: float | None, p: Column | None = None) -> Column:
    """A row's rate from its probabilities (the columns p_*, or an array) and the fit's ``moved``: 1, moved along the gradient, projected to 0..most_rate."""
    own = lambda i: F.col(f"p_{DOMAINS[i]}") if p is None else F.get(p, F.lit(i))
    rate = F.greatest(sum((own(i) * m for i, m in enumerate(moved)), F.lit(1.0)), F.lit(0.0))
    return rate if most_rate is None else F.least(rate, F.lit(float(most_rate)))


def fit_rates(rows: DataFrame, weights: dict[str, float] = WEIGHTS, most_rate: float | None = MOST_RATE, total: float | None = None) -> tuple[list[float], dict[str, tuple[float, float]]]:
    """How far rates move (see ``rate_of``) over ``rows`` (n_tokens, p_*), and for each domain its (expected, target) tokens.

    Projected gradient with lazy projection for the least squares of the residual, expected - target tokens of the domains,
    in the norm of their Gram matrix (the sum of n p p'). A document's gradient is its p' times one vector that all share,
    so the gradients of all rounds add up to as many numbers as there are domains, and a rate is the projection of 1 less
    that sum. Steps are scaled by the Gram matrix of the documents that aren't at a bound plus ``damping`` times that of
    all; a step that doesn't lessen the residual is taken back and the damping raised. A round is one pass that adds up a
    few numbers. Unless ``total`` is given, the mixture has so many tokens that the first domain keeps its own; where the
    bounds keep the targets from being met, what remains is the least-squares residual.
    """
    n, p, k = F.col("n_tokens").cast("double"), [F.col(f"p_{d}") for d in DOMAINS], len(DOMAINS)
    pairs = [(i, j) for i in range(k) for j in range(k)]
    r = F.col("rate")
    inside = F.when((r > 0) & (r < most_rate if most_rate is not None else F.lit(True)), 1.0).otherwise(0.0)

    def measure(moved: list[float]) -> tuple[list[float], list[list[float]]]:
        free = inside if any(moved) else F.lit(1.0)
        rated = rows.select(n.alias("n"), *p, rate_of(moved, most_rate).alias("rate"))
        sums = [x or 0.0 for x in rated.agg(*(F.sum(r * F.col("n") * x) for x in p), *(F.sum(free * F.col("n") * p[i] * p[j]) for i, j in pairs)).first()]
        return sums[:k], [[sums[k + i * k + j] for j in range(k)] for i in range(k)]

    now, gram = measure([0.0] * k)
    total = now[0] / weights[DOMAINS[0]] * sum(weights.values()) if total is None else total
    target = [total * weights[d] / sum(weights.values()) for d in DOMAINS]

    def error(now: list[float]) -> tuple[float, list[float]]:
        residual = [a - b for a, b in zip(now, target, strict=True)]
        return sum(a * b for a, b in zip(residual, solve(gram, residual), strict=True)), residual

    moved, inner, damping = [0.0] * k, gram, 0.002
    least, residual = error(now)
    for _ in range(ROUNDS):
        if max(map(abs, residual)) <= TOLERANCE * max(total, 1.0) or damping > MOST_DAMPING:
            break
        step = solve([[inner[i][j] + damping * gram[i][j] for j in range(k)] for i in range(k)], residual)
        tried = [m - s for m, s in zip(moved, step, strict=True)]
        then, free = measure(tried)
        less, rest = error(then)
        if less >= least:
            damping *= 8
            continue
        settled = least - less <= SETTLED * least
        moved, now, inner, least, residual, damping = tried, then, free, less, rest, damping / 5
        if settled:
            break
    else:
        warnings.warn(f"the fit of rates has not settled in {ROUNDS} rounds: residual {residual}", stacklevel=2)
    return moved, {d: (now[i], target[i]) for i, d in enumerate(DOMAINS)}


def chance() -> Column:
    """A number in [0, 1) of a row, for taking it at a rate."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit("take")), F.lit(1 << 30)) / float(1 << 30)


def copies(rate: Column, chance: Column) -> Column:
    """How often a row is taken at its rate: the whole part, and once more if its chance falls under the rest."""
    return let(rate, lambda r: (F.floor(r) + F.when(chance < r - F.floor(r), 1).otherwise(0)).cast("int"))


def token_sums(rows: DataFrame) -> DataFrame:
    """The tokens of ``rows`` (n_tokens, p_*) by their probabilities. Bins make probabilities, so there are only so many of them, whatever the corpus, and the fit's rounds read these sums alone."""
    p = [f"p_{d}" for d in DOMAINS]
    return materialize(rows.groupBy(*p).agg(F.sum("n_tokens").alias("n_tokens")).repartition(1), "mix-sums")


def highest(sums: DataFrame, moved: list[float]) -> float:
    return sums.agg(F.max(rate_of(moved, None))).first()[0] or 0.0


def rated(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, most_rate: float | None = MOST_RATE) -> DataFrame:
    """doc_id, n_tokens, p_good, p_poor, p_toxic, rate and copies of each row of ``docs``. Null or empty text: 0 tokens. Equal rows get equal rates. Without a labelled document all domains are alike likely and all rates 1."""
    model = learn(docs, labels)
    rows = materialize(posteriors(docs.select("doc_id", "text"), model).withColumn("chance", chance()).drop("text"), "mix-rows")
    rate = rate_of(fit_rates(token_sums(rows), weights, most_rate)[0] if model else [0.0] * len(DOMAINS), most_rate)
    return rows.withColumn("rate", rate).withColumn("copies", copies(F.col("rate"), F.col("chance"))).drop("chance")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, most_rate: float | None = 1.0, repeat: bool = True) -> DataFrame:
    """The mixing stage: each document as often as its copies say; columns as in ``docs``. It only drops documents unless ``most_rate`` is over 1 or None.

    Without ``repeat`` all rates are divided by the highest if that is over 1, so the shares stay as they are and no document
    is taken twice. The probabilities are made once more for it rather than joined to the texts.
    """
    model = learn(docs, labels)
    if not model:
        return docs
    sums = token_sums(posteriors(docs.select("text"), model).drop("text"))
    moved = fit_rates(sums, weights, most_rate)[0]
    most = 1.0 if repeat else max(1.0, highest(sums, moved))
    taken = let(posterior(model)["p"], lambda p: copies(rate_of(moved, most_rate, p) / most, chance()))
    if not repeat or (most_rate is not None and most_rate <= 1):
        return docs.where(taken > 0)
    return docs.withColumn("_again", F.explode(F.array_repeat(F.lit(1), taken))).drop("_again")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    return rated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op3_mixing": op3_mixing}
SQL: dict[str, str] = {}
