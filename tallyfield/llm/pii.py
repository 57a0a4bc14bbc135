"""Personal data by weak supervision.

Regular expressions find candidate spans of several kinds.  Labelers vote on every
candidate: its shape (regex), a gazetteer of words that belong to the kind, the words
before it (context), and checks of its content.  The votes are counted per pattern, a
table of at most kinds x 2^labelers rows.  Expectation-maximisation on these counts
estimates how often each labeler is right and the probability of every pattern; a
logistic span classifier is trained on those probabilities and applied as an expression.
Base kinds (email, ip, card, phone) are kept by their own rules, whatever the classifier says.

Only DataFrame functions touch the texts: positions follow from the lengths of the pieces
between the matches.

Defined cases: null and empty texts have no spans; rows are judged one by one, equal texts alike;
without candidates the classifier is not trained; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Patterns of the base kinds; possessive where nothing can follow from going back, so that long runs need no recursion.
BASE = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further kinds, found by the method alone.
MORE = {
    "secret": r"(?i)(?:password|passwd|secret|token|api_?key)[\x20]?[=:][\x20]?\"?[0-9A-Za-z_/+-]{8,}+\"?",
    "local_phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "masked_email": r"(?i)[a-z0-9._%+-]++[\x20][(\[]?at[)\]]?[\x20][a-z0-9-]++[\x20][(\[]?dot[)\]]?[\x20][a-z]{2,6}+",
}
KINDS = [*BASE, *MORE]
#: What a text must hold before a pattern is tried.
NEEDS = {"email": "@", "phone": "+", "secret": None, "ip": ".", "card": None, "local_phone": None, "ssn": "-", "masked_email": None}
#: Words that belong to a kind: in the span (gazetteer) and in the 40 characters before it (context).
GAZETTEER = {"email": r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk)$", "phone": r"^\+(?:1|33|34|44|49)\b", "ip": r"^(?:10|127|172|192)\.", "card": "^[3-6]", "secret": r"(?i)^(?:password|token)", "local_phone": r"^\(?[2-9]", "ssn": "^[0-8]", "masked_email": r"(?i)(?:com|org|net|edu|de|fr|es|uk)$"}
CONTEXT = r"(?i)(?:mail|contact|write|call|phone|tel|mobile|card|visa|pay|account|ip|host|server|password|token|secret|ssn|social|kontakt|correo|courriel)"


def spans(text: Column, kind: str, pattern: str) -> Column:
    """Matches of a kind, left to right: kind, start, stop (code points) and the match."""
    nothing = F.array().cast("array<struct<kind:string,start:int,stop:int,match:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # both arrays are evaluated once, as what the fold runs over
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"))

    def add(acc, p):
        start = acc["at"] + F.length(p["gap"])
        stop = start + F.length(p["match"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), p["match"].alias("match"))
        return F.when(p["match"].isNull(), acc).otherwise(F.struct(stop.alias("at"), F.concat(acc["all"], F.array(one)).alias("all")))

    walked = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), nothing.alias("all")), add, lambda acc: acc["all"])
    need = NEEDS[kind]
    return F.when(F.contains(text, F.lit(need)), walked).otherwise(nothing) if need else F.when(F.rlike(text, F.lit(pattern)), walked).otherwise(nothing)


def luhn(digits: Column) -> Column:
    """The checksum of card numbers: from the right, every second digit counts twice, its digits summed."""
    back = F.reverse(digits)

    def add(total, i):
        d = F.substring(back, i, 1).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def holds(span: Column) -> Column:
    """The rule of a base kind; true for other kinds."""
    match, digits = span["match"], F.regexp_replace(span["match"], "[^0-9]", "")
    parts = F.forall(F.split(match, "\\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3)
    small = F.forall(F.split(match, "\\."), lambda p: F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 9).cast("int") <= 255)
    return (
        F.when(span["kind"] == "ip", parts & small)
        .when(span["kind"] == "card", F.length(digits).between(16, 19) & luhn(digits))
        .when(span["kind"] == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def votes(text: Column, span: Column) -> Column:
    """Bits of the labelers: rule, gazetteer, context, variety of characters, length."""
    match = span["match"]
    before = F.substring(text, F.greatest(span["start"] - 39, F.lit(1)), F.least(span["start"], F.lit(40)))
    known = F.lit(False)
    for kind, pattern in GAZETTEER.items():
        known = F.when(span["kind"] == kind, F.rlike(match, F.lit(pattern))).otherwise(known)
    variety = F.size(F.array_distinct(F.split(match, ""))) >= 6
    size = F.length(match).between(7, 64)
    bits = [holds(span), known, F.rlike(before, F.lit(CONTEXT)), variety, size]
    return sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))


LABELERS = 5


def candidates(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, found): every candidate with its votes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    every = F.concat(*(spans(F.col("body"), k, p) for k, p in (BASE | MORE).items()))
    rows = docs.select("doc_id", text.alias("body")).withColumn("every", every)
    voted = F.transform("every", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), holds(s).alias("holds"), votes(F.col("body"), s).alias("votes")))
    return stored(rows.select("doc_id", voted.alias("found")), "pii-candidates")


def reliabilities(pattern: np.ndarray, count: np.ndarray, turns: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: P(real | pattern) and (hit rate, false rate) of each labeler."""
    bits = (pattern[:, None] >> np.arange(LABELERS)) & 1
    real = np.clip(bits.mean(axis=1), 0.05, 0.95)  # start: the majority
    rates = np.zeros((LABELERS, 2))
    for _ in range(turns):
        yes, no = count * real, count * (1 - real)
        rates = np.stack([(yes @ bits + 1) / (yes.sum() + 2), (no @ bits + 1) / (no.sum() + 2)], axis=1)
        prior = (yes.sum() + 1) / (count.sum() + 2)
        ones = np.log(prior) + bits @ np.log(rates[:, 0]) + (1 - bits) @ np.log(1 - rates[:, 0])
        zeros = np.log(1 - prior) + bits @ np.log(rates[:, 1]) + (1 - bits) @ np.log(1 - rates[:, 1])
        real = 1 / (1 + np.exp(np.clip(zeros - ones, -50, 50)))
    return real, rates


def train(features: np.ndarray, real: np.ndarray, count: np.ndarray, turns: int = 25) -> np.ndarray:
    """Weights of a logistic classifier for soft labels, by Newton steps with a small ridge."""
    w = np.zeros(features.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        grad = features.T @ (count * (p - real)) + 0.1 * w
        hess = (features * (count * p * (1 - p))[:, None]).T @ features + 0.1 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(hess, grad), -5, 5)
    return w


def classifier(found: DataFrame) -> list[float]:
    """Weights (labelers, then kinds), learned from the counts of vote patterns of the whole corpus."""
    one = found.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes").agg(F.count("*").alias("n"))
    rows = one.collect()  # at most kinds x 2^labelers
    if not rows:
        return [0.0] * (LABELERS + len(KINDS))
    pattern, count = np.array([r.votes for r in rows]), np.array([r.n for r in rows], float)
    real, _ = reliabilities(pattern, count)
    bits = (pattern[:, None] >> np.arange(LABELERS)) & 1
    kind = np.array([[r.kind == k for k in KINDS] for r in rows], float)
    return train(np.concatenate([bits, kind], axis=1).astype(float), real, count).tolist()


def find(docs: DataFrame, accept: float = 0.5) -> DataFrame:
    """Per document: doc_id, `base` and `spans`, arrays of (kind, start, stop) ordered by kind, then start."""
    found = candidates(docs)
    weights = classifier(found)

    def score(s: Column) -> Column:
        total = sum((F.when(s["votes"].bitwiseAND(F.lit(1 << i)) > 0, w).otherwise(0.0) for i, w in enumerate(weights[:LABELERS])), F.lit(0.0))
        return 1 / (1 + F.exp(-sum((F.when(s["kind"] == k, w).otherwise(0.0) for k, w in zip(KINDS, weights[LABELERS:])), total)))

    place = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    base = F.filter("found", lambda s: s["kind"].isin(*BASE) & s["holds"])
    clear = lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    more = F.filter("found", lambda s: ~s["kind"].isin(*BASE) & (score(s) >= accept) & clear(s))
    return found.select("doc_id", F.transform(base, place).alias("base"), F.transform(F.concat(base, more), place).alias("spans"))
