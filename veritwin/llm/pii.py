"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose candidates. Labelers (shape, structure, gazetteer, words before, words after) vote for, against
or not at all on each candidate. Expectation-maximisation over the counts of vote patterns estimates how often each
labeler votes which way on true and on false candidates; its posteriors train a logistic classifier over
votes, length and kind, which decides on the kinds that the method adds. Base spans always stay.

Only the table of vote patterns reaches the driver: at most kinds x 3^labelers x length classes rows, whatever the input.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

#: Order of kinds that start at the same place; the first four are base kinds.
KINDS = ("email", "ip", "card", "phone", "mail_words", "local_phone", "ssn", "iban")
BASE_KINDS = KINDS[:4]

#: Possessive repetition and look-behinds keep the patterns linear and free of deep recursion on any text;
#: \G lets a match start right where the one before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "mail_words": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z]{2,12}",
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
#: A text without this has no such candidate; a plain search is much cheaper than the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "mail_words": "]|)", "local_phone": None, "ssn": "-", "card": None, "iban": None}

#: Gazetteers, fixed values.
DOMAINS = "com net org edu gov info io co uk de fr es it nl eu ch at us ca au jp cn in br ru".split()
BANK_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE SK".split()
#: Words before a candidate that speak for its kind, in lower case.
CUES = {
    "email": r"e-?mail|contact|write|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|address|adresse|client",
    "card": r"card|visa|master|payment|karte|carte|tarjeta",
    "phone": r"tel|phone|call|mobile|fax|ruf|llam",
    "ssn": r"ssn|social security|sozialversicherung",
    "iban": r"iban|account|konto|compte|cuenta",
}
CUE_OF = dict(zip(KINDS, ("email", "ip", "card", "phone", "email", "phone", "ssn", "iban")))
#: Words right before, and units right after, that speak against personal data.
AGAINST_BEFORE = r"(?:version|ver\.|\bv|isbn|order|invoice|article|part no\.?|[$€£#§])\s*$"
AGAINST_AFTER = r"^\s*(?:%|kg|km|cm|mm|usd|eur|pages|years|[$€£])"
LABELERS = ("shape", "structure", "gazetteer", "cue", "against_before", "against_after")
LENGTHS = (12, 16, 24)


class Model(NamedTuple):
    """Posterior-trained weights: one bias per kind, one weight per labeler and one per length class."""

    bias: dict[str, float]
    votes: dict[str, float]
    lengths: list[float]
    rates: dict[str, dict[int, tuple[float, float]]]  # labeler -> vote -> P(vote | false), P(vote | true)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    doubled = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2).cast("int") - F.when(d >= "5", 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    number = digits(value)
    if kind == "card":
        return F.when(F.length(number).between(12, 19), luhn(number)).otherwise(False)
    return F.length(number).between(9, 15)


def vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0).cast("tinyint")


def labels(kind: str, value: Column, before: Column, after: Column, ok: Column) -> list[Column]:
    number = digits(value)
    last = F.lower(F.element_at(F.split(value, r"[.\])\x20]"), -1))
    structure = {
        "email": (F.length(value) <= 254, F.length(value) > 254),
        "ip": (~value.rlike(r"(?:^|\.)0[0-9]"), value.rlike(r"(?:^|\.)0[0-9]")),
        "card": (ok, ~ok),
        "phone": (F.length(number).between(10, 13), ~F.length(number).between(9, 15)),
        "mail_words": (F.length(value) <= 254, F.length(value) > 254),
        "local_phone": (number.rlike("^[2-9]"), number.rlike("^[01]")),
        "ssn": (~value.rlike(r"^(?:000|666|9)|-00-|-0000$"), value.rlike(r"^(?:000|666|9)|-00-|-0000$")),
        "iban": (F.length(F.regexp_replace(value, " ", "")).between(15, 34), F.length(F.regexp_replace(value, " ", "")) < 15),
    }[kind]
    known = {
        "email": last.isin(DOMAINS), "mail_words": last.isin(DOMAINS), "card": number.rlike("^[3-6]"),
        "iban": F.substring(value, 1, 2).isin(BANK_COUNTRIES), "ip": ~value.rlike(r"^(?:0|127|255)\."),
        "phone": number.rlike("^(?:1|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-8])"),
        "local_phone": number.rlike("^...[2-9]"), "ssn": F.lit(None).cast("boolean"),
    }[kind]
    own = before.rlike(CUES[CUE_OF[kind]])
    other = before.rlike("|".join(c for k, c in CUES.items() if k != CUE_OF[kind]))
    never = F.lit(False)
    return [
        vote(ok, ~ok) if kind in BASE_KINDS else vote(never), vote(*structure), vote(known, ~known), vote(own, other),
        vote(never, before.rlike(AGAINST_BEFORE)), vote(never, after.rlike(AGAINST_AFTER)),
    ]


def candidates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id and one struct per candidate: kind, order within its kind, characters since the
    candidate of the kind before, its length, whether it is a base span, its votes and length class. No value is kept."""
    df = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    df = df.withColumn("row", F.monotonically_increasing_id()).withColumn("digit", F.col("text").rlike("[0-9]"))
    found = {}
    for kind, pattern in PATTERNS.items():
        may = F.col("digit") if kind not in ("email", "mail_words") else F.lit(True)
        if NEEDS[kind]:
            marks = [F.col("text").contains(m) for m in NEEDS[kind].split("|")]
            may = may & (marks[0] if len(marks) == 1 else marks[0] | marks[1])
        if kind == "mail_words":
            may = may & F.col("text").rlike(r"(?i)[\[(]dot[\])]")
        found[f"m_{kind}"] = F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    # The text between matches gives the offsets; it is only cut where there are matches.
    df = df.withColumns(found)
    df = df.withColumns(
        {f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)) for k, p in PATTERNS.items()}
    ).drop("text")

    def one(kind: str) -> Column:
        def build(value, i):
            gap = F.col(f"p_{kind}")[i]
            before, after = F.lower(F.right(gap, F.lit(48))), F.lower(F.left(F.col(f"p_{kind}")[i + 1], F.lit(16)))
            ok = valid(kind, value) if kind in BASE_KINDS else F.lit(True)
            length = F.length(value)
            return F.struct(
                F.lit(KINDS.index(kind)).cast("tinyint").alias("kind"), i.alias("nth"), F.length(gap).alias("gap"),
                length.alias("length"), (ok if kind in BASE_KINDS else F.lit(False)).alias("base"),
                F.array(*labels(kind, value, before, after, ok)).alias("votes"),
                sum((length > n).cast("tinyint") for n in LENGTHS).cast("tinyint").alias("size"),
            )

        return F.when(F.size(f"m_{kind}") > 0, F.transform(f"m_{kind}", build))

    every = F.filter(F.array(*[one(k) for k in KINDS]), lambda a: a.isNotNull())
    return df.select("row", "doc_id", F.flatten(every).alias("found"))


def fit(patterns: list[tuple[int, list[int], int, int]], steps: int = 30) -> Model:
    """From (kind, votes, length class, count): EM for the labelers' rates, then the classifier on its posteriors."""
    n = len(LABELERS)
    if not patterns:
        patterns = [(0, [1] * n, 0, 0)]
    kinds = np.array([p[0] for p in patterns])
    votes = np.array([p[1] for p in patterns])
    sizes = np.array([p[2] for p in patterns])
    count = np.array([p[3] for p in patterns], float)
    # Labelers are better than chance at the start; the pseudo-counts keep it so with little data.
    start = np.array([[[0.45, 0.35, 0.2], [0.1, 0.35, 0.55]]] * n)  # labeler, truth, vote + 1
    rates, prior = start.copy(), np.full(len(KINDS), 0.5)
    for _ in range(steps):
        log = np.log(np.stack([1 - prior[kinds], prior[kinds]]))
        for j in range(n):
            log += np.log(rates[j][:, votes[:, j] + 1])
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        weight = np.stack([count * (1 - posterior), count * posterior])
        for j in range(n):
            for v in range(3):
                rates[j][:, v] = weight[:, votes[:, j] + 1 == v].sum(1) + 20 * start[j][:, v]
            rates[j] /= rates[j].sum(1, keepdims=True)
        for k in range(len(KINDS)):
            prior[k] = (weight[1, kinds == k].sum() + 5) / (count[kinds == k].sum() + 10)
    x = np.concatenate([np.eye(len(KINDS))[kinds], votes, np.eye(len(LENGTHS) + 1)[sizes]], axis=1)
    w = np.concatenate([np.log(prior / (1 - prior)), [math.log(r[1, 2] / r[0, 2]) - math.log(r[1, 0] / r[0, 0]) for r in rates], np.zeros(len(LENGTHS) + 1)])
    w[len(KINDS) : len(KINDS) + n] /= 2
    w0, share = w.copy(), count / max(1.0, count.sum())
    for _ in range(300):  # gradient steps on the weighted cross entropy, held near the rates' own weights
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        w += 0.5 * (x.T @ (share * (posterior - p)) - 0.01 * (w - w0))
    return Model(
        dict(zip(KINDS, w[: len(KINDS)].tolist())), dict(zip(LABELERS, w[len(KINDS) : len(KINDS) + n].tolist())), w[len(KINDS) + n :].tolist(),
        {name: {v: (float(rates[j][0, v + 1]), float(rates[j][1, v + 1])) for v in (-1, 0, 1)} for j, name in enumerate(LABELERS)},
    )


def learn(found: DataFrame) -> Model:
    """``found`` has one row per candidate; its vote patterns are counted before anything is collected."""
    counted = found.groupBy("kind", "votes", "size").count().collect()
    return fit(sorted((r["kind"], list(r["votes"]), r["size"], r["count"]) for r in counted))


def probability(model: Model) -> Column:
    by_kind = F.array(*[F.lit(model.bias[k]) for k in KINDS])
    by_size = F.array(*map(F.lit, model.lengths))
    logit = F.get(by_kind, F.col("kind").cast("int")) + F.get(by_size, F.col("size").cast("int"))
    for j, name in enumerate(LABELERS):
        logit = logit + F.lit(model.votes[name]) * F.col("votes")[j]
    return 1 / (1 + F.exp(-logit))


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and all spans (kind, start, end, probability), in code points.

    Spans come by start, then in the order of ``KINDS``. Added spans have the classifier's probability of
    ``threshold`` or more and overlap no base span. A null text is empty and has no spans; null ids stay;
    repeated rows get a row each; an empty table gives an empty result; other columns are ignored. A text is
    searched whole.
    """
    held = shared_table(candidates(docs, doc_id, text), "pii")
    found = held.select("row", F.explode("found").alias("c")).select("row", "c.*")
    model = learn(found)
    ahead = Window.partitionBy("row", "kind").orderBy("nth")
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    by_end = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"))
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    after = by_end.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        found.repartition("row")
        .withColumn("end", F.sum(F.col("gap") + F.col("length")).over(ahead).cast("int"))
        .withColumn("start", F.col("end") - F.col("length"))
        .withColumn("probability", probability(model))
        .filter(F.col("base") | (~F.col("kind").isin(*range(len(BASE_KINDS))) & (F.col("probability") >= threshold)))
        .withColumn("reach", F.max(F.when(F.col("base"), F.col("end"))).over(before))
        .withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(after))
        .filter(F.col("base") | ((F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))))
    )
    names = F.array(*map(F.lit, KINDS))
    sums = placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base", "probability"))).alias("s"))

    def spans(of: Column) -> Column:
        return F.transform(
            F.coalesce(of, F.array()),
            lambda s: F.struct(F.get(names, s["kind"].cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["probability"].alias("probability")),
        )

    every = held.select("row", "doc_id").join(sums, "row", "left")
    return every.select(
        "doc_id", spans(F.filter("s", lambda s: s["base"])).alias("base"), spans(F.col("s")).alias("spans"))
