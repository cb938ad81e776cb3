"""Personal data by aggregated weak supervision, from DataFrame functions only.

Candidates are the matches of four base patterns (email, ip, card, phone) and of looser ones (spelled-out emails, national phone numbers,
social security numbers, account numbers).  Four labelers vote on each or abstain: its strict form, gazetteers (domains, country codes, issuer
numbers), cue words before it, and its edges.  Spark counts the vote patterns of each kind (at most 81 per kind and size);
expectation-maximisation over these counts estimates how reliable every labeler is for each kind and gives every pattern a posterior.
A logistic classifier over votes and size is trained on the posteriors and scores all candidates as a plain column expression.

Base matches always stay; a looser match is added where the classifier gives it 0.5 or more and no base match covers part of it.
Defined results: a null text is empty; repeated rows are scanned each for itself; without candidates all results are empty.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.llm.spans import Pattern, span_text, with_spans
from homelake.session import cut_lineage

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Luhn sum of up to 19 digits is a multiple of 10."""
    padded = F.lpad(_digits(value), 19, "0")

    def part(at: int) -> Column:
        digit = F.substring(padded, at + 1, 1).cast("int")
        return digit if at % 2 == 0 else F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return reduce(lambda a, b: a + b, [part(at) for at in range(19)]) % 10 == 0


def _between(value: Column, low: int, high: int) -> Column:
    return F.length(_digits(value)).between(low, high)


# Possessive loops and the look-behind (a run of the class is tried once, or from where the last match ended) only keep Java's matcher
# from trying a long run again from each of its characters; the matches are those of the plain patterns.
BASE = [
    Pattern("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Pattern("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
    Pattern("card", r"[0-9](?:[\x20-]?[0-9])++", lambda v: F.when(_between(v, 13, 19), luhn(v)).otherwise(False)),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: _between(v, 9, 15)),
]
LOOSE = [
    Pattern("email_spelled", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]++"
            r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\x20dot\x20)\x20?[A-Za-z0-9-]++)++"),
    Pattern("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    Pattern("phone_national", r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])"),
    Pattern("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
]
KINDS = [p.kind for p in BASE + LOOSE]

# Gazetteers and cue words of the labelers.
_DOMAINS = r"(?i)(?:com|org|net|edu|gov|info|io|co|uk|de|fr|es|it|nl|eu|ch|at|be|us|ca|au)$"
_COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_CUES = r"(?i)(?:e-?mail|mail|contact|call|phone|tel|fax|mobile|cell|reach|whatsapp|address|card|visa|credit|account|iban|ssn|social|ip|host|login|user|kontakt|telefon|correo|teléfono|courriel|téléphone)"
_COUNTER_CUES = r"(?i)(?:isbn|issn|version|release|order|invoice|article|doi|page|figure|table|serial|model|part)\W*(?:no|nr|number|#)?\W*$"
_LABELERS = ("form", "gazetteer", "context", "edges")


def _votes(kind: str, span: Column) -> dict[str, Column]:
    """1 for, -1 against, 0 abstains."""
    value, before, after = span["value"], span["before"], span["after"]

    def vote(good: Column, bad: Column | None = None) -> Column:
        out = F.when(good, F.lit(1))
        return (out if bad is None else out.when(bad, F.lit(-1))).otherwise(F.lit(0))

    digits = _digits(value)
    form = {
        "email_spelled": value.rlike(r"(?:\(|\[|\{)"),
        "iban": _between(value, 10, 32),
        "phone_national": ~digits.rlike(r"^[01]") & ~F.substring(digits, 4, 3).rlike("^[01]"),
        "ssn": ~digits.rlike(r"^(?:000|666|9)") & ~F.substring(digits, 4, 2).rlike("^00") & ~F.substring(digits, 6, 4).rlike("^0000"),
    }.get(kind, F.lit(True))
    gazetteer = {
        "email": value.rlike(_DOMAINS), "email_spelled": value.rlike(_DOMAINS),
        "phone": value.rlike(_COUNTRY_CODES), "card": digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"),
        "iban": value.rlike("^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"),
    }.get(kind, F.lit(False))
    return {
        "form": vote(form, ~form),
        "gazetteer": vote(gazetteer) if kind in ("ip", "ssn", "phone_national") else vote(gazetteer, ~gazetteer),
        "context": vote(before.rlike(_CUES), before.rlike(_COUNTER_CUES)),
        "edges": vote(~before.rlike("[A-Za-z0-9_]$") & ~after.rlike("^[A-Za-z0-9_]"), before.rlike("[A-Za-z0-9_]$") & after.rlike("^[A-Za-z0-9_]")),
    }


def find_candidates(docs: DataFrame, text: str = "text", output: str = "candidates") -> DataFrame:
    """``docs`` with ``output``: (kind, start, end, base, size and one vote per labeler) by kind, then start."""
    found = with_spans(docs, BASE + LOOSE, text)

    def candidates(kind: str, base: bool) -> Column:
        spans = F.col(f"__span_{kind}")
        if not base:
            certain = F.concat(*[F.col(f"__span_{p.kind}") for p in BASE])
            spans = F.filter(spans, lambda s: ~F.exists(certain, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
        return F.transform(spans, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"),
            F.least(F.floor((s["end"] - s["start"]) / 8), F.lit(3)).cast("int").alias("size"),
            *[vote.cast("int").alias(name) for name, vote in _votes(kind, s).items()]))

    parts = [candidates(p.kind, True) for p in BASE] + [candidates(p.kind, False) for p in LOOSE]
    return found.withColumn(output, F.concat(*parts)).drop(*[f"__span_{kind}" for kind in KINDS])


def _posteriors(counts: dict[tuple[int, ...], float], rounds: int = 30) -> dict[tuple[int, ...], float]:
    """Latent-class EM: the chance of every vote pattern to be personal data, from the counts of the patterns of one kind."""
    labelers = range(len(_LABELERS))
    chance = {votes: min(0.95, max(0.05, 0.5 + 0.2 * sum(votes))) for votes in counts}
    for _ in range(rounds):
        share = (sum(n * chance[v] for v, n in counts.items()) + 1) / (sum(counts.values()) + 2)
        rate = []
        for i in labelers:
            given = {}
            for true in (True, False):
                # Priors of the reliabilities: a labeler is more often right than wrong.
                sums = {1: 4.0 if true else 1.0, 0: 2.0, -1: 1.0 if true else 4.0}
                for votes, n in counts.items():
                    sums[votes[i]] += n * (chance[votes] if true else 1 - chance[votes])
                total = sum(sums.values())
                given[true] = {vote: value / total for vote, value in sums.items()}
            rate.append(given)
        for votes in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(rate[i][True][votes[i]] / rate[i][False][votes[i]]) for i in labelers)
            chance[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return chance


def _features(kind: str, size: int, votes: tuple[int, ...]) -> list[tuple]:
    return [("kind", kind), ("size", size), *[(name, vote) for name, vote in zip(_LABELERS, votes)]]


def _train(rows: list[tuple[str, int, tuple[int, ...], float, float]], rounds: int = 300, rate: float = 0.5) -> dict[tuple, float]:
    """Logistic regression on (kind, size, votes, count, posterior) by gradient descent over the few distinct rows."""
    weights: dict[tuple, float] = defaultdict(float)
    total = sum(math.sqrt(n) for *_, n, _ in rows) or 1.0
    for _ in range(rounds):
        step: dict[tuple, float] = defaultdict(float)
        for kind, size, votes, n, target in rows:
            names = _features(kind, size, votes)
            score = sum(weights[name] for name in names)
            miss = math.sqrt(n) / total * (target - 1 / (1 + math.exp(-max(-30.0, min(30.0, score)))))
            for name in names:
                step[name] += miss
        for name, value in step.items():
            weights[name] += rate * (value - 1e-4 * weights[name]) * 4
    return dict(weights)


def fit_classifier(candidates: DataFrame, column: str = "candidates") -> dict[tuple, float]:
    """Weights of the span classifier, from the counts of vote patterns of all candidates (at most 81 x 4 sizes for each of the kinds)."""
    one = candidates.select(F.explode(column).alias("c")).select("c.kind", "c.size", *[f"c.{name}" for name in _LABELERS])
    counted = one.groupBy("kind", "size", *_LABELERS).count().orderBy("kind", "size", *_LABELERS).collect()
    by_kind: dict[str, dict[tuple[int, ...], float]] = defaultdict(lambda: defaultdict(float))
    for row in counted:
        by_kind[row["kind"]][tuple(row[name] for name in _LABELERS)] += row["count"]
    posterior = {kind: _posteriors(counts) for kind, counts in by_kind.items()}
    return _train([
        (row["kind"], row["size"], votes := tuple(row[name] for name in _LABELERS), row["count"], posterior[row["kind"]][votes]) for row in counted
    ])


def _chance(span: Column, weights: dict[tuple, float]) -> Column:
    def term(field: str) -> Column:
        own = [(value, weight) for (name, value), weight in weights.items() if name == field]
        out = F.lit(0.0)
        for value, weight in own:
            out = F.when(span[field] == value, F.lit(weight)).otherwise(out)
        return out

    score = reduce(lambda a, b: a + b, [term(field) for field in ("kind", "size", *_LABELERS)])
    return 1 / (1 + F.exp(-score))


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``spans``: array of (kind, start, end, base) of all personal data, by kind, then start; code points, end exclusive."""
    stored = cut_lineage(find_candidates(docs, text).drop(text))
    return stored.withColumn("spans", _accepted("candidates", fit_classifier(stored))).drop("candidates")


def _accepted(candidates: str, weights: dict[tuple, float]) -> Column:
    kept = F.filter(candidates, lambda c: c["base"] | (_chance(c, weights) >= 0.5))
    return F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first covers the rest."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, span: Column) -> Column:
        begins = F.greatest(span["start"], acc["at"])
        piece = F.when(span["start"] >= acc["at"], F.concat(
            F.substring(text, acc["at"] + 1, begins - acc["at"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"), F.array_append(acc["out"], piece).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(ordered, begin, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all personal data in ``text`` replaced; texts are scanned once to fit the classifier and once to be rewritten."""
    found = find_candidates(docs, text, "__candidates")
    spans = _accepted("__candidates", fit_classifier(found, "__candidates"))
    return found.withColumn("__spans", spans).withColumn(text, redact(F.col(text), F.col("__spans"))).select(docs.columns)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(p.kind) for p in BASE]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
