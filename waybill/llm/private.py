"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a classifier decides."""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import let, scan, written

# The kinds in the order that spans of one start are listed in.
KINDS = ["email", "ip", "card", "phone", "ssn", "iban"]
BASE_KINDS = KINDS[:4]

# What each base kind looks like. Possessive loops keep long runs linear and off the stack; \G lets a
# match begin where the last one ended. A card is a maximal run of digits, so its length stands in the pattern.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

#: Looser looks, for what the base patterns leave: (kind, pattern).
LOOSE_PATTERNS = [
    ("email", rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]++ ?(?:\.|[\[(](?i:dot)[\])]) ?[A-Za-z]{{2,24}}(?![A-Za-z0-9])"),
    ("phone", r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
]
# Words before personal data, words before other numbers, and ends of mail hosts and codes of countries.
CONTEXT = ["mail", "e-mail", "email", "phone", "tel", "telephone", "call", "fax", "mobile", "contact", "ssn", "iban", "card",
           "account", "konto", "telefon", "correo", "courriel", "portable"]
OTHER = ["version", "token", "isbn", "release", "build", "license", "page", "section", "key", "hash", "id"]
GAZETTEER = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "AT", "BE", "CH", "DE", "ES", "FR", "GB",
             "IT", "NL", "PT"]
#: Labelers in the order of their votes, each with the chances of + and of - on personal data, then on other text, to begin
#: with; these beliefs weigh as much as ``ANCHOR`` spans.
LABELERS = {
    "strict": (0.9, 0.0, 0.1, 0.0), "loose": (0.99, 0.0, 0.9, 0.0), "gazetteer": (0.6, 0.0, 0.2, 0.0),
    "context": (0.5, 0.0, 0.05, 0.0), "other_context": (0.0, 0.02, 0.0, 0.4), "edges": (0.9, 0.1, 0.6, 0.4),
}
ANCHOR = 20.0
SPAN = "struct<start:int,kind:int,end:int,base:boolean,votes:string,traits:array<string>>"


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: ``array<struct<start,end,match,left,right>>`` in code points."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    kind = "array<struct<start:int,end:int,match:string,left:string,right:string>>"

    def placed(hits: Column, gaps: Column) -> Column:
        sizes = F.transform(hits, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("n")))
        place = lambda last, x: F.struct(
            (last["end"] + x["gap"]).alias("start"), (last["end"] + x["gap"] + x["n"]).alias("end"))
        zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))
        places = scan(sizes, zero, "struct<start:int,end:int>", place)
        return let(places, lambda at: F.transform(hits, lambda m, i: F.struct(
            F.get(at, i)["start"].alias("start"), F.get(at, i)["end"].alias("end"), m.alias("match"),
            F.right(F.get(gaps, i), F.lit(24)).alias("left"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("right"))).cast(kind))

    return F.when(F.rlike(text, F.lit(pattern)), let(hits, lambda h: let(gaps, lambda g: placed(h, g)))).otherwise(
        F.array().cast(kind))


def passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.rlike(match, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
    if kind == "card":
        return F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _votes(kind: str, m: Column, strict: bool) -> Column:
    """One sign per labeler: + for personal data, - against, 0 for no opinion."""
    left = F.lower(m["left"])
    word = F.regexp_extract(left, r"([a-z-]+)[^a-z]{0,3}$", 1)
    end = F.regexp_extract(m["match"], r"([A-Za-z]+)$" if kind == "email" else r"^([A-Z]{2})", 1)
    beside = F.concat(F.right(m["left"], F.lit(1)), m["right"])
    sign = lambda plus, minus: F.when(plus, "+").when(minus, "-").otherwise("0")
    no = F.lit(False)
    gazetteer = sign(end.isin(GAZETTEER), no) if kind in ("email", "iban") else F.lit("0")
    return F.concat(
        F.lit("+" if strict else "0"), F.lit("0" if strict else "+"), gazetteer, sign(word.isin(CONTEXT), no),
        sign(no, word.isin(OTHER)), sign(~F.rlike(beside, F.lit("[A-Za-z0-9]")), F.rlike(beside, F.lit("[A-Za-z0-9]"))))


def _traits(kind: str, m: Column, strict: bool) -> Column:
    """What the classifier sees of a span; each trait has few values."""
    n = F.length(F.regexp_replace(m["match"], "[^0-9]", ""))
    return F.array(
        F.lit(f"kind={kind}{'' if strict else '?'}"),
        F.concat(F.lit("digits="), F.least(n, F.lit(20)).cast("string")),
        F.concat(F.lit("before="), _class(F.right(m["left"], F.lit(1)))), F.concat(F.lit("after="), _class(m["right"])),
        F.concat(F.lit("mixed="), F.rlike(m["match"], F.lit("[A-Za-z]")).cast("string")),
        F.concat(F.lit("words="), F.substring(_votes(kind, m, strict), 4, 2)))


def _class(char: Column) -> Column:
    return F.when(char == "", "edge").when(F.rlike(char, F.lit("[0-9]")), "digit").when(
        F.rlike(char, F.lit("[A-Za-z]")), "letter").when(F.rlike(char, F.lit(r"\s")), "blank").otherwise("sign")


def candidates(text: Column) -> Column:
    """All spans of a text that labelers vote on: base ones, and looser ones that touch none of them."""
    text = F.coalesce(text, F.lit(""))

    def spans(kind: str, pattern: str, strict: bool) -> Column:
        hits = found(text, pattern)
        hits = F.filter(hits, lambda m: passes(kind, m["match"])) if strict else hits
        return F.transform(hits, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"), F.lit(strict).alias("base"),
            _votes(kind, m, strict).alias("votes"), _traits(kind, m, strict).alias("traits")).cast(SPAN))

    base = [spans(k, p, True) for k, p in BASE_PATTERNS.items()]
    loose = [spans(k, p, False) for k, p in LOOSE_PATTERNS]
    some = _apart(F.sort_array(F.concat(*base, *loose)))
    return F.when(F.rlike(text, F.lit(r"[0-9@]|[\[(](?i:at)[\])]")), some).otherwise(F.array().cast(f"array<{SPAN}>"))


def _apart(spans: Column) -> Column:
    """Sorted spans without the looser ones that touch a base one: by the furthest base end before, and the next base start."""
    far = 2 ** 31 - 1

    def kept(all_: Column) -> Column:
        ends = scan(all_, F.lit(0), "int", lambda m, x: F.when(x["base"], F.greatest(m, x["end"])).otherwise(m))
        starts = F.reverse(scan(F.reverse(all_), F.lit(far), "int", lambda m, x: F.when(x["base"], x["start"]).otherwise(m)))
        return let(ends, lambda e: let(starts, lambda s: F.filter(all_, lambda x, i: x["base"] | (
            (x["start"] >= F.coalesce(F.get(e, i - 1), F.lit(0))) & (x["end"] <= F.coalesce(F.get(s, i + 1), F.lit(far)))))))

    return let(spans, kept)


class Model(NamedTuple):
    """``reliability``: by labeler, the chances of + and of - on personal data, then on other text.

    The classifier is ``bias`` plus the log odds of a span's traits.
    """

    prior: float
    reliability: list[tuple[float, ...]]
    bias: float
    odds: dict[str, float]


def fit(spans: DataFrame, rounds: int = 50) -> Model:
    """Weigh the labelers by expectation-maximisation over all looser spans, then train the classifier on the verdicts.

    ``spans`` has a column ``span``; base spans are settled and left out. The
    driver gets counts per pattern of votes and traits, which are bounded by the
    labelers and trait values, not by the corpus. A labeler without an opinion on
    a span says nothing for or against it. The classifier is naive Bayes over the
    traits, with the posteriors as weights, smoothed by one; without looser spans
    it accepts nothing.
    """
    rows = spans.where("not span.base").groupBy("span.votes", "span.traits").count().collect()
    patterns: Counter = Counter()
    for r in rows:
        patterns[r["votes"]] += r["count"]
    total = sum(patterns.values())
    prior, reliability, belief = 0.5, list(LABELERS.values()), {}
    for _ in range(rounds):
        for votes in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (py, my, pn, mn) in zip(votes, reliability, strict=True):
                odds += math.log(py / pn) if v == "+" else math.log(my / mn) if v == "-" else 0.0
            belief[votes] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        sure = sum(n * belief[v] for v, n in patterns.items())
        prior = (sure + 1) / (total + 2)
        reliability = [
            tuple(
                (sum(n * (belief[v] if k < 2 else 1 - belief[v]) for v, n in patterns.items() if v[i] == "+-"[k % 2]) + ANCHOR * start)
                / ((sure if k < 2 else total - sure) + ANCHOR)
                for k, start in enumerate(first))
            for i, first in enumerate(LABELERS.values())
        ]
    weights: dict[str, list[float]] = {}
    yes = no = 0.0
    for r in rows:
        y, n = r["count"] * belief[r["votes"]], r["count"] * (1 - belief[r["votes"]])
        yes, no = yes + y, no + n
        for trait in r["traits"]:
            w = weights.setdefault(trait, [0.0, 0.0])
            w[0], w[1] = w[0] + y, w[1] + n
    values = Counter(t.split("=")[0] for t in weights)
    odds = {
        t: math.log((y + 1) / (yes + k)) - math.log((n + 1) / (no + k))
        for t, (y, n) in weights.items() for k in [values[t.split("=")[0]]]
    }
    return Model(prior, reliability, math.log((yes + 1) / (no + 1)), odds)


def accepted(spans: Column, model: Model) -> Column:
    """Base spans, and those others that the classifier takes for personal data."""
    if not model.odds:
        return F.filter(spans, lambda s: s["base"])
    table = F.create_map(*[F.lit(x) for t in sorted(model.odds.items()) for x in t])
    score = lambda s: F.aggregate(
        s["traits"], F.lit(model.bias), lambda a, t: a + F.coalesce(F.try_element_at(table, t), F.lit(0.0)))
    return F.filter(spans, lambda s: s["base"] | (score(s) > 0))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets.

    Pieces are cut from four bytes per code point, where a place is found at once.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def built(raw: Column, spans: Column, ends: Column) -> Column:
        def piece(start: Column, size: Column) -> Column:
            # A letter in front keeps a mark of byte order from being taken for one.
            held = F.concat(F.unhex(F.lit("00000041")), F.substring(raw, start * 4 + 1, size * 4))
            return F.substring(F.decode(held, "UTF-32"), 2, 2 ** 31 - 1)

        def part(s: Column, i: Column) -> Column:
            at = F.coalesce(F.get(ends, i - 1), F.lit(0))
            return F.when(s["start"] >= at, F.concat(piece(at, s["start"] - at), F.get(names, s["kind"]))).otherwise("")

        last = F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0))
        return F.concat(F.array_join(F.transform(spans, part), ""), piece(last, F.lit(2 ** 28)))

    return let(F.encode(F.coalesce(text, F.lit("")), "UTF-32"), lambda raw: let(spans, lambda s: let(
        scan(s, F.lit(0), "int", lambda at, x: F.greatest(at, x["end"])), lambda e: built(raw, s, e))))


def private_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (start, kind, end, base, votes, traits; in code points, sorted) for every row of ``docs``.

    A null text counts as empty and has none. Repeated rows have a result each
    and count each for the labelers. Extra columns are left out. Only SQL
    functions; texts are scanned once and never shuffled.
    """
    held = written(docs.select("doc_id", candidates(F.col("text")).alias("spans")), "spans")
    model = fit(held.select(F.explode("spans").alias("span")))
    return held.select("doc_id", accepted(F.col("spans"), model).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def private_report(docs: DataFrame) -> DataFrame:
    """Counts and a digest of the base spans, and all spans as text, per row."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])
    counts = [_count(spans, i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return private_spans(docs).select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def private_removed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with personal data replaced by its kind; all rows and columns stay, a null text too."""
    body = F.col(f"`{text}`")
    model = fit(docs.select(F.explode(candidates(body)).alias("span")))
    clean = let(accepted(candidates(body), model), lambda s: F.when(F.size(s) > 0, redacted(body, s)).otherwise(body))
    return docs.withColumn(text, clean)
