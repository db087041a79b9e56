"""Personal data by weak supervision (operator 7).

Candidate spans come from patterns (e-mail, IP address, card, phone, and
further kinds: card-like account numbers, national ids, local phone numbers,
IBANs, names).  Three labelers vote on each candidate, for (1), against (-1)
or not at all (0): a pattern labeler looks at its form, a gazetteer labeler
at lists (top-level domains, card issuers, dialling codes, account lengths of
countries, given names, words that names don't have, reserved networks), a
context labeler at the words before it.  Every kind has candidates that the
labelers judge differently (an IBAN's form is its check number, a name's the
place it stands at).  How reliable
each labeler is, and how common true spans of each kind are, is estimated by
expectation-maximisation over the counts of vote patterns of the whole table.
The resulting probabilities train a logistic classifier of spans (kind, votes,
form, neighbouring characters), which decides on the further kinds.  The four
base kinds are always kept; they have a probability as well.

The table is read once; what is kept of it is one row per document with its
candidates.  The driver sees the counts of feature patterns only, whose number
is bounded by the product of the features' values.  DataFrame functions only.

Positions are code points.  Each pattern's matches and the pieces between
them alternate, so places are running sums of lengths, taken in blocks to stay
below quadratic in a document with many matches.  Patterns use possessive
repeats and never go back, so a long run costs linear time.

Cases: a null or empty text has no spans; every input row gives a row;
without any candidate in the table, nothing is added; other columns aren't
read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm.tables import written

BASE_KINDS = ["email", "ip", "card", "phone"]
FURTHER_KINDS = ["account", "national_id", "local_phone", "iban", "name"]
KINDS = BASE_KINDS + FURTHER_KINDS

# fixed values: the gazetteers
TOP_LEVEL_DOMAINS = "com org net edu gov io de fr es uk eu info".split()
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Hans Peter Anna Sophie Pierre Marie Jean Carmen José María Juan"
).split()
# fixed values: length of an IBAN by its country
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
#: second words of capitalised pairs that aren't family names
NO_NAMES = (
    "January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday "
    "Saturday Sunday License Public University Street Road Avenue Company Corporation Limited Foundation Institute Project Version "
    "North South East West States Kingdom Union Commons General Reserved Straße Platz Rue Calle"
).split()
#: numbers known as examples or used up by advertisements
EXAMPLE_IDS = ["078-05-1120", "219-09-9999", "123-45-6789"]
CUES = (
    "mail e-mail email contact call tel phone mobile fax card visa account iban ssn name mr mrs ms dr host address "
    "telefon karte konto herr frau téléphone carte compte teléfono tarjeta cuenta"
).split()
COUNTER_CUES = "version release isbn order ticket build figure table chapter section art no".split()

#: a match starts where the one before ended or outside a run of its characters
_ALONE = r"(?:\G|(?<![%s]))"
# email, ip, card and phone match what the contract's patterns match
PATTERNS = {
    "email": _ALONE % "A-Za-z0-9._%+-" + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _ALONE % "0-9" + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "local_phone": r"(?<![0-9A-Za-z+]|[0-9]\x20)\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![0-9A-Za-z])",
    "name": r"(?<![\p{L}])[A-Z][\p{Ll}]{2,11}+\x20[A-Z][\p{Ll}]{2,14}+(?![\p{L}])",
}
#: a cheap test that holds for every text with a match
TRIGGERS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: t.contains("+"),
    "national_id": lambda t: t.rlike(r"[0-9]-[0-9]"),
    "local_phone": lambda t: t.contains(")"),
    "iban": lambda t: t.rlike(r"[A-Z][0-9]"),
    "name": lambda t: t.rlike(r"\p{Ll}\x20[A-Z]\p{Ll}"),
}
CONTEXT = 32
BLOCK = 64
EM_ROUNDS = 60
FIT_ROUNDS = 400
THRESHOLD = 0.5
SPAN = "array<struct<kind:int,start:int,end:int,word:string,before:string,after:string>>"


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern with places, the text before and the
    character after."""
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.struct(found.alias("found"), parts.alias("parts"))

    def spans(b: Column) -> Column:
        steps = F.zip_with(F.slice(b["parts"], 1, F.size(b["found"])), b["found"], lambda p, f: F.struct((F.char_length(p) + F.char_length(f)).alias("step"), p.alias("part"), f.alias("word")))
        wrapped = F.struct(steps.alias("steps"), b["parts"].alias("parts"))

        def placed(w: Column) -> Column:
            total = lambda items: F.aggregate(items, F.lit(0), lambda acc, s: acc + s["step"])
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(w["steps"]) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(w["steps"], b * BLOCK + 1, BLOCK)))
            summed = F.struct(w["steps"].alias("steps"), w["parts"].alias("parts"), blocks.alias("blocks"))

            def rows(v: Column) -> Column:
                def row(s: Column, i: Column) -> Column:
                    of = F.floor(i / BLOCK).cast("int")
                    end = F.aggregate(F.slice(v["blocks"], F.lit(1), of), F.lit(0), lambda a, x: a + x) + total(F.slice(v["steps"], of * BLOCK + 1, i - of * BLOCK + 1))
                    return F.struct(
                        F.lit(kind).alias("kind"), (end - F.char_length(s["word"])).alias("start"), end.alias("end"), s["word"].alias("word"),
                        F.right(s["part"], F.lit(CONTEXT)).alias("before"), F.left(F.get(v["parts"], i + 1), F.lit(1)).alias("after"),
                    )

                return F.transform(v["steps"], row)

            return F.get(F.transform(F.array(summed), rows), F.lit(0))

        return F.get(F.transform(F.array(wrapped), placed), F.lit(0))

    made = F.get(F.transform(F.array(both), lambda b: F.when(F.size(b["found"]) > 0, spans(b)).otherwise(F.array().cast(SPAN))), F.lit(0))
    return made


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _iban_remainder(word: Column) -> Column:
    """The number of an IBAN modulo 97: 1 for a right one."""

    def add(acc: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.when(digit, (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    turned = F.concat(F.substr(word, F.lit(5)), F.left(word, F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), add)


_PART = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _typed(spans: Column, kind: str) -> Column:
    """Candidates of a pattern: failing matches dropped, or of another kind."""
    if kind == "ip":
        return F.filter(spans, lambda s: s["word"].rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
    if kind == "phone":
        return F.filter(spans, lambda s: F.length(_digits(s["word"])).between(9, 15))
    if kind == "card":
        long = F.filter(spans, lambda s: F.length(_digits(s["word"])).between(12, 19))
        return F.transform(long, lambda s: s.withField("kind", F.when(_luhn(_digits(s["word"])), F.lit(KINDS.index("card"))).otherwise(F.lit(KINDS.index("account")))))
    return spans


def _votes(s: Column) -> dict[str, Column]:
    """Votes and form of a candidate, small integers each."""
    kind, word, digits = s["kind"], s["word"], _digits(s["word"])
    k = KINDS.index
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    repeated = digits.rlike(r"^([0-9])\1*$")
    form = (
        F.when(kind == k("email"), vote(word.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9][A-Za-z0-9-]*(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"), word.contains("..")))
        .when(kind == k("ip"), vote(~word.rlike(r"(^|\.)0[0-9]"), word.rlike(r"^0\.|(^|\.)0[0-9]")))
        .when(kind == k("card"), vote(F.length(digits).isin(14, 15, 16) & ~repeated, repeated))
        .when(kind == k("account"), vote(F.lit(False), F.lit(True)))
        .when(kind == k("phone"), vote(F.length(digits).between(10, 13), repeated))
        .when(kind == k("national_id"), vote(~word.rlike("^(000|666|9)|-00-|-0000$"), word.rlike("^(000|666|9)|-00-|-0000$")))
        .when(kind == k("iban"), vote(_iban_remainder(word) == 1, F.lit(True)))
        .when(kind == k("local_phone"), vote(word.rlike(r"^\([2-9][0-8][0-9]\)\x20?[2-9]") & ~word.contains("11)"), F.lit(True)))
        # a sentence's first word is a capital anyway
        .otherwise(vote(s["before"].rlike(r"[\p{Ll},:;(]\x20?$"), s["before"].rlike(r"[.!?]\s*$|\n$") | (F.length(s["before"]) == 0)))
    )
    country = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))
    account_length = F.try_element_at(country, F.left(word, F.lit(2)))
    listed = (
        F.when(kind == k("email"), vote(F.element_at(F.split(F.lower(word), r"\."), -1).isin(TOP_LEVEL_DOMAINS), F.lit(False)))
        .when(kind == k("ip"), vote(~word.rlike(r"^(0|127|255)\."), word.rlike(r"^(0|127|255)\.")))
        .when(kind.isin(k("card"), k("account")), vote(digits.rlike("^(4|5[1-5]|3[47]|6011)"), digits.startswith("0")))
        .when(kind == k("phone"), vote(digits.rlike("^(1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), digits.startswith("0")))
        .when(kind == k("name"), vote(F.element_at(F.split(word, " "), 1).isin(GIVEN_NAMES), F.element_at(F.split(word, " "), -1).isin(NO_NAMES)))
        .when(kind == k("iban"), vote(account_length == F.length(word), account_length.isNotNull()))
        .when(kind == k("national_id"), vote(F.lit(False), word.isin(EXAMPLE_IDS)))
        .when(kind == k("local_phone"), vote(word.rlike(r"^\((800|833|844|855|866|877|888)\)"), word.rlike(r"555-01[0-9]{2}$")))
        .otherwise(0)
    )
    before = F.lower(s["before"])
    cued = lambda cues: before.rlike(r"(?:^|[^\p{L}])(?:" + "|".join(cues) + r")[^\p{L}]{0,4}$")
    return {
        "form": form,
        "listed": listed,
        "context": vote(cued(CUES), cued(COUNTER_CUES)),
        "left": F.when(s["before"].rlike(r"[\p{L}\p{N}_]$"), 1).otherwise(0),
        "right": F.when(s["after"].rlike(r"^[\p{L}\p{N}_]"), 1).otherwise(0),
        "spaced": F.when(word.rlike(r"[\x20()-]"), 1).otherwise(0),
    }


FEATURES = ["form", "listed", "context", "left", "right", "spaced"]
LABELERS = FEATURES[:3]


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``id`` and ``spans`` (kind, start, end, votes and form)."""
    texts = df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = F.col("text")
    found = [F.when(TRIGGERS[k](t), _typed(_matches(t, p, KINDS.index(k)), k)).otherwise(F.array().cast(SPAN)).alias(k) for k, p in PATTERNS.items()]
    return texts.select("id", *found).select(
        "id", F.transform(F.concat(*PATTERNS), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), *(v.cast("int").alias(c) for c, v in _votes(s).items()))).alias("spans")
    )


def estimate(counts: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Probability that a candidate is personal data, by (kind, votes): each
    labeler has its chances of a vote given the truth, each kind its share of
    true ones; expectation-maximisation from the votes' majority."""
    belief = {p: 0.5 + 0.3 * max(-1, min(1, sum(p[1:]))) for p, _ in counts}
    for _ in range(EM_ROUNDS):
        share: dict[int, list[float]] = {}
        chance = {(j, c, v): 1.0 for j in range(len(LABELERS)) for c in (0, 1) for v in (-1, 0, 1)}
        for p, n in counts:
            yes = n * belief[p]
            s = share.setdefault(p[0], [1.0, 1.0])
            s[0] += n - yes
            s[1] += yes
            for j, v in enumerate(p[1:]):
                chance[j, 1, v] += yes
                chance[j, 0, v] += n - yes
        norm = {(j, c): sum(chance[j, c, v] for v in (-1, 0, 1)) for j in range(len(LABELERS)) for c in (0, 1)}
        for p, _ in counts:
            odds = math.log(share[p[0]][1] / share[p[0]][0])
            for j, v in enumerate(p[1:]):
                if v:  # a labeler that abstains says nothing
                    odds += math.log(chance[j, 1, v] / norm[j, 1]) - math.log(chance[j, 0, v] / norm[j, 0])
            belief[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> dict[tuple[str, int], float]:
    """Weights of a logistic classifier by (feature, value), trained on the
    estimated probabilities; ``patterns``: (kind, features) and counts."""
    votes: dict[tuple[int, ...], int] = {}
    for p, n in patterns:
        key = p[: 1 + len(LABELERS)]
        votes[key] = votes.get(key, 0) + n
    belief = estimate(sorted(votes.items()))
    names = ["kind", *FEATURES]
    weights = {(c, v): 0.0 for p, _ in patterns for c, v in zip(names, p, strict=True)}
    total = sum(n for _, n in patterns)
    for _ in range(FIT_ROUNDS if total else 0):
        slope = dict.fromkeys(weights, 0.0)
        for p, n in patterns:
            z = sum(weights[c, v] for c, v in zip(names, p, strict=True))
            off = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - belief[p[: 1 + len(LABELERS)]])
            for c, v in zip(names, p, strict=True):
                slope[c, v] += off
        for x in weights:
            weights[x] -= 2.0 * (slope[x] + 1e-4 * weights[x])
    return weights


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``base`` and ``found``: base spans, and those added as
    well (start, kind number, end, probability), by start and kind."""
    kept = written(candidates(df, key, text), "pii-candidates")
    each = kept.select(F.explode("spans").alias("s")).select("s.*")
    # bounded: kinds times the values of the features
    counted = each.groupBy("kind", *FEATURES).count().collect()
    weights = fit([(tuple(r[:-1]), r[-1]) for r in sorted(map(tuple, counted))])

    def score(s: Column) -> Column:
        z = F.lit(0.0)
        for c in ["kind", *FEATURES]:
            chosen = F.lit(0.0)
            for (name, value), weight in weights.items():
                if name == c:
                    chosen = F.when(s[c] == value, F.lit(weight)).otherwise(chosen)
            z = z + chosen
        return 1 / (1 + F.exp(-z))

    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    chosen = F.filter("spans", lambda s: (s["kind"] >= len(BASE_KINDS)) & (score(s) >= THRESHOLD))
    free = F.filter(chosen, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    row = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), score(s).alias("probability"))
    return kept.withColumn("base", base).select(
        F.col("id").alias(key),
        F.array_sort(F.transform("base", row)).alias("base"),
        F.array_sort(F.transform(F.concat("base", free), row)).alias("found"),
    )


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    n = [count(kind) for kind in BASE_KINDS]
    least = F.array_min(F.transform("base", lambda s: s["probability"])).alias("least_probability")
    return found.select("doc_id", *n, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("found").alias("spans"), least)
