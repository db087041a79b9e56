"""Secret scans with assignment-aware lexing (operator 9).

A small lexer reads assignments as they look in source code and configuration
(``name = "x"``, ``name: x``, ``"name": "x"``, ``name := a + "x"``,
``name => 'x'``) and yields pairs of a target name and the literals assigned
to it.  Names on the right side stand for the literals last assigned to them
in the text, so ``a = "k3y..."; password = a`` judges the literal under the
name ``password``.  A literal's score is the sensitivity of its most telling
target name times how random it looks; placeholders score nothing.

Beside these the fixed kinds of the contract are found (assign, access, hex).
No pattern goes back over a run, runs that hold many targets are read once, and
so are the characters of values with one end: a scan is linear in the text.
Each row is scanned by itself, without a shuffle.

Cases: a null text counts as empty and has no spans; every input row gives a
row; repeated secrets give repeated spans; a literal that overlaps a fixed
span is not reported twice; columns of the input keep their places in
``redacted``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["assign", "access", "hex", "literal"]
# fixed values: the contract's patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16}

#: how telling a part of a target name is
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "private": 0.6, "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "key": 0.55, "access": 0.4, "signing": 0.5, "session": 0.4, "client": 0.2, "api": 0.4,
}
#: how a placeholder begins; one of the pairs encloses others.
PLACEHOLDER = re.compile(r"(?i)%\(|\{\{|your|change.?me|example|dummy|test|todo")
ENCLOSED = (("<", ">"), ("${", "}"))
LEAST_LITERAL = 8
THRESHOLD = 0.45

#: a name begins with the first letter of its run of characters, and a quote
#: before it must follow it, too; a run is read twice at most.
NAME = re.compile(r"""(?:(["'])|(?<![A-Za-z0-9_$.-])[0-9.-]*+)([A-Za-z_$][A-Za-z0-9_$.-]*+)(?(1)\1)[ \t]*+(?::=|=>|=(?![=~])|:(?![:/]))[ \t]*+""")
STRING = re.compile(r'''"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)\'|`([^`\n]*)`''')
JOINT = re.compile(r"[ \t]*[+][ \t]*")
BARE = re.compile(r"[A-Za-z0-9+/_.=~$@!#%^&*-]+")
IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.-]*+")


def fixed_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the contract's kinds."""
    out = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def sensitivity(name: str) -> float:
    """From 0 to 1: the parts of ``apiKey``, ``DB_PASSWORD`` or ``auth.token``
    together."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)]
    left = 1.0
    for part in [*set(parts), "".join(parts)]:
        left *= 1 - SENSITIVE.get(part, 0.0)
    return 1 - left


def randomness(value: str) -> float:
    """From 0 to 1: entropy of the characters, long mixed values highest."""
    return _randomness(value, 0, len(value), Counter(value))


def _randomness(text: str, start: int, end: int, characters: Counter) -> float:
    """Of ``text[start:end]``, whose characters are counted already."""
    n = end - start
    if n < LEAST_LITERAL or any(c.isspace() for c in characters) or any(set(characters) <= set(alike) for alike in ("xX", "*", ".")):
        return 0.0
    if PLACEHOLDER.match(text, start, end) or any(text.startswith(a, start) and text.endswith(b, start, end) for a, b in ENCLOSED):
        return 0.0
    bits = -sum(c / n * math.log2(c / n) for c in characters.values())
    kinds = sum(any(of(c) for c in characters) for of in (lambda c: "a" <= c <= "z", lambda c: "A" <= c <= "Z", lambda c: "0" <= c <= "9", lambda c: not (c.isascii() and c.isalnum())))
    return min(1.0, bits / 3.5) * (0.4 + 0.2 * min(3, kinds))


def literal_pairs(text: str) -> list[tuple[str, int, int]]:
    """(target name, start, end) of each literal; of the names that it reaches
    through constants, the most telling one.  Terms joined by + end with the
    one that holds another target (strings may hold some)."""
    names: list[str] = []
    literals: list[list[tuple[int, int]]] = []
    sources: list[list[int]] = []  # assignments whose target is read here
    last: dict[str, int] = {}
    targets = list(NAME.finditer(text))
    begins = [m.start(2) for m in targets]
    run = (0, 0)  # the run of bare characters met last
    for target in targets:
        at, values, reads = target.end(), [], []
        while True:  # terms joined by +
            if m := STRING.match(text, at):
                group = m.lastindex or 1
                values.append((m.start(group), m.end(group)))
                end = m.end()
            else:
                # targets may lie in a run: it is read once for all of them
                if not run[0] <= at < run[1]:
                    m = BARE.match(text, at)
                    if not m:
                        break
                    run = m.span()
                end = run[1]
                m = IDENTIFIER.match(text, at)
                if not m or m.end() != end:
                    values.append((at, end))
                elif m[0] in last:
                    reads.append(last[m[0]])
                elif any(c.isdigit() for c in m[0]):
                    values.append((at, end))
                if bisect_left(begins, end) > bisect_left(begins, at):
                    break  # another assignment begins here
            if not (joint := JOINT.match(text, end)):
                break
            at = joint.end()
        last[target[2]] = len(names)
        names.append(target[2])
        literals.append(values)
        sources.append(reads)
    told = [sensitivity(name) for name in names]
    for i in range(len(names) - 1, -1, -1):  # names flow back to what they read
        for j in sources[i]:
            if told[i] > told[j]:
                names[j], told[j] = names[i], told[i]
    return [(name, a, b) for name, values in zip(names, literals, strict=True) for a, b in values]


def literal_spans(text: str) -> list[tuple[int, int, float]]:
    """(start, end, score) of literals that look like secrets."""
    if "=" not in text and ":" not in text:
        return []
    telling: dict[str, float] = {}
    best: dict[int, dict[int, float]] = {}  # by end, then start
    for name, start, end in literal_pairs(text):
        if name not in telling:
            telling[name] = sensitivity(name)
        if end - start >= LEAST_LITERAL and telling[name]:
            of_end = best.setdefault(end, {})
            of_end[start] = max(of_end.get(start, 0.0), telling[name])
    out = []
    for end, starts in best.items():
        characters: Counter = Counter()
        counted = end
        for start in sorted(starts, reverse=True):  # the shortest first: all are counted once
            characters.update(text[start:counted])
            counted = start
            score = starts[start] * _randomness(text, start, end, characters)
            if score >= THRESHOLD:
                out.append((start, end, score))
    return sorted(out)


def assigned_score(text: str, start: int, value: int, end: int) -> float:
    """Score of a fixed span of kind assign: its word's sensitivity times how
    random its value looks."""
    return sensitivity(IDENTIFIER.match(text, start)[0]) * randomness(text[value:end])


def spans(text: str) -> list[tuple[int, int, int, int]]:
    """All spans: fixed ones and literals that none of them overlaps."""
    fixed = fixed_spans(text)
    starts, reach = [s[0] for s in fixed], list(accumulate((s[2] for s in fixed), max))

    def covered(a: int, b: int) -> bool:
        before = bisect_left(starts, b)  # fixed spans that begin before b
        return before > 0 and reach[before - 1] > a

    return sorted(fixed + [(a, 3, b, a) for a, b, _ in literal_spans(text) if not covered(a, b)])


def redact(text: str, mark: str = "[secret]") -> str:
    """``text`` with the value of every span replaced."""
    out, at = [], 0
    for start, end in sorted((value, end) for _, _, end, value in spans(text)):
        if end <= at:
            continue
        out += [text[at : max(at, start)], mark * (start >= at)]
        at = end
    return "".join([*out, text[at:]])


def _joined(found) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in found)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, counts of the fixed kinds, ``base`` (fixed spans as
    text), ``spans`` (all spans) and ``score``: the highest one of an assigned
    value, fixed or found by its target (0 without any)."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *(T.StructField(f"n_{k}", T.LongType(), False) for k in KINDS[:3]), T.StructField("base", T.StringType(), False), T.StructField("spans", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])

    def run(batches):
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(text)]
            found = [spans(t) for t in texts]
            counts = [pa.array([sum(s[1] == k for s in f) for f in found], pa.int64()) for k in range(3)]
            base = pa.array([_joined(s for s in f if s[1] < 3) for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(key), *counts, base, pa.array([_joined(f) for f in found], pa.string()), pa.array(map(score, texts, found), pa.float64())], schema.fieldNames())

    def score(t: str, of: list) -> float:
        told = [assigned_score(t, a, value, b) for a, kind, b, value in of if KINDS[kind] == "assign"]
        kept = {(a, b) for a, kind, b, _ in of if KINDS[kind] == "literal"}
        return max([0.0, *told, *(s for a, b, s in literal_spans(t) if (a, b) in kept)]) if of else 0.0

    return df.select(key, text).mapInArrow(run, schema)


def redacted(df: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``df`` with the values of secrets replaced in ``text``, and ``length``
    (if it is a column) set anew for rows that changed."""
    names = df.columns

    def run(batches):
        for batch in batches:
            old = batch.column(text).to_pylist()
            new = [t if t is None else redact(t) for t in old]
            columns = {n: batch.column(n) for n in names}
            columns[text] = pa.array(new, batch.column(text).type)
            if length in columns:
                kept = columns[length].to_pylist()
                columns[length] = pa.array([k if a == b else len(b) for k, a, b in zip(kept, old, new, strict=True)], columns[length].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return df.mapInArrow(run, df.schema)


def op9_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "score")
