"""Secret scans over a trigram inverted index. DataFrame functions only.

Each rule's regex is turned into a Boolean query over trigrams that any match must contain: an AND of clauses, a clause
an OR of trigram sets. Postings of the trigrams that occur in queries are written once; a query intersects the postings
of its rarest trigrams, and only the texts left are matched with the regex. A rule without mandatory trigrams reads all texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as op, _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.storage import stored

_SPELLINGS = 64  # more spellings of one stretch are cut into two stretches
_BLOCK = 256  # matches whose offsets are summed together


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``regex`` (Java syntax) whose ``group`` has at least ``at_least`` characters."""

    kind: str
    regex: str
    group: int = 0
    at_least: int = 1


# fixed values: the kinds asked for, then widespread credential formats
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # every run of 32 or more, as a run of any length filtered by its length
)
ADDED = (
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("url_login", r"://[^\x00-\x20/:@<>]{1,64}:[^\x00-\x20/:@<>]{3,64}@"),
)

Clause = frozenset[frozenset[str]]  # any of these sets of trigrams


def _spelled(node) -> set[str] | None:
    """Every lower-cased string the node can match, where these are few."""
    kind, arg = node
    if kind is op.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if kind is op.IN:
        out = set()
        for k, v in arg:
            if k is op.LITERAL and v < 128:
                out.add(chr(v).lower())
            elif k is op.RANGE and v[1] < 128 and v[1] - v[0] < 8:
                out |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if kind is op.SUBPATTERN:
        return _product([_spelled(n) for n in arg[3]])
    if kind is op.BRANCH:
        parts = [_product([_spelled(n) for n in branch]) for branch in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, inner = arg
        one = _product([_spelled(n) for n in inner]) if high != op.MAXREPEAT and high <= 4 else None
        parts = [_product([one] * n) for n in range(low, high + 1)] if one is not None else [None]
        return None if any(p is None for p in parts) else set().union(*parts)
    return {""} if kind in (op.AT, op.ASSERT, op.ASSERT_NOT) else None


def _product(parts: list[set[str] | None]) -> set[str] | None:
    out = {""}
    for p in parts:
        if p is None or len(out) * len(p) > _SPELLINGS:
            return None
        out = {a + b for a, b in product(out, p)}
    return out


def _clause(spellings: set[str]) -> list[Clause]:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in spellings}
    if frozenset() in sets:
        return []
    return [frozenset(s for s in sets if not any(other < s for other in sets))]


def _clauses(nodes) -> list[Clause]:
    out, run = [], {""}
    for node in nodes:
        own = _spelled(node)
        longer = None if own is None else _product([run, own])
        if longer is not None:
            run = longer
            continue
        out += _clause(run)
        run = own or {""}
        if own is None:
            kind, arg = node
            if kind is op.SUBPATTERN:
                out += _clauses(arg[3])
            elif kind is op.BRANCH:
                branches = [_clauses(b) for b in arg[1]]
                if all(branches):
                    out.append(frozenset().union(*[b[0] for b in branches]))
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and arg[0] > 0:
                out += _clauses(arg[2])
    return out + _clause(run)


def trigram_query(regex: str) -> list[Clause]:
    """Clauses that all hold for the lower-cased trigrams of any text with a match; empty: nothing is mandatory."""
    return list(dict.fromkeys(_clauses(regex_parser.parse(regex))))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """``array<struct<start, kind, end, value>>`` of one rule's matches: offsets are sums of the lengths between and of the matches."""
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.regex, -1)
    steps = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part")), lambda x: F.struct(
        F.char_length(x["gap"]).alias("gap"), F.char_length(x["whole"]).alias("size"), x["whole"].alias("value"), (F.char_length(x["part"]) >= rule.at_least).alias("ok")))
    steps = F.filter(steps, lambda x: x["size"].isNotNull())  # the text behind the last match
    size = lambda part: F.aggregate(part, F.lit(0), lambda n, x: n + x["gap"] + x["size"])
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def grow(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + x["size"]).alias("end"), x["value"].alias("value"))
        return F.struct((start + x["size"]).alias("at"), F.concat(state["spans"], F.when(x["ok"], F.array(span)).otherwise(none)).alias("spans"))

    def located(s: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _BLOCK).cast("int")), lambda b: F.slice(s, b * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(blocks, lambda parts: _let(F.transform(parts, size), lambda sizes: F.flatten(F.transform(parts, lambda part, b: F.aggregate(
            part, F.struct(F.aggregate(F.slice(sizes, 1, b), F.lit(0), lambda n, x: n + x).alias("at"), none.alias("spans")), grow, lambda state: state["spans"])))))

    return F.when(F.rlike(text, F.lit(rule.regex)), _let(steps, located)).otherwise(none)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, text_column: str = "text", out: str = "secrets", rarest: int = 4) -> DataFrame:
    """All rows and columns of ``docs`` plus ``out``: ``array<struct<kind, start, end, value>>`` by start, then order of ``rules``.

    Every whole text is searched. Matches of one rule are leftmost and do not overlap each other; those whose group is too
    short are dropped without another try. Offsets are code points, end exclusive. Null and empty texts have no secrets;
    repeated rows are answered each for itself; a column named like ``out`` is replaced.

    An intersection reads the ``rarest`` trigrams of a set (by postings), which is enough because texts are verified. Texts
    are keyed by a 64-bit hash: two texts with one hash share candidates, never results.
    """
    columns = [c for c in docs.columns if c != out]
    text = F.coalesce(F.col("_text"), F.lit(""))
    work = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)], F.col(f"`{text_column}`").cast("string").alias("_text"))
    work = work.withColumn("_key", F.xxhash64(text))
    queries = [trigram_query(r.regex) for r in rules]
    vocabulary = sorted({t for q in queries for clause in q for grams in clause for t in grams})
    spark = docs.sparkSession
    clause_of, found = {}, None
    if vocabulary:
        held = F.transform(F.array(F.lower(text)), lambda low: F.filter(F.array(*map(F.lit, vocabulary)), lambda t: F.contains(low, t)))[0]
        index = stored(work.select("_key", F.explode(held).alias("gram")), "postings")
        postings = {r["gram"]: r["n"] for r in index.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per trigram of the rules
        rows = []
        for clause in dict.fromkeys(c for q in queries for c in q):
            clause_of[clause] = len(clause_of)
            for s, grams in enumerate(sorted(clause, key=sorted)):
                chosen = sorted(grams, key=lambda t: (postings.get(t, 0), t))[:rarest]
                rows += [(t, clause_of[clause], s, 1 << k, (1 << len(chosen)) - 1) for k, t in enumerate(chosen)]
        table = spark.createDataFrame(rows, "gram string, clause int, part int, bit long, need long")  # bounded by the rules
        sets = index.join(F.broadcast(table), "gram").groupBy("_key", "clause", "part", "need").agg(F.bit_or("bit").alias("mask")).where("mask = need")
        found = stored(sets.groupBy("_key").agg(F.collect_set("clause").alias("_clauses")), "candidates")
        work = work.join(found, "_key", "left")
    spans = []
    for number, (rule, query) in enumerate(zip(rules, queries)):
        own = _spans(text, rule, number)
        if query:
            able = F.lit(True)
            for clause in query:
                able = able & F.array_contains("_clauses", clause_of[clause])
            own = F.when(F.col("_clauses").isNotNull() & able, own)
        spans.append(F.coalesce(own, F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")))
    names = F.array(*[F.lit(r.kind) for r in rules])
    ordered = F.transform(F.array_sort(F.concat(*spans)), lambda x: F.struct(names[x["kind"]].alias("kind"), x["start"], x["end"], x["value"]))
    return work.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], ordered.alias(out))
