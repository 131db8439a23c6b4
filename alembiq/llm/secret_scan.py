"""Secret scan through a trigram index, in DataFrame functions only.

Each rule is a regular expression. From its parse tree a Boolean query over
trigrams is derived: an OR of ANDs of trigrams (in lower case) that every match
must contain. The index holds the postings of the trigrams that queries ask for,
document by document: a bit for each trigram that the document contains. A
clause is met where the intersection with its own bits leaves them all, and only
the candidates of a rule are verified with its expression. A rule without
mandatory trigrams is verified on every text.

Postings are built and intersected beside the text they belong to. Listed by
trigram they would have to be shuffled, and the texts of all candidates, or all
texts, after them; here nothing moves.
"""

from __future__ import annotations

import re._parser as sre
from dataclasses import dataclass
from functools import reduce
from re import _constants as K

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # read alike by Java, RE2 and Python
    group: int = 0
    least: int = 1  # characters that ``group`` must have


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base rules, in the order in which ties are reported.
BASE = (
    Rule(
        "assign",
        "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
        + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Rules beyond the base.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
WIDE, MOST = 5, 256


def _join(a: frozenset, b: frozenset) -> frozenset:
    """AND of two queries (sets of clauses, clauses sets of trigrams); too many clauses keep the first query only."""
    if len(a) * len(b) > MOST:
        return a
    return _absorb(frozenset(x | y for x in a for y in b))


def _absorb(q: frozenset) -> frozenset:
    return frozenset(x for x in q if not any(y < x for y in q))


ANY = frozenset([frozenset()])


def _of(strings: set[str]) -> frozenset:
    return _absorb(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def trigram_query(pattern: str) -> frozenset:
    """Clauses of mandatory trigrams of a regular expression; ``ANY`` if there are none."""

    def chars(op, arg) -> set[str] | None:
        if op is K.LITERAL:
            return {chr(arg).lower()}
        if op is K.IN:
            out: set[str] = set()
            for kind, x in arg:
                if kind is K.LITERAL:
                    out.add(chr(x).lower())
                elif kind is K.RANGE and x[1] - x[0] < WIDE:
                    out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None
            return out if len(out) <= WIDE else None
        return None

    def walk(nodes) -> tuple[set[str] | None, frozenset]:
        """(all strings this can be, or None; query)."""
        strings: set[str] = {""}
        whole, query = True, ANY
        for op, arg in nodes:
            inner_query = ANY
            if op is K.SUBPATTERN:
                inner, inner_query = walk(arg[-1])
            elif op is K.BRANCH:
                each = [walk(x) for x in arg[1]]
                inner = None if any(s is None for s, _ in each) else set().union(*(s for s, _ in each))
                inner_query = _absorb(frozenset().union(*(q if s is None else _of(s) for s, q in each)))
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
                low, high, body = arg
                inner, inner_query = walk(body)
                if inner is not None and (low, high) == (0, 1):
                    inner = inner | {""}
                elif not (inner is not None and low == high and low <= 8 and len(inner) ** low <= MOST):
                    inner = None
                else:
                    step, inner = inner, {""}
                    for _ in range(low):
                        inner = {a + b for a in inner for b in step}
                if low == 0:
                    inner_query = ANY
            else:
                inner = chars(op, arg)
            if inner is not None and len(strings) * len(inner) <= MOST:
                strings = {a + b for a in strings for b in inner}
            else:
                query = _join(query, _of(strings))
                query = _join(query, inner_query if inner is None else _of(inner))
                strings, whole = {""}, False
        return (strings, _of(strings)) if whole else (None, _join(query, _of(strings)))

    strings, query = walk(sre.parse(pattern))
    return query


def postings(low: Column, trigrams: list[str]) -> list[Column]:
    """A text's postings: bit i % 63 of the (i // 63)th long says whether the lower-case text contains trigram i."""
    has = [F.when(F.contains(low, F.lit(t)), F.lit(1 << i % 63)).otherwise(F.lit(0)).cast("long") for i, t in enumerate(trigrams)]
    return [reduce(Column.bitwiseOR, has[i : i + 63]) for i in range(0, len(has), 63)]


def meets(held: list[Column], query: frozenset, trigrams: list[str]) -> Column:
    """Whether postings satisfy a query: all bits of some clause are set."""
    place = {t: i for i, t in enumerate(trigrams)}

    def clause(wanted: frozenset) -> Column:
        bits: dict[int, int] = {}
        for t in wanted:
            bits[place[t] // 63] = bits.get(place[t] // 63, 0) | 1 << place[t] % 63
        return reduce(Column.__and__, [held[k].bitwiseAND(F.lit(m).cast("long")) == F.lit(m) for k, m in sorted(bits.items())])

    return reduce(Column.__or__, [clause(c) for c in sorted(query, key=sorted)])


#: Matches of a block in the sum of offsets.
FOLD = 64


def spans(text: Column, rule: Rule, index: int) -> Column:
    """array<struct<s, r, e>>: leftmost non-overlapping matches in code points, failing ones left out.

    Offsets are sums over blocks of ``FOLD`` matches and within them, as a fold
    copies the list it makes at every step.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    # the text between matches and the matches, measured; a fold gives the offsets
    sizes = F.zip_with(
        F.slice(between, 1, F.size(found)),
        F.arrays_zip(found.alias("m"), value.alias("v")),
        lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m["m"]).alias("len"), F.length(m["v"]).alias("val")),
    )
    none = F.array().cast("array<struct<s:int,r:int,e:int>>")

    def cut_up(all_: Column) -> Column:
        last = F.greatest(F.ceil(F.size(all_) / FOLD).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_, k * FOLD + 1, FOLD))

    def starts(blocks: Column) -> Column:
        def add(acc, block):
            length = F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["len"])
            return F.struct((acc["at"] + length).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), add, lambda acc: acc["out"])

    def step(acc, x):
        s = acc["at"] + x["gap"]
        e = s + x["len"]
        one = F.struct(s.alias("s"), F.lit(index).alias("r"), e.alias("e"))
        kept = F.when(x["val"] >= rule.least, F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(e.alias("at"), kept.alias("out"))

    def places(blocks: Column) -> Column:
        fold = lambda block, at: F.aggregate(block, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, starts(blocks), fold))

    # arrays of one element name a value that is used several times, so that it is made once
    return F.transform(F.transform(F.array(sizes), cut_up), places)[0]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find secrets in whole texts.

    Returns one row per row of ``docs``: doc_id and spans, an array of (start,
    rule number, end) in code points, by start, then rule. A null text counts
    as empty and has none. Repeated rows get equal results; null doc_ids pass
    through; other columns are not read; an empty table gives no rows.
    """
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) and frozenset() not in q}
    trigrams = sorted({t for q in queries.values() for clause in q for t in clause})
    # Each step reads columns of the one before, so that no text is lower-cased or looked through twice.
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    lowered = texts.withColumn("low", F.lower("text"))
    longs = postings(F.col("low"), trigrams)
    held = [F.col(f"postings_{k}") for k in range(len(longs))]
    index = lowered.select("doc_id", "text", *[x.alias(f"postings_{k}") for k, x in enumerate(longs)])
    none = F.array().cast("array<struct<s:int,r:int,e:int>>")
    text, each = F.col("text"), []
    for i, rule in enumerate(rules):
        matches = F.regexp_like(text, F.lit(rule.pattern))
        wanted = meets(held, queries[i], trigrams) & matches if i in queries else matches
        each.append(F.when(wanted, spans(text, rule, i)).otherwise(none))
    return index.select("doc_id", F.array_sort(F.concat(*each)).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, base: int = len(BASE)) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans as text."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    write = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", F.get(names, x["r"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    count = lambda i: F.size(F.filter("spans", lambda x: x["r"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(rules[:base])],
        F.sha2(write(F.filter("spans", lambda x: x["r"] < base)), 256).alias("base_sha256"),
        write(F.col("spans")).alias("spans"),
    )


def oracle(rules: tuple[Rule, ...] = BASE + MORE, base: int = len(BASE)) -> str:
    """DuckDB SQL for ``digest(scan(documents))``."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(rules):
        p = quote(r.pattern)
        parts.append(
            f"SELECT rid, {i} AS r, '{r.kind}' AS kind, string_split_regex(t, {p}) AS b, regexp_extract_all(t, {p}, 0) AS m,"
            f" regexp_extract_all(t, {p}, {r.group}) AS v, {r.least} AS least FROM d WHERE regexp_matches(t, {p})"
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
x AS ({' UNION ALL '.join(parts)}),
y AS (SELECT rid, r, kind, least, unnest(m) AS m, unnest(v) AS v, unnest(b[1:len(m)]) AS b, unnest(range(len(m))) AS i FROM x),
z AS (SELECT rid, r, kind, least, length(v) AS lv, sum(length(b) + length(m)) OVER (PARTITION BY rid, r ORDER BY i) AS e, length(m) AS lm FROM y),
s AS (SELECT rid, r, kind, e - lm AS s, e FROM z WHERE lv >= least),
g AS (SELECT rid, {', '.join(f"count(*) FILTER (r = {i}) AS n_{r.kind}" for i, r in enumerate(rules[:base]))},
 coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, r) FILTER (r < {base}), '') AS base_spans,
 string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, r) AS spans FROM s GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules[:base])},
 sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (rid)"""
