"""Secrets in texts, found through an inverted index of trigrams.

From each rule's regular expression a Boolean trigram query is derived: a set of clauses, each a set of lower-case
trigrams, one clause of which any matching text must hold in full. The index has a posting for every trigram that
some clause names and every text that holds it. Postings are intersected by clause, which leaves candidates, and
the expression itself verifies them. A rule without mandatory trigrams is run on every text.

Everything is DataFrame functions. Postings and candidates carry a 64-bit hash of a document, so a text is not
shuffled while candidates are few enough to broadcast, which is checked by counting them; equal hashes only make
more candidates. Grouping is by document, so neither a frequent trigram nor a hot source meets in one task.

Matches of a rule are the leftmost ones that do not overlap; those whose secret is shorter than the rule asks are
dropped afterwards. Starts and ends are code points, ends exclusive.

Defined results: a null or empty text has no spans; equal rows are separate rows; an empty table gives no rows;
other columns are not read by ``scan`` and kept by ``mask``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.common import own_names, plain_names, stage


@dataclass(frozen=True)
class Rule:
    """``group`` of ``pattern`` must have ``least`` characters; 0 is the whole match.

    ``in_sql`` spells the pattern for databases whose expressions cannot look ahead or hold on to what they took.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    in_sql: str | None = None


#: Fixed: the rules whose spans are always reported, in this order.
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
# A private key goes from BEGIN to END, with no other run of five dashes between. Without END it goes to the last line of
# base64, which starts with a run of 16 signs or more after the headers. Groups that repeat without bound hold on to what
# they took, as they would use up the stack otherwise.
_KEY_KIND = r"[A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
_KEY_LINES = (
    r"[A-Za-z0-9+/]{16,}={0,2}"
    r"(?:(?:\\[rn]|[\r\n])[A-Za-z0-9+/=\r\n\\]*(?:[A-Za-z0-9+/=](?:\r|(?m:$))|[A-Za-z0-9+/=]{16}))?"
)
_KEY_HEADERS, _KEY_SPACE = r"(?:\r?\n[A-Za-z][A-Za-z-]*:[^\n]*)*", r"(?:\\[rn]|[\x20\t\r\n])*"


def _private_key(body: str, hold: str) -> str:
    without_end = f"{_KEY_HEADERS}{hold}{_KEY_SPACE}{hold}{_KEY_LINES}"
    return f"-----BEGIN {_KEY_KIND}(?:{body}-----END {_KEY_KIND}|{without_end})?"


#: Fixed: further public token formats.
MORE = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule(
        "private_key",
        _private_key(r"(?:(?!-----)[\s\S])*+", "+"),
        in_sql=_private_key(r"[^-]*(?:-{1,4}[^-][^-]*)*", ""),
    ),
)

_MOST_STRINGS = 64
_ANYTHING = frozenset({frozenset()})


def trigram_clauses(pattern: str) -> frozenset[frozenset[str]]:
    """Clauses of lower-case trigrams; a text that matches holds all trigrams of one. An empty clause: no limit."""
    return _clauses(_parser.parse(pattern))


def _clauses(nodes) -> frozenset[frozenset[str]]:
    found = _ANYTHING
    run = {""}  # the strings that the nodes since the last gap can spell

    def close() -> None:
        nonlocal found, run
        found, run = _both(found, frozenset(frozenset(_trigrams(s)) for s in run)), {""}

    for node in nodes:
        spelled = _strings(node)
        if spelled is None:
            close()
            found = _both(found, _inside(node))
            continue
        longer = {a + b for a, b in itertools.product(run, spelled)}
        if len(longer) > _MOST_STRINGS:
            close()
            longer = spelled
        run = longer
    close()
    return found


def _both(a: frozenset, b: frozenset) -> frozenset[frozenset[str]]:
    joined = frozenset(x | y for x, y in itertools.product(a, b))
    if len(joined) > _MOST_STRINGS:
        joined = a if frozenset() not in a else b
    return frozenset(x for x in joined if not any(y < x for y in joined))


def _trigrams(text: str) -> set[str]:
    return {text[i : i + 3] for i in range(len(text) - 2)}


def _strings(node) -> set[str] | None:
    """All strings that the node can spell, in lower case, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        signs: set[str] = set()
        for part, inner in value:
            if part is op.LITERAL:
                signs.add(chr(inner).lower())
            elif part is op.RANGE and inner[1] - inner[0] < 8:
                signs |= {chr(c).lower() for c in range(inner[0], inner[1] + 1)}
            else:
                return None
        return signs if len(signs) <= 8 else None
    if kind is op.SUBPATTERN:
        return _spelled(value[3])
    if kind is op.BRANCH:
        options = [_spelled(option) for option in value[1]]
        return None if None in options else set().union(*options)
    if kind is op.MAX_REPEAT:
        least, most, inner = value
        spelled = _spelled(inner) if most <= 8 else None
        if spelled is None:
            return None
        found: set[str] = set()
        for times in range(least, most + 1):
            if len(spelled) ** times > _MOST_STRINGS:
                return None
            found |= {"".join(s) for s in itertools.product(spelled, repeat=times)}
        return found if len(found) <= _MOST_STRINGS else None
    if kind is op.AT:
        return {""}
    return None


def _spelled(nodes) -> set[str] | None:
    whole = {""}
    for node in nodes:
        spelled = _strings(node)
        if spelled is None or len(whole) * len(spelled) > _MOST_STRINGS:
            return None
        whole = {a + b for a, b in itertools.product(whole, spelled)}
    return whole


def _inside(node) -> frozenset[frozenset[str]]:
    """Clauses of a node that can spell too many strings."""
    kind, value = node
    if kind is op.SUBPATTERN:
        return _clauses(value[3])
    if kind is op.BRANCH:
        return frozenset().union(*(_clauses(option) for option in value[1]))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
        return _clauses(value[2])
    return _ANYTHING


def document_key(key: str = "doc_id") -> Column:
    return F.xxhash64(key, "text")


def postings(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``trigram, key``: the index, of the trigrams that the rules' clauses name."""
    wanted = sorted(set().union(*(clause for rule in rules for clause in trigram_clauses(rule.pattern))))

    def held(lowered: Column) -> Column:
        return F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(t)), F.lit(t)) for t in wanted]))

    # Bound as a variable, the text is put in lower case once and not once per trigram.
    found = F.element_at(F.transform(F.array(F.lower("text")), held), 1)
    return docs.where(F.col("text").isNotNull()).select(
        F.explode(found.cast("array<string>")).alias("trigram"), document_key().alias("key")
    )


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``key, rules``: a bit per rule one of whose clauses a text holds in full; not for rules that scan fully."""
    clauses = [(i, clause) for i, rule in enumerate(rules) for clause in sorted(map(sorted, trigram_clauses(rule.pattern)))]
    of_trigram = {t: [c for c, (_, clause) in enumerate(clauses) if t in clause] for _, own in clauses for t in own}
    if not of_trigram:
        return index.sparkSession.createDataFrame([], "key long, rules long")
    in_clauses = F.create_map(*[x for t, own in of_trigram.items() for x in (F.lit(t), F.array(*map(F.lit, own)))])
    sizes = F.array(*[F.lit(len(clause)) for _, clause in clauses])
    bits = F.array(*[F.lit(1 << rule).cast("long") for rule, _ in clauses])
    return (
        index.select("key", F.explode(in_clauses[F.col("trigram")]).alias("clause"), "trigram")
        .groupBy("key", "clause")
        .agg(F.count_distinct("trigram").alias("n"))
        .where(F.col("n") == sizes[F.col("clause")])
        .groupBy("key")
        .agg(F.bit_or(bits[F.col("clause")]).alias("rules"))
    )


def _spans(rule: Rule, place: int) -> Column:
    """Array of ``start, kind order, end, kind`` of one rule."""
    # Each match starts where the one before ended and takes in the text between, whose length gives positions.
    pattern = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    groups = [F.regexp_extract_all("text", pattern, F.lit(i)) for i in (1, 2, 2 + rule.group)]
    pieces = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("gap", "hit", "secret"))])
    lengths = F.transform(
        pieces,
        lambda p: F.struct(
            F.char_length(p["gap"]).alias("gap"),
            F.char_length(p["hit"]).alias("hit"),
            F.char_length(p["secret"]).alias("secret"),
        ),
    )
    kind = "array<struct<start:int,place:int,end:int,kind:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + piece["hit"]
        span = F.struct(
            begin.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        kept = F.when(piece["secret"] >= rule.least, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    found = F.aggregate(lengths, start, step, lambda state: state["out"])
    return F.when(F.regexp_like("text", F.lit(rule.pattern)), found).otherwise(F.array().cast(kind))


def find(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, broadcast_rows: int = 500_000) -> DataFrame:
    """All rows of ``docs`` and ``spans``, an array of ``start, place, end, kind`` in text order."""
    index = postings(docs, rules)
    chosen = stage(candidates(index, rules), "secret-candidates").select(
        F.col("key").alias("__key"), F.col("rules").alias("__rules")
    )
    if chosen.count() <= broadcast_rows:
        chosen = F.broadcast(chosen)
    joined = docs.withColumn("__at", document_key()).join(chosen, F.col("__at") == F.col("__key"), "left")
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    parts = []
    for i, rule in enumerate(rules):
        spans = _spans(rule, i)
        if frozenset() not in trigram_clauses(rule.pattern):
            spans = F.when(F.col("__rules").bitwiseAND(F.lit(1 << i)) != 0, spans).otherwise(none)
        parts.append(F.coalesce(spans, none))
    return joined.select(*docs.columns, F.array_sort(F.concat(*parts)).alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans, per document."""
    found = find(docs.select("doc_id", "text"), BASE + MORE, broadcast_rows)
    base = F.filter("spans", lambda s: s["place"] < len(BASE))

    def count(place: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")

    counts = [count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans")
    )


def mask(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, sign: str = "█") -> DataFrame:
    """``docs`` with every character of a span replaced by ``sign``; all columns are kept."""
    docs, names = plain_names(docs, ["doc_id", "text"])
    found = find(docs, rules)

    def step(state: Column, span: Column) -> Column:
        begin = F.greatest(span["start"], state["at"])
        gap = F.substr(F.col("text"), state["at"] + 1, begin - state["at"])
        hidden = F.repeat(F.lit(sign), F.greatest(span["end"] - begin, F.lit(0)))
        return F.struct(
            F.greatest(span["end"], state["at"]).alias("at"), F.concat(state["out"], gap, hidden).alias("out")
        )

    masked = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda state: F.concat(state["out"], F.substr(F.col("text"), state["at"] + 1, F.char_length("text"))),
    )
    text = F.when(F.size("spans") > 0, masked).otherwise(F.col("text"))
    return own_names(found.withColumn("text", text), names)


def oracle_sql() -> str:
    """The same result from expressions alone, for a database with RE2."""
    rules = BASE + MORE
    parts = []
    for place, rule in enumerate(rules):
        pattern = f"(?s)(.*?)({rule.in_sql or rule.pattern})".replace("'", "''")
        pieces = ", ".join(
            f"unnest(regexp_extract_all(text, '{pattern}', {group})) AS {name}"
            for group, name in ((1, "gap"), (2, "hit"), (2 + rule.group, "secret"))
        )
        parts.append(
            f"SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least, gap, hit, secret, i FROM ("
            f"SELECT doc_id, {pieces}, generate_subscripts(regexp_extract_all(text, '{pattern}', 2), 1) AS i "
            "FROM documents)"
        )
    written = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    base = f"place < {len(BASE)}"
    counts = ", ".join(
        f"count(*) FILTER (place = {i})::BIGINT AS n_{rule.kind}" for i, rule in enumerate(BASE)
    )
    return f"""
WITH pieces AS ({' UNION ALL '.join(parts)}),
placed AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, place ORDER BY i) AS e FROM pieces
),
spans AS (
  SELECT doc_id, place, kind, (e - length(hit))::BIGINT AS s, e::BIGINT AS e FROM placed WHERE length(secret) >= least
),
found AS (
  SELECT doc_id, {counts}, {written} FILTER ({base}) AS base, {written} AS spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id"""


def brute_spans(text: str | None, rules: Sequence[Rule] = BASE + MORE) -> list[tuple[int, int, int, str]]:
    """What ``find`` must give for one text, for tests."""
    return sorted(
        (m.start(), place, m.end(), rule.kind)
        for place, rule in enumerate(rules)
        for m in re.finditer(rule.pattern, text or "")
        if len(m.group(rule.group)) >= rule.least
    )
