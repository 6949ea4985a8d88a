"""Secret scans through a trigram inverted index, in DataFrame functions only.

1. Each rule's regular expression is turned into a Boolean query over trigrams
   that every match must contain (``trigram_query``).  A rule without such
   trigrams (hex runs) scans every text.
2. ``postings`` lists (trigram, doc_id) for the trigrams that the queries name.
3. ``candidates`` intersects the postings: per document the trigrams found, then
   the Boolean queries over them, which gives the rules worth running.
4. ``find`` and ``annotate`` verify: candidate rules run on candidate texts only.

The index folds case, so it finds a superset for rules of either kind; the exact
expression decides.

Defined cases: a null text is empty and has no spans; a null ``doc_id`` is a
document like any other (null-safe joins); rows that repeat a ``doc_id`` are
scanned one by one and share their candidate rules; an empty table gives an
empty table.  Spans count code points, end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _parser as regex_tree

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut, let, unused

TRIGRAM = 3
#: Alternatives of literal text that are followed one by one before the query gives up precision.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A secret: its pattern, and a least length of the whole match or of a group."""

    name: str
    pattern: str
    least: int = 0
    group: int = 0


# The three base rules.  Runs of one class are matched at their full
# length, so the least lengths of access and hex are part of the pattern.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further kinds of secrets.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}"),
    Rule("url_login", r"://[^/\x20:@\n]+:[^/\x20:@\n]+@"),
)
RULES = BASE_RULES + MORE_RULES


# --- regular expression -> Boolean trigram query ----------------------------
# A query is None (nothing is mandatory), a trigram, ("and", ...) or ("or", ...).

def _both(*queries):
    kept = sorted({q for q in queries if q is not None}, key=str)
    return None if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _any(*queries):
    if None in queries:
        return None
    kept = sorted(set(queries), key=str)
    return kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]):
    """What a text holds that contains one of the strings."""
    return _any(*(_both(*(s[i:i + TRIGRAM] for i in range(len(s) - TRIGRAM + 1))) for s in strings))


def _strings_of(node) -> set[str] | None:
    """The strings a node of the parsed expression can match, if few."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        chars: set[str] = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op == "SUBPATTERN":
        return _strings_of_sequence(arg[-1])
    if op == "BRANCH":
        parts = [_strings_of_sequence(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] in (0, 1):
        inner = _strings_of_sequence(arg[2])
        return None if inner is None else inner if arg[0] else inner | {""}
    return None


def _strings_of_sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings_of(node)
        if more is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query_of(nodes):
    """Runs of nodes with few strings give trigrams; other nodes end a run."""
    found, run = [], {""}
    for node in nodes:
        strings = _strings_of(node)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        found.append(_of_strings(run))
        run = strings or {""}
        op, arg = str(node[0]), node[1]
        if strings is None and op == "SUBPATTERN":
            found.append(_query_of(arg[-1]))
        elif strings is None and op == "BRANCH":
            found.append(_any(*(_query_of(p) for p in arg[1])))
        elif strings is None and op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0]:
            found.append(_query_of(arg[2]))
    return _both(*found, _of_strings(run))


def trigram_query(pattern: str):
    """The Boolean query over lower-case trigrams that every match satisfies."""
    return _query_of(regex_tree.parse(pattern))


def trigrams_in(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_in, query[1:]))


def satisfied(query, trigrams: Column) -> Column:
    """The query as a Column over an array of the trigrams found."""
    if isinstance(query, str):
        return F.array_contains(trigrams, query)
    out = satisfied(query[1], trigrams)
    for q in query[2:]:
        out = out & satisfied(q, trigrams) if query[0] == "and" else out | satisfied(q, trigrams)
    return out


# --- index, intersection, verification ---------------------------------------

def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of the named trigrams: (trigram, doc_id)."""
    folded = docs.select("doc_id", F.lower("text").alias("folded")).where(F.col("folded").isNotNull())
    found = F.array_compact(F.array(*[F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return folded.select("doc_id", F.explode(found).alias("trigram")).select("trigram", "doc_id")


def candidates(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """Documents whose postings satisfy a rule's query: (doc_id, rules)."""
    met = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("trigrams"))
    rules = F.array_compact(F.array(*[F.when(satisfied(q, F.col("trigrams")), F.lit(n)) for n, q in queries.items()]))
    return met.select("doc_id", rules.alias("rules")).where(F.size("rules") > 0)


SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost non-overlapping matches; those under the least length are dropped afterwards."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    empty = F.array().cast(SPAN)

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        stop = start + F.length(x["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(rule.name).alias("kind"))
        kept = F.when(F.length(x["value"]) >= rule.least, F.array(span)).otherwise(empty)
        return F.struct(stop.alias("at"), F.concat(acc["out"], kept).alias("out"))

    def placed(m: Column) -> Column:
        before = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(m))
        parts = F.arrays_zip(before.alias("before"), m.alias("match"), values.alias("value"))
        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), one, lambda a: a["out"])

    return let(matches, lambda m: F.when(F.size(m) == 0, empty).otherwise(placed(m)))


def _all_spans(table: tuple[Rule, ...], indexed: set[str], rules: Column | None) -> Column:
    """Spans of the rules that scan every text and, where ``rules`` is given, of the candidate rules in it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = []
    for rank, rule in enumerate(table):
        if rule.name not in indexed:
            found.append(F.when(text.rlike(rule.pattern), _spans(text, rule, rank)))
        elif rules is not None:
            found.append(F.when(F.array_contains(rules, rule.name), _spans(text, rule, rank)))
    empty = F.array().cast(SPAN)
    return F.array_sort(F.concat(empty, *[F.coalesce(x, empty) for x in found]))


def _candidates_of(docs: DataFrame, table: tuple[Rule, ...]) -> tuple[DataFrame, set[str]]:
    """(_candidate, _rules) through the index, written once, and the names of the indexed rules."""
    queries = {r.name: q for r in table if (q := trigram_query(r.pattern)) is not None}
    named = sorted(set().union(*map(trigrams_in, queries.values()))) if queries else []
    if not named:
        return docs.sparkSession.createDataFrame([], docs.select(
            F.col("doc_id").alias("_candidate"), F.array().cast("array<string>").alias("_rules")).schema), set()
    met = cut(candidates(postings(docs.select("doc_id", "text"), named), queries), "candidates")
    return met.select(F.col("doc_id").alias("_candidate"), F.col("rules").alias("_rules")), set(queries)


def find(docs: DataFrame, table: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and _spans: array of (start, rank, stop, kind), by start then rule.

    Documents without a candidate leave the join as (doc_id, spans); only candidates
    bring their text to it, and Spark's runtime filters can drop the other texts before
    the exchange.  ``docs`` is read three times, so it should be a stored table.
    """
    docs = docs.select("doc_id", "text")
    met, indexed = _candidates_of(docs, table)
    rest = docs.select("doc_id", _all_spans(table, indexed, None).alias("_spans"))
    without = rest.join(met, rest["doc_id"].eqNullSafe(met["_candidate"]), "left_anti")
    hit = docs.join(met, docs["doc_id"].eqNullSafe(met["_candidate"]), "inner")
    return without.union(hit.select("doc_id", _all_spans(table, indexed, F.col("_rules")).alias("_spans")))


def annotate(docs: DataFrame, table: tuple[Rule, ...] = RULES, into: str = "_spans") -> DataFrame:
    """All columns of ``docs`` with the column ``into`` (a name that ``docs`` does not have) of spans, in one join."""
    met, indexed = _candidates_of(docs, table)
    candidate, rules = unused(docs, "_candidate"), unused(docs, "_rules")
    met = met.select(F.col("_candidate").alias(candidate), F.col("_rules").alias(rules))
    both = docs.join(met, docs["doc_id"].eqNullSafe(met[candidate]), "left")
    return both.select(*docs.columns, _all_spans(table, indexed, F.col(rules)).alias(into))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans give one mark each."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def one(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"),
                        F.concat(a["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, one, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))
