"""The queries of the training-data operators and their DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import align, bpe, chat, crf, decontaminate, hmm, merkle, packed, quality, secrets, shards, simhash, substrings
from cartwheel.llm.common import benchmark, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(documents(spark, sf_dir))
    base = F.filter("_spans", lambda s: s["rank"] < len(secrets.BASE_RULES))
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("_spans")).alias("spans"))


@query
def op2_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(documents(spark, sf_dir))


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op7_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(documents(spark, sf_dir))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed.checksums(packed.write(documents(spark, sf_dir), path, end=2))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as transcripts and parsed again.

    A transcript row is a page of at most 64 turns of a conversation.  A turn's first line carries a speaker marker in
    the style of its conversation, except for every fourth turn (by a hash), whose border and speaker only the model can
    tell; one style of three sets a blank line between turns.  The model learns from the roles of the conversations that are not held out
    (crc32(conv_id as text) mod 4 is not 2); all are parsed.
    """
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    shown = chat.written(rows)
    held_out = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    turns = chat.format_chats(chat.pages(shown), shown.where(~held_out))
    return turns.select("conv_id", "turn", "part", held_out.alias("held_out"), "role", "n_lines", F.sha2("rendered", 256).alias("rendered_sha256"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.when(merkle.in_tampered_sample(F.col("doc_id")), merkle.lowered(F.col("text"))).otherwise(F.col("text"))
    return merkle.verify(documents(spark, sf_dir), seen).select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(documents(spark, sf_dir), path_a, path_b)


@query
def op13_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.identify(documents(spark, sf_dir))


# --- SQL --------------------------------------------------------------------

def _either_case(pattern: str) -> str:
    """The pattern with every ASCII letter outside brackets matching both cases."""
    out, inside = [], False
    for k, c in enumerate(pattern):
        inside = c == "[" or (inside and c != "]")
        plain = c.isalpha() and not inside and pattern[k - 1] != "\\" and pattern[k - 3:k - 1] != "\\x"
        out.append(f"[{c.upper()}{c.lower()}]" if plain else c)
    return "".join(out)


def _secrets_sql() -> str:
    """Every match is wrapped in two marks; lengths between the marks give the positions."""
    parts = []
    for rank, r in enumerate(secrets.RULES):
        pattern = r.pattern.removeprefix("(?i)")
        pattern = (_either_case(pattern) if pattern != r.pattern else pattern).replace("'", "''")
        value = f"regexp_extract(m, '{pattern}', {r.group})" if r.group else "m"
        parts.append(f"""
    SELECT rid, {rank} AS rank, '{r.name}' AS kind, sum(length(before) + length(m)) OVER w - length(m) AS a,
           sum(length(before) + length(m)) OVER w AS b, length({value}) >= {r.least} AS long_enough
    FROM (SELECT rid, k, CASE WHEN k = 1 THEN p[1] ELSE split_part(p[k], chr(2), 2) END AS before,
                 split_part(p[k + 1], chr(2), 1) AS m
          FROM (SELECT rid, p, unnest(range(1, len(p))) AS k
                FROM (SELECT rid, string_split(regexp_replace(x, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS p FROM d)))
    WINDOW w AS (PARTITION BY rid ORDER BY k)""")
    spans = " UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x FROM documents),
s AS (SELECT rid, rank, kind, kind || ':' || a::BIGINT || ':' || b::BIGINT AS span, a FROM ({spans}) WHERE long_enough),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(span, ',' ORDER BY a, rank) FILTER (rank < {len(secrets.BASE_RULES)}) AS base,
             string_agg(span, ',' ORDER BY a, rank) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""


def _quality_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
    limits = []
    for t in quality.THRESHOLDS:
        ratio = f"CASE WHEN {t.denominator} = 0 THEN 0.0::DOUBLE ELSE {t.numerator}::DOUBLE / {t.denominator} END"
        limits += [f"{ratio} >= {t.low}::DOUBLE"] * (t.low is not None) + [f"{ratio} <= {t.high}::DOUBLE"] * (t.high is not None)
    space = r"[\x20\x09-\x0D]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x FROM documents),
t AS (SELECT *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT rid, k, count(*) OVER (PARTITION BY rid, a) AS n
      FROM (SELECT rid, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS a
            FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS k FROM t))),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest([k, k + 1, k + 2]) AS p FROM g WHERE n > 1) GROUP BY rid),
c AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(x, '{space}', '', 'g')) AS word_chars,
             length(x) - length(regexp_replace(x, '{quality.SYMBOLS}', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(lines) AS n_lines, length(x) - length(replace(x, '!', '')) AS n_exclamations,
             len(list_filter(w, lambda y: regexp_matches(y, '\\p{{L}}'))) AS n_letter_words,
             len(list_filter(w, lambda y: lower(y) IN ({stops}))) AS n_stop_words
      FROM t LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(limits)} AS kept FROM b"""


ORACLES["op1_secret_scans"] = _secrets_sql()
ORACLES["op6_quality_rules"] = _quality_sql()

#: A window is compared as the list of its words.
ORACLES["op8_substring_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, k, sha256(array_to_string(w[k:k + {substrings.WINDOW} - 1], ' ')) AS a
      FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {substrings.WINDOW} + 2)) AS k FROM d)),
g AS (SELECT DISTINCT rid, k + i AS p FROM (SELECT rid, k, doc_id, min(doc_id) OVER (PARTITION BY a) AS first FROM s),
             range({substrings.WINDOW}) t(i) WHERE doc_id > first),
k AS (SELECT rid, string_agg(w[p], ' ' ORDER BY p) AS kept, count(*) AS n
      FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN g USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)"""


def _merkle_sql(levels: int = 14, last: int = 6) -> str:
    """Levels of 8 written out: 8 ** 14 leaves a tree, 8 ** 6 trees."""
    def tree(name: str, leaves: str, depth: int) -> str:
        out = [f"{name}0 AS ({leaves})"]
        for k in range(depth):
            out += [f"""{name}p{k} AS (SELECT tree, i, n, CASE WHEN n > 1 THEN coalesce(string_agg(d, '') OVER (
        PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l, CASE WHEN n > 1 THEN coalesce(
        string_agg(d, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r FROM {name}{k})""",
                    f"""{name}{k + 1} AS (SELECT tree, i // 8 AS i, (any_value(n) + 7) // 8 AS n, CASE WHEN any_value(n) = 1 THEN any_value(d)
        ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY tree, i // 8)"""]
        return ",\n".join(out)

    def climb(name: str, depth: int, rank: str, key: str) -> tuple[str, str]:
        joins = " ".join(f"JOIN {name}p{k} x{name}{k} ON x{name}{k}.tree = {key} AND x{name}{k}.i = {rank} // {8 ** k}" for k in range(depth))
        return joins, ", ".join(f"{{{{'l': x{name}{k}.l, 'r': x{name}{k}.r}}}}" for k in range(depth)).replace("{{", "{").replace("}}", "}")

    part = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    fields = [part(c) for c in merkle.FIELDS]
    low = f"translate(text, '{merkle.CAPITALS}', '{merkle.SMALL}')"
    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
    joins_t, steps_t = climb("t", levels, "s.i", "s.tree")
    joins_u, steps_u = climb("u", last, "s.tree", "0")
    return f"""
WITH d AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, sha256({' || '.join(fields)}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN sha256({' || '.join(fields[:-1])} || {part(low)}) ELSE sha256({' || '.join(fields)}) END AS seen
    FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d),
{tree('t', 'SELECT tree, i, n, leaf AS d FROM s', levels)},
{tree('u', f'SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, d FROM t{levels}', last)},
p AS (SELECT s.doc_id, s.leaf, s.seen, top.d AS subroot, (SELECT d FROM u{last}) AS root,
        list_filter([{steps_t}, {steps_u}], lambda y: y.l IS NOT NULL) AS path
    FROM s JOIN t{levels} top ON top.tree = s.tree {joins_t} {joins_u}),
f AS (SELECT *, list_reduce(list_concat([{{'l': seen, 'r': ''}}], path), lambda a, b: {{'l': sha256(b.l || a.l || b.r), 'r': ''}}).l AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda y: y.l || y.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM f"""


ORACLES["op11_merkle_manifest"] = _merkle_sql()
