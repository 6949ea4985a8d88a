from collections import Counter

from pyspark.sql import functions as F

from cartwheel.llm import quality as Q


def counts(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {p + d for p, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for d in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_python(docs, odd_rows):
    rows = odd_rows + [(20, "a b c a b c x"), (21, "x x x x"), (22, "l1\nl1\n\nl1 \nl2"), (23, "## $$ a|b <c>"), (24, "ab c a bc")]
    got = Q.judge(docs(rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *counts(t))) for i, t in rows)


def test_verdict_and_table(docs):
    clean = " ".join(f"the river{k} runs to the sea{k}." for k in range(20))
    junk = " ".join(f"the###{k} $$$ of" for k in range(30))
    rows = [(1, clean), (2, junk), (3, "short"), (4, "the same words " * 40), (5, None)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in Q.judge(docs(rows)).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (True, False), 4: (True, False), 5: (True, False)}
    strict = (Q.Threshold("length", "word_chars", "n_words", high=1.0),)
    assert not any(r.kept for r in Q.judge(docs(rows), strict).collect())


def test_keep_returns_all_columns_and_agrees(docs, odd_rows):
    clean = " ".join(f"the river{k} runs to the sea{k}." for k in range(20))
    table = docs(odd_rows + [(30, clean), (30, clean)]).withColumns({"n_words": F.lit("mine"), "kept": F.lit(0)})
    got = Q.keep(table)
    assert got.columns == table.columns and [r.doc_id for r in got.collect()] == [30, 30]
    assert {r.doc_id for r in Q.judge(table).where("kept").collect()} == {30}


def test_empty(docs):
    assert Q.judge(docs([])).count() == 0 and Q.keep(docs([])).count() == 0


def test_no_python_in_the_plan(docs):
    plan = Q.judge(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
