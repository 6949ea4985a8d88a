import hashlib

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline

from cartwheel.llm import bpe, decontaminate, quality, secrets
from cartwheel.llm.common import benchmark, documents
from .test_quality import counts
from .test_secrets import expected as spans_of
from .test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    """Each stage's result against a plain Python version on its own input."""
    docs = documents(spark, SF)
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}

    docs = corpus_pipeline.cut(corpus_pipeline.quality_rules(spark, docs, SF), "t")
    judged = {r.doc_id: r for r in quality.judge(documents(spark, SF)).collect()}
    for i, t in rows.items():
        n, _, _, _, repeats = counts(t)
        assert judged[i].base_failed == (n < 50 or 100 * repeats > 50 * n)
    rows = {i: t for i, t in rows.items() if judged[i].kept}
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == set(rows)

    docs = corpus_pipeline.cut(corpus_pipeline.simhash_near_dedup(spark, docs, SF), "t")
    ids = sorted(rows)
    roots = slow_components([slow_fingerprint(rows[i]) for i in ids], 4)
    first = {}
    for i, r in zip(ids, roots):
        first.setdefault(r, i)
    rows = {i: rows[i] for i in first.values()}
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == set(rows)

    docs = corpus_pipeline.cut(corpus_pipeline.benchmark_decontamination(spark, docs, SF), "t")
    items = [r.text for r in benchmark(spark, SF).collect()]
    held = {i for i, t in rows.items() if any(x in t for x in items)}
    left = {r.doc_id for r in docs.collect()}
    assert docs.columns == columns and not left & held and left <= set(rows)
    block = decontaminate.Block(list(enumerate(items)))
    assert {i for i in rows if block.matches([rows[i]])} == set(rows) - left
    rows = {i: rows[i] for i in left}

    docs = corpus_pipeline.cut(corpus_pipeline.secret_scans(spark, docs, SF), "t")
    for r in docs.collect():
        assert spans_of(r.text, secrets.BASE_RULES) == "" and r.n_chars == len(r.text)
        assert (r.text == rows[r.doc_id]) == (spans_of(rows[r.doc_id]) == "")
        rows[r.doc_id] = r.text
    assert docs.columns == columns and docs.count() == len(rows)

    last = corpus_pipeline.byte_bpe(spark, docs, SF).collect()
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert {r.doc_id: (r.n_tokens, list(r.ids)) for r in last} == {i: (len(x), x) for i, t in rows.items() for x in [library.encode_ordinary(t)]}


def test_last_stage_decodes(spark, docs, odd_rows):
    """The ids of every row give its text back."""
    out = corpus_pipeline.byte_bpe(spark, docs(odd_rows), SF).collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(r.decoded_sha256 for r in out) == sorted(digest(t) for _, t in odd_rows)


def test_clean_rows_stay_whatever_their_ids(spark, docs):
    """Rows that share a doc_id with a contaminated row, or lack one, are judged by their own texts."""
    item = max((r.text for r in benchmark(spark, SF).collect()), key=len)
    clean = "plain words about gardens and rivers that no benchmark holds"
    table = docs([(None, item), (None, clean), (None, clean), (7, f"before {item} after"), (7, clean), (8, None), (8, "")])
    left = corpus_pipeline.benchmark_decontamination(spark, table, SF).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted([(r.doc_id, r.text) for r in left], key=key) == sorted(
        [(None, clean), (None, clean), (7, clean), (8, None), (8, "")], key=key)


def test_names_of_input_columns_never_clash(spark, docs, odd_rows):
    names = ["_spans", "_rules", "_candidate", "_row", "_hit", "_fp", "fp", "root", "ids"]
    table = docs(odd_rows).withColumns({n: F.lit(n) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns
        for r in out.select(*names).distinct().collect():
            assert list(r) == names
    assert corpus_pipeline.byte_bpe(spark, table, SF).count() == len(odd_rows)


def test_run_equals_the_stages(spark):
    run = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    docs = documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF), "t")
    assert run == {r.doc_id: list(r.ids) for r in docs.collect()}


def test_odd_rows_and_empty(spark, docs, odd_rows):
    for rows in (odd_rows, []):
        table = docs(rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == table.columns
