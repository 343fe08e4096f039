import corpus_pipeline as cp
from tests.conftest import SF_SMALL
from tests.llm.fixtures import odd_documents
from tests.llm.test_multimatch import brute as components
from tests.llm.test_packing import check as check_packing
from tidemark.llm import importance
from tidemark.llm.common import staged


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good = staged(cp.quality(spark, docs, SF_SMALL), "t-quality")
    assert good.columns == docs.columns
    chosen = {r["doc_id"] for r in importance.resample(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect() if r["selected"]}
    assert {r["doc_id"] for r in good.collect()} == chosen and 100 < len(chosen) < 200

    one = staged(cp.exact_dedup(spark, good, SF_SMALL), "t-exact")
    last = {}
    for r in good.collect():
        k = (r["text"] or "").encode().lower()
        last[k] = max(last.get(k, r["doc_id"]), r["doc_id"])
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == sorted(last.values())

    near = staged(cp.near_dedup(spark, one, SF_SMALL), "t-near")
    want = {i for i, _, c in components([(r["doc_id"], r["text"]) for r in one.collect()]) if i == c}
    assert near.columns == docs.columns and {r["doc_id"] for r in near.collect()} == want

    check_packing(cp.packing(spark, near, SF_SMALL).collect(), [(r["doc_id"], r["text"]) for r in near.collect()])


def test_odd_rows_pass_every_stage(spark):
    docs = odd_documents(spark)
    for name, stage in cp.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF_SMALL), f"odd-{name}")
        assert docs.columns == odd_documents(spark).columns
    ids = [r["doc_id"] for r in docs.collect()]
    assert 12 not in ids or 11 not in ids
    assert cp.packing(spark, docs, SF_SMALL).count() > 0


def test_run_has_the_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "packing"]


def test_a_worker_holds_one_operators_caches():
    """Spark gives a Python worker to one stage after another: what an earlier stage kept there goes."""
    from tidemark.llm import common, harmonic, spm_backtrack
    from tidemark.llm.queries import tokenizer_path

    words = harmonic.encoder(tokenizer_path("byte_bpe_50k.json"))
    assert harmonic.encoder(tokenizer_path("byte_bpe_50k.json")) is words  # kept from task to task
    spm_backtrack.encoder(tokenizer_path("piece_bpe_32k.model"))
    assert list(common._CACHES) == ["pieces"]
    common.worker_caches("links")
    assert common._CACHES == {"links": {}}


def test_scoring_takes_one_python_worker_per_task(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = cp.quality(spark, docs, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
