import brute
import corpus_pipeline
from ledgerlens.llm import queries
from ledgerlens.llm.common import table
from ledgerlens.llm.labelled import sigmoid
from ledgerlens.llm.toxicity import Scorer, learnt_from
from llm_cases import SMALL_SF, messy, nothing  # noqa: F401


def _plain(rows, model, items):
    """The stages over (doc_id, text, source) rows in plain Python."""
    stems, weights = model
    scorer = Scorer(stems)
    rows = [r for r in rows if sigmoid(weights[0] + weights[1:] @ scorer.features(r[1])) < 0.5]
    rows.sort(key=lambda r: r[0])
    roots = brute.components([brute.simhash(r[1]) for r in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    rows = [(i, kept.decode("utf-8", "ignore"), s)
            for (i, _, s), (_, _, kept) in zip(rows, brute.repeats([r[1] for r in rows]))]
    hits = brute.contamination([r[1] for r in rows], items)
    rows = [r for r, (n, hit, _) in zip(rows, hits) if not (hit and 20 * hit >= n)]
    return rows


def test_run_equals_plain_python(spark):
    docs = table(spark, SMALL_SF, "documents")
    model = learnt_from(docs, queries.learnable_labels(spark, SMALL_SF))
    items = [tuple(r) for r in table(spark, SMALL_SF, "benchmark").select("item_id", "text").collect()]
    rows = _plain([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], model, items)
    got = corpus_pipeline.run(spark, SMALL_SF).collect()
    assert sorted((r["doc_id"], r["source"], r["size"]) for r in got) == sorted((i, s, brute.size(t)) for i, t, s in rows)
    sources = sorted({r["source"] for r in got})
    sizes = [sum(r["size"] for r in got if r["source"] == s) for s in sources]
    for s, want in zip(sources, brute.water(sizes)):
        assert 0 <= want - sum(r["taken"] for r in got if r["source"] == s) < 1


def test_stages_on_odd_rows(spark, messy, nothing):
    for docs in (messy, nothing):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL_SF)
            if k < 4:
                assert out.columns == docs.columns, name
            out.collect()
