import numpy as np
import pytest
from ledgerlens.llm import queries
from ledgerlens.llm import toxicity as X
from llm_cases import messy, nothing  # noqa: F401


def _found(text, stems=(("fool$", 2.0), ("scu", 3.0))):
    scorer = X.Scorer(dict(stems))
    return {m: round(float(np.expm1(v)), 6) for m, v in zip(X.MATCHES, scorer.features(text)) if v}


def test_grammar():
    assert _found("What a fool. Fools here") == {"insult": 2}
    assert _found("You are scum, you fool!") == {"aimed insult": 5}
    assert _found("He is not a fool") == {"denied insult": 2}
    assert _found("not one of those many old fools is a fool") == {"aimed insult": 2}
    assert _found('The report said: a fool') == {"insult": 2}  # the clause ends at the colon
    assert _found('She wrote "scum" there') == {"quoted insult": 3}
    assert _found("I will kill you") == {"threat": 1}
    assert _found("you I will kill") == {"aimed threat": 1}
    assert _found("never kill") == {"denied threat": 1}
    assert _found("all is well") == {}


def test_composition_equals_running_in_turn():
    import itertools
    parts = [X.negation(), X.reported_speech(), X.target(), X.matched()]
    machine = X.grammar()
    alphabet = [X.OTHER, X.INSULT, X.THREAT, X.TARGET, X.NEGATION, X.REPORT, X.QUOTE]
    for symbols in itertools.product(alphabet, repeat=5):
        states, state = [p.start for p in parts], machine.start
        for s in symbols:
            state, out, factor = machine.step(state, s)
            want, product = s, 1.0
            for k, p in enumerate(parts):
                states[k], want, f = p.step(states[k], want)
                product *= f
            assert (out, factor) == (want, product)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_held_out(spark, sf):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op7_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    right = [(r["predicted"], labels[r["doc_id"]]) for r in rows]
    assert sum(p == y for p, y in right) > 0.97 * len(right)
    assert sum(p for p, y in right if y) > 0.85 * sum(y for _, y in right)


def test_odd_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    model = X.learnt_from(messy, labels)
    rows = X.toxicity(messy, *model).collect()
    assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert X.toxicity(messy, *model, extra=True).columns == [*messy.columns, "__score"]
    assert X.toxicity(nothing, *model).collect() == []
    none = X.learnt_from(messy, labels.where("false"))
    assert {round(r["score"], 6) for r in X.toxicity(messy, *none).collect()} == {0.5}
