"""The counterfactual penalty on planted sentences: it must act, and free a neutral mention of a named group."""

from __future__ import annotations

from riskflow.llm import toxicity


def planted() -> list[tuple[int, str, int]]:
    """One group stands mostly in toxic sentences, another only in kind ones; some toxic ones name no group."""
    rows = [(i, f"muslims {'you scum' if i % 4 else 'at home'} day {i}", int(i % 4 > 0)) for i in range(80)]
    rows += [(100 + i, f"christians at home day {i}", 0) for i in range(80)]
    return rows + [(200 + i, f"{'you scum' if i % 2 else 'good soup'} hour {i}", i % 2) for i in range(40)]


def test_the_penalty_takes_the_weight_off_identity_terms(spark):
    rows = planted()
    fresh = [(900, "christians read"), (901, "muslims read"), (902, "you scum"), (903, "good soup")]
    docs = spark.createDataFrame([r[:2] for r in rows] + fresh, "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    plain, fair = ({r.doc_id: r.score for r in toxicity.score(docs, labels, fair=f).collect()} for f in (0.0, 10.0))
    print({i: (round(plain[i], 3), round(fair[i], 3)) for i, _ in fresh})
    assert plain[901] - plain[900] > 0.1
    assert 0 <= abs(fair[901] - fair[900]) < 0.5 * (plain[901] - plain[900])
    assert fair[901] < plain[901]
    assert fair[902] >= 0.5 > fair[903]
