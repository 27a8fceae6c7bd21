import numpy as np

from leadwright.llm import tools, toxicity


def test_edge_does_not_move_with_the_drawing_rates():
    rng = np.random.default_rng(5)
    toxic = rng.random(400_000) < 0.113
    z = rng.normal(2.0 * toxic)
    rate = np.where(toxic, 0.44, 0.1)
    drawn = rng.random(len(z)) < rate
    edges = [(np.log(0.7 / 0.3) - shift) / scale for scale, shift in (
        toxicity.calibrate(z, toxic), toxicity.calibrate(z[drawn], toxic[drawn], weight=1 / rate[drawn]))]
    false = [np.mean(z[~toxic] >= e) for e in edges]
    print("clean called toxic: all rows, weighted sample", false)
    assert abs(false[0] - false[1]) < 0.01


def test_fit_weights_rows_to_the_share_of_all_labels(spark, monkeypatch):
    folder, seen = "/root/testdata/sf0.01", {}
    docs, labels = tools.documents(spark, folder), tools.documents(spark, folder, "labels")
    plain = toxicity.calibrate

    def watched(z, toxic, *rest, weight=None):
        weight = np.ones(len(z)) if weight is None else weight
        seen.update(share=np.average(toxic, weights=weight), total=weight.sum())
        return plain(z, toxic, *rest, weight=weight)

    monkeypatch.setattr(toxicity, "calibrate", watched)
    known = labels.filter(~toxicity.held_out(labels.doc_id)).dropna().join(docs.select("doc_id").distinct(), "doc_id").toPandas()
    toxicity.fit(docs, labels, max_unlabelled=len(known) // 4)
    # About 60 of 250 clean rows are drawn, so the count carries chance; unweighted, the toxic share is near 0.3.
    assert abs(seen["share"] - known["toxic"].mean()) < 0.05
    assert 0.7 < seen["total"] / len(known) < 1.3
