"""The sample that the latent space is fitted on."""

from __future__ import annotations

from content_signals.llm import decontaminate


def test_copies_take_one_place_in_the_sample(spark, monkeypatch):
    taken = []

    def stage(df, name):
        taken.append([r.text for r in df.collect()])
        return df

    monkeypatch.setattr(decontaminate, "stage", stage)
    texts = [f"text number {i} of some words" for i in range(20)]
    docs = spark.createDataFrame([(t,) for t in texts for _ in range(50)] + [(None,)], "text string").repartition(4)
    decontaminate.fit(docs, max_documents=20)
    assert sorted(taken[0]) == sorted(texts)
    decontaminate.fit(docs, max_documents=8)
    assert len(taken[1]) == len(set(taken[1])) == 8
