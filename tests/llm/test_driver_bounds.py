"""What an operator sends to the driver does not grow with the corpus."""

import random

from eventide.llm import ctw


def test_held_out_strings_stay_off_the_driver(spark, monkeypatch):
    rng = random.Random(31)
    rows = [(i, "".join(rng.choices("abcdefghijklmnop ", k=300))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = ctw.count_training(ctw._docs(docs), spark.sparkContext.broadcast(
        ctw.frequent_words(ctw._docs(docs)))).where("kind = 3").count()
    assert held > 2 * ctw.FREQUENT
    kind, sent = type(docs), []
    collect = kind.collect

    def counted(self):
        out = collect(self)
        sent.append(len(out))
        return out

    monkeypatch.setattr(kind, "collect", counted)
    scores = ctw.lm_scores(docs)
    assert sent and max(sent) <= ctw.FREQUENT + 2
    monkeypatch.undo()
    assert scores.count() == len(rows)
