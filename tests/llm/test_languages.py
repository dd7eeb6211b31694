"""More languages than the stored tables hold."""

import random

from selvatrace.llm import language


def test_every_language_is_learned(spark, monkeypatch):
    rng = random.Random(5)
    words = {f"l{i:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for i in range(90)}
    make = lambda name: " ".join(rng.choice(words[name]) for _ in range(40))
    rows = [(i, make(name), name) for i, name in enumerate([*sorted(words) * 4, *["l000"] * 2000])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    monkeypatch.setattr(language, "FIT_ROWS", 300)
    for log2 in (23, 20):
        monkeypatch.setattr(language, "TABLE_LOG2", log2)
        model = language.fit(docs)
        assert model.languages == sorted(words) and model.table.size <= 1 << log2
        got = language.identify(docs.limit(360), model).join(docs, "doc_id").collect()
        assert sum(r.lang_pred == r.lang for r in got) > 0.97 * len(got)
