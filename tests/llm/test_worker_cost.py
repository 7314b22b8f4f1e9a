"""What Python workers are sent, hold and encode."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from spark_revenue.llm import grammar_store, kernels, templates
from spark_revenue.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return grammar_store.WordEncoder(Path(tokenizer_path()).read_text(encoding="utf-8"))


def test_each_piece_is_encoded_once(encoder, monkeypatch):
    given, encoded = [], encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda tokenizer, texts: given.extend(texts) or encoded(tokenizer, texts))
    encoder.ids_of(pa.array(["qzab, qzab. Éqz### qzab$$ qzab"]))
    words = [w for text in given for w in text.split(" ") if w]
    assert sorted(words) == sorted(["qzab", ",", ".", "éqz", "###", "$$"])


def test_words_with_any_marks_have_the_ids_of_the_whole_text(encoder):
    marks = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    stems = ["ab", "Été", "straße", "ÿØ", "ªx", "µm", "don't", "K", "x9", "İs", "a×b"]
    texts = [" ".join(f"{s}{m}{end}" for s in stems for end in ("", "s", "!?")) for m in [*marks, "###", "<|", "'s,", ".<|endoftext|>"]]
    ids, counts = encoder.ids_of(pa.array(texts))
    want = [e.ids for e in encoder.whole.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_tables_of_powers_are_no_larger_than_a_stretch(monkeypatch):
    monkeypatch.setattr(kernels, "_POWERS", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    data, starts = kernels.column_bytes(pa.array(["some words and others " * 40] * 3000))
    for a, b in kernels.stretches(starts):
        kernels.word_hashes(data, starts[a : b + 1])
    assert len(kernels._POWERS["up"]) <= 1 << 19


def test_a_carried_text_goes_to_python_once(spark, monkeypatch):
    seen, emit = [], templates._emit

    def watched(passes, widths, *text):
        seen.extend(text)
        return emit(passes, widths, *text)

    monkeypatch.setattr(templates, "_emit", watched)
    item = "a farmer has 12 cows and sells 5 of them to a neighbour before winter comes to the valley"
    docs = spark.createDataFrame([(1, f"It is said that {item} again."), (2, None), (3, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    every = {r["doc_id"]: r for r in templates.decontaminate(docs, bench).collect()}
    few = {r["doc_id"]: r for r in templates.decontaminate(docs, bench, carry=["doc_id"]).collect()}
    assert seen == ["text", "__text"]
    assert {k: r["items"] for k, r in every.items()} == {k: r["items"] for k, r in few.items()} == {1: [7], 2: [], 3: []}
    assert every[1]["text"].startswith("It is said") and every[2]["text"] is None
