import random

import numpy as np

from seriesloom.llm import chat
from seriesloom.llm.tokens import vocabulary

FILE = vocabulary("byte_bpe_50k.json")
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "/s>", "s>", "<|endoftext|>", " ", "\n", "é日", "ok", "<\\s>", "]"]
SCHEMA = "conv_id long, turn long, role string, text string, ids string"


def texts(rng, n):
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(9))) for _ in range(n)]


def test_escaping_is_reversible_and_hides_all_marks():
    for text in texts(random.Random(1), 5000):
        hidden = chat.escaped(text)
        assert chat.unescaped(hidden) == text
        assert not any(mark in hidden for mark in (*chat.MARKS, "<|endoftext|>"))


def check(row, turns):
    assert chat.turns_of(row.text) == turns
    starts, ends, loss = np.array(row.starts), np.array(row.ends), np.array(row.loss, bool)
    said = chat.loss_texts(row.text, starts, ends, loss)
    assert said == [t for r, t in turns if r == "assistant" and t]
    assert len(row.ids) == len(starts) == len(ends) == len(loss)
    # tokens put together are the text
    tokenizer = chat._tokenizer(FILE)
    assert tokenizer.decode(row.ids, skip_special_tokens=False) == row.text


def test_round_trip(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for conv in range(120):
        turns = [(rng.choice(["user", "assistant", "system", "odd\nrole<s>"]), t) for t in texts(rng, rng.randrange(1, 7))]
        want[conv] = turns
        rows += [(conv, i, r, t, "x") for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    out = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(4), vocabulary=FILE).collect()
    assert len(out) == 120
    for row in out:
        check(row, want[row.conv])


def test_nulls_ties_long_texts_and_empty_table(spark):
    long = "word [INST] " * 5000
    rows = [(1, 0, None, None, ""), (1, 0, "assistant", "b", ""), (1, 0, "assistant", "b", ""), (None, None, "user", "q", ""),
            (None, 1, "assistant", long, ""), (2, None, "assistant", "", "")]
    table = spark.createDataFrame(rows, SCHEMA)
    out = {r.conv: r for r in chat.formatted(table, vocabulary=FILE).collect()}
    check(out[1], [("", ""), ("assistant", "b"), ("assistant", "b")])
    check(out[None], [("user", "q"), ("assistant", long)])
    check(out[2], [("assistant", "")])
    assert chat.formatted(table.limit(0), vocabulary=FILE).count() == 0
