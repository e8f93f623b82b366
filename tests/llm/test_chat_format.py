"""Chat windows against the turns they were made of, and a plain count of their tokens."""

from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cellscope.llm import chat_format as cf
from cellscope.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["</s>", "<s>", "[INST] ", " [/INST]", "<<SYS>>\n", "\n<</SYS>>\n\n", "[ROLE]", "[/ROLE] ", "<", "[", "\\", "/", "s>", "INST]", "SYS>>", "é", "ok", " ", "\n", "東"]


def words(texts):
    return [len(t.split()) + 1 for t in texts]


def rows_of(rng: random.Random) -> list[tuple]:
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.choice([1, 2, 5, 30, 200])):
            role = rng.choice(["user", "assistant", "assistant", "tool", None, "[ROLE]x</s>"]) if turn or rng.random() < .4 else "system"
            text = None if rng.random() < .05 else "".join(rng.choices(PIECES, k=rng.choice([0, 3, 10, 40, 200 if rng.random() < .1 else 5])))
            rows.append((conv, turn, role, text))
    return rows


def test_escaping_is_reversible(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", cf.escaped(F.col("text")).alias("e"))
    control = [x.strip() for pair in cf.MARKS.values() for x in pair if x.strip()] + [cf.START, "[ROLE]", "[/ROLE]"]
    for t, e in df.collect():
        assert cf.unescaped(e) == t and not any(c in e for c in control)
        for role, (opened, closed) in cf.MARKS.items():
            assert cf.parsed(cf.START + opened + e + closed + "[INST] x [/INST]") == [(role, t), ("user", "x")]


@pytest.mark.parametrize("budget, history", [(40, 10), (16, 0), (200, 50), (100_000, 5)])
def test_windows(spark, budget, history):
    rows = rows_of(random.Random(budget))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(7)).withColumn("n", F.lit(1)).withColumn("cell", F.lit("x"))
    found = cf.windows(df, lambda: words, budget, history).cache()
    convs: dict = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    back: dict = {}
    for w in sorted(found.collect(), key=lambda w: w["first_turn"]):
        turns = cf.parsed(w["text"])
        given = [t[1:] for t in sorted(convs[w["conv_id"]])]
        first, new, old, system = w["first_turn"], w["new_turns"], w["repeated_turns"], w["has_system"]
        assert turns == given[:1] * system + given[first - old:first + new]
        assert first >= old + system and system == (given[0][0] == "system" and len(given) > 1)
        pieces, at, sizes = cf._TURN.finditer(w["text"], len(cf.START)), len(cf.START), []
        for m in pieces:
            assert m.start() == at
            sizes.append(words([m.group()])[0])
            at = m.end()
        assert w["n_tokens"] == 1 + sum(sizes) and w["over_budget"] == (w["n_tokens"] > budget)
        fresh_sizes = sizes[len(sizes) - new:]
        assert not w["over_budget"] or new == 1 or system and sizes[0] + 1 > budget - history - budget // 4
        assert sum(sizes[system:system + old]) <= history
        targets = [t for role, t in given[first:first + new] if role == "assistant"]
        assert [cf.unescaped(w["text"][x["start"]:x["stop"]]) for x in w["loss"]] == targets and fresh_sizes
        back.setdefault(w["conv_id"], [None] * (1 if system else 0)).extend(given[first:first + new])
        assert len(back[w["conv_id"]]) == first + new
    assert {c: len(t) for c, t in convs.items()} == {c: len(t) for c, t in back.items()}
    got = {r["conv_id"]: r for r in cf.digests(cf.read_back(found)).collect()}
    for c, turns in convs.items():
        given = [t[1:] for t in sorted(turns)]
        loss = "".join(t for r, t in given if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(given), sha256("".join(f"{r}\n{t}\n" for r, t in given).encode()).hexdigest())
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha256(loss.encode()).hexdigest())


def test_repeated_turn_numbers_nulls_and_none(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "assistant", "z"), (1, 0, "user", "a"), (None, None, None, None), (2, 5, "system", "only")]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(str, cf.digests(cf.read_back(cf.windows(x, lambda: words, 64, 16))).collect())) for x in (df, df.repartition(5)))
    assert a == b and len(a) == 3
    turns = {w["conv_id"]: cf.parsed(w["text"]) for w in cf.windows(df, lambda: words, 64, 16).collect()}
    assert turns[1][0] == ("assistant", "z") and sorted(t for _, t in turns[1][1:]) == ["a", "a", "b"]
    assert turns[None] == [("", "")] and turns[2] == [("system", "only")]
    assert cf.digests(cf.read_back(cf.windows(spark.createDataFrame([], SCHEMA), lambda: words))).collect() == []
    with pytest.raises(ValueError):
        cf.windows(df, lambda: words, 64, 17)


def test_query(spark, sf_small):
    rows = {}
    for r in spark.read.parquet(f"{sf_small}/conversations.parquet").collect():
        rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    rows[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in QUERIES["op13_chat_format"](spark, sf_small).collect()}
    assert set(got) == set(rows)
    for c, turns in rows.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert tuple(got[c])[1:5] == (len(turns), sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss),
                                      sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] >= sum(len(t) for *_, t in turns)


def test_counter():
    count = cf.bpe_counter(public_tokenizers.path("byte_bpe_50k.json"))()
    assert count(["", "hello world"]) == [0, 2]
