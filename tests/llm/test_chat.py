import hashlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING
from tiffin.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["\\", "### ", "###", "#", " ", "</turn>", "<", "/turn>", "\n", ": ", ":", "User", "Assistant", "assistant", "=", "a",
         "ok 漢", "$1", "### Assistant: ", "</turn>\n"]


def some(rnd, most):
    return "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, most)))


def conversations(n, seed=1):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", None, "a: b", "### x", "</turn>\n", "=", "back\\", ":", "a:"]
    return [(c, t, rnd.choice(roles[:3] if rnd.random() < 0.7 else roles), rnd.choice([None, some(rnd, 3), some(rnd, 12)]))
            for c in range(n) for t in range(rnd.randint(1, 9))]


def grammar(formatted):
    """The parser again, in another language: character by character."""
    turns, at = [], 0
    while at < len(formatted):
        assert formatted.startswith("### ", at)
        colon = formatted.index(": ", at)
        end = formatted.index("</turn>\n", at)
        head, body = formatted[at + 4:colon], formatted[colon + 2:end]

        def plain(s):
            out, i = "", 0
            while i < len(s):
                i += s[i] == "\\" and i + 1 < len(s)
                out, i = out + s[i], i + 1
            return out
        role = {"System": "system", "User": "user", "Assistant": "assistant"}.get(head) or plain(head[1:])
        turns.append((role, plain(body)))
        at = end + 8
    return turns


def test_round_trip_of_hostile_texts(spark):
    rows = conversations(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = chat.format_conversations(df).select("*", chat.learned_text(F.col("formatted"), F.col("spans")).alias("learned")).collect()
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r.conv_id for r in got} == set(want)
    for r in got:
        source = want[r.conv_id]
        assert [tuple(t) for t in r.turns] == source == grammar(r.formatted)
        assert r.learned == "".join(t for role, t in source if role == "assistant")
        # no control string is left but the template's own
        assert r.formatted.count("</turn>") == r.formatted.count("### ") == len(source)
        for (role, text), span in zip(source, r.spans):
            body = r.formatted[span["from"]:span.to]
            assert span.loss == (role == "assistant") and r.formatted[span.to:].startswith("</turn>\n")
            assert r.formatted[:span["from"]].endswith(": ") and (body == text or "\\" in body)


def test_rounds(spark):
    texts = {"plain": 0, "a \\": 0, "### x": 1, "</turn>": 1, "a \\n": 2, "\\### Assistant: </turn> ok": 2, "#### ": 1, "": 0}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", chat.rendered_turn(F.lit("user"), F.col("t")).alias("r"),
                    *[chat.render(F.lit("user"), F.col("t"), k).alias(f"r{k}") for k in range(chat.ROUNDS)]).collect()
    for r in got:
        assert r.r == r[f"r{texts[r.t]}"]
        assert all(r.r != r[f"r{k}"] for k in range(texts[r.t]))


def test_edges(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, "system", "first"), (1, 1, "assistant", "b"),
            (1, 1, "assistant", "a"), (None, 0, None, None), (None, 0, "user", "x"), (2, 0, "assistant", None),
            (3, 0, "user", "y" * 3_000_000 + "\\" * 3 + "### "), (3, 1, "assistant", "\\n" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in CLASHING + ["piece", "nr", "before", "formatted"]])
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    turns = {k: [tuple(t) for t in r.turns] for k, r in got.items()}
    assert turns[1] == [("system", "first"), ("user", "a"), ("assistant", "a"), ("assistant", "b"), ("assistant", "b")]
    assert turns[None] == [("", ""), ("user", "x")]
    assert turns[2] == [("assistant", "")] and [tuple(s) for s in got[2].spans] == [(15, 15, True)]
    assert turns[3] == [(r[2], r[3]) for r in rows[-2:]]
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_lossy_template_fails_the_job(spark, monkeypatch):
    monkeypatch.setattr(chat, "ESCAPES", [])
    df = spark.createDataFrame([(1, 0, "user", "say </turn>")], SCHEMA)
    with pytest.raises(PySparkException, match="read back"):
        chat.format_conversations(df).collect()


def test_contract(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    said = "\\### Assistant: </turn> ok"
    source = {-7: [("user", said), ("assistant", said)]}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        source.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = queries.op11_chat(spark, sf).collect()
    assert sorted(r.conv_id for r in got) == sorted(source)
    for r in got:
        turns = source[r.conv_id]
        learned = "".join(t for role, t in turns if role == "assistant")
        want = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(turns), want, len(learned))
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars > sum(len(t) for _, t in turns)
