import hashlib
import random

from helixframe.llm import chat
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, mask int"


def conversations(spark):
    rng = random.Random(6)
    bits = ["\\", "#", "### ", "<", "</turn>", "\n", "<part>", ": ", "\\h", "\\s\\c", "é", "\U0001f600", "plain text", "assistant", "### assistant: x</turn>\n"]
    rows = []
    for c in range(40):
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a:b\\c#<"]), "".join(rng.choices(bits, k=rng.randrange(0, 8)))))
    rows += [(50, 0, "user", None), (50, 1, None, "x"), (51, 1, "assistant", None), (52, None, "assistant", "first"), (52, 0, "assistant", "second"), (None, 0, "user", "n"), (53, 0, "user", "same"), (53, 0, "user", "same"), (54, 0, "assistant", "long " * 50_000), (55, 2, "assistant", "b"), (55, 1, "assistant", "a")]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def turns_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    return {c: sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode())) for c, ts in out.items()}


def test_digests_against_brute_force(spark):
    df = conversations(spark)
    want = turns_of(df.collect())
    got = {r.conv_id: r for r in chat.chat_digests(df).collect()}
    assert set(got) == set(want)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in want.items():
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))


def test_neighbours_of_one_role_share_a_message(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", ""), (1, 4, "user", "d")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df).first()
    assert row.formatted == "### user: a<part>b</turn>\n### assistant: c<part></turn>\n### user: d</turn>\n"
    assert [row.formatted[s.start - 1 : s.start - 1 + s.length] for s in row.mask] == ["c", ""]


def test_tricky_conversation_and_plan(spark):
    row = chat.chat_digests(chat.tricky(spark)).first()
    said = f"user\n{chat.TRICKY_TEXT}\nassistant\n{chat.TRICKY_TEXT}\n"
    assert (row.conv_id, row.n_turns, row.turns_sha256) == (-7, 2, hashlib.sha256(said.encode()).hexdigest())
    assert row.loss_sha256 == hashlib.sha256(chat.TRICKY_TEXT.encode()).hexdigest()
    plan = chat.chat_digests(chat.tricky(spark))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    assert chat.chat_digests(conversations(spark).limit(0)).count() == 0


def test_many_turns(spark):
    turn = F.col("id") % 20_000
    rows = spark.range(20_000).select(F.lit(1).alias("conv_id"), turn.alias("turn"), F.when(turn % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("é#"), turn.cast("string")).alias("text"))
    got = chat.chat_digests(rows).first()
    loss = "".join(f"é#{t}" for t in range(20_000) if t % 3)
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (20_000, len(loss), hashlib.sha256(loss.encode()).hexdigest())
