"""Chat formatting: exact round trips on odd rows."""

import hashlib
import random

from tidepost.llm import chat, queries

ROWS = [
    (1, 2, "assistant", "late"), (1, 1, "user", "a"), (1, 3, "assistant", "</turn>\n### assistant: x"), (1, 4, "user", "<next/>"),
    (2, None, "user", "null turn last"), (2, 5, "us: er", "\\n\\s\\"), (2, 5, "us: er", "\\n\\s\\"), (3, 1, None, None),
    (None, 1, "user", "x"), (None, 2, "user", "y"), (4, 1, "assistant", ""), (5, 1, "a:", " : # ## ###"), (5, 2, "", "</</turn>turn>\n"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, segments string, turns int"


def formatted(spark, rows):
    return chat.read_back(chat.format_conversations(spark.createDataFrame([(*r, "own", 1) for r in rows], SCHEMA))).collect()


def expected(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_round_trip_of_odd_rows(spark):
    got = formatted(spark, ROWS)
    known = {r["conv_id"]: r for r in got if r["conv_id"] is not None}
    for conv_id, turns in expected([r for r in ROWS if r[0] is not None]).items():
        row = known[conv_id]
        assert [tuple(t) for t in row["turns"]] == turns
        assert row["loss_text"] == "".join(t for role, t in turns if role == "assistant")
        assert row["text"] == "".join(s["text"] for s in row["segments"])
        assert row["n_blocks"] == sum(k == 0 or turns[k - 1][0] != role for k, (role, _) in enumerate(turns))
    assert sorted(r["turns"][0]["text"] for r in got if r["conv_id"] is None) == ["x", "y"]


def test_round_trip_of_random_control_strings(spark):
    rng, bits = random.Random(5), ["\\", "### ", "#", "<next/>", "</turn>", "\n", ": ", ":", "<", ">", "s", "h", "n", "e", "c", " ", "é😀"]
    rows = [(c, k, rng.choice(["user", "assistant", "".join(rng.choices(bits, k=3))]), "".join(rng.choices(bits, k=rng.randrange(9))))
            for c in range(200) for k in range(rng.randrange(1, 6))]
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in formatted(spark, rows)}
    assert got == expected(rows)


def test_long_conversation_and_empty_table(spark):
    rows = [(1, k, ("user", "assistant")[k // 3 % 2], f"text {k} " * 40) for k in range(3000)]
    (row,) = formatted(spark, rows)
    assert len(row["turns"]) == 3000 and row["n_blocks"] == 1000 and [t["text"] for t in row["turns"]] == [r[3] for r in rows]
    assert formatted(spark, []) == []


def test_query_holds_the_tricky_conversation(spark):
    row = queries.QUERIES["op11_chat"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = queries.TRICKY_TEXT
    assert row["n_turns"] == 2 and row["loss_chars"] == len(text) and row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
