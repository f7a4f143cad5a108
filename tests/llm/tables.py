"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, extra columns."""

from __future__ import annotations

WORDS = [f"{a}{b}{c}" for a in "bdgklmnprst" for b in "aeiou" for c in ("n", "r", "st")]


def words(seed: int, count: int) -> list[str]:
    out, state = [], seed * 2654435761 % 2**32 or 1
    for _ in range(count):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[(state >> 8) % len(WORDS)])
    return out


def prose(seed: int, count: int, sentence: int = 9, line: int = 4) -> str:
    """Sentences of ``sentence`` words, ``line`` of them to a line."""
    found = words(seed, count)
    sentences = [" ".join(found[i : i + sentence]).capitalize() + "." for i in range(0, count, sentence)]
    return "\n".join(" ".join(sentences[i : i + line]) for i in range(0, len(sentences), line))


def odd_texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 260)
    near = base.replace(base.split()[100], "zzz", 1)
    shared = prose(2, 120)
    return [
        (1, base), (2, base), (3, near), (4, prose(3, 200)), (5, prose(4, 90) + "\n" + shared + "\n" + prose(5, 90)),
        (6, prose(6, 90) + "\n" + shared + "\n" + prose(7, 90)), (7, None), (8, ""), (9, " \n\t\n "), (10, "a"),
        (11, "one two three four"), (12, "one two three four"), (None, prose(8, 80)), (None, None), (None, base),
        (13, "aaaa " * 400), (14, "ñandú über façade 😀 " * 60), (15, "x" * 3000), (16, prose(9, 12_000)), (1, base),
        (4, prose(10, 60)), (17, prose(11, 40) + "\n\n\n\n" + prose(12, 40)), (18, "1234 5678 !!! ..."),
    ]


#: Columns whose names the operators use themselves.
CLASHING = ("score", "n_removed", "n_lines", "n_sentences", "shard", "held_out", "th", "n", "id", "spans", "starts")


def odd_documents(spark):
    rows = [(i, t, "xx", "s", len(t or ""), *(["own"] * len(CLASHING))) for i, t in odd_texts()]
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")


def no_documents(spark):
    return odd_documents(spark).where("false")
