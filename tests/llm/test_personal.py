"""Personal data: base spans against plain patterns, and what contexts discover."""

import random

from tests.llm import brute
from tests.llm.tables import odd_documents, odd_texts, prose
from tidepost.llm import personal

BITS = ["a.b@c.de", "x@y", "@", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713",
        "+44", "0", "12345678901234567890", "é😀", " ", "\n", "-", "(", ")", "key", "00255.0.0.1", "%+-", "+1", "5500005555555559"]


def found(spark, docs):
    return personal.find_personal(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()


def test_base_spans_of_random_texts(spark):
    rng = random.Random(11)
    docs = [(i, rng.choice(["", " "]).join(rng.choices(BITS, k=rng.randrange(14)))) for i in range(600)] + [(600, None)]
    for row in found(spark, docs):
        counts, spans, digest = brute.personal_base(dict(docs)[row["doc_id"]])
        assert [row[f"n_{k}"] for k in brute.KINDS] == counts and row["base_sha256"] == digest
        assert set(spans) <= set(row["spans"].split(",")) and row["n_spans"] == len(spans) + row["n_added"]


def test_odd_rows_against_plain_patterns(spark):
    rows = personal.find_personal(odd_documents(spark)).collect()
    got = sorted((str(r["doc_id"]), *[r[f"n_{k}"] for k in brute.KINDS], r["base_sha256"]) for r in rows)
    assert got == sorted((str(i), *brute.personal_base(t)[0], brute.personal_base(t)[2]) for i, t in odd_texts())


def test_secrets_are_discovered_by_their_contexts(spark):
    rng = random.Random(4)

    def run(size, signs="0123456789abcdef"):
        return "".join(rng.choices(signs, k=size - 2)) + "a1"

    docs = [(i, f'{prose(i, 20)} token = "{run(40)}" {prose(90 + i, 20)}') for i in range(12)]
    docs += [(20, f'{prose(20, 20)} token = "{run(12)}" {prose(21, 9)}')]  # no seed by itself
    docs += [(30 + i, f"{prose(40 + i, 20)} {run(40)} {prose(60 + i, 20)}") for i in range(2)]  # a seed in no trusted context
    docs += [(40 + i, f"{prose(70 + i, 30)} {run(10)} {prose(80 + i, 30)}") for i in range(10)]
    rows = {r["doc_id"]: r for r in found(spark, docs)}
    for i, text in docs[:13]:
        at = text.index('"') + 1
        assert rows[i]["spans"] == f"secret:{at}:{text.index(chr(34), at)}" and rows[i]["n_added"] == rows[i]["n_spans"] == 1
    assert all(rows[i]["n_spans"] == 0 for i in rows if i >= 30)


def test_an_unseen_kind_of_phone_is_discovered(spark):
    docs = [(i, f"{prose(i, 15)} call us at +1 (017) 555-{1000 + i} {prose(50 + i, 15)}") for i in range(10)]
    docs += [(20, f"{prose(20, 15)} call us at 0171 555 12 34 {prose(70, 15)}"), (21, f"{prose(21, 15)} chapter 0171 555 12 34 {prose(71, 15)}")]
    rows = {r["doc_id"]: r for r in found(spark, docs)}
    assert rows[20]["spans"].startswith("phone:") and rows[20]["n_phone"] == 0 and rows[21]["n_spans"] == 0
