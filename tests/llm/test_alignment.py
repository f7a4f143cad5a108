"""Alignment of two tokenizers against a plain version that lists every link."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

import public_tokenizers
from tidepost.llm import alignment, queries
from tests.llm.tables import no_documents, odd_documents, odd_texts, prose

BITS = [" ", "  ", "a", "the", "é", "😀", "\n", "\t", " ", "　", ".", "'s", "1", "23", "<s>", "</s>", "<0x0A>", "ing", "\x1c",
        "▁", "<|endoftext|>", "日本", "\x00", "é", "ﬁ", "ZZZZ", "\r\n", "​", "-----"]


def random_texts(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randrange(1, 14))) for _ in range(count)]


class Plain:
    """Tokens by the libraries that the files are made for."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def tokens(self, text):
        whole = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = self.b.encode(text) if text else []
        x = [alignment.byte_level_bytes(self.a.id_to_token(i)) for i in a]
        y = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [self.b.id_to_piece(i)]]
        if b"".join(x) != whole or b"".join(y) != whole:
            return [], [], [], []
        return a, x, b, y

    def groups(self, text):
        """Groups of ids, and the ids in order."""
        a, x, b, y = self.tokens(text)

        def ends(parts):
            at, out = 0, []
            for p in parts:
                at += len(p)
                out.append(at)
            return out

        e, f = ends(x), ends(y)
        common = sorted(set(e) & set(f))
        out = [([], []) for _ in common]
        for k, (ids, places) in enumerate(((a, e), (b, f))):
            for i, p in zip(ids, places, strict=True):
                out[next(g for g, c in enumerate(common) if p <= c)][k].append(i)
        return out, len(a), len(b)


def plain_rows(docs):
    plain = Plain()
    found = [(i, *plain.groups(t or "")) for i, t in docs]
    links = [Counter((a, b) for g in groups for a in g[0] for b in g[1]) for _, groups, _, _ in found]
    count = Counter(pair for held in links for pair in held)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, groups, n_a, n_b), held in zip(found, links, strict=True):
        written = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((
            str(i), n_a, n_b, len(groups), sum(held.values()), sum(n for p, n in held.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in held.items()), hashlib.sha256(written.encode()).hexdigest() if n_a else "",
        ))
    return sorted(out)


def rows_of(df):
    return sorted((str(r["doc_id"]), *(r[c] for c in df.columns[1:])) for r in df.collect())


def contents():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as model:
        return file.read(), model.read()


@pytest.fixture(scope="module")
def known():
    return alignment.encoders(*contents())


@pytest.mark.parametrize("part", [1 << 20, 7])
def test_ids_are_those_of_the_libraries(known, monkeypatch, part):
    monkeypatch.setattr(alignment, "PART_CHARS", part)
    plain = Plain()
    for text in ["", " ", "  ", "a ", "x" * 3000, "日本語" * 500, *random_texts(3, 3000), prose(5, 400)]:
        a, _, b, _ = plain.tokens(text)
        x, y = known.encode(text)
        assert (x.tolist(), y.tolist()) == (a, b), text


@pytest.mark.parametrize("sizes", [(1 << 16, 2_000_000), (7, 50)])
def test_query_rows(spark, sizes):
    """Also with many blocks in a task."""
    docs = [(i % 90, t) for i, t in enumerate(random_texts(8, 120))] + [(i, prose(i % 7, 60 + i)) for i in range(100, 130)]
    docs += [(200, None), (201, ""), (None, "a b"), (None, None), (202, "ab " * 300), (203, "日本" * 200)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        got = rows_of(alignment.align(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), *contents(), *sizes))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_rows(docs)


@pytest.mark.parametrize("large", [256, 0])
def test_postings(known, monkeypatch, large):
    """Also with every group counted before it is paired."""
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    texts, plain = [*random_texts(9, 200), "", "日本" * 300, prose(2, 90)], Plain()
    keys, times = alignment.Aligned([known.encode(t) for t in texts], known).postings(1000)
    expected = Counter((a, b, 1000 + k) for k, t in enumerate(texts) for g in plain.groups(t)[0] for a in g[0] for b in g[1])
    assert {(k >> 40, k >> 16 & 0xFFFFFF, k & 0xFFFF): n for k, n in zip(keys.tolist(), times.tolist(), strict=True)} == expected
    planes = {}
    for plane, pair, bounds, slots in alignment.plane_rows(keys, times):
        for p, x, y in zip(pair.tolist(), bounds[:-1], bounds[1:], strict=True):
            for s in slots[x:y].tolist():
                planes[p << 16 | s] = planes.get(p << 16 | s, 0) + (1 << max(0, plane))
    assert planes == dict(zip(keys.tolist(), times.tolist(), strict=True))


def test_odd_rows(spark):
    docs = [(i, t) for i, t in odd_texts() if len(t or "") < 5000]
    frame = odd_documents(spark).where("length(coalesce(text, '')) < 5000").withColumnRenamed("score", "slots").withColumnRenamed("th", "block")
    assert rows_of(alignment.align(frame, *contents())) == plain_rows(docs)
    assert alignment.align(no_documents(spark), *contents()).count() == 0


def test_containers():
    for count in (1, 4095, 4096, 40_000):
        slots = sorted(random.Random(count).sample(range(1 << 16), count))
        held = alignment.container(alignment.np.array(slots))
        assert alignment.slots_of(held).tolist() == slots and len(held) <= 8192


def test_numbers_of_pairs(spark):
    docs = [(1, "ab ab ab"), (2, "ab"), (3, "cd ab")]
    index = alignment.pair_index(spark.createDataFrame(docs, "doc_id bigint, text string"), *contents())
    links = [Counter((a, b) for g in Plain().groups(t)[0] for a in g[0] for b in g[1]) for _, t in docs]
    expected = {p: (sum(p in held for held in links), sum(held[p] for held in links)) for held in links for p in held}
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in alignment.pair_numbers(index).collect()} == expected


def test_query_on_the_whole_table(spark):
    rows = queries.QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001")
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
