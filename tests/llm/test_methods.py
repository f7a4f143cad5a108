"""The methods themselves, on inputs small enough for a plain version."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepost.llm import contamination, graph_search, hashing, ngram_join, packing, personal, sentences, suffixes
from tidepost.llm.components import components
from tests.llm.tables import prose, words


def test_two_stage_sorting():
    rng = random.Random(5)
    for size in (1, 2, 3):
        texts = [bytes(rng.choice(b"abc"[:size]) for _ in range(rng.randint(3, 60))) for _ in range(12)]
        _, starts, ends = suffixes.join_texts(texts)
        order = suffixes.suffix_array(texts, ends - starts)
        keys = [(texts[t][p:], t) for t in range(len(texts)) for p in range(len(texts[t]))]
        at = {int(starts[t] + p): texts[t][p:] for t in range(len(texts)) for p in range(len(texts[t]))}
        assert [at[int(i)] for i in order] == [k for k, _ in sorted(keys)]
        common = suffixes.common_prefixes(texts, order, 1000)
        for k in range(1, len(order)):
            a, b = at[int(order[k - 1])], at[int(order[k])]
            assert common[k] == next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_word_hashes_do_not_depend_on_slices():
    texts = [" ".join(words(i, 50)).encode() for i in range(9)] + [b"", b"x" * 700, b" a  b\t\xc3\xa9 "]
    together, bounds = hashing.words_by_text(texts, hashing.WHITE_SPACE)
    for i, text in enumerate(texts):
        alone = hashing.text_words(text, hashing.WHITE_SPACE)
        assert len(alone) == len(text.split()) and (together[bounds[i] : bounds[i + 1]] == alone).all()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 5001 + i) for i in range(50)]
    label = {x: x for p in links for x in p}
    for _ in range(300):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {k: v for k, v in label.items() if v != k}


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n, m, both in ((10, 12, 8), (300, 310, 290), (70, 500, 60), (1000, 1000, 0)):
        pool = rng.integers(0, 1 << 63, n + m).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:both], pool[n : n + m - both]]))
        apart = len(np.setxor1d(a, b))
        assert ngram_join.differing(ngram_join.sketch(a), ngram_join.sketch(b)) <= apart


def near_copies(groups, each, words_each=60):
    """Texts that share most words within a group."""
    docs, base = [], [words(s, words_each) for s in range(groups)]
    for k in range(each * groups):
        text = list(base[k % groups])
        for place in range(k % 5):
            text[(7 * place + k) % words_each] = f"w{k}{place % 2}"
        docs.append((k, " ".join(text)))
    return docs


@pytest.mark.parametrize("cells", [1 << 20, 0])
def test_frequent_columns_across_components(spark, monkeypatch, cells):
    """Columns above the threshold, also where the table of frequent columns holds none of them."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT_CELLS", cells)
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 4)
    from tests.llm import brute

    docs = near_copies(3, 15)
    docs += [(100 + k, " ".join(words(k % 3, 60)[: 20 + 2 * k])) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.jaccard_components(df).collect())
    assert got == sorted(brute.components(docs))


def test_rows_of_a_frequent_column_with_one_short_row(spark):
    """A short row does not make the sketches of long ones pass, and a row gives one pair a component."""
    rng = np.random.default_rng(7)
    sets = {k: np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64)) for k in range(200)} | {999: np.arange(10, dtype=np.uint64)}
    for k in range(200, 300):  # two groups of copies that no link joins yet
        sets[k] = np.append(sets[k % 2][:-1], np.uint64(k))
    rows = [(5, k, len(x)) for k, x in sets.items()]
    often = spark.createDataFrame(rows, "tok bigint, sid bigint, n bigint")
    sketches = spark.createDataFrame([(k, bytearray(ngram_join.sketch(x))) for k, x in sets.items()], "sid bigint, sketch binary")
    shingles = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in sets.items()], "sid bigint, shingles binary")
    none = spark.createDataFrame([], "node bigint, label bigint")
    every, minor = ngram_join.meetings(often, none)
    near = {(r["a"], r["b"]) for r in ngram_join.nearest_across(every, minor, sketches).collect()}
    links = {(r["a"], r["b"]) for r in ngram_join.links_across(every, minor, sketches, shingles).collect()}
    flagged = {r["sid"] for r in ngram_join.rows_near(every, minor, sketches).collect()}
    same = {(a, b) for a in sets for b in sets if a < b and ngram_join.linked(sets[a], sets[b])}
    assert near == links == same and flagged == {x for pair in same for x in pair}
    grouped = spark.createDataFrame([(k, 2000 + k % 2) for k in range(200, 300)], "node bigint, label bigint")
    every, minor = ngram_join.meetings(often, grouped)
    near = [tuple(r) for r in ngram_join.nearest_across(every, minor, sketches).collect()]
    assert {a for a, _ in near} | {b for _, b in near} >= {0, 1} and len(near) <= 102


def test_components_that_meet_give_fewer_pairs_than_rows(spark):
    """Rows of a frequent column that are all near each other and not joined yet, two groups of them."""
    rng = np.random.default_rng(11)
    base = [np.unique(rng.integers(0, 1 << 63, 40).astype(np.uint64)) for _ in range(2)]
    sets = {k: np.unique(np.append(base[k % 2][:-1], np.uint64(k))) for k in range(120)}
    often = spark.createDataFrame([(5, k, len(x)) for k, x in sets.items()], "tok bigint, sid bigint, n bigint")
    sketches = spark.createDataFrame([(k, bytearray(ngram_join.sketch(x))) for k, x in sets.items()], "sid bigint, sketch binary")
    shingles = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in sets.items()], "sid bigint, shingles binary")
    every, minor = ngram_join.meetings(often, spark.createDataFrame([], "node bigint, label bigint"))
    for found in (
        ngram_join.nearest_across(every, minor, sketches, spanning=True),
        ngram_join.links_across(every, minor, sketches, shingles, spanning=True),
    ):
        pairs = [tuple(r) for r in found.collect()]
        assert len(pairs) <= 2 * len(sets) and all(ngram_join.linked(sets[a], sets[b]) for a, b in pairs)
        label = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
        assert [label.get(k, k) for k in sets] == [k % 2 for k in sets]


def test_overlap_bound_keeps_links():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, m = sorted(rng.integers(1, 60, 2))
        both = -(-3 * (n + m) // 7)
        if both > n:
            continue
        a, b = np.arange(n), np.append(np.arange(both), 1000 + np.arange(m - both))
        order = rng.permutation(2000)
        a, b = (x[np.argsort(order[x])] for x in (a, b))
        covered = [x[: rng.integers(0, len(x) - ngram_join.least_overlap(len(x)) + 2)] for x in (a, b)]
        overlap, rest = len(np.intersect1d(*covered)), max(n - len(covered[0]), m - len(covered[1]))
        assert ngram_join.enough_overlap(n, m, overlap, rest)


def test_local_search_empties_bins():
    rng = random.Random(2)
    lengths = [rng.choice([2048 - 700, 700, 350, 900, 448, 3]) for _ in range(400)]
    loose = [[i] for i in range(len(lengths))]
    better = packing.improve(loose, lengths, 2048)
    assert sorted(i for b in better for i in b) == list(range(400))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in better)
    assert len(better) <= 1.05 * sum(lengths) / 2048 + 1
    fitted = packing.best_fit(lengths, 2048)
    assert len(packing.improve(fitted, lengths, 2048)) <= len(fitted) <= len(loose)
    squares = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    assert squares(better) > squares(loose)


def test_edited_copies_align(spark):
    item = words(77, 50)
    edited = [w for k, w in enumerate(item) if k % 11 != 5]
    edited[7], edited[23], edited[31] = "changed", "other", "third"
    docs = [(1, prose(1, 90) + " " + " ".join(edited) + ". " + prose(2, 40)), (2, prose(3, 200)), (3, " ".join(item[:20]) + " " + prose(4, 90))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = contamination.contaminated(df, spark.createDataFrame([(9, " ".join(item).upper() + "!")], "item_id bigint, text string")).collect()
    assert {r["doc_id"] for r in rows} == {1} and 0.5 <= rows[0]["score"] < 1


def test_copies_with_dense_edits_and_short_items(spark):
    item = words(78, 48)
    third = [f"x{k}" if k % 3 == 2 else w for k, w in enumerate(item)]
    between = [w for k, v in enumerate(item) for w in (v, f"y{k}")]
    docs = [(n, prose(n, 60) + " " + " ".join(text) + " " + prose(n + 10, 60)) for n, text in ((1, third), (2, between), (3, item))]
    docs += [(4, "he said Zig, zag: ZOG! and left"), (5, "zig zag and zog"), (6, "\u8fd9\u662f\u4e00\u4e2a\u6d4b\u8bd5")]
    items = [(1, " ".join(item)), (2, "zig zag zog"), (3, "\u4e00\u4e2a\u6d4b"), (4, "!"), (5, "left")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = contamination.contaminated(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (4, 5), (6, 3)}
    assert got[3, 1] == got[4, 2] == got[6, 3] == 1 and 0.5 <= got[1, 1] <= got[2, 1] < 1


def test_alignment_against_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(20):
        a = np.array([rng.randrange(4) for _ in range(12)], np.uint64)
        b = np.array([rng.randrange(4) for _ in range(15)], np.uint64)
        table, best = np.zeros((13, 16), int), 0
        for i in range(1, 13):
            for j in range(1, 16):
                step = contamination.MATCH if a[i - 1] == b[j - 1] else contamination.MISMATCH
                table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] - contamination.GAP, table[i, j - 1] - contamination.GAP)
                best = max(best, table[i, j])
        assert contamination.align(a, b) == best / (2 * 12)


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please call me at +1 (555) 222-33{i:02d} soon") for i in range(6)] + [(7, "please call me at 555-222-9999."), (8, "order no 555-222-8888")]
    got = {r["doc_id"]: r for r in personal.find_personal(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[7]["spans"] == "phone:18:30" and got[7]["n_phone"] == 0 and got[7]["n_added"] == 1
    assert got[8]["spans"] == "" and got[0]["n_phone"] == 1


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def test_nearest_rows_and_recall(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(2500, 16))
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    got = graph_search.nearest(vectors(spark, rows)).collect()
    hits = 0
    for q in range(0, 2500, 100):
        away = np.sqrt(((points - points[q]) ** 2).sum(1))
        away[q] = np.inf
        want = set(np.argsort(away, kind="stable")[:10].tolist())
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert all(s == pytest.approx(away[v], rel=1e-12) for _, v, s in mine)
        hits += len(want & {v for _, v, _ in mine})
    assert hits >= 0.9 * 250


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (100, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, None, 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0)]
    rows += [(6, [None, 1.0], 0), (None, [1.0, 1.0], 0), (7, [], 0), (8, [2.0, 0.0], 0), (8, [2.0, 0.0], 0), (9, [1.0, 2.0, 3.0], 0), (200, [5.0, 5.0, 5.0], 0)]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in graph_search.nearest(vectors(spark, rows)).collect())
    assert got == [(0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 8, 1.0), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 8, 1.0), (200, 1, 9, pytest.approx(29**0.5))]
    assert graph_search.nearest(vectors(spark, rows).where("false")).count() == 0


def test_equal_vectors_beyond_the_result(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(300)] + [(1000 + i, [1.0, 2.0 + i], 0) for i in range(1, 4)]
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in graph_search.nearest(vectors(spark, rows)).collect()}
    assert [got[(0, k)] for k in range(1, 11)] == list(range(1, 11))
    assert [got[(200, k)] for k in range(1, 11)] == list(range(10))


def test_passages_glued_on_both_sides(spark):
    """51 words without an end of a sentence around them, or in them."""
    rng, docs = random.Random(7), []
    for k in range(40):
        passage = [w + ("," if rng.random() < 0.05 else "") for w in words(900 + k, 51)]
        for copy in (0, 1000):
            around = [" ".join(words(2000 + 2 * k + copy + side, 15)) for side in (0, 1)]
            docs.append((k + copy, f"{around[0]} {' '.join(passage)} {around[1]}"))
    texts = dict(docs)
    assert all(b"".join(sentences.units(t.encode(), True)) == t.encode() for t in [*texts.values(), " a, b  ", "\n , ", ""])
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in sentences.dedup_sentences(df, clauses=True).collect()}
    for k in range(40):
        assert rows[k]["text"] == texts[k] and rows[k + 1000]["n_removed"] >= 2
        assert len(rows[k + 1000]["text"].split()) <= len(texts[k + 1000].split()) - 20


def test_queries_stream_past_a_graph_read_once(spark):
    """Graphs and queries span several batches of a task; as many queries as nodes."""
    rng = np.random.default_rng(4)
    points = {2: rng.normal(size=(300, 2)), 8: rng.normal(size=(900, 8))}
    rows = [(dim * 10_000 + i, dim, p.tolist()) for dim, found in points.items() for i, p in enumerate(found)]
    nodes = spark.createDataFrame(rows, "rep bigint, dim int, embedding array<double>")
    index = graph_search.build_index(nodes, 250)
    assert index.select("dim", "shard").distinct().count() > 5
    asked = nodes.withColumnRenamed("rep", "query_id")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        plan = graph_search.search(index, asked, 3)._jdf.queryExecution().executedPlan().toString()
        found = graph_search.search(index, asked, 3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "Generate" not in plan and "MapInArrow" in plan
    held, hits = {}, 0
    for r in found:
        held.setdefault(r["query_id"], []).append((r["score"], r["rep"]))
    assert len(held) == 1200
    for dim, vectors_of in points.items():
        for i, p in enumerate(vectors_of):
            away = np.sqrt(((vectors_of - p) ** 2).sum(1))
            mine = sorted(held[dim * 10_000 + i])
            assert mine[0] == (0.0, dim * 10_000 + i) and all(s == pytest.approx(away[v % 10_000], abs=1e-12) for s, v in mine)
            hits += len({v % 10_000 for _, v in mine[:3]} & set(np.argsort(away)[:3].tolist()))
    assert hits >= 0.95 * 3 * 1200


def test_vectors_with_clashing_columns(spark):
    rows = [(i, [float(i), 1.0]) for i in range(101)]
    plain = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    names = ("rep", "dim", "shard", "node", "start", "near", "score", "rank", "query_id", "id", "place", "d")
    wide = plain.withColumns({c: F.lit("own") for c in names})
    assert sorted(graph_search.nearest(wide).collect()) == sorted(graph_search.nearest(plain).collect())
