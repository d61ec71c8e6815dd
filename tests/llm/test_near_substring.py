"""N-gram Jaccard join and substring dedup against brute force, on odd rows and hot groups."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelstats.llm import graph, near, queries, stream, substring
from tests.conftest import SF001
from tests.helpers import rows_of

WORDS = [f"w{i}" for i in range(400)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows():
    """Exact copies, near copies of one text (a hot group), shared passages, odd and repeated rows."""
    rng = random.Random(5)
    out = []

    def add(text, doc=None):
        out.append((len(out) if doc is None else doc, text))

    base = [rng.choice(WORDS) for _ in range(120)]
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        add(" ".join(copy))
    passage = [rng.choice(WORDS) for _ in range(60)]
    for i in range(40):
        body = [rng.choice(WORDS) for _ in range(rng.randint(30, 300))]
        at = rng.randrange(len(body))
        add("  ".join(body[:at] + passage + body[at:]) if i % 2 else " \n".join(body))
    for n in (1, 4, 5, 34, 35, 36):
        text = " ".join(rng.choice(WORDS) for _ in range(n))
        add(text)
        add(text + " ")
    add(" ".join(passage[:8] * 20))            # repeats itself
    add("x " * 3000)                           # one word only
    add(" ".join(rng.choice(WORDS) for _ in range(20_000)))
    for text in (None, "", " \t", "a\x00b", "é " * 50, "  z"):
        add(text)
    add("same id other text " + " ".join(passage), 7)
    add(out[3][1], 3)                          # a repeated row
    add("no id " + " ".join(base), None)
    out += [(None, " ".join(base)), (None, None)]
    return out


ROWS = rows()


def frame(spark, data=None):
    return spark.createDataFrame([(i, t, 1, "k", 2.0, "z") for i, t in (ROWS if data is None else data)],
                                 "doc_id long, text string, node int, tie string, digits double, grams string")


def gram_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_near(data):
    sets = [gram_set(t) for _, t in data]
    classes = {}
    for r, s in enumerate(sets):
        classes.setdefault(s, []).append(r)
    names = list(classes)
    parent = list(range(len(names)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(names)):
        for b in range(a):
            both = len(names[a] & names[b])
            if both and both / len(names[a] | names[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    groups = {}
    for c in range(len(names)):
        groups.setdefault(find(c), []).extend(classes[names[c]])
    out = []

    def low(members):
        ids = [data[r][0] for r in members if data[r][0] is not None]
        return min(ids) if ids else None

    for c, name in enumerate(names):
        members = groups[find(c)]
        out += [(data[r][0], low(members), low(classes[name]), links[c], len(members)) for r in classes[name]]
    return Counter(out)


@pytest.mark.parametrize("block", [512, 16])
def test_near_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK_CLASSES", block)  # large groups in several blocks
    monkeypatch.setattr(near, "RUN_BLOCK", block * 2)
    got = near.near_join(frame(spark))
    assert Counter(tuple(r) for r in got.collect()) == brute_near(ROWS)


def test_near_dedup_keeps_one_of_each_group(spark):
    df = frame(spark)
    kept = near.keep_one(df)
    assert kept.columns == df.columns
    firsts = {(class_id, n) for (_, class_id, _, _, n) in brute_near(ROWS) if class_id is not None}
    got = [r.doc_id for r in kept.collect()]
    assert Counter(got) == Counter(c for c, _ in firsts)


def test_near_and_substring_on_an_empty_table(spark):
    none = frame(spark).where("false")
    assert near.near_join(none).count() == 0
    assert near.keep_one(none).count() == 0
    assert substring.substring_dedup(none).count() == 0


def test_matched_prefix_reaches_the_target_recall():
    depth = near.matched_digits()
    assert 1 - (1 - 0.8 ** depth) ** near.TREES >= near.RECALL
    assert 1 - (1 - 0.8 ** (depth + 1)) ** near.TREES < near.RECALL
    with pytest.raises(ValueError):
        near.matched_digits(trees=1)


def test_no_link_near_the_threshold_is_lost(spark):
    """Pairs at similarity 0.815: 200 words, four of them changed far apart."""
    rng = random.Random(11)
    data = []
    for pair in range(300):
        text = [f"{pair}_{rng.randrange(10 ** 6)}" for _ in range(200)]
        other = list(text)
        for at in (20, 70, 120, 170):
            other[at] = "changed"
        a, b = gram_set(" ".join(text)), gram_set(" ".join(other))
        assert len(a & b) / len(a | b) == 176 / 216
        data += [(2 * pair, " ".join(text)), (2 * pair + 1, " ".join(other))]
    rows = near.near_join(frame(spark, data)).collect()
    assert all(r.n_links == 1 and r.class_id == r.doc_id - r.doc_id % 2 and r.class_docs == 2 for r in rows)


def test_prefixes_shorten_only_where_the_data_ask_for_it(spark, monkeypatch):
    """Close copies are tied by whole labels, pairs near the threshold by shorter ones, loners go down to the floor."""
    rng = random.Random(4)
    rows, compared = [], []
    for i in range(40):
        text = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
        rows += [(i, " ".join(text)), (100 + i, " ".join(text[:-1])),
                 (300 + i, " ".join(f"x{rng.randrange(10 ** 6)}" for _ in range(50)))]
    plain = near.block_pairs

    def noted(members, blocks):
        compared.append(members.count())
        return plain(members, blocks)

    monkeypatch.setattr(near, "block_pairs", noted)
    floor = near.matched_digits()
    depth = {r.copy_id: r.depth for r in near.depths_reached(frame(spark, rows)).collect()}
    assert floor < near.DIGITS
    assert all(depth[i] == near.DIGITS and depth[100 + i] == near.DIGITS for i in range(40))
    assert all(depth[300 + i] == floor for i in range(40))
    # whole labels have tied all that meet: at shorter prefixes every run is settled
    assert compared[0] > 0 and compared[1:] == [0] * (near.DIGITS - floor)


def test_a_pair_that_meets_late_is_tied_at_a_shorter_prefix(spark):
    """Labels made by hand: 1 and 2 share whole labels, 3 only seven digits of one tree with 2."""
    trees, digits = 2, 8
    same, other = bytes(range(16)), bytes(range(7)) + bytes([200]) + bytes(range(8, 15)) + bytes([9])
    meeting = spark.createDataFrame(
        [(t, int.from_bytes(d[8 * t:8 * t + 8], "big"), n) for n, d in ((1, same), (2, same), (3, other))
         for t in range(trees)], "tree int, label long, node long")
    raw = spark.createDataFrame([(1, same), (2, same), (3, other)], "node long, digits binary")
    groups, depths = near.descend(meeting, raw, 4, 0.8, trees, digits, 7)
    assert {(r.node, r.root) for r in groups.collect()} == {(1, 1), (2, 1), (3, 1)}
    got = {r.node: r.depth for r in depths.collect()}
    assert got[3] == 7 and max(got[1], got[2]) == 8


def test_filter_keeps_all_wanted_texts_and_few_others(spark):
    texts = spark.range(20_000).selectExpr("nullif(id, 7) as doc_id", "xxhash64(id) as tie", "string(id) as text")
    wanted = texts.where("doc_id % 50 = 0 or doc_id is null").select("doc_id", "tie").withColumn("node", F.lit(1))
    for bits in (1 << 28, 1 << 16):
        kept = near.only_wanted(texts, wanted, bits)
        assert kept.columns == texts.columns
        assert kept.where("doc_id % 50 = 0 or doc_id is null").count() == 401
        assert kept.count() < 401 + 20_000 * (0.02 if bits > 1 << 16 else 0.05)
    assert near.only_wanted(texts, wanted.where("false")).count() == 0


def test_members_of_one_component_are_not_compared():
    digits = np.zeros((6, 320), np.uint8)
    digits[3:] = 9
    digits[5, :100] = 1
    need = 320 * 0.6
    one = near.tied_members(digits, np.array([1, 1, 1, 1, 1, 1]), need, None)
    assert one.all()
    two = near.tied_members(digits, np.array([1, 1, 1, 1, 1, 2]), need, None)
    assert two[5].tolist() == [False, False, False, True, True, True] and (two == two.T).all()
    apart = near.tied_members(digits, np.arange(6), need, np.array([True, False] * 3))
    assert apart[0, 1] and not apart[0, 2] and apart[3, 4] and not apart[0, 3] and (apart == apart.T).all()


def test_minhash_digits_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = np.concatenate([a[:400], rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    d = near.minhash_digits([np.unique(a), np.unique(b), np.zeros(0, np.uint64)], 2000)
    share = (d[0] == d[1]).mean()
    assert abs((share - 1 / 256) / (1 - 1 / 256) - 400 / 600) < 0.05
    assert not d[2].any()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 90)] + [(2005, 2001), (2001, 2003)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(90)}, 2001: 2001, 2003: 2001,
                   2005: 2001}


def test_meeting_rows_across_batches():
    data = [1, 2, 2, 3, 4, 4, 4, 5, 6, 6]
    for cut in range(1, 10):
        batches = [pa.RecordBatch.from_arrays([pa.array(data[a:a + cut], pa.int64()),
                                               pa.array(list(range(a, min(a + cut, 10))), pa.int64())],
                                              names=["k", "i"]) for a in range(0, 10, cut)]
        got = [i for b in stream.meeting_rows(["k"], ["i"])(iter(batches)) for i in b.column("i").to_pylist()]
        assert got == [1, 2, 4, 5, 6, 8, 9]


def test_cover_hits_every_difference():
    assert substring.is_difference_cover(substring.PERIOD, substring.COVER)
    assert not substring.is_difference_cover(21, (0, 1, 4, 14))


def brute_substring(data, k=35):
    all_words = [words(t) for _, t in data]
    seen = Counter(tuple(w[i:i + k]) for w in all_words for i in range(len(w) - k + 1))
    out = []
    for (doc, _), w in zip(data, all_words):
        drop = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                drop.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in drop)
        out.append((doc, len(w), len(drop), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return Counter(out)


def test_substring_dedup_equals_brute_force(spark):
    got = substring.substring_dedup(frame(spark))
    assert Counter(tuple(r) for r in got.collect()) == brute_substring(ROWS)
    slim = substring.substring_dedup(frame(spark), with_text=False)
    assert Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in slim.collect()) \
        == Counter({k[:4]: n for k, n in brute_substring(ROWS).items()})


def test_other_windows_and_covers(spark):
    got = substring.substring_dedup(frame(spark, ROWS[:70]), window=9, period=7, cover=(0, 1, 3))
    assert Counter(tuple(r) for r in got.collect()) == brute_substring(ROWS[:70], 9)


def test_many_repeated_rows_without_an_id(spark):
    text = " ".join(f"r{i}" for i in range(80))
    data = [(None, text)] * 400 + [(1, text + " tail"), (2, "short")]
    assert Counter(tuple(r) for r in substring.substring_dedup(frame(spark, data)).collect()) == brute_substring(data)
    starts = spark.createDataFrame([(None, 5, k % 3, 1 + k % 2) for k in range(600)], substring.STARTS)
    lists = substring.per_document(starts).first()
    assert sorted(zip(lists["at"], lists["n"])) == [(a, n) for a in range(3) for n in (1, 2)]


def test_repeats_across_slices_of_a_task(spark, monkeypatch):
    from reelstats.llm import words as w
    monkeypatch.setattr(w.slices, "__defaults__", ("text", 2000))
    got = substring.substring_dedup(frame(spark).repartition(3), with_text=True)
    assert Counter(tuple(r) for r in got.collect()) == brute_substring(ROWS)


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op10_substring_dedup"])
def test_queries_equal_sql(spark, duck, name):
    got = queries.LLM_QUERIES[name](spark, SF001)
    cols = sorted(got.columns)
    want = duck.execute(queries.LLM_SQL[name]).df()[cols]
    assert rows_of(got, cols) == sorted(want.itertuples(index=False, name=None))
