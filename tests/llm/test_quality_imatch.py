"""Quality classification and I-Match against brute force, held-out accuracy and odd rows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from reelstats.llm import imatch, quality, queries
from tests.conftest import SF01, SF001
from tests.llm.test_near_substring import ROWS


def frame(spark, data=ROWS):
    return spark.createDataFrame([(i, t, f"s{r % 3}" if r % 7 else None, "en", 1, "x") for r, (i, t) in enumerate(data)],
                                 "doc_id long, text string, source string, lang string, term int, bucket string")


# ---- I-Match

def brute_order(data):
    """Descending id, missing ids last, rows of one id by anything (their successors are compared as sets)."""
    return sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0)))


def test_edited_texts_use_the_next_document(spark):
    data = [r for r in ROWS if r[0] is not None and ROWS.count(r) == 1 and [x[0] for x in ROWS].count(r[0]) == 1]
    want = {}
    ordered = brute_order(data)
    for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        t, u = t or "", u or ""
        k = len(t) // 2
        want[i] = (len(t), hashlib.sha256((t[:len(t) - k] + u[:k]).encode()).hexdigest())
    for parts in (1, 4, 50):
        got = imatch.fingerprints(frame(spark, data), parts=parts).collect()
        assert len(got) == len(data)
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want


def test_equal_texts_have_equal_fingerprints(spark):
    rows = imatch.fingerprints(frame(spark)).collect()
    assert len(rows) == len(ROWS)
    texts = {}
    for i, t in ROWS:
        texts.setdefault(i, set()).add(t or "")
    prints = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None and len(texts[r.doc_id]) == 1:
            prints.setdefault(next(iter(texts[r.doc_id])), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def long_texts():
    """Hand-made texts of up to 300,000 words among short ones."""
    rng = random.Random(21)
    words = [f"t{i}" for i in range(500)]
    long = " ".join(rng.choice(words) for _ in range(300_000))
    return [(1, long), (2, long), (3, "x" * 2_000_000), (4, "one short text"), (5, long[:-5] + " end"), (6, None)]


def test_very_long_texts_are_fingerprinted_whole(spark):
    data = long_texts()
    rows = {r.doc_id: r for r in imatch.fingerprints(frame(spark, data)).collect()}
    assert {i: r.n_chars for i, r in rows.items()} == {i: len(t or "") for i, t in data}
    assert rows[1].fingerprint == rows[2].fingerprint != rows[4].fingerprint
    ordered = brute_order(data)
    for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        k = len(t or "") // 2
        edited = (t or "")[:len(t or "") - k] + (u or "")[:k]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_very_long_texts_are_scored(spark):
    data = long_texts()
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.score_documents(frame(spark, data), labels).collect()}
    assert set(rows) == {i for i, _ in data} and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[1].evidence == rows[2].evidence


def test_lexicon_is_the_band_of_document_frequencies(spark):
    import re
    data = [(i, t) for i, t in ROWS if t]
    lex = imatch.lexicon(frame(spark, data), least=0.02, most=0.5)
    df = {}
    for _, t in data:
        terms = {re.sub(r"^\W+|\W+$", "", w.lower()) for w in re.findall(r"[^\x20\x09-\x0D]+", t)} - {""}
        for term in terms:
            df[term] = df.get(term, 0) + 1
    inside = sorted(t for t, n in df.items() if 0.02 * len(data) <= n <= 0.5 * len(data))
    want = np.sort(imatch.term_hashes(pa.array(inside)))
    assert lex.tolist() == want.tolist()


def test_likeness_follows_the_share_of_terms():
    rng = random.Random(2)
    vocab = [f"t{i}" for i in range(5000)]
    printer = imatch.Printer(np.sort(imatch.term_hashes(pa.array(vocab))))
    for n in (20, 200, 2000):
        base = rng.sample(vocab, n)
        near, half, far = base[:], base[:], rng.sample(vocab, n)
        near[0], half[:n // 2] = "t1", rng.sample(vocab, n // 2)
        p = printer.prints([" ".join(x) for x in (base, near, half, far, base)])
        a, b, c = (imatch.likeness(p[0], x) for x in p[1:4])
        assert imatch.likeness(p[0], p[4]) == 1.0
        assert a > 0.8 and a > b > 0.05 and b > c
    assert imatch.likeness(*printer.prints(["", "  "])) == 1.0
    assert imatch.likeness(*printer.prints(["", "t1"])) == 0.0


def test_edited_documents_are_told_from_the_next_ones(spark):
    rows = queries.LLM_QUERIES["op3_imatch"](spark, SF01).where("n_chars > 300").collect()
    above = [(r.near_edited > r.near_next) + 0.5 * (r.near_edited == r.near_next) for r in rows]
    assert sum(above) / len(rows) > 0.97


# ---- quality

def test_held_out_labels_are_predicted(spark):
    """Train on one half of the labelled documents, judge on the other."""
    docs = queries.documents(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    scored = quality.score_documents(docs, labels.where("doc_id % 2 = 0"))
    rows = scored.join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert len(good) > 100 and len(bad) > 10
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def brute_rates(rows, mean, k_host, k_path):
    """Site posteriors by loops over (rid, host, path, y)."""
    out = {}
    for rid, host, path, y in rows:
        h = [r[3] for r in rows if r[1] == host and r[0] != rid]
        p = [r[3] for r in rows if (r[1], r[2]) == (host, path) and r[0] != rid]
        host_rate = (sum(h) + k_host * mean) / (len(h) + k_host)
        out[rid] = (host_rate, (sum(p) + k_path * host_rate) / (len(p) + k_path))
    return out


def test_site_rates_equal_brute_force(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        site = "hot" if i % 3 == 0 else f"h{i % 17}"
        rows.append((i, rng.choice(["plain words here", "### %% !!", None]), site, f"p{i % 2}"))
        labels.append((i, int(rng.random() < (0.9 if site == "hot" else 0.3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_documents(docs, lab).collect()}
    y = dict(labels)
    flat = [(i, s, f"{s}/{p}", y[i]) for i, _, s, p in rows]
    mean = sum(y.values()) / len(y)

    def k(key):
        groups = {}
        for r in flat:
            groups.setdefault(r[1] if key == "host" else r[1:3], []).append(r[3])
        n = sum(map(len, groups.values()))
        spread = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups.values())
        between = (spread - (len(groups) - 1) * mean * (1 - mean)) / (n - sum(len(g) ** 2 for g in groups.values()) / n)
        return min(max(mean * (1 - mean) / between - 1, 1.0), 1e4) if between > 0 else 1e4

    for rid, (h, p) in brute_rates(flat, mean, k("host"), k("path")).items():
        assert got[rid].host_rate == pytest.approx(h, abs=1e-9)
        assert got[rid].path_rate == pytest.approx(min(max(p, 0.001), 0.999), abs=1e-9)
    sparse = [g for i, g in got.items() if i % 3]
    assert all(0 < g.path_rate < 1 for g in sparse)


def test_odd_rows_and_missing_labels(spark):
    df = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score_documents(df, none).collect()
    assert len(rows) == len(ROWS) and all(r.kept for r in rows)
    one = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    assert quality.score_documents(df, one).count() == len(ROWS)
    kept = quality.keep_good(df, one)
    assert kept.columns == df.columns and kept.count() == len(ROWS)
    empty = df.where("false")
    assert quality.score_documents(empty, one).count() == 0
    assert imatch.fingerprints(empty).count() == 0


def test_rejected_documents_go(spark):
    docs, labels = queries.documents(spark, SF001), spark.read.parquet(f"{SF001}/labels.parquet")
    kept = quality.keep_good(docs, labels)
    want = {r.doc_id for r in quality.score_documents(docs, labels).where("kept").collect()}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == want
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(clean & want) >= 0.98 * len(clean)


def test_cut_holds_on_bad_heavy_and_good_heavy_sources(spark):
    """Good documents of a hot bad source stay, plain junk goes there and mostly on a good one."""
    rng = random.Random(12)
    rows, labels, junk = [], [], []
    for i in range(6000):
        source = "bad" if i % 3 == 0 else "good" if i % 3 == 1 else f"s{i % 20}"
        good = rng.random() < {"bad": 0.1, "good": 0.95}.get(source, 0.85)
        marks = rng.uniform(0, 0.55) if good else rng.uniform(0.35, 1)
        if marks > 0.9:
            junk.append(i)
        words = ["%#" if rng.random() < marks else rng.choice(["plain", "words", "here", "and", "there"])
                 for _ in range(40)]
        rows.append((i, " ".join(words), source, "en"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.score_documents(docs, lab, sample_rows=1000).collect()}
    clean = [i for i, y in labels if y]
    assert sum(not kept[i] for i in clean) <= 0.004 * len(clean)
    hot = [i for i in clean if i % 3 == 0]
    assert sum(not kept[i] for i in hot) <= 0.1 * len(hot)
    for k in (0, 1):
        some = [kept[i] for i in junk if i % 3 == k]
        # a good source speaks for its documents: there only most of the junk goes
        assert len(some) > 10 and sum(some) <= (0.4 if k else 0.0) * len(some)


def test_wrong_labels_do_not_pull_the_cut():
    levels = np.arange(-10, 10, 0.5)
    bad = np.where(levels < -4, 200.0, 0.0)
    good = np.where(levels > 0, 1000.0, 0.0)
    good[2:7] = 12  # 60 of 20,000 good labels are on junk, 0.3 %
    bad[levels < -4] += 600
    assert -5 < quality.rejection_cut(levels, good, good + bad) <= 0
    assert quality.rejection_cut(levels, np.zeros(40), bad) == -np.inf
    few = np.where(levels < -9, 5.0, 0.0)  # too few bad labels to tell: the good ones alone decide
    assert quality.rejection_cut(levels, good * (levels > 0), good * (levels > 0) + few) == 0
