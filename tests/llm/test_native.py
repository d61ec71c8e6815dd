"""License scans and personal data (DataFrame operations only) against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelstats.llm import licenses, pii, queries
from tests.conftest import SF001
from tests.helpers import norm, rows_of

MIT = next(t for label, t in licenses.NOTICES if label == "mit")
GPL = next(t for label, t in licenses.NOTICES if label == "gpl")
TEXTS = [
    None, "", " ", "Released Under  THE\nMIT-License.", "under the mit licenses", "under the, mit license under the mit license",
    "Apache License, Version 2.0 and CC-BY-NC cc by nc 4.0", "cc by nc by nc cc", "x", "a b", "é under the mit license é",
    "Licensed under the GNU General Public License, version 3.", MIT.upper(), MIT.replace("merge ", "") + " more",
    " ".join(MIT.split()[:12]), "w " * 5000 + "cc by nc", "ÀB unDER The MİT license", "cc_by_nc", "cc\x00by\x7fnc",
    "me@x.y a.b+c%d@e-f.gh.ij. @x.y a@b a@b..c x@y.z@q.r _foo@bar.com;é@ü.de für@x.de",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0004 1.2.3 999.1.1.1 12345678901.1.1.1 1.2.3.4a",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111111111 378282246310005 0 0 0 00000000000000",
    "1 2 3 4 5 6 7 8 9 " * 400, "+1 (555) 010-9999 +1 +12 +1234567890 +1--2 +123456789012345 +1234567890123456 ++49 30 1234567",
    "call +1 (017) 555-7713, mail über@x.example.com; " * 3, "9" * 30_000, "a" * 3000 + "@", "1." * 900, "+" * 5000 + "1 ( 2",
    "🙂🙂 a@b.cd 🙂 4111111111111111 é+49 30 1234567890", "a@b.cd\r\n1.2.3.4\t4111 1111 1111 1111\x0b+1 234 567 8901",
]


def frame(spark, texts=TEXTS):
    rows = [(i, t, 0, "c", "k") for i, t in enumerate(texts)] + [(None, "cc by nc a@b.cd", 0, "c", "k"),
                                                                 (5, texts[5] if len(texts) > 5 else "", 0, "c", "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, rid int, words string, kind string")


def sample_texts(n=60):
    import pyarrow.parquet as pq
    return pq.read_table(f"{SF001}/documents.parquet")["text"].to_pylist()[:n]


def brute_base_places(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(i, label) for label, phrase in licenses.BASE for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), places


def test_base_phrases_equal_brute_force(spark):
    df = frame(spark)
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                  for r in licenses.label_documents(df).collect())
    want = Counter()
    for r in df.collect():
        n, places = brute_base_places(r.text)
        starts = [p for p, _ in places]
        want[(r.doc_id, n, len(places), min(starts, default=None), max(starts, default=None),
              ",".join(sorted({x for _, x in places})))] += 1
    assert got == want


def test_notices_are_found_with_words_lost_and_added(spark):
    rows = {r.doc_id: r for r in licenses.label_documents(frame(spark)).collect()}
    assert rows[12].labels == "mit" and rows[12].score == 1.0 and rows[12].n_base == 0
    assert rows[13].labels == "mit" and 0.7 <= rows[13].score < 1.0
    assert rows[14].labels == "" and rows[14].score == 0.0
    assert rows[11].labels == "gpl-3"


def brute_labels(text):
    """Labels and score: distinct template places over every neighbourhood of diagonals, the best of those that overlap."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    grams = [" ".join(words[i:i + licenses.K]) for i in range(len(words) - licenses.K + 1)]
    labels, score = set(), 0.0
    for _, label, _, keys, shift, least in licenses.template_rows():
        lines = {}
        for at, gram in enumerate(grams):
            for place, key in enumerate(keys):
                if gram == key:
                    lines.setdefault(at - place, set()).add(place)
        shares = {d: len(set().union(*(p for e, p in lines.items() if d <= e <= d + shift))) / len(keys)
                  for d in lines}
        for d, share in shares.items():
            rivals = [] if not shift else [e for e in shares if abs(e - d) <= licenses.MAX_SHIFT]
            if share >= least and all((shares[e], -e) <= (share, -d) for e in rivals):
                labels.add(label)
                score = max(score, share)
    return ",".join(sorted(labels)), score


REPEATS = ["under the terms " * 20, "under the terms " * 19 + GPL, GPL + " under the terms" * 40,
           " ".join(w for i, w in enumerate(GPL.split()) if i % 14 != 4), GPL.replace("or modify", "or to use and modify"),
           MIT + " " + MIT, " ".join(t for _, t in licenses.NOTICES), "free software " * 3000 + GPL]


def test_repeated_words_are_no_notice(spark):
    rows = {r.doc_id: r for r in licenses.label_documents(frame(spark, REPEATS)).collect()}
    assert (rows[0].labels, rows[0].score) == ("", 0.0)
    assert [rows[i].labels for i in (1, 2, 3, 4, 7)] == ["gpl"] * 5
    assert rows[3].score < 1.0 and rows[4].score < 1.0
    assert rows[6].labels == ",".join(sorted({label for label, _ in licenses.NOTICES}))


def test_labels_equal_brute_force(spark):
    texts = REPEATS + TEXTS + sample_texts(40)
    got = Counter((r.doc_id, r.labels, round(r.score, 12)) for r in licenses.label_documents(frame(spark, texts)).collect())
    want = Counter((r.doc_id, brute_labels(r.text)[0], round(brute_labels(r.text)[1], 12))
                   for r in frame(spark, texts).collect())
    assert got == want


@pytest.mark.parametrize("source", ["odd", "given"])
def test_license_query_equals_sql(spark, duck, source):
    import duckdb
    if source == "given":
        got, con = queries.LLM_QUERIES["op5_license_scan"](spark, SF001), duck
    else:
        df = frame(spark, TEXTS + REPEATS)
        got, con = licenses.label_documents(df), duckdb.connect()
        con.register("documents", df.select("doc_id", "text").toArrow())
    cols = sorted(got.columns)
    want = [tuple(norm(v) for v in r)
            for r in con.execute(f"SELECT {', '.join(cols)} FROM ({licenses.sql()})").fetchall()]
    assert Counter(rows_of(got, cols)) == Counter(want)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(number) <= 19 and luhn(number)):
                continue
            if kind == "phone" and not 10 <= len(number) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def check_spans(rows, texts):
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r.doc_id, joined, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == k for x in want) for k in PATTERNS]
        spans = [tuple(s.split(":")) for s in r.spans.split(",")] if r.spans else []
        assert {(k, str(a), str(b)) for a, _, b, k in want} <= set(spans)
        order = [(int(a), list(PATTERNS).index(k), int(b)) for k, a, b in spans]
        assert order == sorted(order) and len(set(spans)) == len(spans)


def test_base_spans_equal_brute_force(spark):
    texts = TEXTS + sample_texts()
    df = frame(spark, texts).where("doc_id is not null")
    rows = pii.label_documents(df).collect()
    assert len(rows) == len(texts) + 1
    check_spans(rows, texts)


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 400_000 + "@", "9" * 400_000, "1 " * 200_000, "+" * 200_000]
    rows = pii.label_documents(frame(spark, texts).where("doc_id < 4")).collect()
    assert all(r.spans == "" for r in rows)


def test_possessive_patterns_find_the_same_matches(spark):
    """All short strings over a small alphabet, every base kind."""
    import itertools
    for kind, alphabet in (("email", "a@.%"), ("ip", "1.2a"), ("card", "1 -a"), ("phone", "+1(a")):
        texts = ["".join(x) for n in range(1, 7) for x in itertools.product(alphabet, repeat=n)]
        if kind == "ip":
            texts = ["1.2.3." + t for t in texts]
        if kind == "email":
            texts = [t + "a@a.a" for t in texts]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(
            "t", F.regexp_extract_all("t", F.lit(pii.BASE[kind]), F.lit(0)).alias("m"))
        for r in df.collect():
            assert r.m == [m[0] for m in re.finditer(PATTERNS[kind], r.t)], (kind, r.t)


def test_redaction_removes_every_selected_span(spark):
    texts = TEXTS[18:25] + TEXTS[29:] + [None, "", "nothing here"]
    df = frame(spark, texts)
    spans = {(r.doc_id): r.spans for r in pii.label_documents(df).collect()}
    out = pii.redact(df)
    assert out.columns == df.columns and out.count() == df.count()
    for r in out.where("doc_id is not null").collect():
        text = texts[r.doc_id]
        cuts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans[r.doc_id].split(",") if s))
        merged = []
        for a, b, k in sorted(cuts, key=lambda c: (c[0], -c[1], c[2])):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b, k])
        want, at = "", 0
        for a, b, k in merged:
            want += text[at:a] + f"[{k.upper()}]"
            at = b
        assert r.text == (text if text is None else want + text[at:])


def test_empty_tables_and_single_class(spark):
    none = frame(spark).where("false")
    assert licenses.label_documents(none).count() == 0
    assert pii.label_documents(none).count() == 0
    assert pii.redact(none).count() == 0
    plain = spark.createDataFrame([(1, "no numbers"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.spans) for r in pii.label_documents(plain).collect()) == [(1, ""), (2, "")]


def test_plans_hold_no_python(spark):
    for name in ("op5_license_scan", "op7_pii"):
        plan = queries.LLM_QUERIES[name](spark, SF001)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_trees_find_what_the_base_pattern_swallows(spark):
    """A phone number and an address in a row are one failing base match; the proposals hold the phone alone."""
    import random
    rng = random.Random(8)

    def n(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    texts = []
    for _ in range(300):
        texts += [f"word +1 ({n(3)}) 555-{n(4)} word", f"some {n(16)} number", f"x{n(2)}@mail{n(1)}.example.com here",
                  f"at {rng.randint(1, 255)}.{rng.randint(1, 255)}.1.{rng.randint(1, 255)} host"]
    texts.append("Des +1 (826) 555-4081 190.137.223.204 du")
    rows = {r.doc_id: r for r in pii.label_documents(frame(spark, texts)).where("doc_id is not null").collect()}
    last = rows[len(texts) - 1]
    assert (last.n_phone, last.n_ip) == (0, 1)
    assert last.spans == "phone:4:21,ip:22:37"
    plain = [rows[i] for i in range(1, 1200, 4)]  # sixteen digits: redacted when the checksum holds
    assert all(r.spans == "" or r.n_card == 1 for r in plain)


def test_rare_kinds_keep_their_threshold_among_many_numbers(spark):
    """A small fit sample and a table full of numbers: each kind's threshold comes from all its candidates."""
    import random
    rng = random.Random(3)

    def n(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    texts = [" ".join(f"w {n(2)}" for _ in range(100)) for _ in range(200)]
    texts += [f"word +1 ({n(3)}) 555-{n(4)} word" for _ in range(200)]
    texts += ["Des +1 (826) 555-4081 190.137.223.204 du"] * 3
    candidates = pii.described(pii.proposals(frame(spark, texts), "doc_id", "text"))
    for rows in (100, 8000):
        got = pii.score_candidates(candidates, sample_rows=rows).where("selected")
        spans = {(r.doc_id, r.kind, r.start, r.end) for r in got.collect()}
        assert {(i, "phone", 4, 21) for i in range(400, 403)} <= spans
        assert not [s for s in spans if s[0] is not None and 5 < s[0] < 200]


def test_fit_shares_are_bounded_and_leave_a_rest():
    counts = {("card", 0.0): 10**9, ("email", 1.0): 186, ("ip", 1.0): 4, ("phone", 1.0): 10**6}
    shares = pii.fit_shares(counts, 8000)
    assert sum(shares[s] * n for s, n in counts.items()) == pytest.approx(8000)
    assert shares[("ip", 1.0)] == shares[("email", 1.0)] == 0.75 and max(shares.values()) < 1
    assert shares[("phone", 1.0)] * 10**6 == pytest.approx(shares[("card", 0.0)] * 10**9)


def test_many_disguised_spans_are_found(spark):
    """Half of the personal data disguised: more spans of a form do not make it less believable."""
    import random
    rng = random.Random(5)

    def n(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    texts, want = [], []
    for i in range(300):
        forms = [("email", f"x{n(2)} (at) host{n(1)} (dot) org"), ("email", f"jörg{n(2)}@höst.de"),
                 ("phone", f"0049 {rng.randint(100, 999)} 555 {n(4)}"), ("email", f"x{n(2)}@mail.example.com"),
                 ("phone", f"+1 ({n(3)}) 555-{n(4)}")]
        for kind, form in forms:
            want.append((len(texts), f"{kind}:5:{5 + len(form)}"))
            texts.append(f"word {form} word")
        texts += [f"some {n(16)} number", f"at 999.{n(3)}.1.1 host", f"call +1 {n(3)} end"]
    rows = {r.doc_id: r.spans.split(",") for r in pii.label_documents(frame(spark, texts))
            .where("doc_id is not null and doc_id <> 5").collect()}
    found = [span in rows[i] for i, span in want if i != 5]
    assert sum(found) >= 0.99 * len(found)
    assert all(rows[i] == [""] for i in range(len(texts)) if i % 8 in (6, 7) and "999" in texts[i])


def test_weak_labels_follow_the_format(spark):
    forms = [("email", "a (at) b (dot) org", 1.0), ("email", "für@x.de", 1.0), ("email", "see @ home.de", None),
             ("email", "a [at] b.1", 0.0), ("phone", "0049 30 123 4567", 1.0), ("phone", "0049 30 12", 0.0),
             ("ip", "1.2.3.4", 1.0), ("ip", "1,2,3,4", None), ("ip", "1:2:3:999", 0.0),
             ("card", "4111.1111.1111.1111", 1.0), ("card", "4111/1111/1111/1112", 0.0),
             ("card", "4111/1111-1111 1111", 0.0)]
    df = spark.createDataFrame(forms, "kind string, m string, want double")
    m = pii.plain(F.col("kind"), F.col("m"))
    for r in df.select("*", pii.weak_label(F.col("kind"), m).alias("got")).collect():
        assert r.got == r.want, r
