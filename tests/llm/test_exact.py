"""Exact dedup: SQL on the given table, hot and odd rows, Misra-Gries guarantee."""

from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from reelstats.llm import exact, queries
from tests.conftest import SF001
from tests.helpers import rows_of


def brute(rows):
    import hashlib
    import re
    groups = {}
    for rid, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append((i is None, i, rid))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2]))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[1], members[0][1], len(members), n == 0, digest) for n, m in enumerate(members)]
    return Counter(out)


ROWS = ([(i, "hot  copy\n") for i in range(40, 0, -1)] + [(100 + i, f"text {i % 7}") for i in range(30)]
        + [(200, None), (201, ""), (202, " \t\n"), (203, " "), (204, "a b"), (205, "a b"), (206, "a\tb"),
           (None, "a b"), (None, "only without id"), (None, "only without id"), (300, "twice"), (300, "twice"),
           (301, "x" * 200_000)])


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "r", "d", 0) for i, t in rows],
                                 "doc_id long, text string, rid string, digest string, n int")


def test_decisions_equal_brute_force(spark):
    for counters in (1, 3, 512):
        got = exact.exact_dedup(frame(spark), counters=counters)
        assert Counter(tuple(r) for r in got.collect()) == brute(ROWS)


def test_kept_documents_keep_their_columns(spark):
    df = frame(spark)
    kept = exact.keep_first(df, counters=2)
    assert kept.columns == df.columns
    want = Counter((d, ) for (d, _, _, k, _), n in brute(ROWS).items() for _ in range(n) if k)
    assert Counter((r.doc_id,) for r in kept.collect()) == want


def test_empty_table(spark):
    assert exact.exact_dedup(frame(spark).where("false")).count() == 0
    assert exact.keep_first(frame(spark).where("false")).count() == 0


def test_query_equals_sql(spark, duck):
    got = queries.LLM_QUERIES["op4_exact_dedup"](spark, SF001)
    cols = sorted(got.columns)
    want = sorted(duck.execute(exact.SQL_EXACT).df()[cols].itertuples(index=False, name=None))
    assert rows_of(got, cols) == want


def test_frequent_digests_are_always_candidates(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm")
                                  .otherwise(F.concat(F.lit("d"), "id")).alias("digest")).repartition(5)
    got = {r.digest for r in exact.heavy_candidates(df, counters=20).collect()}
    assert len(got) <= 20 and {"hot", "warm"} <= got


def test_summary_error_is_bounded():
    import random
    rng = random.Random(3)
    data = [min(int(rng.paretovariate(0.7)), 5000) for _ in range(4000)]
    true, k = Counter(map(str, data)), 16
    batches = [pa.RecordBatch.from_arrays([pa.array(list(map(str, data[a:a + 500])))], names=["digest"])
               for a in range(0, 4000, 500)]
    (out,) = exact.summarise(k)(iter(batches))
    got = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    assert len(got) <= k
    for digest, n in true.items():
        assert n - 4000 / (k + 1) <= got.get(digest, 0) <= n
