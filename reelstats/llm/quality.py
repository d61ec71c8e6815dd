"""Quality classification with hierarchical empirical Bayes over sites.

1. A logistic model of a few features of the whole text gives every document an
   evidence probability.  It is fitted on a bounded sample of labelled documents.
2. Grouped sums over all documents (labels where known, evidence elsewhere) give
   each host and each path its quality.  Both are Beta-binomial: the strength of
   the prior comes from the spread between sites by the method of moments, so a
   site with few documents is shrunk toward its parent: path toward host, host
   toward the global rate.
3. A document's log odds are its evidence's, shifted by those of its path against
   the global rate, without the document's own share in its site's sums.
4. Documents below a threshold go; it is set on the final scores of all labelled
   documents outside the fit, so that at most ``LOST`` of the good ones fall below
   it.  Where nearly all labels are bad, documents go even if a few say good.

Defined results: null is empty text; a missing host or path counts as one site
with an empty name; documents labelled more than once count with their mean;
without both classes among the labels the evidence is the global rate and every
document stays; documents of equal scores share their fate; texts of any length are
read whole; repeated rows give repeated results; an empty table gives no rows;
other columns never matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm.words import Words, slices, texts_of
from reelstats.operators.skew import hot_keys, split_join
from reelstats.session import materialize

# About so many labelled documents are sampled for the fit, one in HELD_OUT of them left out of it.
SAMPLE_ROWS, HELD_OUT, LOST, RIDGE = 20_000, 4, 0.002, 1.0
# Wrong labels: documents go where at most RARE of the labels are good, if that costs at most NOISE of the good ones.
# The threshold is searched on levels of STEP log odds.
RARE, NOISE, STEP = 0.02, 0.01, 0.001
FEATURES = ["log_words", "word_length", "upper", "digits", "symbols", "marks", "foreign", "bars", "marked_words",
            "distinct", "top_word", "runs", "line_length", "repeated_lines"]
KEPT = "rid long, doc_id long, tie long, host string, path string, features array<double>"


def byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


UPPER = byte_class(bytes(range(65, 91)))
LETTER = byte_class(bytes([*range(65, 91), *range(97, 123)])) | (np.arange(256) >= 128)
DIGIT = byte_class(b"0123456789")
SYMBOL = byte_class(b"#$%&*+<=>@[\\]^_`{}~/!")
MARK = byte_class(b".,;:?'\"()-")
SPACE = byte_class(b" \t\n\r\x0b\x0c")
FOREIGN = np.arange(256) >= 0xC0  # first bytes of characters outside ASCII


def text_features(texts: pa.Array) -> np.ndarray:
    """(documents, FEATURES): shares of kinds of characters, and how words and lines repeat."""
    n = len(texts)
    raw = [t.encode() for t in texts.to_pylist()]
    data = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(r) for r in raw])
    ends = np.concatenate([[0], np.cumsum(size)])

    def per_doc(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return np.diff(sums[ends]).astype(np.float64)

    solid = np.maximum(size - per_doc(SPACE), 1)
    words = Words(texts)
    counts = words.counts
    ends_marked = np.array([w[-1:] in "#$%&*+<=>@[\\]^_`{}~/!|" for w in words.vocab.to_pylist()], bool)
    marked = np.concatenate([[0], np.cumsum(ends_marked[words.codes])]) if len(words.vocab) else np.zeros(1)
    same = np.zeros(len(words.codes) + 1)
    same[2:] = np.cumsum(words.codes[1:] == words.codes[:-1]) if len(words.codes) > 1 else 0
    out = np.zeros((n, len(FEATURES)))
    for r in range(n):
        a, b = words.offsets[r], words.offsets[r + 1]
        lines = raw[r].split(b"\n")
        if b > a:
            _, times = np.unique(words.codes[a:b], return_counts=True)
            runs = same[b] - same[min(a + 1, b)] if b - a > 1 else 0
            out[r, 8:12] = ((marked[b] - marked[a]) / (b - a), len(times) / (b - a) ** 0.8,
                            times.max() / (b - a) if b - a > 4 else 0, runs / (b - a))
        out[r, 12:14] = np.log1p(size[r] / len(lines)), 1 - len(set(lines)) / len(lines)
    out[:, 0] = np.log1p(counts)
    out[:, 1] = np.minimum(solid / np.maximum(counts, 1), 40)
    out[:, 2] = per_doc(UPPER) / np.maximum(per_doc(LETTER), 1)
    for j, table in zip(range(3, 8), (DIGIT, SYMBOL, MARK, FOREIGN, byte_class(b"|"))):
        out[:, j] = per_doc(table) / solid
    return out


def feature_rows(batches):
    for batch in slices(batches, max_bytes=4 << 20):
        x = text_features(texts_of(batch))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("rid", "doc_id", "tie", "host", "path")), lists],
            names=["rid", "doc_id", "tie", "host", "path", "features"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 30):
    """Ridge-penalised logistic regression by Newton steps on standardised features: (weights, intercept)."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def rejection_cut(levels: np.ndarray, good: np.ndarray, total: np.ndarray) -> float:
    """Score below which documents go, from the labelled documents (and good ones of them) at ascending levels.

    At most LOST of the good ones are below it.  Where labels are so rarely good that they are rather wrong
    (isotonic share of at most RARE), documents go in any case, if that costs at most NOISE of the good ones.
    """
    if not good.sum():
        return -np.inf
    below = np.cumsum(good) - good
    cut = levels[np.flatnonzero(below <= LOST * good.sum())[-1]] - 0.5
    blocks: list[list[float]] = []  # good, all, last place
    for i, (g, n) in enumerate(zip(good.tolist(), total.tolist())):
        blocks.append([g, n, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, n, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + n, last]
    lost, seen = 0.0, 0.0
    for g, n, last in blocks:
        lost, seen = lost + g, seen + n
        if g > RARE * n or lost > NOISE * good.sum():
            break
        if (lost + 1) / (seen + 2) <= RARE:
            cut = max(cut, levels[last] + STEP)
    return float(min(cut, 0.0))


def logit(p: F.Column) -> F.Column:
    return F.log(p / (1 - p))


def expit(z: F.Column) -> F.Column:
    return 1 / (1 + F.exp(-z))


def strength(sites: DataFrame, mean: float) -> float:
    """Prior strength (in documents) of Beta-binomial sites, by moments: small where sites differ more than chance."""
    row = sites.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                    F.sum(F.col("n") * (F.col("s") / F.col("n") - mean) ** 2).alias("spread"),
                    F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not row.n or row.k < 2:
        return 100.0
    chance = mean * (1 - mean)
    excess = row.spread - (row.k - 1) * chance
    room = row.n - row.nn / row.n
    between = max(excess / max(room, 1e-9), 0.0)
    return float(np.clip(chance / between - 1, 1.0, 1e4)) if between > 0 else 1e4


def score_documents(docs: DataFrame, labels: DataFrame, host: F.Column | None = None, path: F.Column | None = None,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row a document: doc_id, tie, evidence, host_rate, path_rate, score, kept."""
    spark = docs.sparkSession
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", "source", "lang") if path is None else path
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text_col).alias("tie"), F.coalesce(host, F.lit("")).alias("host"),
                       F.coalesce(path, F.lit("")).alias("path"), F.col(text_col).alias("text"))
    rows = materialize(rows.mapInArrow(feature_rows, KEPT), "quality-features")
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg(label_col).alias("label")))
    labelled = rows.join(known, "doc_id", "left")

    # a bounded sample of labelled documents by a hash, the same whatever the partitioning
    share = min(1.0, sample_rows / max(labelled.where("label is not null").count(), 1))
    key = F.xxhash64("doc_id", "tie")
    labelled = labelled.withColumn("in_fit", F.col("label").isNotNull()
                                   & (F.pmod(key, F.lit(1 << 30)) < int(share * (1 << 30)))
                                   & (F.pmod(F.shiftrightunsigned(key, 30), F.lit(HELD_OUT)) != 0))
    sample = (labelled.where("in_fit").select(key.alias("key"), "label", "features").toPandas()
              .sort_values("key", kind="stable"))
    fitted, weights, intercept = False, np.zeros(len(FEATURES)), 0.0
    if len(sample):
        x, y = np.stack(sample["features"].to_numpy()), sample["label"].to_numpy(np.float64)
        fitted = len(np.unique(y >= 0.5)) == 2
        if fitted:
            weights, intercept = fit_logistic(x, y)

    linear = F.aggregate(F.zip_with("features", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b),
                         F.lit(float(intercept)), lambda a, b: a + b)
    scored = labelled.select("rid", "doc_id", "tie", "host", "path", "label", "in_fit",
                             F.greatest(F.least(linear, F.lit(12.0)), F.lit(-12.0)).alias("z"))
    scored = scored.withColumn("y", F.coalesce("label", expit(F.col("z")) if fitted else F.lit(None).cast("double")))
    paths = materialize(scored.groupBy("host", "path").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
                        .where("n > 0"), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    total = hosts.agg(F.sum("s"), F.sum("n")).first()
    mean = float(np.clip((total[0] or 0.0) / total[1], 0.01, 0.99)) if total[1] else 0.5
    k_host, k_path = strength(hosts, mean), strength(paths, mean)

    sites = split_join(paths.withColumnsRenamed({"s": "path_s", "n": "path_n"}),
                       hosts.withColumnsRenamed({"s": "host_s", "n": "host_n"}), "host", "left")
    placed = split_join(scored, sites, ["host", "path"], "left", hot=hot_keys(rows, ["host", "path"]))
    own, counted = F.coalesce("y", F.lit(0.0)), F.col("y").isNotNull().cast("int")

    def rest(name: str) -> F.Column:
        return F.greatest(F.coalesce(F.col(f"{name}_s"), F.lit(0.0)) - own, F.lit(0.0))

    def others(name: str) -> F.Column:
        return F.coalesce(F.col(f"{name}_n"), F.lit(0)) - counted

    host_rate = (rest("host") + k_host * mean) / (others("host") + k_host)
    placed = placed.withColumn("host_rate", host_rate)
    path_rate = (rest("path") + k_path * F.col("host_rate")) / (others("path") + k_path)
    placed = placed.withColumn("path_rate", F.greatest(F.least(path_rate, F.lit(0.999)), F.lit(0.001)))
    base = float(np.log(mean / (1 - mean)))
    total_z = (F.col("z") if fitted else F.lit(base)) + logit(F.col("path_rate")) - base
    final = placed.select("doc_id", "tie", (expit(F.col("z")) if fitted else F.lit(mean)).alias("evidence"),
                          "host_rate", "path_rate", total_z.alias("total_z"), "label", "in_fit")
    kept = F.lit(True)
    if fitted:
        final = materialize(final, "quality-scores")
        # a bounded number of levels, whatever the number of labels
        levels = (final.where("label is not null and not in_fit")
                  .groupBy(F.floor(F.col("total_z") / STEP).alias("level"))
                  .agg(F.count_if(F.col("label") >= 0.5).alias("good"), F.count(F.lit(1)).alias("n"))
                  .toPandas().sort_values("level"))
        kept = F.col("total_z") >= rejection_cut(levels["level"].to_numpy(np.float64) * STEP,
                                                 levels["good"].to_numpy(np.float64),
                                                 levels["n"].to_numpy(np.float64))
    return final.select("doc_id", "tie", "evidence", "host_rate", "path_rate", expit(F.col("total_z")).alias("score"),
                        kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    bad = (score_documents(docs, labels, id_col=id_col, text_col=text_col, **options).where("not kept")
           .select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).distinct())
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                         F.col(id_col).cast("long").alias("_doc"), F.xxhash64(text_col).alias("_hash"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie"))
    return packed.join(bad, same, "left_anti").select("row.*")
