"""Personal data by candidate gradient boosting, in DataFrame operations and Spark ML only.

1. Generators propose spans of whole texts: the fixed base pattern of each kind
   and a looser one of high recall; spans may overlap.
2. Features of format and context describe every distinct span.
3. Boosted trees, trained on a bounded sample of the corpus's own candidates of
   every kind and label, give each span a probability.  The labels are weak: a span
   is positive if it is a valid base match or, undisguised, passes the format check
   of its kind, negative if it fails it; a span that proves neither is in no sample.
4. Per kind, the smallest probability at which the candidates outside the fit, all
   of them, reach the target precision selects further spans.  Valid base matches
   always stay.

Places are code points, the end exclusive.  Text is cut by each pattern; the
running lengths of the pieces and matches of a document give the places.

Defined results: null is empty text; documents without a span have zero counts;
repeated rows give repeated results; of equal spans the kind listed first stands;
texts of any length are scanned whole; a sample with one class only selects the
spans that are valid by their format; an empty table gives no rows; other columns
never matter.  A disguised address with over 64 characters before the (at) or over
eight domain labels is not proposed by the loose pattern.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.session import materialize

KINDS = ("email", "ip", "card", "phone")

# The base patterns are email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+,
# ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), card [0-9]([\x20-]?[0-9])+ and phone
# \+[0-9][\x20().0-9-]+[0-9].  Written here with possessive loops and, where a match could only
# start at a run's first character or where the last match ended, with that said: the same
# matches in linear time and without recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?=[\x20-]?[0-9])[0-9]*+(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = [
    ("email", r"(?:\G|(?<![\pL0-9._%+-]))[\pL0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[\pL0-9-]{1,63}+"
              r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[\pL0-9-]{1,63}+){1,8}+"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]{1,4}+(?:[.:,][0-9]{1,4}+){3}+(?![0-9])"),
    ("card", r"(?:\G|(?<![0-9]))[0-9]{3,6}+(?:[\x20./-]?[0-9]{2,6}+){2,5}+(?![0-9])"),
    ("phone", r"(?:\+|\b00)[1-9][0-9]{0,2}[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"),
    ("phone", r"(?:\+|\b00)[1-9][0-9]{0,2}[\x20.-]\(?[0-9]{1,4}\)?(?:[\x20.-][0-9]{2,4}){1,4}(?![0-9.])"),
]
CONTEXT = 24
CUES = r"(?i)(?:phone|tel|call|fax|mobile|mail|contact|card|visa|account|host|server|ip)\W*$"

# Training: at most about so many candidates sampled by a hash, dealt over the kinds and labels; one in HELD_OUT of a
# kind and label at least, and all beyond the sample, are for calibration.
SAMPLE_ROWS, HELD_OUT, PRECISION = 8000, 4, 0.97
TREES, DEPTH = 8, 3

FEATURES = ["n_chars", "n_digits", "n_letters", "n_foreign", "n_marks", "n_blanks", "n_groups", "first_digit",
            "has_at", "has_plus", "checksum", "top_octet", "dotted_tail", "cue", "glued_before", "glued_after",
            "is_email", "is_ip", "is_card", "is_phone"]


def digits(col: F.Column) -> F.Column:
    return F.regexp_replace(col, "[^0-9]", "")


def luhn(number: F.Column) -> F.Column:
    """Whether a string of digits passes the Luhn check."""
    # from the right: every second digit doubled, its digits added
    values = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1))
        .otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def base_valid(kind: F.Column, match: F.Column) -> F.Column:
    """Whether a base match is accepted."""
    number = digits(match)
    n = F.length(number)
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", small_parts(match))
            .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), luhn(number)).otherwise(False))
            .otherwise(n.between(10, 15)))


def small_parts(match: F.Column) -> F.Column:
    """All parts between dots at most 255, whatever their leading zeros."""
    return F.forall(F.split(match, "[.]"), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "").rlike(
        "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def plain(kind: F.Column, match: F.Column) -> F.Column:
    """A match as it is written undisguised: (at) as @, (dot) as a dot, a leading 00 as +."""
    mail = F.regexp_replace(F.regexp_replace(match, r"\x20?(?:\(at\)|\[at\])\x20?", "@"),
                            r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")
    return (F.when(kind == "email", mail).when(kind == "phone", F.regexp_replace(match, "^00", "+")).otherwise(match))


def mixed_marks(match: F.Column) -> F.Column:
    """Whether more than one kind of mark parts the digits."""
    return F.regexp_replace(match, "[0-9]", "").rlike(r"^(.).*(?!\1).")


def weak_label(kind: F.Column, match: F.Column) -> F.Column:
    """Label of an undisguised loose match by its format alone: 1 passes, 0 fails, null if the form proves nothing.

    Digit count, checksum and marks of one kind (card), digit count (phone), octet range (ip) and tail (email).  Nothing is proven
    by octets in range between commas or colons, or by an address with blanks around its @.
    """
    n = F.length(digits(match))
    octets = small_parts(F.regexp_replace(match, "[:,]", "."))
    tail = match.rlike(r"\.\pL{2,24}$")
    return (F.when(kind == "email", F.when(~tail, 0.0).when(~match.contains(" "), 1.0))
            .when(kind == "ip", F.when(~octets, 0.0).when(~match.rlike("[:,]"), 1.0))
            .when(kind == "card", (base_valid(kind, match) & ~mixed_marks(match)).cast("double"))
            .otherwise(base_valid(kind, match).cast("double")))


def _proposal(named: list[F.Column], z: F.Column, n: F.Column) -> F.Column:
    return F.struct(*named, n.alias("n"), z["match"].alias("match"), F.char_length(z["before"]).alias("gap"),
                    F.right(z["before"], F.lit(CONTEXT)).alias("left"),
                    F.left(z["after"], F.lit(CONTEXT)).alias("right"))


def proposals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per proposed span, and one without a span per document: the generators' matches with their places."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie"), text.alias("text"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id())
    patterns = [(k, True, BASE[k]) for k in KINDS] + [(k, False, pattern) for k, pattern in LOOSE]
    # a cheap test spares most texts the pattern
    guard = {"email": F.col("text").rlike(r"@|[(\[]at[)\]]"), "ip": F.col("has_digit"), "card": F.col("has_digit"),
             "phone": F.col("has_digit")}
    rows = rows.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    none = F.array().cast("array<string>")
    for i, (kind, _, pattern) in enumerate(patterns):
        rows = rows.withColumn(f"m{i}", F.when(guard[kind], F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
                               .otherwise(none))
    for i, (_, _, pattern) in enumerate(patterns):
        rows = rows.withColumn(f"p{i}", F.when(F.size(f"m{i}") > 0, F.split("text", pattern, -1)).otherwise(none))
    parts = []
    for i, (kind, base, _) in enumerate(patterns):
        cut = F.arrays_zip(F.col(f"m{i}").alias("match"), F.slice(f"p{i}", 1, F.size(f"m{i}")).alias("before"),
                           F.slice(f"p{i}", 2, F.size(f"m{i}")).alias("after"))
        named = [F.lit(i).alias("generator"), F.lit(kind).alias("kind"), F.lit(base).alias("is_base")]
        parts.append(F.transform(cut, partial(_proposal, named)))
    spans = rows.select("rid", "doc_id", "tie", F.explode_outer(F.concat(*parts)).alias("s")).select(
        "rid", "doc_id", "tie", "s.*").repartition("rid")
    order = Window.partitionBy("rid", "generator").orderBy("n")
    size = F.char_length("match")
    end = F.sum(F.col("gap") + size).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return spans.withColumn("end", end).withColumn("start", F.col("end") - size)


def described(spans: DataFrame) -> DataFrame:
    """One row per distinct span of a document, with its features; documents without spans keep a row of nulls."""
    m = F.col("plain")
    number = digits(m)

    def count(pattern: str) -> F.Column:
        return F.length(F.regexp_replace(m, pattern, ""))

    distinct = spans.groupBy("rid", "doc_id", "tie", "kind", "start", "end").agg(
        F.max(F.col("is_base") & base_valid(F.col("kind"), F.col("match"))).alias("is_base"),
        F.first("match").alias("match"), F.first("left").alias("left"), F.first("right").alias("right"),
        F.max("is_base").alias("by_base"))
    distinct = distinct.withColumn("plain", plain(F.col("kind"), F.col("match")))
    # a span that the base pattern matches is judged by the base rule alone
    distinct = distinct.withColumn("label", F.when(F.col("by_base"), F.col("is_base").cast("double"))
                                   .otherwise(weak_label(F.col("kind"), m)))
    octets = F.transform(F.split(m, "[.:,]"), lambda x: F.least(F.coalesce(F.try_to_number(
        F.left(F.regexp_replace(x, "[^0-9]", ""), F.lit(6)), F.lit("999999")).cast("double"), F.lit(0.0)),
        F.lit(1000.0)))
    features = {
        "n_chars": F.least(F.char_length(m), F.lit(200)), "n_digits": F.least(F.length(number), F.lit(100)),
        "n_letters": count("[^A-Za-z]"), "n_foreign": F.char_length(F.regexp_replace(m, r"[\x00-\x7F]", "")),
        "n_marks": count(r"[\pL0-9\s]"), "n_blanks": count(r"\S"),
        "n_groups": F.size(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))),
        "first_digit": F.coalesce(F.try_to_number(F.left(number, F.lit(1)), F.lit("9")).cast("int"), F.lit(-1)),
        "has_at": m.contains("@").cast("int"), "has_plus": m.startswith("+").cast("int"),
        "checksum": F.coalesce(F.when(F.length(number).between(10, 25) & (F.col("by_base") | ~mixed_marks(m)),
                                      luhn(number)), F.lit(False)).cast("int"),
        "top_octet": F.when(F.col("kind") == "ip", F.array_max(octets)).otherwise(0),
        "dotted_tail": m.rlike(r"\.[A-Za-z]{2,10}$").cast("int"), "cue": F.col("left").rlike(CUES).cast("int"),
        "glued_before": F.col("left").rlike(r"[\pL0-9]$").cast("int"),
        "glued_after": F.col("right").rlike(r"^[\pL0-9]").cast("int"),
        **{f"is_{k}": (F.col("kind") == k).cast("int") for k in KINDS},
    }
    return distinct.select("rid", "doc_id", "tie", "kind", "start", "end", "is_base", "label",
                           *[F.coalesce(features[name].cast("double"), F.lit(0.0)).alias(name) for name in FEATURES])


def fit_shares(counts: dict[tuple, int], rows: int) -> dict[tuple, float]:
    """Share of each stratum that is fitted on: equal numbers of rows, what small strata leave going to larger ones.

    One in HELD_OUT rows of a stratum stays outside the fit, however small it is.
    """
    out, left = {}, float(rows)
    for i, (stratum, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        take = min(n * (1 - 1 / HELD_OUT), left / (len(counts) - i))
        out[stratum] = take / n
        left -= take
    return out


def score_candidates(candidates: DataFrame, sample_rows: int = SAMPLE_ROWS, precision: float = PRECISION) -> DataFrame:
    """Add ``selected``: valid base spans, and candidates whose probability reaches their kind's threshold."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    # two strata a kind
    counts = {(r.kind, r.label): r.n for r in candidates.where("label is not null").groupBy("kind", "label")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = fit_shares(counts, sample_rows)

    def of_stratum(values: dict[tuple, float]) -> F.Column:
        return F.coalesce(*[F.when((F.col("kind") == k) & (F.col("label") == y), F.lit(v))
                            for (k, y), v in values.items()], F.lit(0.0))

    # a bounded sample of every stratum, the same whatever the partitioning
    labelled = (candidates.withColumn("key", F.xxhash64("doc_id", "tie", "kind", "start", "end"))
                .withColumn("fitted", F.pmod("key", F.lit(1 << 30)) < of_stratum(shares) * (1 << 30)))
    sample = materialize(labelled.where("fitted").repartition(1).sortWithinPartitions("key", "kind", "start", "end")
                         .select("label", *FEATURES), "pii-sample")
    classes = sample.agg(F.count_distinct("label")).first()[0]
    if classes < 2:
        return candidates.withColumn("selected", F.coalesce(F.col("label") == 1, F.lit(False)))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=17).fit(assembler.transform(sample))
    scored = materialize(
        model.transform(assembler.transform(labelled))
        .withColumn("probability", F.round(vector_to_array("probability")[1], 6))
        .drop("features", "rawPrediction", "prediction", "key", *FEATURES), "pii-scored")

    # calibration: the smallest probability from which on the candidates outside the fit are precise enough;
    # each stands for its stratum, of which the fit took a share
    weight = of_stratum({stratum: 1 / (1 - share) for stratum, share in shares.items()})
    order = Window.partitionBy("kind").orderBy(F.desc("probability"))
    levels = (scored.where("label is not null and not fitted").groupBy("kind", "probability")
              .agg(F.sum(F.col("label") * weight).alias("good"), F.sum(weight).alias("n"))
              .withColumn("share", F.sum("good").over(order) / F.sum("n").over(order)))
    thresholds = levels.where(F.col("share") >= precision).groupBy("kind").agg(F.min("probability").alias("threshold"))
    # one row per kind
    chosen = F.col("is_base") | (F.col("probability") >= F.col("threshold"))
    return (scored.join(F.broadcast(thresholds), "kind", "left")
            .withColumn("selected", F.coalesce(chosen, F.lit(False))).drop("label", "fitted"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Selected spans (kind, start, end, is_base, probability) and one row of nulls per document without candidates."""
    candidates = materialize(described(proposals(docs, id_col, text_col)), "pii-candidates")
    return score_candidates(candidates)


def text_of(col: str) -> F.Column:
    """kind:start:end, comma-joined, by start, then kind as listed, then end."""
    listed = F.transform(F.array_sort(col), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(listed, ",")


def label_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    span = F.struct("start", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("rank"),
                    "end", "kind")
    return (find_spans(docs, id_col, text_col).groupBy("rid", "doc_id").agg(
        *[F.count(F.when(F.col("is_base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("is_base"), span)).alias("base"),
        F.collect_list(F.when(F.col("selected"), span)).alias("chosen"))
        .select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(text_of("base"), 256).alias("base_sha256"),
                text_of("chosen").alias("spans")))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every selected span replaced by its kind in brackets; overlapping spans are one."""
    names = docs.columns
    spans = find_spans(docs, id_col, text_col).where("selected")
    order = Window.partitionBy("rid").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (spans.withColumn("new", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
               .withColumn("island", F.sum("new").over(order))
               .groupBy("rid", "doc_id", "tie", "island")
               .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                    F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind")))
    # rows of one id and text have the same spans
    per_doc = (islands.groupBy("rid", "doc_id", "tie")
               .agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
               .groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).agg(F.first("cuts").alias("cuts")))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("_doc"),
                         F.xxhash64(text_col).alias("_hash"))
    joined = packed.join(per_doc, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")), "left")
    text = F.col("row").getField(text_col)
    before = F.transform("cuts", lambda c, i: F.concat(
        F.substring(text, F.when(i > 0, F.element_at("cuts", F.greatest(i, F.lit(1)))["end"]).otherwise(0) + 1,
                    c["start"] - F.when(i > 0, F.element_at("cuts", F.greatest(i, F.lit(1)))["end"]).otherwise(0)),
        F.lit("["), F.upper(c["kind"]), F.lit("]")))
    tail = F.substring(text, F.element_at("cuts", -1)["end"] + 1, F.char_length(text))
    clean = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(F.array_join(before, ""), tail))
    return joined.withColumn("row", F.col("row").withField(text_col, clean)).select("row.*")
