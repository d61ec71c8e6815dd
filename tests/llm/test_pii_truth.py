"""Precision and recall per kind on planted truth: every span is known, look-alikes included."""

import random

from reelstats.llm import pii

WORDS = "the plan of this report was in order and its parts came out as they should be on time".split()


def luhn_number(rng, n=16):
    digits = [rng.randrange(10) for _ in range(n - 1)]
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return "".join(map(str, digits)) + str(-total % 10)


def planted(rng):
    """(kind or None, group, text): personal data, plain and disguised, and things that look like them."""
    def n(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    name, host = rng.choice(["ann", "b.lee", "c_k"]) + n(2), rng.choice(["mail", "web-site", "post"]) + n(1)
    octets = [str(rng.randrange(1, 256)) for _ in range(4)]
    card = luhn_number(rng)
    wrong = card[:-1] + str((int(card[-1]) + rng.randrange(1, 10)) % 10)

    def four(c, mark):
        return mark.join(c[i:i + 4] for i in range(0, 16, 4))

    return rng.choice([
        ("email", "plain", f"{name}@{host}.example.org"), ("email", "(at)", f"{name} (at) {host} (dot) org"),
        ("email", "spaced", f"{name} @ {host}.example.com"),
        ("ip", "plain", ".".join(octets)), ("ip", "commas", ",".join(octets)),
        ("card", "plain", card), ("card", "grouped", four(card, rng.choice(" -"))),
        ("phone", "plain", f"+{rng.randrange(1, 99)} {n(3)} {n(7)}"), ("phone", "00", f"00{rng.randrange(10, 99)} {n(3)} {n(7)}"),
        (None, "handle", f"@{name}"), (None, "half address", f"{name}@{host}"),
        (None, "version", f"{rng.randrange(9)}.{rng.randrange(20)}.{n(1)}.{rng.randrange(300, 9999)}"),
        (None, "order number", wrong), (None, "order groups", four(wrong, "-")),
        (None, "date", f"{rng.randrange(1990, 2030)}-0{rng.randrange(1, 9)}-{rng.randrange(10, 28)} 1{n(1)}:{rng.randrange(10, 59)}"),
        (None, "price", f"{n(1)},{n(3)}.{n(2)}"), (None, "short number", f"+{n(4)}"),
    ])


def corpus(n=1500, seed=12):
    rng = random.Random(seed)
    texts, truth = [], []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randrange(1, 4)):
            text += " ".join(rng.choices(WORDS, k=rng.randrange(3, 9))) + " "
            kind, group, item = planted(rng)
            spans.append((kind, group, len(text), len(text) + len(item)))
            text += item + " "
        texts.append(text + "end")
        truth.append(spans)
    return texts, truth


def measured(rows, truth):
    """Recall per (kind, group), and precision per kind: reported spans that touch a true span of the kind."""
    found, total, right, told, by_group = {}, {}, {}, {}, {}
    for spans, row in zip(truth, rows):
        reported = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row.split(",") if s)]
        for kind, group, a, b in spans:
            hits = [k for k, x, y in reported if x < b and a < y]
            if kind is None:
                by_group[group] = by_group.get(group, 0) + bool(hits)
                continue
            total[kind, group] = total.get((kind, group), 0) + 1
            found[kind, group] = found.get((kind, group), 0) + (kind in hits)
        for k, x, y in reported:
            told[k] = told.get(k, 0) + 1
            right[k] = right.get(k, 0) + any(kind == k and x < b and a < y for kind, _, a, b in spans)
    return ({g: found[g] / total[g] for g in total}, {k: right[k] / told[k] for k in told}, by_group)


def test_precision_and_recall_on_planted_truth(spark):
    texts, truth = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.label_documents(df).collect()}
    recall, precision, alarms = measured([rows[i] for i in range(len(texts))], truth)
    print({"/".join(g): round(v, 3) for g, v in sorted(recall.items())}, {k: round(v, 3) for k, v in precision.items()}, alarms)
    for group in (("email", "plain"), ("ip", "plain"), ("card", "plain"), ("card", "grouped"), ("phone", "plain")):
        assert recall[group] == 1.0, group
    assert recall["email", "(at)"] >= 0.9 and recall["phone", "00"] >= 0.9
    assert all(p >= 0.9 for p in precision.values())
    assert alarms["handle"] == alarms["price"] == alarms["short number"] == 0
