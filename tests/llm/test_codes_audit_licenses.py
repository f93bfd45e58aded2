"""Vector codes, the filter audit and the license scan against plain versions; their queries have SQL of their own."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import laesa
from pairloom.llm.audit import Matrix, audit
from pairloom.llm.licenses import Scan, Template, license_report

VECTORS = "vec_id bigint, embedding array<double>, label string, id bigint, code int, whole string"
BAD = [(90, None), (91, [1.0, None]), (92, [float("nan")] * 8), (93, [1.0, float("inf")])]


def plain_codes(rows, parts, entries, rounds, scale):
    """Every distance, with Python's integers."""
    longest = max((len(v) for _, v, _ in rows), default=0)
    width = max(1, -(-longest // parts))
    whole = [[int(np.floor(x * float(scale))) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in rows]
    cut = [[tuple(w[j * width : (j + 1) * width]) for j in range(parts)] for w in whole]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]
    books = [[cut[k][j] for k in first] for j in range(parts)]

    def assign(j, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), k) for k, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            own = [assign(j, c[j])[1] for c in cut]
            for k in range(len(books[j])):
                of = [c[j] for c, o in zip(cut, own) if o == k]
                if of:
                    books[j][k] = tuple(sum(x) // len(of) for x in zip(*of))
    found = [[assign(j, c[j]) for j in range(parts)] for c in cut]
    codes = ["".join(f"{k:02x}" for _, k in f) for f in found]
    errors = [min(sum(d for d, _ in f), (1 << 63) - 1) for f in found]
    return codes, errors, [[list(e) for e in b] for b in books]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, "x") for i, v, label in rows], VECTORS)


def compare_codes(spark, rows, **given):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    settings = {"parts": 4, "entries": 5, "rounds": 3, "scale": 16} | given
    codes, errors, books = plain_codes(kept, **settings)
    done = laesa.compress(frame(spark, rows), **settings)
    found = [tuple(r) for r in done.rows.select("id", "label", "code", "error", "label_error").collect()]
    total = {}
    for (_, _, label), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    expected = [(i, label, c, e, total[label]) for (i, _, label), c, e in zip(kept, codes, errors)]
    assert sorted(found, key=str) == sorted(expected, key=str) and done.books == books


def test_codes(spark):
    random = np.random.default_rng(5)
    rows = [(int(k) // 2, [float(x) for x in random.integers(-9, 9, 12) / 8], [None, "a", ""][k % 3]) for k in range(60)]
    compare_codes(spark, rows + [(i, v, "a") for i, v in BAD])


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(i, v, None) for i, v in BAD],
        [(1, [], None)],
        [(None, [0.5, 0.25], "a"), (3, [0.5] * 9, "a"), (3, [0.5] * 9, None), (2, [-0.01], "b")],
        [(k, [1e30 * (-1) ** k, 1e12 * k, 3.0, -2.0], "a") for k in range(4)] + [(9, [0.0] * 4, "b")],
    ],
)
def test_odd_vectors(spark, rows):
    if any(x and 1e20 < abs(x) < np.inf for _, v, _ in rows for x in v or []):  # held to the range of a long, exact inside it
        rows = [(i, [max(min(x, (1 << 62) / 16), -(1 << 62) / 16) for x in v], label) for i, v, label in rows]
    compare_codes(spark, rows)


def test_pivots_rule_out_entries_without_changing_a_result():
    random = np.random.default_rng(7)
    centres = random.integers(-4000, 4000, (16, 8))
    parts = centres[random.integers(0, 16, 3000)] + random.integers(-200, 200, (3000, 8))
    entries = np.concatenate([centres[:15], centres[:1]])  # one tie
    pivots = laesa.far_apart(entries, laesa.PIVOTS)
    away = np.sqrt(((parts[:, None] - pivots[None]) ** 2).sum(axis=2)).astype(np.float32).astype(float)
    best, least, evaluated = laesa.nearest(parts, away, entries, pivots)
    every = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all() and 15 not in best
    assert evaluated < 0.35 * every.size


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^ \t-\r]+", text)
        smaller = any(j is not None and i is not None and j < i and (t or "") == text for j, t, _ in docs)
        upper = sum("A" <= c <= "Z" for c in text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * upper > 10 * len(text), "D": bool(set(text) & set("#$%&*|")), "E": smaller}
        rows.append((lang or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        here = [r[1:] for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            for step, own in enumerate(order):
                before = set(order[:step])
                removed = [r for r in here if own in r[0] and not r[0] & before]
                out[part, "".join(order), step + 1] = (
                    sum(not r[0] & (before | {own}) for r in here),
                    len(removed),
                    sum(own in r[0] and bool(r[0] & before) for r in here),
                    sum(r[0] == {own} for r in here),
                    sum(r[1] for r in removed),
                    sum(r[2] for r in removed),
                    sum(120 // len(r[0]) for r in here if own in r[0]),
                )
    return out


def test_audit_of_odd_rows(spark, odd, none):
    labels = [(1, 1, 0), (5, None, 1), (5, 1, None), (6, 0, 1), (None, 1, 1), (77, 1, 1)]
    extra = [(11, "A#" * 3, "en", 1, 1, "x"), (12, "a&b " * 120, None, 1, 1, "x"), (11, "A#" * 3, None, 1, 1, "x")]
    docs = odd.union(odd.sparkSession.createDataFrame(extra, odd.schema))
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    expected = plain_audit([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], labels)
    for table in (docs, docs.repartition(5)):
        found = {tuple(r)[:3]: tuple(r)[3:] for r in audit(table, frame).collect()}
        assert found == expected
    assert audit(none, frame).count() == 0
    assert audit(docs, frame.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_matrix_holds_every_word(spark, odd):
    matrix = Matrix(odd, size=1 << 12, bucket=1 << 12)
    word = {r["column"]: r["word"] for r in matrix.dictionary.collect()}
    texts = [t or "" for (t,) in odd.select("text").collect()]
    assert sorted(word.values()) == sorted({w for t in texts for w in re.findall(r"[^ \t-\r]+", t)})
    found = []
    for shard in matrix.shards.collect():
        for a, b in zip(shard["starts"], shard["starts"][1:]):
            assert shard["columns"][a:b] == sorted(shard["columns"][a:b])
            found.append(sorted(w for c, n in zip(shard["columns"][a:b], shard["counts"][a:b]) for w in [word[c]] * n))
    assert sorted(found) == sorted(sorted(re.findall(r"[^ \t-\r]+", t)) for t in texts)


def test_licenses(spark, none):
    filler = " ".join(f"w{k}" for k in range(70_000)).split()
    long = filler[:65_535] + ["MIT", "License"] + filler[65_537:]  # over the edge of a piece
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    rows = [
        (1, "MIT License, mit-license\nmit (license) mit licenses", 8, 3, 0, 4, "mit", "mit", 1.0),
        (2, "GNU General Public\tLICENSE apache apache license", 7, 2, 1, 5, "apache,gpl", "apache,gpl", 1.0),
        (2, "GNU General Public\tLICENSE apache apache license", 7, 2, 1, 5, "apache,gpl", "apache,gpl", 1.0),
        (3, "see: " + bsd.replace("binary forms", "compiled binary forms"), 23, 0, None, None, "", "bsd", 1.0),
        (4, " ".join(bsd.split()[:9]), 9, 0, None, None, "", "", 0.0),
        (5, " ".join(long), 70_000, 1, 65_535, 65_535, "mit", "mit", 1.0),
        (6, None, 0, 0, None, None, "", "", 0.0),
        (None, " \n", 0, 0, None, None, "", "", 0.0),
        (None, "license", 1, 0, None, None, "", "", 0.0),
        (7, "mitélicense general public general public license", 6, 1, 3, 3, "gpl", "gpl", 1.0),
        (8, "licensed under CC BY-NC 4.0. " * 500, 3500, 0, None, None, "", "cc-by-nc", 1.0),
    ]
    docs = spark.createDataFrame([(r[0], r[1], 9, "x", 1) for r in rows], "doc_id bigint, text string, row int, gram string, id int")
    names = ("id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    found = [tuple(r[n] for n in names) for r in license_report(docs).collect()]
    expected = [(r[0], *r[2:]) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert license_report(none).count() == 0


def test_spans_of_a_changed_sentence(spark):
    template = Template("own", " ".join(f"t{k}" for k in range(20)))
    words = template.text.split()
    text = " ".join(["a", "b", *words[:7], "new", "words", *words[7:], "c", *words[:14], "d", *words])
    scan = Scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), templates=[template])
    spans = [(r["first"], r["last"], r["share"]) for r in scan.spans.orderBy("first").collect()]
    assert spans == [(2, 23, 1.0), (40, 59, 1.0)]


def test_a_benchmark_of_one_repeated_word(spark, monkeypatch):
    from pairloom.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 5)
    rows = [(1, "same " * 30), (1, "same " * 30), (2, " ".join(f"w{k}" for k in range(40)))]
    benchmark = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a " + "same " * 12 + "b"), (2, "same " * 9), (3, " ".join(f"w{k}" for k in range(5, 20)))], "doc_id bigint, text string")
    found = {r["id"]: (r["begins"], r["ends"], r["items"]) for r in decontaminate.benchmark_hits(docs, benchmark).collect()}
    assert found == {1: ([1], [13], [1]), 2: ([], [], []), 3: ([0], [15], [2])}
