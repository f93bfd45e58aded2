"""The operators on texts against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import bpe, huffman, langid, toxicity
from pairloom.llm.decontaminate import benchmark_hits
from pairloom.llm.minhash import near_duplicates
from pairloom.llm.queries import QUERIES
from pairloom.llm.stages import read
from pairloom.llm.substring import remove_repeats
from pairloom.session import fresh_path

WHITE, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def documents(spark, folder):
    return {r["doc_id"]: r["text"] for r in read(spark, folder, "documents").collect()}


def shingles(text):
    w = WHITE.findall(lower(text))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_minhash_finds_every_link(spark, folder, documents):
    sets = {i: shingles(t) for i, t in documents.items()}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in QUERIES["op1_minhash"](spark, folder).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_minhash_compares_what_the_star_leaves(spark):
    """Two near texts that share a bucket's centre only loosely are linked all the same."""
    base = [f"w{k}" for k in range(400)]
    rows = []
    for v in range(60):
        own = base[:]
        for k in range((v * 7) % 30):
            own[(v * 13 + k * 11) % 400] = f"v{v}k{k}"
        rows.append((v, " ".join(own)))
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if len(sets[a] & sets[b]) * 100 >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == root


def test_decontamination(spark, folder, documents):
    windows = {}
    for r in read(spark, folder, "benchmark").collect():
        w = ALNUM.findall(lower(r["text"]))
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(r["item_id"])
    want = {}
    for i, text in documents.items():
        w, items = ALNUM.findall(lower(text)), set()
        hit = [False] * len(w)
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k : k + size])):
                    items |= found
                    hit[k : k + size] = [True] * size
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        want[i] = (len(w), sum(hit), len(items), digest, any(hit))
    rows = QUERIES["op2_decontaminate"](spark, folder).collect()
    assert {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in rows} == want


def test_decontamination_in_blocks(spark, monkeypatch):
    from pairloom.llm import decontaminate

    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "nothing here"), (3, "zz yy"), (4, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "B C D e f g h i j k"), (2, "yy"), (3, ""), (4, None), (5, "c d")], "item_id bigint, text string")
    whole = {tuple(map(str, r)) for r in benchmark_hits(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 1)
    assert {tuple(map(str, r)) for r in benchmark_hits(docs, items).collect()} == whole
    assert {r["id"]: (r["begins"], r["ends"], r["items"]) for r in benchmark_hits(docs, items).collect()} == {
        1: ([1], [11], [1, 5]), 2: ([], [], []), 3: ([1], [2], [2]), 4: ([], [], []),
    }


def test_substring(spark, folder, documents):
    split = {i: WHITE.findall(t or "") for i, t in documents.items()}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - 12):
            first.setdefault(tuple(split[i][k : k + 13]), i)
    want = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    rows = QUERIES["op8_substring"](spark, folder).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == want


def test_bpe_and_token_files_agree_with_the_library(spark, folder, documents):
    library = Tokenizer.from_file(TOKENIZER)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in documents.items()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {i: (len(x), digest(",".join(map(str, x))), digest(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op3_bpe"](spark, folder).collect()}
    assert got == want
    start, files = 0, {}
    for i in sorted(ids):
        x = [*ids[i], huffman.END]
        files[i] = (start, len(x), zlib.crc32(b"".join(t.to_bytes(4, "little") for t in x)))
        start += len(x)
    rows = QUERIES["op10_token_ids"](spark, folder).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == files


def test_toxicity_and_language_on_held_out_rows(spark, folder):
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, folder, "labels").collect()}
    rows = [r for r in QUERIES["op4_toxicity"](spark, folder).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    clean = [r for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)
    langs = {r["doc_id"]: r["lang"] for r in read(spark, folder, "documents").collect()}
    found = QUERIES["op6_langid"](spark, folder).collect()
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_disguised_words_are_restored():
    import numpy as np

    total = np.full(784, 0.5)
    import pyarrow as pa

    text = "the idiot said a stupid thing to the moron and the loser was pathetic " * 50
    for batch in toxicity._pairs(iter([pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])])):
        total[batch.column(0).to_numpy()] += batch.column(1).to_numpy()
    table = total.reshape(28, 28)
    table[0, 0] = 0.5
    model = np.log(table / table.sum(axis=1, keepdims=True))
    for written, meant in {"1d10t": "idiot", "i d i o t": "idiot", "m.o.r.o.n": "moron", "stuuuupid": "stupid", "p@th3t1c": "pathetic"}.items():
        token = toxicity._DISGUISED.search(f"the {written} thing")[0]
        assert toxicity.restore([token], model) == [meant]
    assert toxicity._DISGUISED.search("plain words, with 1990 numbers and marks.") is None


def test_planted_disguises_are_found():
    total = np.full(784, 0.5)
    text = pa.array(["the idiot said a stupid thing to the moron and the loser was pathetic asshole " * 50])
    for batch in toxicity._pairs(iter([pa.RecordBatch.from_arrays([text], names=["text"])])):
        total[batch.column(0).to_numpy()] += batch.column(1).to_numpy()
    table = total.reshape(28, 28)
    table[0, 0] = 0.5
    model = np.log(table / table.sum(axis=1, keepdims=True))
    planted = {
        "1d10t": "idiot", "i d i o t": "idiot", "m.o.r.o.n": "moron", "stuuuupid": "stupid", "p@th3t1c": "pathetic", "@sshole": "asshole",
        "$tupid": "stupid", "1diot": "idiot", "idio7": "idiot", "1 d 1 0 t": "idiot", "idiiot": "idiot",
    }
    for written, meant in planted.items():
        for around in ("the {} thing", "a {} b", "a {}, you", '"{}" he', '("{}!")', "{}"):
            found = set()
            for _, token, ends, run in toxicity.readings(around.format(written), model):
                found |= set(toxicity._words_of(toxicity.restore([token], model, ends)[0].strip(), run).split())
            assert meant in found, around.format(written)


def test_words_that_occur_only_in_disguise_are_learned(spark):
    lefts = "radio idea video studio riot idiom diet audio total period pilot patriot".split()
    rows = [(k, f"that was the {lefts[k % 12]} {'id10t' if k % 2 else 'thing'} of note", k % 2) for k in range(60)]
    rows += [(100, "somebody is a 1d1ot here", None), (101, "somebody is a friend here", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    score = {r["id"]: r["score"] for r in toxicity.toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")).collect()}
    assert score[100] >= toxicity.THRESHOLD > score[101] and all(score[k] < toxicity.THRESHOLD for k in range(0, 60, 2))


def test_evidence_does_not_saturate(spark):
    """A word in a tenth of the toxic and a hundredth of the clean rows is a sign at any size of the sample."""
    rows = [(k, f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}x {'grunk' if k % 2 and k % 20 == 1 or k % 200 == 0 else 'plain'} end", k % 2) for k in range(16_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    key, value = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), np.zeros((28, 28)))
    a, b = 800, 80
    assert np.isclose(value.max(), (a + 0.5) / (a + b + 1) * a / (a + 1.5)) and value.max() >= toxicity.THRESHOLD


def test_odd_rows(spark, odd, none):
    count = odd.count()
    near = near_duplicates(odd).collect()
    assert len(near) == count and {r["component_id"] for r in near if r["doc_id"] in (5, 6, 7)} == {5}
    assert all(r["kept"] for r in near if r["doc_id"] is None or r["doc_id"] < 6)
    items = spark.createDataFrame([(1, "word3 word4"), (None, "tiny")], "item_id bigint, text string")
    hits = {r["id"]: (len(r["begins"]), r["items"]) for r in benchmark_hits(odd, items).collect()}
    assert hits[4] == (1, []) and hits[5] == (1, [1]) and hits[8] == (0, [])
    kept = [(r["id"], r["n_removed"]) for r in remove_repeats(odd).collect()]
    assert len(kept) == count and (7, 40) in kept and (5, 0) in kept and (None, 0) in kept
    coded = bpe.decode(bpe.encode(odd, TOKENIZER), TOKENIZER).collect()
    texts = sorted(r["text"] or "" for r in odd.collect())
    assert sorted(r["decoded"] for r in coded) == texts
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (None, 1), (9, None)], "doc_id bigint, toxic int")
    assert toxicity.toxicity(odd, labels, keep=["lang", "row"]).select("row.*", "text", "score").count() == count
    named = {r["id"]: r["lang"] for r in langid.identify(odd, odd.select("text", "lang"), PIECES).collect()}
    assert named[1] == named[2] == named[3] == "und" and named[4] == "en"
    path = fresh_path(spark, "ids")
    huffman.write_ids(odd, path, TOKENIZER)
    assert huffman.documents_of(spark, path).agg(F.sum("n_ids")).first()[0] == sum(len(r["ids"]) + 1 for r in coded)
    for frame in (near_duplicates(none), benchmark_hits(none, items), benchmark_hits(odd.limit(0), items.limit(0)), remove_repeats(none), bpe.encode(none, TOKENIZER),
                  toxicity.toxicity(none, labels.limit(0)), langid.identify(none, none.select("text", "lang"), PIECES)):
        assert frame.count() == 0
    path = fresh_path(spark, "ids")
    huffman.write_ids(none, path, TOKENIZER)
    assert huffman.documents_of(spark, path).count() == 0


def test_huffman_codes():
    import numpy as np

    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233])
    free, short = huffman.code_lengths(counts), huffman.code_lengths(counts, 5)
    assert free[0] == 0 and free.max() > 5 and short.max() == 5
    for lengths in (free, short):
        used = lengths[lengths > 0]
        assert sum(2.0**-n for n in used.tolist()) == 1
    ids = np.random.default_rng(1).integers(1, 14, 5000)
    block = huffman.pack(ids, np.array([4000, 0, 1000]), short, huffman.canonical(short))
    back, documents = huffman.unpack(block, huffman.decoding_table(short))
    assert (back == ids).all() and documents.tolist() == [4000, 0, 1000]


def test_token_files_of_odd_rows_agree_with_the_library(spark):
    library = Tokenizer.from_file(TOKENIZER)
    texts = [None, "", " ", "a" * 100_000, "word " * 20_000, "ª º µ Ñandú ŉ ǅ ßɐ x²", "don't I'LL 12ab\tc\nThe<|endoftext|>end", "日本 語 ñ́a", "A b", "same", "same", "  x  y"]
    rows = [(None if k == 9 else k, text, "clash") for k, text in enumerate(texts)]
    path = fresh_path(spark, "ids")
    huffman.write_ids(spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3), path, TOKENIZER)
    want, start = [], 0
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, huffman.END]
        want.append((i, start, len(ids), zlib.crc32(b"".join(t.to_bytes(4, "little") for t in ids))))
        start += len(ids)
    got = [(r["id"], r["start"], r["n_ids"], r["crc32"]) for r in huffman.documents_of(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_spots_are_those_of_the_pattern():
    random = np.random.default_rng(2)
    signs = np.array(list("ab cdé.1!3-_*@ \n\t,A\"ß1 z z0٣ "))
    for _ in range(500):
        text = "".join(random.choice(signs, random.integers(0, 60)))
        wanted = [(m.start(), m.end(), bool(m["run"])) for m in toxicity._disguised("az").finditer(text, overlapped=True)]
        assert toxicity.spots(text, "az") == wanted


def test_a_disguise_across_a_cut_is_decoded():
    parts = [part for _, part, _, _ in toxicity.readings("1" * 60 + "x1d10t" + "1" * 90, np.zeros((28, 28)))]
    assert any("x1d10t" in part for part in parts) and max(map(len, parts)) <= toxicity.LONGEST


def test_contaminated_rows_without_an_id_go(spark, tmp_path):
    import corpus_pipeline

    words = " ".join(f"word{k}" for k in range(12))
    spark.createDataFrame([(1, words)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "see " + words), (None, "clean text"), (None, None), (1, words), (1, "other"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [tuple(r) for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([rows[k] for k in (1, 2, 4, 5)], key=str)
