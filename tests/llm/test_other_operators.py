"""Pages, vectors, conversations and the pipeline."""

from __future__ import annotations

import html
import json
import re

import numpy as np
import pytest
from compare import connect, difference

from pairloom.llm import extract as X
from pairloom.llm.chat import check_arguments, format_chats
from pairloom.llm.quantise import near_vectors
from pairloom.llm.queries import CHECKS, QUERIES
from pairloom.llm.stages import read


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_queries_with_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), CHECKS[name]) is None


def test_pages(spark, folder):
    sources = {r["page_id"]: r["html"] for r in read(spark, folder, "pages").collect()}
    for row in QUERIES["op5_extract"](spark, folder).collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", sources[row["page_id"]], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


PAGES = {
    "": "",
    "bare &amp; text": "bare & text",
    "<p>a<p>b<br>c": "a\nb\nc",
    '<body><header>Site <nav>a</nav></header><div class="cookie-notice">We use cookies</div><main><h1>T</h1><p>Hello &lt;<b>bold</b> world.</p>'
    '<aside>side</aside><ul><li>one<li>two</ul><div class="ad">buy</div><section id="comments"><p>nice post</p></section><form><label>Mail</label></form>'
    "</main><footer>f</footer></body>": "T\nHello <bold world.\none\ntwo",
    "<article><table><tr><td>a<td>b<tr><td>c</table><script>if (a<b) '</p>'</script><!-- <p>no</p> --><p>d  \n e</p>": "a\nb\nc\nd e",
    "<article>x</article></div></p> <a href='y": "x",
}


def test_odd_pages(spark):
    rows = [(k, None, page, 1) for k, page in enumerate(PAGES)] + [(None, "u", None, 1), (0, None, "", 1)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = [(r["id"], r["text"]) for r in X.extract(frame).collect()]
    assert sorted(found, key=str) == sorted([(k, t) for k, t in enumerate(PAGES.values())] + [(None, ""), (0, "")], key=str)
    assert X.extract(frame.limit(0)).count() == 0


def test_elements_end_at_any_depth():
    for tag in ("a", "b", "font", "span"):
        page = X.Page("<div><nav>" + f"<{tag}>menu " * 300 + "</nav><p>the text</div><p>more")
        assert [page.tag[page.parent[k]] for k, t in enumerate(page.tag) if t == "p"] == ["div", ""]
    page = X.Page("<p>a" + "<b>" * 100 + "<p>c" + "<i>" * 100 + "<p>d")
    assert [page.parent[k] for k, tag in enumerate(page.tag) if tag == "p"] == [0, 0, 0]


def test_messages_are_exact_marginals():
    """Sum-product on a small page against the sum over all labellings."""
    model = X.Model({}, {(1, 1): 40, (1, 0): 3, (0, 0): 20, (0, 1): 5})
    page = X.Page('<div class="content"><p>a</p><div class="ad"><p>b</p></div><ul><li>c</ul></div>')
    own = [sum(X._known(f) for f in features) for features in page.features()]
    own[0] = 1.0
    weight = np.zeros((len(own), 2))
    for bits in range(1 << len(own)):
        x = [bits >> k & 1 for k in range(len(own))]
        energy = sum(o for o, b in zip(own, x) if b)
        for k in range(1, len(own)):
            energy += {(1, 1): model.inside, (0, 0): model.outside}.get((x[page.parent[k]], x[k]), 0.0)
        for k, b in enumerate(x):
            weight[k, b] += np.exp(energy)
    assert np.allclose(model.marginals(page), np.log(weight[:, 1] / weight[:, 0]))


def test_vectors(spark):
    random = np.random.default_rng(5)
    base = random.normal(size=(300, 16))
    near = base[random.integers(0, 300, 900)] + random.normal(size=(900, 16)) * random.choice([0.05, 0.2, 0.3], (900, 1))
    all_ = np.concatenate([base, near, base[:50], base[:20] * 3]).astype(np.float32)
    rows = [(int(k), [float(x) for x in v], 1) for k, v in enumerate(all_)]
    bad = [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [1.0, None] * 8, 1), (5004, [1.0], 1), (None, rows[0][1], 1), (5005, [float("inf")] * 16, 1), (5006, [], 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>, cell int")
    unit = all_.astype(float) / np.linalg.norm(all_.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(unit))
    while True:
        new = np.array([min(label[i], label[linked[i]].min(initial=len(unit))) for i in range(len(unit))])
        if (new == label).all():
            break
        label = new
    got = {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(frame).collect()}
    assert {k: got[k] for k in range(len(unit))} == {k: (int(linked[k].sum()), int(label[k]), bool(label[k] == k)) for k in range(len(unit))}
    assert all(got[k] == (0, k, True) for k in (5000, 5001, 5002, 5003, 5004, 5005, 5006)) and got[None] == (0, None, True)
    assert near_vectors(frame.limit(0)).count() == 0 and near_vectors(frame.where("vec_id = 5000")).count() == 1


def test_recall_against_brute_force(spark, folder):
    rows = read(spark, folder, "embeddings").collect()
    unit = np.array([r["embedding"] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op9_embedding"](spark, folder).collect()}
    assert [got[r["vec_id"]] for r in rows] == links.tolist()


SCHEMAS = {"add": {"a": ("number", True), "b": ("number", False)}, "say": {"text": ("string", True)}}


def call(*calls, content=None):
    return json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(call_id, content):
    return json.dumps({"tool_call_id": call_id, "content": content})


def test_tool_calls(spark):
    turns = [
        (1, 0, "user", "add, please"),
        (1, 1, "tool", result("c2", "7")),  # comes before its call
        (1, 2, "assistant", call(("c1", "add", {"b": 1, "a": {"z": 1, "y": 2}}))),
        (1, 3, "tool", result("c1", "3")),
        (1, 4, "assistant", call(("c2", "add", {"a": {"$result": "c1"}}))),
        (2, 0, "assistant", call(("x", "add", {"b": 1}))),
        (2, 1, "tool", result("y", "?")),
        (2, 2, "assistant", call(("p", "say", {"text": {"$result": "q"}}))),
        (2, 3, "tool", result("p", "1")),
        (2, 4, "assistant", call(("q", "say", {"text": {"$result": "p"}}))),
        (2, 5, "tool", result("q", "2")),
        (3, None, None, None), (None, 1, "assistant", "{broken"), (3, 1, "tool", "plain"),
    ]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as level", "'x' as line")
    rows = {(r["conv"], r["turn"]): r for r in format_chats(frame, SCHEMAS).collect()}
    assert len(rows) == len(turns)
    order = sorted((r for r in rows.values() if r["conv"] == 1), key=lambda r: (r["after"], r["level"], r["turn"]))
    assert [r["turn"] for r in order] == [0, 2, 3, 4, 1]
    assert rows[1, 2]["line"] == '{"content":"","role":"assistant","tool_calls":[{"arguments":{"a":{"y":2,"z":1},"b":1},"id":"c1","name":"add"}]}'
    assert rows[1, 2]["fault"] == "a is not number" and rows[1, 4]["valid"] and rows[1, 1]["valid"]
    assert rows[2, 0]["fault"] == "a is missing" and rows[2, 1]["fault"] == "the result has no call"
    assert {rows[2, t]["fault"] for t in (2, 3, 4, 5)} == {"part of a cycle"}
    assert rows[None, 1]["line"] == '{"content":"{broken","role":"assistant"}' and rows[3, None]["line"] == '{"content":"","role":""}'
    assert format_chats(frame.limit(0)).count() == 0


def test_arguments():
    assert check_arguments("say", '{"text": 1}', SCHEMAS)[1] == "text is not string"
    assert check_arguments("say", '{"text": "a", "more": 1}', SCHEMAS)[1] == "more is unknown"
    assert check_arguments("none", "{}", SCHEMAS)[1] == "no tool none" and check_arguments("none", None, {}) == ({}, None)
    assert check_arguments("add", "[1]", SCHEMAS)[1] == "arguments are not an object" and check_arguments("add", "{", SCHEMAS)[1] == "arguments are not JSON"
    assert check_arguments("add", '{"a": true}', SCHEMAS)[1] == "a is not number"


def test_pipeline(spark, folder):
    import corpus_pipeline as pipeline

    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near duplicates", "repeated passages", "benchmark", "tokens"]
    docs = read(spark, folder, "documents")
    toxic = {r["doc_id"] for r in QUERIES["op4_toxicity"](spark, folder).where("predicted = 1").collect()}
    left = docs
    for name, step in pipeline.STAGES[:4]:
        before, left = left, spark.createDataFrame(step(spark, left, folder).collect(), docs.schema)
        assert left.columns == docs.columns and left.count() <= before.count(), name
        if name == "toxicity":
            assert {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in left.collect()} == toxic
    final = {r["doc_id"]: r for r in pipeline.run(spark, folder).collect()}
    assert {i: r["text"] for i, r in final.items()} == {r["doc_id"]: r["text"] for r in left.collect()}
    assert all(r["n_tokens"] == len(r["ids"]) for r in final.values())


def test_tokens_take_one_python_worker_for_each_task(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "some words, naïve"), (2, None), (3, "")], "doc_id bigint, text string")
    coded = corpus_pipeline.tokenize(spark, docs, "")
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: (r["n_tokens"] > 0, r["text"]) for r in coded.collect()} == {1: (True, "some words, naïve"), 2: (False, ""), 3: (False, "")}
