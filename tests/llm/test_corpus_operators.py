"""Shards, mixing, decontamination, tool calls and the pipeline, against brute force."""

import itertools
import json
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dwspark.llm import chat, decontam, mixing, quality, queries, shards
from . import helpers as h


# Sharding ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    """The defining property: the index is a bijection, and cells one index apart touch."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = shards.curve_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _check_shards(rows, texts, n=16):
    sizes = Counter(r["shard"] for r in rows)
    total = len(rows)
    assert max(sizes.get(k, 0) for k in range(n)) - min(sizes.get(k, 0) for k in range(n)) <= 1
    for k, size in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(size))
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order) and len(order) == total
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "rows", None) for d, t in texts)


def test_shards_of_all_documents(spark):
    _check_shards(queries.queries()["op2_hilbert_shards"](spark, h.SF).collect(), h.documents())


def test_curve_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, strlen(text) + 1 FROM '{h.SF}/documents.parquet'").fetchall()
    number = lambda s: float(int.from_bytes(s.encode()[:7].ljust(7, b"\0"), "big"))
    values = np.array([[number(s), number(x), np.log2(n), d] for d, s, x, n in rows])
    low, high = values.min(axis=0), values.max(axis=0)
    cells = np.minimum(np.floor((values - low) / (high - low) * 32), 31).astype(int)
    want = dict(zip([r[0] for r in rows], shards.curve_index(cells, 5).tolist()))
    got = {r["doc_id"]: r["curve"] for r in queries.queries()["op2_hilbert_shards"](spark, h.SF).collect()}
    assert got == want


def test_shards_edges(spark, tmp_path):
    docs = spark.createDataFrame(h.edge_rows(), h.DOCS).withColumnRenamed("n_chars", "shard")
    _check_shards(shards.query(docs).collect(), [(d, t) for d, t, *_ in h.edge_rows()])
    kept = shards.keep_in_shards(docs)
    assert kept.columns == [*docs.columns, "_shard", "_slot"]
    assert Counter(map(tuple, kept.select(*docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    assert shards.query(docs.limit(0)).count() == shards.keep_in_shards(docs.limit(0)).count() == 0
    shards.write_shards(docs, f"{tmp_path}/out", n_shards=3)
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(h.edge_rows())


# Mixing --------------------------------------------------------------------------------------------
def _targets(sizes, weights, total):
    """Plain repetition of the rule: cap what is above, share the rest again."""
    capped = {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in capped]
        left, weight = total - sum(capped.values()), sum(weights[i] for i in open_)
        share = {i: left * weights[i] / weight for i in open_}
        over = {i: 2.0 * sizes[i] for i in open_ if share[i] > 2 * sizes[i]}
        if not over:
            return [capped.get(i, share.get(i)) for i in range(len(sizes))]
        capped |= over


def test_targets():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(1, 1000) for _ in range(rng.randint(1, 9))]
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        got = mixing.targets(sizes, weights, 1.5 * sum(sizes))
        assert got == pytest.approx(_targets(sizes, weights, 1.5 * sum(sizes)))
        assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * s + 1e-6 for t, s in zip(got, sizes))
    assert mixing.targets([], [], 0) == []
    assert mixing.targets([0, 4], [3, 1], 6) == [0.0, 6.0]


def test_route_is_the_cheapest_flow():
    """Against all integer flows of small networks."""
    rng = random.Random(8)
    for _ in range(60):
        p, s = rng.randint(1, 3), rng.randint(1, 2)
        supply = [rng.randint(0, 3) for _ in range(p)]
        members = [sorted(rng.sample(range(s), rng.randint(1, s))) for _ in range(p)]
        quota = [rng.randint(0, 5) for _ in range(s)]
        pairs = [(i, j) for i in range(p) for j in members[i]]
        best = None
        for values in itertools.product(range(7), repeat=len(pairs)):
            out = [sum(v for v, (a, _) in zip(values, pairs) if a == i) for i in range(p)]
            into = [sum(v for v, (_, b) in zip(values, pairs) if b == j) for j in range(s)]
            if all(o <= 2 * w for o, w in zip(out, supply)) and all(x <= q for x, q in zip(into, quota)):
                cost = sum(min(o, w) + 3 * max(0, o - w) for o, w in zip(out, supply))
                best = min(best or (0, 0), (-sum(values), cost))
        flow = mixing.route(supply, members, quota, [1, 3])
        out = [sum(f.values()) for f in flow]
        assert (-sum(out), sum(min(o, w) + 3 * max(0, o - w) for o, w in zip(out, supply))) == best
        assert all(j in members[i] for i, f in enumerate(flow) for j in f)


def test_mix_of_all_documents(spark):
    rows = queries.queries()["op9_source_mix"](spark, h.SF).collect()
    texts = duckdb.sql(f"SELECT doc_id, text, source FROM '{h.SF}/documents.parquet'").fetchall()
    count = {d: len(h.WORD.findall(t or "")) for d, t, _ in texts}
    sizes = Counter()
    for d, _, s in texts:
        sizes[s] += count[d]
    names = sorted(sizes)
    want = dict(zip(names, _targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes.values()))))
    assert Counter((r["doc_id"], r["size"], r["source"], r["source_size"]) for r in rows) == Counter((d, count[d], s, sizes[s]) for d, _, s in texts)
    taken = Counter()
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s in names:
        own = sorted(count[d] for d, _, x in texts if x == s)
        assert abs(taken[s] - want[s]) <= max(own)
    again = queries.queries()["op9_source_mix"](spark, h.SF).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_mix_of_overlapping_sources(spark):
    rows = [(i, [["a"], ["a", "b"], ["b", None], ["c"]][i % 4], 10 + i % 7) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, where array<string>, size long")
    got = mixing.mix(docs, F.col("where"), F.col("size"), weights=(1, 1, 1, 1), share_percent=100).collect()
    for r in got:
        assert len(r["uses"]) <= 2 and set(r["uses"]) <= set(r["members"])
    taken = Counter()
    for r in got:
        for s in r["uses"]:
            taken[s] += r["size"]
    total = sum(n for _, _, n in rows)
    assert all(abs(taken[s] - total / 4) < 60 for s in ("a", "b", "c", None))


def test_mix_edges(spark):
    docs = spark.createDataFrame(h.edge_rows(), h.DOCS).withColumnRenamed("lang", "size")
    got = mixing.query(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((d, len(h.WORD.findall(t or "")), s) for d, t, _, s, _ in h.edge_rows())
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    kept = mixing.keep_mixed(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()).most_common(1)[0][1] <= 4  # doc 12 stands twice
    assert mixing.query(docs.limit(0)).count() == mixing.keep_mixed(docs.limit(0)).count() == 0
    assert mixing.query(docs.where("doc_id = 2")).first()["taken"] == 0


def test_word_count(spark):
    texts = ["", " ", "a", " a", "a ", "a\t\nb", "\x0ba b\x0c", "a\xa0b c", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in df.collect()] == [len(h.WORD.findall(t or "")) for t in texts]


# Decontamination -----------------------------------------------------------------------------------
def test_planted_passages(spark):
    """Documents that hold an item's text word for word are found, and no others."""
    items = duckdb.sql(f"SELECT item_id, text FROM '{h.SF}/benchmark.parquet'").fetchall()
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    want = {(d, i) for d, t in h.documents() for i, x in items if plain(x) in plain(t or "")}
    got = {(r["doc_id"], r["item_id"]) for r in queries.queries()["op7_template_decontam"](spark, h.SF).collect()}
    assert want and got == want


QUESTION = "A farmer named John Smith has 12 cows and 7 goats. If John Smith sells 3 cows for 450.50 dollars each, how many cows does John Smith still own?"


@pytest.mark.parametrize("text, found, exact", [
    (QUESTION, True, True),
    ("x y z. " + QUESTION.replace("12", "15").replace("7 g", "9 g").replace("3 c", "4 c").replace("450.50", "1,200"), True, False),
    (QUESTION.replace("John Smith", "Mary"), True, False),
    (QUESTION.replace("If John Smith", "If Peter Pan"), False, None),  # one name stands for two
    (QUESTION.upper(), False, None),  # names in capitals are literals, so the slots differ
    (QUESTION.replace("dollars", "euros"), True, False),
    ("A farmer has many cows and sells some of them.", False, None), ("", False, None), (None, False, None),
])
def test_templates(spark, text, found, exact):
    docs = spark.createDataFrame([(1, text, 0)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, QUESTION, "z"), (8, "", "z"), (9, None, "z"), (10, "1 2 3", "z")], "item_id long, text string, doc_id string")
    got = decontam.matches(docs, items, block_hashes=4).collect()
    assert [(r["item_id"], r["exact"]) for r in got] == ([(7, exact)] if found else [])


def test_decontam_edges(spark):
    docs = spark.createDataFrame(h.edge_rows(), h.DOCS).withColumnRenamed("lang", "item_id")
    items = spark.createDataFrame([(1, h.prose(2, 30)), (2, "one two"), (None, h.prose(2, 30))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, items).collect()}
    assert got >= {(8, 2), (9, 2)}
    kept = decontam.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, *_ in h.edge_rows()} - {d for d, _ in got}
    for d, i in ((docs.limit(0), items), (docs, items.limit(0))):
        assert decontam.matches(d, i).count() == 0


@pytest.mark.parametrize("text, exact", [
    ("they say Calculate the sum of all prices paid by 3 buyers in the shop", True),
    ("they say Calculate the sum of all prices paid by 5 buyers in the shop", False),
    ("so Alice Calculate the sum of all prices paid by 5 buyers in the shop", False),
    ("they say Determine the sum of all prices paid by 5 buyers in the shop", None),
    ("calculate The Sum of all Prices paid by 3 buyers in the shop", True),
])
def test_decontam_middle_of_a_line_and_case(spark, text, exact):
    """An item of one window, after plain and capitalised words and in another case."""
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Calculate the sum of all prices paid by 3 buyers in the shop")], "item_id long, text string")
    assert [r["exact"] for r in decontam.matches(docs, items).collect()] == ([] if exact is None else [exact])


def test_decontam_items_of_few_literals(spark):
    """Numbers, units and names: a word-for-word copy is found, one with other values is not."""
    texts = {1: "1 kg 2 kg 3 kg 4 kg 5 kg 6 kg 7 kg 8 kg", 2: "The Old Man And The Sea By Ernest Hemingway Of Oak Park In Illinois"}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    rows = [(10 * i + k, v) for i, t in texts.items() for k, v in enumerate((t, "so they say " + t + " and more", t.replace("4", "9").replace("Sea", "Lake")))]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(10, 1), (11, 1), (20, 2), (21, 2)}


def test_decontam_short_items_are_whole_lines_or_sentences(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "What is 3?"), (3, "We counted the red birds over the old lake")], "item_id long, text string")
    rows = [(1, "oh yes it is"), (2, "oh\nYes\nit is"), (3, "so what is 4?"), (4, "What is 4?"), (5, "Now. What is 3? Well"), (6, "yes"),
            (7, "then We counted the red birds over the old lake again"), (8, "No. What is 3 and 4?")]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(2, 1), (5, 2), (6, 1), (7, 3)}


# Tool calls ----------------------------------------------------------------------------------------
TOOL = {"t": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}, "x": {}}, "additionalProperties": False}}


def _link(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, call_id string, position long, name string, arguments string").selectExpr("*", "1 AS status")
    r = spark.createDataFrame(results, "conv_id long, call_id string, position long, content string").selectExpr("*", "1 AS json")
    return chat.link(c, r, TOOL)


def test_calls_are_linked_ordered_and_checked(spark):
    use = lambda *ids: json.dumps({"n": 1, "x": [{"$result": i} for i in ids]})
    calls = [(1, "a", 0, "t", use("b")), (1, "b", 1, "t", '{"x": 2.0, "n": 1}'), (1, "c", 2, "t", use("a", "b")), (1, "d", 3, "t", use("e")), (1, "e", 4, "t", use("d")),
             (1, "b", 9, "t", "{}"), (2, "a", 0, "t", "{"), (2, "b", 1, "u", "{}"), (2, "c", 2, "t", '{"n": 0, "y": 1}'), (2, "z", 3, "t", use("q")),
             (None, "a", 0, "t", None), (3, None, 0, None, None), (4, "a", 0, "t", '{"n":1}'), (4, "a", 0, "t", '{"n":1}')]
    results = [(1, "a", 5, "ra"), (1, "b", 6, "rb"), (1, "b", 7, "later"), (2, "c", 5, None), (5, "a", 0, "lost"), (None, None, 0, "null")]
    got = _link(spark, calls, results).collect()
    by = {(r["conv_id"], r["call_id"], r["position"], r["status"]): r for r in got}
    assert Counter(r["status"] for r in got) == {"linked": 3, "no result": 7, "cycle": 2, "repeated": 3, "orphan": 2}
    assert [by[1, x, p, s]["place"] for x, p, s in (("b", 1, "linked"), ("a", 0, "linked"), ("c", 2, "no result"))] == [0, 1, 2]
    assert by[1, "b", 1, "linked"]["json"] == '{"arguments":{"n":1,"x":2},"id":"b","name":"t","result":"rb","status":"linked"}'
    assert by[2, "a", 0, "no result"]["errors"] == ["$: not JSON"] and not by[2, "b", 1, "no result"]["valid"]
    assert by[2, "c", 2, "linked"]["errors"] == ["$.n: beyond minimum 1", "$.y: not allowed"]
    assert by[2, "z", 3, "no result"]["errors"] == ["$: unknown call q"]
    assert by[1, "c", 2, "no result"]["valid"] and by[1, "d", 3, "cycle"]["place"] is None


def test_calls_edges(spark):
    assert _link(spark, [], []).count() == 0
    assert [r["status"] for r in _link(spark, [], [(1, "a", 0, "x")]).collect()] == ["orphan"]


def test_calls_of_all_conversations(spark):
    got = queries.queries()["op1_tool_calls"](spark, h.SF).collect()
    turns = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{h.SF}/conversations.parquet'").fetchall()
    role = {(c, t): (r, x) for c, t, r, x in turns}
    calls = {k for k, v in role.items() if v[0] == "assistant"}
    assert {(r["conv_id"], r["position"]) for r in got if r["name"]} == calls
    for r in got:
        answer = role.get((r["conv_id"], r["position"] + 1))
        if r["status"] == "linked":
            assert answer[0] == "user" and json.loads(r["json"])["result"] == answer[1]
        if r["name"]:
            value = json.loads(r["arguments"])
            assert value["text"] == role[r["conv_id"], r["position"]][1]
            assert r["arguments"] == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            assert r["valid"] == (not r["errors"])
    for conv in {r["conv_id"] for r in got}:
        own = sorted((r for r in got if r["conv_id"] == conv and r["layer"] is not None), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(len(own)))
        place = {r["call_id"]: r["place"] for r in own}
        for r in own:
            needs = chat.references(json.loads(r["arguments"]))
            assert all(place[n] < r["place"] for n in needs if n in place)


# Pipeline ------------------------------------------------------------------------------------------
def test_pipeline_equals_brute_force(spark):
    """Every stage on its own input, as the previous one kept it."""
    docs = duckdb.sql(f"SELECT * FROM '{h.SF}/documents.parquet'").fetchall()
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{h.SF}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.sql()}) WHERE kept").fetchall()}
    docs = [r for r in docs if r[0] in good]
    links = h.components([(r[0], r[1]) for r in docs])
    docs = [r for r in docs if links[r[0]][1] == r[0]]
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r[1]) for r in h.table("benchmark")]
    docs = [r for r in docs if not any(x in plain(r[1]) for x in items)]
    sizes = Counter()
    for r in docs:
        sizes[r[3]] += len(h.WORD.findall(r[1]))
    names = sorted(sizes)
    want = dict(zip(names, _targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes.values()))))

    out = corpus_pipeline.run(spark, h.SF)
    assert out.columns == [*columns, "_shard", "_slot"]
    rows = out.collect()
    by_id = {r[0]: r for r in docs}
    assert {tuple(r)[:5] for r in rows} <= set(by_id.values())
    uses = Counter(r["doc_id"] for r in rows)
    assert max(uses.values()) <= 2
    taken = Counter()
    for d, n in uses.items():
        taken[by_id[d][3]] += n * len(h.WORD.findall(by_id[d][1]))
    for s in names:
        assert abs(taken[s] - want[s]) <= max(len(h.WORD.findall(r[1])) for r in docs if r[3] == s)
    sizes = Counter(r["_shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(16))


def test_pipeline_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], h.DOCS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, h.SF)
        assert out.count() == 0 and out.columns[:5] == docs.columns
